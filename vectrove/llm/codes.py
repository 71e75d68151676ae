"""Vector codes: each part of a vector is the number of its nearest codebook entry.

The nearest entry is found by a geometric near-neighbour access tree over a codebook's
entries. An inner node has split points; each of the others belongs to its nearest split
point, and for every split point and every child the node keeps the range of distances from
the one to the entries of the other. A query's distance to a split point, with the nearest
distance so far, rules out every child whose range it cannot meet. Ranges are rounded
outwards and only strict inequalities rule out, so a tie is never lost; distances that
decide are compared as integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectrove.llm.common import stored
from vectrove.llm.vectors import usual_length, whole

#: Grid steps of a unit, largest grid number; parts of a vector, entries of a codebook, rounds.
SCALE, BOUND, PARTS, ENTRIES, ROUNDS = 256, 1 << 26, 16, 64, 2
#: Split points of a node, entries of a leaf, rows that go down a tree together.
SPLITS, LEAF, ROWS = 8, 6, 8192
#: Labels whose sums may be broadcast.
LABELS = 100_000
_OUT = 1 + 2.0**-45


def _squares(rows: np.ndarray, entry: np.ndarray) -> np.ndarray:
    apart = rows - entry
    return np.einsum("ij,ij->i", apart, apart)


def _down(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64)) / _OUT


def _up(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64)) * _OUT


class AccessTree:
    """Nearest entry of integer rows, ties to the lower number; ``measured`` counts distances."""

    def __init__(self, entries: np.ndarray):
        self.entries = np.asarray(entries, np.int64)
        self.measured = 0
        self.root = self._grow(np.arange(len(entries)))

    def _grow(self, members: np.ndarray):
        if len(members) <= LEAF:
            return members
        points = self.entries[members]
        chosen = [0]
        nearest = _squares(points, points[0])
        while len(chosen) < SPLITS and nearest.max() > 0:
            chosen.append(int(nearest.argmax()))  # the farthest from those chosen
            nearest = np.minimum(nearest, _squares(points, points[chosen[-1]]))
        if len(chosen) == 1:  # copies of one entry: the first wins every tie
            return members[:1]
        apart = np.stack([_squares(points, points[c]) for c in chosen])
        owner = apart.argmin(0)
        owner[chosen] = np.arange(len(chosen))
        low, high = np.zeros((len(chosen), len(chosen))), np.zeros((len(chosen), len(chosen)))
        children = []
        for j in range(len(chosen)):
            inside = apart[:, owner == j]
            low[:, j], high[:, j] = _down(inside.min(1)), _up(inside.max(1))
            rest = np.flatnonzero((owner == j) & (np.arange(len(members)) != chosen[j]))
            children.append(self._grow(members[rest]) if len(rest) else None)
        return members[chosen], low, high, children

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``index, squared distance`` of each row's nearest entry."""
        index = np.zeros(len(rows), np.int64)
        best = np.full(len(rows), np.iinfo(np.int64).max)
        for first in range(0, len(rows), ROWS):
            part = slice(first, first + ROWS)
            self._visit(self.root, rows[part], np.arange(len(rows[part])), index[part], best[part])
        return index, best

    def _measure(self, entry: int, rows, at, index, best) -> np.ndarray:
        squares = _squares(rows[at], self.entries[entry])
        self.measured += len(at)
        better = (squares < best[at]) | ((squares == best[at]) & (entry < index[at]))
        found = at[better]
        best[found], index[found] = squares[better], entry
        return squares

    def _visit(self, node, rows, at, index, best) -> None:
        if isinstance(node, np.ndarray):
            for entry in node.tolist():
                self._measure(entry, rows, at, index, best)
            return
        splits, low, high, children = node
        alive = np.ones((len(at), len(splits)), bool)
        for i, entry in enumerate(splits.tolist()):
            some = np.flatnonzero(alive[:, i])
            if not len(some):
                continue
            squares = self._measure(entry, rows, at[some], index, best)
            reach = _up(best[at[some]])
            beyond = (_down(squares) - reach)[:, None] > high[i]
            before = (_up(squares) + reach)[:, None] < low[i]
            alive[some] &= ~(beyond | before)
        for j, child in enumerate(children):
            some = at[alive[:, j]]
            if child is not None and len(some):
                self._visit(child, rows, some, index, best)


@dataclass
class Codebooks:
    """``entries[part][entry]``: integer vectors; ``length`` is that of the vectors coded."""

    entries: np.ndarray
    length: int

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def assigned(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry numbers and squared distances, a column for each part."""
        parts = in_parts(x, len(self.entries))
        index, squares = np.zeros(parts.shape[:2], np.int64), np.zeros(parts.shape[:2], np.int64)
        for p, entries in enumerate(self.entries):
            index[:, p], squares[:, p] = AccessTree(entries).nearest(parts[:, p])
        return index, squares


def in_parts(x: np.ndarray, parts: int) -> np.ndarray:
    """Rows cut in equal consecutive parts; zeros fill up a length that they don't divide."""
    short = -x.shape[1] % parts
    return np.pad(x, ((0, 0), (0, short))).reshape(len(x), parts, -1)


def _sums(vectors: DataFrame, books: Codebooks) -> dict[tuple[int, int, int], int]:
    """``(part, entry, at) -> sum`` of the parts assigned to each entry; ``at`` -1 counts them."""
    shape = books.entries.shape
    width = shape[2] + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((shape[0] * shape[1], width), np.int64)
        for batch in batches:
            x = whole(batch.column(0), books.length, SCALE, BOUND)[1]
            index = books.assigned(x)[0] + np.arange(shape[0]) * shape[1]
            parts = in_parts(x, shape[0])
            order = np.argsort(index.ravel(), kind="stable")
            ranked = index.ravel()[order]
            first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(ranked) else np.zeros(0, np.int64)
            rows = np.concatenate([np.ones((len(ranked), 1), np.int64), parts.reshape(-1, shape[2])[order]], 1)
            if len(first):
                totals[ranked[first]] += np.add.reduceat(rows, first, axis=0)
        used = np.flatnonzero(totals[:, 0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used, width)), pa.array(np.tile(np.arange(width), len(used))), pa.array(totals[used].ravel())], ["entry", "at", "value"]
        )

    found = vectors.select(F.col("embedding").cast("array<double>")).mapInArrow(run, "entry long, at long, value long")
    rows = found.groupBy("entry", "at").agg(F.sum("value").alias("value")).collect()
    return {(r.entry // shape[1], r.entry % shape[1], r.at - 1): r.value for r in rows}


def fit_codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of integer entries, trained on all rows; None where no row can start one.

    Rows take part whose embedding is not null, has no null or non-finite component and has
    the length that most have (the smaller of equals). A component ``c`` becomes
    ``floor(256 * c)``, held within 2**26. A codebook starts as its part of the ``entries``
    smallest ids (an id that repeats counts once, with its smallest vector; null ids start
    nothing), fewer if there are fewer. In each round every part goes to its nearest entry,
    ties to the lower number, and an entry becomes the mean of its parts, rounded down; an
    unused one stays. Sums are made within tasks, then by entry; parts x entries x width
    numbers reach the driver.
    """
    length = usual_length(vectors.where("embedding is not null"), "embedding")
    if length <= 0:
        return None
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    sound = (F.size("v") == length) & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & sound)
    ids = [r.vec_id for r in rows.select("vec_id").distinct().orderBy("vec_id").limit(entries).collect()]
    if not ids:
        return None
    first = rows.where(F.col("vec_id").isin(ids)).groupBy("vec_id").agg(F.min("v").alias("v")).orderBy("vec_id").toArrow()
    x = whole(first.column("v").combine_chunks(), length, SCALE, BOUND)[1]
    books = Codebooks(in_parts(x, parts).transpose(1, 0, 2).copy(), length)
    for _ in range(rounds):
        sums = _sums(vectors, books)
        new = books.entries.copy()
        for (part, entry, at), value in sums.items():
            if at >= 0:
                new[part, entry, at] = value // sums[part, entry, -1]
        books = Codebooks(new, length)
    return books


def encode(vectors: DataFrame, books: Codebooks | None) -> DataFrame:
    """``vec_id, label, codes binary, error``: a byte for each part, and the squared distance over all parts.

    Rows that take no part (see :func:`fit_codebooks`) are left out; null ids and labels stay
    null, repeated rows come back repeated, other columns are ignored. One map.
    """
    kind = dict(vectors.dtypes)["label"]
    schema = f"vec_id long, label {kind}, codes binary, error long"
    if books is None:
        return vectors.sparkSession.createDataFrame([], schema)
    if len(books.entries[0]) > 256:
        raise ValueError("a code is one byte a part: no more than 256 entries")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits, x = whole(batch.column("v"), books.length, SCALE, BOUND)
            index, squares = books.assigned(x)
            data = index.astype(np.uint8).tobytes()
            codes = [data[i : i + index.shape[1]] for i in range(0, len(data), index.shape[1])]
            kept = [batch.column(c).filter(pa.array(fits)) for c in ("vec_id", "label")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(codes, pa.binary()), pa.array(squares.sum(1))], ["vec_id", "label", "codes", "error"])

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("v"))
    return rows.mapInArrow(run, schema)


def decode(coded: DataFrame, books: Codebooks) -> DataFrame:
    """``coded`` with ``embedding``: the vector of the entries that ``codes`` names, in the vectors' units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(batch.num_rows, len(books.entries))
            x = np.stack([books.entries[p][index[:, p]] for p in range(len(books.entries))], 1).reshape(len(index), -1)[:, : books.length]
            flat = pa.array((x / SCALE).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, books.length), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "embedding"])

    schema = ", ".join(f"`{n}` {t}" for n, t in coded.dtypes)
    return coded.mapInArrow(run, f"{schema}, embedding array<double>")


def coded_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every row that takes part.

    ``code`` has two hex digits a part; ``label_error`` is the error summed over rows of one
    label, rows without a label together. Rows as in :func:`encode`; empty tables give none.
    Errors are summed by label within tasks first; labels are joined back by broadcast up to
    a counted number of them, else by an ordinary join, of which Spark splits hot labels.
    """
    books = fit_codebooks(vectors)
    coded = stored(encode(vectors, books), "codes")
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    if books is not None and sums.count() <= LABELS:
        sums = F.broadcast(sums)
    out = coded.join(sums, F.col("label").eqNullSafe(F.col("_label")))
    digest = books.digest() if books is not None else None
    return out.select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(digest).cast("string").alias("codebooks_sha256"))
