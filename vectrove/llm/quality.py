"""A quality classifier on random-indexing word vectors.

Every word has a fixed sparse ternary index vector, drawn from its hash. Its context vector
is the sum of the index vectors of the words beside it, over all documents: partial sums
per task, added up in two levels. A document is the mean of its words' context vectors
with a few shares of its text's form, and a two-layer network gives the probability that it
is good, sharpened or softened by one temperature that is fitted on rows kept from training.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectrove.llm import units
from vectrove.llm.common import map_arrow, plain_texts, slices, texts_of, tidy

#: Words are held in this many classes by their hash; a class is one row of the vectors.
WORDS = 1 << 14
DIMENSIONS = 64
NONZERO = 4
REACH = 2
BLOCK = 256
#: Shares of a text's form: see :func:`_shapes`.
SHAPES = 10
#: At most so many labelled rows train the network; they are drawn by a hash of doc_id.
SAMPLE = 20_000


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of every index vector."""
    rng = np.random.default_rng(20)
    places = np.argsort(rng.random((WORDS, DIMENSIONS)), axis=1)[:, :NONZERO]
    return places.astype(np.int64), rng.choice([-1.0, 1.0], (WORDS, NONZERO))


@dataclass
class Words:
    """The words of some texts: class of each, first word of each text, and the text's signs."""

    classes: np.ndarray
    bounds: np.ndarray  # of texts in ``classes``
    codes: np.ndarray
    kinds: np.ndarray
    signs: np.ndarray  # bounds of texts in ``codes``


def words_of(texts: list[str]) -> Iterator[Words]:
    units.release()
    for a, b in units.chunks(texts):
        text = "\n".join(texts[a:b])
        lengths = np.array([len(t) + 1 for t in texts[a:b]], np.int64)
        signs = np.concatenate([[0], np.cumsum(lengths)])
        signs[-1] -= 1
        codes = units.code_points(text)
        kinds = units.char_classes()[codes]
        blank = kinds == units.SPACE
        starts = np.flatnonzero(~blank & np.append(True, blank[:-1])) if len(codes) else np.zeros(0, np.int64)
        small = codes + np.where((codes >= 65) & (codes <= 90), 32, 0).astype(np.uint32)
        classes = (units.hashes(small, starts, blank) >> np.uint64(50)).astype(np.int64) if len(starts) else starts
        yield Words(classes, np.searchsorted(starts, signs), codes, kinds, signs)


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, 0, dtype=np.float64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def context_sums(docs: DataFrame) -> np.ndarray:
    """``WORDS x (DIMENSIONS + 1)``: summed context vectors and word counts over all documents.

    Each task sends one matrix in blocks, whatever it has read; two rounds of sums follow.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        places, signs = index_vectors()
        sums = np.zeros(WORDS * DIMENSIONS)
        counts = np.zeros(WORDS)
        for batch in slices(batches):
            for words in words_of(texts_of(batch)):
                c = words.classes
                counts += np.bincount(c, minlength=WORDS)
                owner = np.repeat(np.arange(len(words.bounds) - 1), np.diff(words.bounds))
                for step in range(1, REACH + 1):
                    near = np.flatnonzero(owner[step:] == owner[:-step])
                    left, right = c[near], c[near + step]
                    for of, to in ((left, right), (right, left)):
                        at = (of[:, None] * DIMENSIONS + places[to]).ravel()
                        sums += np.bincount(at, signs[to].ravel(), minlength=len(sums))
        whole = np.concatenate([sums.reshape(WORDS, DIMENSIONS), counts[:, None]], 1)
        blocks = [whole[i : i + BLOCK].astype("<f8").tobytes() for i in range(0, WORDS, BLOCK)]
        part = TaskContext.get().partitionId() % 64
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(blocks)), pa.int32()), pa.array([part] * len(blocks), pa.int32()), pa.array(blocks, pa.binary())],
            ["block", "part", "sums"],
        )

    def add(keys: list[str]):
        def total(rows: pd.DataFrame) -> pd.DataFrame:
            out = sum(np.frombuffer(x, "<f8") for x in rows["sums"])
            return rows[["block", "part"]].head(1).assign(sums=[out.tobytes()])

        return lambda df: df.groupBy(*keys).applyInPandas(total, "block int, part int, sums binary")

    sent = docs.select("text").mapInArrow(tidy(run), "block int, part int, sums binary")
    rows = add(["block"])(add(["block", "part"])(sent)).collect()
    out = np.zeros((WORDS // BLOCK, BLOCK, DIMENSIONS + 1))
    for row in rows:
        out[row.block] = np.frombuffer(row.sums, "<f8").reshape(BLOCK, -1)
    return out.reshape(WORDS, -1)


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """Unit context vectors, less their common part."""
    counts = sums[:, -1:]
    mean = sums[:, :-1] / np.maximum(counts, 1)
    mean -= (mean * counts).sum(0) / max(1.0, counts.sum())
    length = np.linalg.norm(mean, axis=1, keepdims=True)
    return (mean / np.where(length > 0, length, 1)).astype(np.float32)


def _shapes(words: Words) -> np.ndarray:
    """Per text: how long; mean word length; words equal to the one, two before; share of
    letters, numbers, other signs, capitals, line ends; words that hold neither letter nor number."""
    n_signs = np.maximum(np.diff(words.signs), 1)
    n_words = np.diff(words.bounds)
    some = np.maximum(n_words, 1)
    c, owner = words.classes, np.repeat(np.arange(len(n_words)), n_words)
    columns = [np.log1p(n_signs), n_signs / some / 10]
    for step in (1, 2):
        same = np.zeros(len(c))
        if len(c) > step:
            same[step:] = (c[step:] == c[:-step]) & (owner[step:] == owner[:-step])
        columns.append(_sums(same, words.bounds) / some)
    capital = (words.codes >= 65) & (words.codes <= 90)
    for mask in (words.kinds == units.LETTER, words.kinds == units.NUMBER, words.kinds == units.OTHER, capital, words.codes == 10):
        columns.append(_sums(mask, words.signs) / n_signs)
    solid = (words.kinds == units.LETTER) | (words.kinds == units.NUMBER)
    blank = words.kinds == units.SPACE
    starts = np.flatnonzero(~blank & np.append(True, blank[:-1])) if len(blank) else np.zeros(0, np.int64)
    bare = np.zeros(len(c))
    if len(starts):
        bare = (np.add.reduceat(solid.astype(np.int64), starts) == 0).astype(float)
    columns.append(_sums(bare, words.bounds) / some)
    return np.stack(columns, 1)


def features_of(texts: list[str], vectors: np.ndarray) -> np.ndarray:
    """Pooled word vectors and shapes, a row for each text; all zero but constants when empty."""
    rows = [np.zeros((0, DIMENSIONS + SHAPES))]
    for words in words_of(texts):
        pooled = np.zeros((len(words.bounds) - 1, DIMENSIONS))
        full = np.flatnonzero(np.diff(words.bounds) > 0)
        if len(full):
            sums = np.add.reduceat(vectors[words.classes], words.bounds[full], axis=0)
            pooled[full] = sums / np.diff(words.bounds)[full, None]
        rows.append(np.concatenate([pooled, _shapes(words)], 1))
    return np.concatenate(rows)


@dataclass
class Network:
    """Two dense layers over scaled features; ``temperature`` divides the last sum."""

    center: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh(np.clip((x - self.center) / self.scale, -8, 8) @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def fit_network(x: np.ndarray, y: np.ndarray, keep: np.ndarray, hidden: int = 32, epochs: int = 60, seed: int = 5) -> Network:
    """Adam on batches of 256 rows; rows marked in ``keep`` fit the temperature only."""
    rng = np.random.default_rng(seed)
    if not len(x):
        x, y, keep = np.zeros((1, DIMENSIONS + SHAPES)), np.ones(1), np.zeros(1, bool)
    train = np.flatnonzero(~keep) if (~keep).any() else np.arange(len(x))
    scale = x[train].std(0)
    net = Network(
        x[train].mean(0), np.where(scale > 1e-9, scale, 1.0), rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)),
        np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), 0.0,
    )
    z = np.clip((x - net.center) / net.scale, -8, 8)
    state = {name: [0.0, 0.0] for name in ("w1", "b1", "w2", "b2")}
    step = 0
    for epoch in range(epochs):
        rate = 3e-3 * (1 - epoch / epochs) + 1e-4
        for at in np.array_split(rng.permutation(train), max(1, len(train) // 256)):
            h = np.tanh(z[at] @ net.w1 + net.b1)
            error = (1 / (1 + np.exp(-np.clip(h @ net.w2 + net.b2, -40, 40))) - y[at]) / len(at)
            back = np.outer(error, net.w2) * (1 - h * h)
            grads = {"w2": h.T @ error + 1e-4 * net.w2, "b2": error.sum(), "w1": z[at].T @ back + 1e-4 * net.w1, "b1": back.sum(0)}
            step += 1
            for name, g in grads.items():
                m, v = state[name]
                state[name] = m, v = [0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g]
                setattr(net, name, getattr(net, name) - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8))
    if keep.any():
        sums, labels = net.logits(x[keep]), y[keep]
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
        loss = [np.mean(np.logaddexp(0, np.where(labels == 1, -sums, sums) / t)) for t in grid]
        net.temperature = float(grid[int(np.argmin(loss))])
    return net


def held_out(doc_id) -> F.Column:
    """Whether labels of a row are kept from all learning: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


@dataclass
class QualityModel:
    vectors: np.ndarray
    network: Network


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, label: str = "quality") -> QualityModel:
    """Word vectors from all documents, the network from at most ``sample`` labelled rows.

    Rows held out (:func:`held_out`), without a label of 0 or 1, or without text are not
    learnt from; of repeated labels of one id the larger counts, of its texts the one of
    smallest hash. A fifth of the sample fits
    the temperature. Without any labelled row every score is near one half.
    """
    docs = plain_texts(docs)
    vectors = word_vectors(context_sums(docs))
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
        .where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = features_of(texts_of(batch), vectors).astype(np.float32)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("y"), pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "y", "x"]
        )

    # The sample is bounded, so it may be broadcast. Rows that repeat an id are combined before they are exchanged.
    labelled = docs.join(F.broadcast(known), "doc_id").groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))
    rows = map_arrow(labelled, run, "doc_id long, y int, x binary").collect()
    rows.sort(key=lambda r: (zlib.crc32(b"order %d" % r.doc_id), r.x))
    x = np.array([np.frombuffer(r.x, np.float32) for r in rows], float).reshape(len(rows), DIMENSIONS + SHAPES)
    keep = np.arange(len(rows)) % 5 == 4
    return QualityModel(vectors, fit_network(x, np.array([float(r.y) for r in rows]), keep))


def column_scores(scores: Callable[[list[str]], np.ndarray]) -> Callable[[Iterator[pd.Series]], Iterator[pd.Series]]:
    """``scores`` over columns of texts, in a worker that is left small: see :func:`tidy`."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(scores([t or "" for t in texts]))

    return tidy(run)


def score_quality(docs: DataFrame, model: QualityModel, threshold: float = 0.3, keep_columns: bool = False) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document; one map over the table.

    A null text is empty; empty texts are scored like others, by what is known of them: no
    words and no signs. A null id stays null. Rows are treated one by one, repeated ones
    too. ``keep_columns`` returns the table's own columns with ``_score`` and
    ``_predicted`` instead.
    """
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((model.vectors, model.network))  # of fixed size

    def scores(texts: list[str]) -> np.ndarray:
        vectors, network = shared.value
        return network.score(features_of(texts, vectors))

    if keep_columns:

        @F.pandas_udf("double")
        def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            yield from column_scores(scores)(batches)

        scored = docs.withColumn("_score", score(F.coalesce(F.col("text"), F.lit(""))))
        return scored.withColumn("_predicted", (F.col("_score") >= threshold).cast("int"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        p = scores(texts_of(batch))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"]
        )

    out = map_arrow(plain_texts(docs), run, "doc_id long, score double, predicted int")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
