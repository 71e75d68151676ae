"""N-gram Jaccard join with token-combination prefixes.

A document is its set of word shingles. All shingles have one order, rare ones first; which
are frequent is read off a sketch of fixed size that counts all shingles of all documents.
Any order and any choice of classes gives the same links; a good one gives few candidates.

Let ``e`` be how many of a set's ``n`` shingles a partner may lack. Two sets that link share
a shingle among the first ``e + 1`` of both, and ``g + 1`` among the first ``e + g + 1``. If
the first shared one is rare, it is indexed alone. If it is frequent, so are all that
follow, and with frequent shingles parted in ``g`` lots by their hash, two shared ones lie
in one lot; all pairs within a lot are indexed. ``g`` grows with the size, so a set has few
pairs, and every posting list of a frequent pair is short.

Candidates are verified on the sets themselves, after a bitmap of each set has shown that
they may differ little enough. A posting list is worked off from its smallest member first,
then from others, and only what this leaves in different components is compared pair by pair, so
a large group of copies costs its size, not its square, and no link between components is lost.
Two documents may share many lists; a pair becomes a row in the first of them, as far as the
smallest signatures of both, which rows carry, tell which that is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectrove.llm import units
from vectrove.llm.common import IdFilter, block_rows, discard, keep_repeated, parted, plain_texts, slices, stored, summed_blocks, texts_of, tidy
from vectrove.llm.graph import stored_components

#: Cells of the frequency sketch, and words of a folded bitmap.
CELLS, FOLDS = 1 << 20, 16
#: Signatures of a document that its rows carry where lists are compared pair by pair.
CARRIED = 8
_CELL_SHIFT, _BLOCK = np.uint64(44), 1 << 14
_STEP = [np.uint64(pow(0xD6E8FEB86659FD93, i, 1 << 64)) for i in range(64)]


def shingle_sets(texts: list[str], size: int) -> Iterator[np.ndarray]:
    """The distinct ``size``-word shingles of each text as sorted 64-bit hashes.

    Words are runs without ASCII white space, A-Z in lower case. A text of fewer words is one
    shingle; without words the set is empty.
    """
    units.release()
    for a, b in units.chunks(texts):
        lengths = np.array([len(t) + 1 for t in texts[a:b]], np.int64)
        codes = units.code_points(" ".join(texts[a:b]))
        codes = codes + np.where((codes >= 65) & (codes <= 90), 32, 0).astype(np.uint32)
        blank = (codes == 32) | (codes >= 9) & (codes <= 13)
        starts = np.flatnonzero(~blank & np.append(True, blank[:-1])) if len(codes) else np.zeros(0, np.int64)
        words = units.hashes(codes, starts, blank) if len(starts) else np.zeros(0, np.uint64)
        bounds = np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)])).tolist()
        if len(words) >= size:
            whole = words[: len(words) - size + 1] * _STEP[0]
            for i in range(1, size):
                whole = whole + words[i : len(words) - size + 1 + i] * _STEP[i]
            whole = units.mixed(whole)
        for first, end in zip(bounds, bounds[1:], strict=False):
            n = end - first
            if n >= size:
                yield np.unique(whole[first : end - size + 1])
            elif n:
                one = (words[first:end] * np.array(_STEP[:n], np.uint64)).sum(dtype=np.uint64) + np.uint64(n)
                yield units.mixed(np.array([one], np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def _digest(shingles: np.ndarray) -> tuple[int, int]:
    data = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
    return tuple(np.frombuffer(data, "<i8").tolist())


def most_missing(n: int, percent: int) -> int:
    """How many of ``n`` shingles a partner may lack: it has at least ``percent`` of the larger set."""
    return n - (percent * n + 99) // 100


def lots_of(level: int) -> int:
    """Lots of frequent shingles for sets of ``2 ** level`` shingles and more."""
    return max(1, (1 << level) // 8)


def signatures(shingles: np.ndarray, rank: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures, place in the order of the first shingle of each, and shared ones that may lie before.

    ``rank`` is 0 for rare shingles and rises with frequency.
    """
    n = len(shingles)
    e = most_missing(n, percent)
    order = np.lexsort((shingles, rank))
    ordered, rare = shingles[order], int(np.searchsorted(rank[order], 1))
    alone = ordered[: min(rare, e + 1)]
    found = [units.mixed(alone ^ np.uint64(0xA5A5))]
    places, before = [np.arange(len(alone))], [np.zeros(len(alone), np.int64)]
    top = n.bit_length() - 1
    least = (percent * n + 99) // 100
    for level in {top, max(0, least.bit_length() - 1)}:  # that of the smaller of two sets counts
        lots = lots_of(level)
        common = ordered[rare : e + lots + 1]
        if len(common) < 2:
            continue
        lot = (common >> np.uint64(7)) % np.uint64(lots)
        by = np.argsort(lot, kind="stable")
        for step in range(1, len(by)):
            same = lot[by[step:]] == lot[by[:-step]]
            if not same.any():
                break
            i, j = by[:-step][same], by[step:][same]
            found.append(units.mixed(common[i] * _STEP[1] + common[j] * _STEP[2] + np.uint64(level + 1)))
            places.append(rare + i)
            before.append(np.full(len(i), lots))
    return np.concatenate(found), np.concatenate(places), np.concatenate(before)


def _bitmap(shingles: np.ndarray) -> bytes:
    """Which classes an odd number of shingles falls in; there are some two classes a shingle.

    Sets differ in no less shingles than their bitmaps differ in classes, also after the
    larger bitmap is folded onto the smaller one.
    """
    bits = min(max((2 * len(shingles)).bit_length(), (64 * FOLDS).bit_length() - 1), 20)
    places = ((shingles >> np.uint64(20)) & np.uint64((1 << bits) - 1)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=1 << bits) & 1).astype(bool)).tobytes()


def _may_link(percent: int):
    """Of pairs ``a, b, both, x, y`` (sizes together, bitmaps) those whose bitmaps let them link, as ``a, b, far``.

    ``far`` is the share of their shingles in which they differ, as the bitmaps have it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, far = [], []
            for n, x, y in zip(batch.column("both").to_pylist(), batch.column("x"), batch.column("y"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint8) for v in (x, y))
                if len(x) < len(y):
                    x, y = y, x
                apart = np.bitwise_count(np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0) ^ y).sum()
                good.append((100 - percent) * n >= (100 + percent) * int(apart))
                far.append(int(apart) / n)
            out = batch.select(["a", "b"]).append_column("far", pa.array(far, pa.float64())).filter(pa.array(good, pa.bool_()))
            if out.num_rows:
                yield out

    return run


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose sets link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                at = np.searchsorted(y, x)
                both = int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(y) else 0
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            out = batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))
            if out.num_rows:
                yield out

    one = sets.select(F.col("e").alias("a"), F.col("data").alias("x"))
    two = sets.select(F.col("e").alias("b"), F.col("data").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(tidy(run), "a long, b long")


def once(sig: str, own: str, own2: str) -> F.Column:
    """False where two documents that share the signature share a smaller one for certain.

    ``own`` and ``own2`` are the smallest signatures of both, some or all. The least signature
    that two documents share always passes, so no pair is lost.
    """
    return F.coalesce(F.array_min(F.array_intersect(own, own2)) >= F.col(sig), F.lit(True))


def similar_documents(docs: DataFrame, size: int = 5, percent: int = 75, rounds: int = 3) -> DataFrame:
    """``doc_id, n_shingles, component_id``: documents linked when 100 * shared >= percent * all shingles.

    ``component_id`` is the smallest doc_id that links reach. A null text is empty; texts
    without words are linked with nothing, each its own component. Equal sets (copies, and
    texts that differ in case or white space) are one node of the join. Repeated rows come
    back repeated; a null id stays null, links like any other and is never a component's id
    unless there is no other; other columns are ignored. ``rounds`` (1 or more) rounds run before what is left is
    compared pair by pair; the number changes the cost alone.
    """
    docs = plain_texts(docs)

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CELLS, np.int64)
        for batch in slices(batches):
            n, e, check, bits, pile, held = [], [], [], [], [], 0
            for shingles in shingle_sets(texts_of(batch), size):
                n.append(len(shingles))
                one, two = _digest(shingles)
                e.append(one)
                check.append(two)
                bits.append(_bitmap(shingles))
                pile.append(shingles)
                held += len(shingles)
                if held > 500_000:
                    counts += np.bincount((np.concatenate(pile) >> _CELL_SHIFT).astype(np.int64), minlength=CELLS)
                    pile, held = [], 0
            if pile:
                counts += np.bincount((np.concatenate(pile) >> _CELL_SHIFT).astype(np.int64), minlength=CELLS)
            none = pa.nulls(len(n))
            maps = pa.array(bits, pa.binary())
            folded = np.stack([np.bitwise_xor.reduce(np.frombuffer(b, "<i8").reshape(-1, FOLDS), axis=0) for b in bits], 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(e, pa.int64()), pa.array(check, pa.int64()), maps, *map(pa.array, folded)]
                + [none.cast(t) for t in (pa.int32(), pa.int32(), pa.binary())],
                names,
            )
        blocks = block_rows(counts, _BLOCK)
        none = pa.nulls(blocks.num_rows)
        yield pa.RecordBatch.from_arrays(
            [none.cast(pa.int64())] * 4 + [none.cast(pa.binary())] + [none.cast(pa.int64())] * FOLDS + blocks.columns, names
        )

    folds = [f"f{i}" for i in range(FOLDS)]
    names = ["doc_id", "n", "e", "check", "bits", *folds, "block", "part", "data"]
    schema = f"doc_id long, n long, e long, check long, bits binary, {' long, '.join(folds)} long, block int, part int, data binary"
    seen = stored(docs.mapInArrow(tidy(survey), schema), "survey")
    ids = seen.where("block is null")
    blocks = summed_blocks(seen.where("block is not null").select("block", "part", "data"), lambda x: np.sum(x, 0), "<i8")
    counts = np.concatenate([blocks[i] for i in sorted(blocks)]) if blocks else np.zeros(CELLS, np.int64)
    # What other shingles add to a cell varies by the root of its mean, however many there are.
    frequent = counts.mean() + 6 * counts.mean() ** 0.5 + 8
    levels = np.clip(np.floor(np.log2(np.maximum(counts, 1) / frequent)) + 1, 0, 60).astype(np.uint8)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()  # copies within a task are indexed once
        for batch in slices(batches):
            columns: list[list[np.ndarray]] = [[] for _ in range(5)]
            rows = 0
            for shingles in shingle_sets(texts_of(batch), size):
                if len(shingles) < 2:
                    continue
                e = _digest(shingles)[0]
                if e in done:
                    continue
                if len(done) >= 500_000:
                    done.clear()
                done.add(e)
                sig, place, before = signatures(shingles, levels[shingles >> _CELL_SHIFT], percent)
                values = (sig.view(np.int64), np.full(len(sig), e), np.full(len(sig), len(shingles)), place, before)
                for column, value in zip(columns, values, strict=True):
                    column.append(value)
                rows += len(sig)
                if rows > 400_000:
                    yield _rows(columns)
                    columns, rows = [[] for _ in range(5)], 0
            if rows:
                yield _rows(columns)

    postings = docs.mapInArrow(tidy(index), "sig long, e long, n int, p int, g int").repartition("sig").sortWithinPartitions("sig", "e")
    first = {"e2": "e", "n2": "n", "p2": "p"}  # of each posting list, its smallest member
    shared = stored(
        postings.mapInArrow(tidy(keep_repeated(["sig"], ["e"], first)), "sig long, e long, n int, p int, g int, e2 long, n2 int, p2 int"), "shared"
    )
    # One document for each set, the smallest; its digest's second half tells sets from collisions.
    clash = F.when(F.min("check") != F.max("check"), F.raise_error(F.lit("two sets have one digest")))
    reps = ids.where("n > 0").groupBy("e").agg(F.min("doc_id").alias("doc_id"), clash.alias("clash"), *(F.first(c).alias(c) for c in ["bits", *folds]))
    wanted = shared.select("e").distinct().join(reps.where("clash is null"), "e")
    wanted = stored(wanted.select("e", "doc_id", "bits", *folds), "wanted")

    open_, tested, links, comps = shared, None, None, None
    done: list[DataFrame] = []  # tables of the rounds
    for turn in range(rounds + 1):
        if turn:  # lists that hold more than one component; of lists with the same members, one
            labelled = open_.select("sig", "e", "n").withColumn("c", F.col("e"))
            if comps is not None:
                labelled = labelled.drop("c").join(comps, "e", "left").withColumn("c", F.coalesce("c", "e"))
            members = F.count("e").alias("k"), F.sum(F.xxhash64("e").cast("decimal(20,0)")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "e")).alias("y")
            several = labelled.groupBy("sig").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), *members).where("lo < hi")
            several = several.groupBy("k", "x", "y").agg(F.min("sig").alias("sig")).select("sig")
            old, open_ = open_, stored(labelled.join(several, "sig"), "open")
            discard(old)
        small, large = F.least("n", "n2"), F.greatest("n", "n2")
        fits = 100 * small >= percent * large
        if not turn:  # against the first of each list
            reach = F.least("p", "p2", "g") + F.least(F.col("n") - F.col("p"), F.col("n2") - F.col("p2"))
            fits &= reach * (100 + percent) >= percent * (F.col("n") + F.col("n2"))
            joined = open_.withColumns({"c": F.col("e"), "c2": F.col("e2")})
        elif turn < rounds:  # against the first in another order
            other = F.struct(F.xxhash64("e", F.lit(turn)).alias("r"), "e", "n", "c")
            first_of = open_.groupBy("sig").agg(F.min(other).alias("o"))
            joined = open_.join(first_of.select("sig", *(F.col(f"o.{x}").alias(f"{x}2") for x in "enc")), "sig")
        else:
            # Folded bitmaps turn most pairs away before they become rows.
            own = open_.groupBy("e").agg(F.slice(F.sort_array(F.collect_set("sig")), 1, CARRIED).alias("own"))
            marked = open_.join(wanted.select("e", *folds).join(own, "e"), "e")
            others = marked.select(*(F.col(x).alias(f"{x}2") for x in ["sig", "e", "n", "c", "own"]), *(F.col(f).alias(f"other_{f}") for f in folds))
            apart = sum((F.bit_count(F.col(f).bitwiseXOR(F.col(f"other_{f}"))) for f in folds), F.lit(0))
            near = (100 - percent) * (F.col("n") + F.col("n2")) >= (100 + percent) * apart
            on = (F.col("sig") == F.col("sig2")) & (F.col("e") < F.col("e2")) & (F.col("c") != F.col("c2")) & fits & near & once("sig", "own", "own2")
            joined = marked.join(others, on)
        pairs = joined.where((F.col("c") != F.col("c2")) & fits)
        pairs = pairs.select(F.least("e", "e2").alias("a"), F.greatest("e", "e2").alias("b"), (F.col("n") + F.col("n2")).alias("both")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        one = wanted.select(F.col("e").alias("a"), F.col("bits").alias("x"))
        two = wanted.select(F.col("e").alias("b"), F.col("bits").alias("y"))
        pairs = pairs.join(one, "a").join(two, "b").select("a", "b", "both", "x", "y").mapInArrow(tidy(_may_link(percent)), "a long, b long, far double")
        if turn < rounds:  # one partner for each set is enough for now, the one that seems nearest
            pairs = pairs.groupBy("b").agg(F.min(F.struct("far", "a")).alias("o")).select(F.col("o.a").alias("a"), "b")
        pairs = stored(pairs.select("a", "b"), "pairs")
        done.append(pairs)
        if pairs.isEmpty():
            continue
        nodes = pairs.select(F.col("a").alias("e")).union(pairs.select(F.col("b").alias("e"))).distinct()
        nodes = stored(wanted.select("e", "doc_id").join(nodes, "e"), "nodes")
        good = stored(_verify(pairs, _fetch(docs, nodes, size), percent), "good")
        discard(nodes)
        tested = pairs if tested is None else tested.union(pairs)
        # Links of earlier rounds are stars by now.
        links = good if comps is None else good.union(comps.select(F.col("e").alias("a"), F.col("c").alias("b")))
        old, comps = comps, stored_components(links, "e", "c")
        discard(old, good)

    discard(open_, wanted, *done)
    named = ids.select("doc_id", "n", "e")
    named = named.withColumn("c", F.col("e")) if comps is None else named.join(comps, "e", "left").withColumn("c", F.coalesce("c", "e"))
    least = named.where("n > 0").groupBy("c").agg(F.min("doc_id").alias("component_id"))
    full = named.where("n > 0").join(least, "c").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    empty = named.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.union(empty)


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """The documents that have the smallest doc_id of their component, with all columns.

    Rows that repeat id and text stay once; rows without an id are left as they are.
    """
    found = stored(similar_documents(docs, size, percent), "similar").where("doc_id is not null")
    kept = found.where("doc_id = component_id").select("doc_id").distinct()
    repeated = found.groupBy("doc_id").agg(F.count("n_shingles").alias("n")).where("n > 1").select("doc_id")
    gone = found.where("doc_id <> component_id").select("doc_id").union(repeated)
    row = F.col("row")
    named = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"))
    touched, clear = parted(named, IdFilter(gone, "doc_id"), "doc_id")
    stay = touched.join(kept, "doc_id", "left_semi").withColumn("t", F.xxhash64(row["text"])).dropDuplicates(["doc_id", "t"])
    return stay.select("row.*").unionByName(clear.select("row.*"))


def _rows(columns: list[list[np.ndarray]]) -> pa.RecordBatch:
    sig, e, n, p, g = (np.concatenate(c) for c in columns)
    return pa.RecordBatch.from_arrays(
        [pa.array(sig), pa.array(e.astype(np.int64))] + [pa.array(x.astype(np.int32)) for x in (n, p, g)], ["sig", "e", "n", "p", "g"]
    )


def _fetch(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``e, data``: the sets of the documents in ``wanted(e, doc_id)``.

    A filter of their ids goes ahead of the join, so most other documents are not dealt out. A
    set that only rows without an id have is found by its digest alone.
    """
    wanted_ids = IdFilter(wanted, "doc_id")
    nameless = not wanted.where("doc_id is null").isEmpty()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            near = wanted_ids.may_hold(ids.fill_null(0).to_numpy())
            named = ids.is_valid().to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(np.where(named, near, nameless)))
            if batch.num_rows:
                data, e = [], []
                for shingles in shingle_sets(texts_of(batch), size):
                    data.append(shingles.tobytes())
                    e.append(_digest(shingles)[0])
                yield pa.RecordBatch.from_arrays([pa.array(e, pa.int64()), pa.array(data, pa.binary())], ["e", "data"])

    sets = docs.mapInArrow(tidy(run), "e long, data binary")
    return sets.join(wanted.select("e"), "e").groupBy("e").agg(F.first("data").alias("data"))
