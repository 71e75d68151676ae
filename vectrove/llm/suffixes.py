"""Removing long repeated byte strings by a distributed merge sort of suffixes.

Every string of ``length`` bytes holds an anchor: the ``GRAM``-byte piece of smallest hash
in it, leftmost of equals. Equal strings have their anchors at the same place, so it is
enough to sort the suffixes at anchors, and of those only the ones whose gram occurs twice.

A task sorts the suffixes of its texts into runs, one a shard, and front-codes them: each
entry is the length it shares with the one before and the bytes that follow. The runs are
exchanged, and a loser tree merges those of a shard. Its nodes know how much each loser
shares with the last winner, so a comparison starts there and often needs no byte at all.
The merged order comes with the length that neighbours share, which tells at once which
suffixes agree on any number of bytes; with a hash of what lies before the anchor, this
decides for every string around it whether it occurs again.

The places of one gram meet in one task there, so only grams of at most ``GROUP`` places are
sorted. Around a place of a commoner one, every string becomes a row with its 128-bit hash,
and an aggregate that tasks begin on their own rows tells which hashes occur again.
"""

from __future__ import annotations

import hashlib
import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectrove.llm import units
from vectrove.llm.common import IdFilter, discard, keep_repeated, parted, plain_texts, stored, tidy

#: Bytes of an anchor's gram; bytes scanned at a time; suffixes of a run and of a shard.
GRAM, SEGMENT, RUN, SHARD = 64, 1 << 19, 100_000, 100_000
#: Places of a gram that are sorted in one task; strings of a batch of hashes.
GROUP, STRINGS = 20_000, 50_000
#: Common grams that may be broadcast; powers that a scan needs: its pile is below two segments.
COMMON, POWERS = 1_000_000, 2 * SEGMENT + 1


def digest(data: bytes) -> tuple[int, int]:
    return tuple(np.frombuffer(hashlib.blake2b(data, digest_size=16).digest(), "<i8").tolist())


def anchors(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Text, place and gram hash of every anchor; texts shorter than ``length`` have none."""
    pile: list[tuple[int, int, bytes]] = []
    size = 0
    for i, text in enumerate(texts):
        for at in range(0, max(len(text) - length + 1, 0), SEGMENT - length + 1):
            piece = text[at : at + SEGMENT]
            pile.append((i, at, piece))
            size += len(piece)
            if size >= SEGMENT:
                yield _scan(pile, length)
                pile, size = [], 0
    if pile:
        yield _scan(pile, length)


def _scan(pile: list[tuple[int, int, bytes]], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(p for _, _, p in pile), np.uint8)
    sizes = np.array([len(p) for _, _, p in pile], np.int64)
    ends = np.cumsum(sizes)
    power, inverse = units.powers(POWERS)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(7)) * power[: len(data)], out=total[1:])
    grams = total[GRAM:] - total[:-GRAM]
    grams *= inverse[: len(grams)]
    grams = units.mixed(grams)
    # Low bits are the place, so that of equal grams in a window the leftmost is the smallest.
    value = grams >> np.uint64(21) << np.uint64(21)
    value |= np.arange(len(value), dtype=np.uint64)
    wide = length - GRAM + 1
    rows = -(-len(value) // wide)
    block = np.full(rows * wide, np.iinfo(np.uint64).max, np.uint64)
    block[: len(value)] = value
    block = block.reshape(rows, wide)
    ahead = np.minimum.accumulate(block, 1).reshape(-1)
    behind = np.minimum.accumulate(block[:, ::-1], 1)[:, ::-1].reshape(-1)
    n = len(value) - wide + 1
    least = np.minimum(behind[:n], ahead[wide - 1 : wide - 1 + n])
    inside = np.zeros(len(data) + 1, np.int64)
    np.add.at(inside, ends - sizes, 1)
    np.add.at(inside, np.maximum(ends - length + 1, ends - sizes), -1)
    valid = np.cumsum(inside)[:n] > 0  # the window lies in one text
    at = np.unique((least[valid] & np.uint64((1 << 21) - 1)).astype(np.int64))
    which = np.searchsorted(ends, at, side="right")
    text, first = np.array([p[0] for p in pile]), np.array([p[1] for p in pile])
    return text[which], first[which] + at - (ends - sizes)[which], grams[at].view(np.int64)


def shared_length(a: bytes, b: bytes, known: int) -> int:
    """How many first bytes are equal, of which ``known`` are known to be."""
    end = min(len(a), len(b))
    while known < end:
        step = min(32, end - known)
        x, y = a[known : known + step], b[known : known + step]
        if x == y:
            known += step
            continue
        differ = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
        return known + step - (differ.bit_length() + 7) // 8
    return end


def coded_run(entries: list[tuple[bytes, bytes, list[tuple[int, int]]]]) -> bytes:
    """Front-coded ``(suffix, what lies before, owners)``, sorted; equal ones become one."""
    entries.sort(key=lambda x: (x[0], x[1]))
    shared, rests, lefts, owners = [], [], [], []
    last = (None, None)
    for suffix, left, own in entries:
        if (suffix, left) == last:
            owners[-1] += own
            continue
        known = shared_length(last[0], suffix, 0) if shared else 0
        shared.append(known)
        rests.append(suffix[known:])
        lefts.append(left)
        owners.append(list(own))
        last = (suffix, left)
    counts = [len(x) for x in owners]
    flat = np.array([x for own in owners for x in own], np.int64).reshape(-1, 2)
    sizes = [np.array(x, np.int32) for x in (shared, [len(r) for r in rests], [len(x) for x in lefts], counts)]
    return pickle.dumps((sizes, b"".join(rests), b"".join(lefts), flat), protocol=5)


def decoded_run(data: bytes) -> Iterator[tuple[bytes, int, bytes, np.ndarray]]:
    """``suffix, length shared with the one before, what lies before, owners`` of a run."""
    (shared, rests, lefts, counts), rest, left, owners = pickle.loads(data)
    suffix, a, b, c = b"", 0, 0, 0
    for known, n, m, k in zip(shared.tolist(), rests.tolist(), lefts.tolist(), counts.tolist(), strict=True):
        suffix = suffix[:known] + rest[a : a + n]
        yield suffix, known, left[b : b + m], owners[c : c + k]
        a, b, c = a + n, b + m, c + k


def merged_runs(runs: list[Iterator[tuple]]) -> Iterator[tuple[int, tuple]]:
    """The entries of sorted runs in order, each with the length it shares with the one before.

    A loser tree. All that is left in it shares a known length with the last winner; of two,
    the one that shares more is smaller, and only equal lengths are compared, from there on.
    """
    leaves = 1 << max(0, (len(runs) - 1).bit_length())
    heads: list[tuple | None] = [next(r, None) for r in runs] + [None] * (leaves - len(runs))
    known = [0] * leaves
    loser = [-1] * leaves

    def play(i: int, j: int) -> tuple[int, int]:
        """Winner and loser; the loser's known length becomes the one shared with the winner."""
        x, y = heads[i], heads[j]
        if x is None:
            return j, i
        if y is None:
            return i, j
        if known[i] != known[j]:
            return (i, j) if known[i] > known[j] else (j, i)
        a, b = x[0], y[0]
        n = shared_length(a, b, known[i])
        if n == len(a) or n < len(b) and a[n] < b[n]:
            known[j] = n
            return i, j
        known[i] = n
        return j, i

    def start(node: int) -> int:
        if node >= leaves:
            return node - leaves
        win, lose = play(start(2 * node), start(2 * node + 1))
        loser[node] = lose
        return win

    top = start(1)
    while heads[top] is not None:
        entry = heads[top]
        yield known[top], entry
        heads[top] = nxt = next(runs[top], None) if top < len(runs) else None
        known[top] = nxt[1] if nxt is not None else 0
        node = (top + leaves) // 2
        while node:
            top, loser[node] = play(top, loser[node])
            node //= 2


def repeated_around(merged: list[tuple[int, tuple]], length: int) -> Iterator[tuple[int, int, int]]:
    """``text, first, end`` of bytes covered by strings that occur again.

    ``merged`` is a stretch of the merged order that no group of equal grams crosses.
    """
    reach = length - GRAM
    n = len(merged)
    common = np.array([m[0] for m in merged])
    common[0] = 0
    right = np.array([len(m[1][0]) for m in merged])
    left = np.array([len(m[1][2]) for m in merged])
    many = np.array([len(m[1][3]) > 1 for m in merged])
    behind = np.zeros((n, reach), np.uint8)  # byte before the anchor first
    for i, (_, entry) in enumerate(merged):
        if entry[2]:
            behind[i, : left[i]] = np.frombuffer(entry[2], np.uint8)[::-1]
    twice = np.zeros((n, reach + 1), bool)
    hashed = np.zeros(n, np.uint64)
    for o in range(reach + 1):
        if o:
            hashed = (hashed + behind[:, o - 1].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C55)
        fits = (left >= o) & (right >= length - o)
        segment = np.cumsum(common < length - o)
        twice[:, o] = fits & many
        # Only segments of two and more can hold an equal string.
        like = np.append(False, segment[1:] == segment[:-1])
        at = np.flatnonzero(fits & (like | np.append(like[1:], False)))
        if len(at) > 1:
            key = units.mixed(hashed[at] + segment[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            order = np.argsort(key, kind="stable")
            same = key[order][1:] == key[order][:-1]
            twice[at[order], o] |= np.append(same, False) | np.append(False, same)
    edge = np.diff(np.pad(twice, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, begin = np.nonzero(edge == 1)
    end = np.nonzero(edge == -1)[1]  # runs of places in the same order
    for i, a, b in zip(row.tolist(), begin.tolist(), end.tolist(), strict=True):
        for text, at in merged[i][1][3].tolist():
            yield text, at - (b - 1), at - a + length


def _merge_shard(blobs: list[bytes], length: int) -> Iterator[pa.RecordBatch]:
    def out(stretch: list) -> pa.RecordBatch:
        rows = np.array(list(repeated_around(stretch, length)), np.int64).reshape(-1, 3)
        return pa.RecordBatch.from_arrays([pa.array(rows[:, i]) for i in range(3)], ["e", "first", "last"])

    stretch: list = []
    for known, entry in merged_runs([decoded_run(b) for b in blobs]):
        if known < GRAM and len(stretch) >= 20_000:
            yield out(stretch)
            stretch = []
        stretch.append((known, entry))
    if stretch:
        yield out(stretch)


def string_hashes(data: bytes, places: list[int], length: int) -> Iterator[tuple[int, int, int]]:
    """``first, lo, hi``: the start and the 128-bit hash of every string that holds a gram at one of the places."""
    last = -1
    for at in sorted(places):
        first = max(last + 1, at - length + GRAM, 0)
        last = max(last, min(at, len(data) - length))
        for i in range(first, last + 1):
            yield i, *digest(data[i : i + length])


def _hashed_spans(sent: DataFrame, length: int) -> tuple[DataFrame, list[DataFrame]]:
    """``e, first, last`` of the strings around the places of ``sent(e, data, places)`` that occur again.

    The tables of the second are what it reads, to be discarded after.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, int, int, int]] = []

        def out() -> pa.RecordBatch:
            values = np.array(rows, np.int64)
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(values[:, i]) for i in range(4)], ["e", "first", "lo", "hi"])

        for batch in batches:
            for e, data, where in zip(*(batch.column(c) for c in ("e", "data", "places")), strict=True):
                name = e.as_py()
                for row in string_hashes(data.as_py(), where.as_py(), length):
                    rows.append((name, *row))
                    if len(rows) >= STRINGS:
                        yield out()
        if rows:
            yield out()

    strings = stored(sent.select("e", "data", "places").mapInArrow(tidy(hashed), "e long, first long, lo long, hi long"), "strings")
    place = F.struct("e", "first")
    # A row a hash and task is exchanged. It is stored, so that in the join Spark splits the rows of a common hash.
    again = strings.groupBy("lo", "hi").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a < b")
    again = stored(again.select("lo", "hi"), "again")
    found = strings.join(again.hint("merge"), ["lo", "hi"])
    return found.select("e", "first", (F.col("first") + F.lit(length)).alias("last")), [strings, again]


def repeated_spans(texts: DataFrame, length: int = 200) -> DataFrame:
    """``e, spans``: for each different text that has them, the bytes to remove.

    ``texts(text)`` may repeat. ``spans`` are sorted, apart from each other, ``first`` to
    ``last`` (exclusive). Texts that occur twice are left to the caller: all of them goes.
    """

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units.release()
        done: set[int] = set()
        for batch in batches:
            fresh, names = [], []
            for text in batch.column("text").to_pylist():
                data = text.encode()
                if len(data) >= length:
                    e = digest(data)[0]
                    if e not in done:
                        if len(done) >= 500_000:
                            done.clear()
                        done.add(e)
                        fresh.append(data)
                        names.append(e)
            owner = np.array(names, np.int64)
            for which, at, gram in anchors(fresh, length):
                yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(owner[which]), pa.array(at)], ["gram", "e", "at"])

    found = texts.mapInArrow(tidy(survey), "gram long, e long, at long")
    found = found.repartition("gram").sortWithinPartitions("gram", "e", "at")
    twice = stored(found.mapInArrow(tidy(keep_repeated(["gram"], ["e", "at"])), "gram long, e long, at long"), "anchors")
    # One of every GROUP rows at most; broadcast where they are few, else Spark joins and splits them.
    common = stored(twice.groupBy("gram").count().where(F.col("count") > GROUP).select("gram"), "common")
    few = F.broadcast(common) if common.count() <= COMMON else common
    sorted_, hashed = twice.join(few, "gram", "left_anti"), twice.join(few, "gram")
    total = sorted_.count()
    shards = max(1, -(-total // SHARD))

    def bodies(anchored: DataFrame) -> DataFrame:
        """``e, data, places``: the different texts that have these anchors."""
        wanted = IdFilter(anchored, "e")

        def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            done: set[int] = set()
            for batch in batches:
                data = [t.encode() for t in batch.column("text").to_pylist()]
                names = np.array([digest(t)[0] for t in data], np.int64)
                rows = []
                for i in np.flatnonzero(wanted.may_hold(names)).tolist():
                    if int(names[i]) not in done:
                        if len(done) >= 500_000:
                            done.clear()
                        done.add(int(names[i]))
                        rows.append(i)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(names[rows]), pa.array([data[i] for i in rows], pa.binary())], ["e", "data"])

        places = anchored.groupBy("e").agg(F.collect_list("at").alias("places"))  # of one text: no longer than it
        # A text that several tasks sent is taken once.
        sent = texts.mapInArrow(tidy(fetch), "e long, data binary").groupBy("e").agg(F.first("data").alias("data"))
        return sent.join(places, "e").select("e", "data", "places")

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lots: dict[int, list] = {}
        held = 0

        def flush() -> pa.RecordBatch:
            blobs = [coded_run(x) for x in lots.values()]
            out = pa.RecordBatch.from_arrays([pa.array(list(lots), pa.int64()), pa.array(blobs, pa.binary())], ["shard", "run"])
            lots.clear()
            return out

        for batch in batches:
            for e, data, where in zip(
                batch.column("e").to_pylist(), batch.column("data").to_pylist(), batch.column("places").to_pylist(), strict=True
            ):
                for at in set(where):
                    suffix = data[at : at + length]
                    entry = (suffix, data[max(0, at - length + GRAM) : at], [(e, at)])
                    lots.setdefault(zlib.crc32(suffix[:GRAM]) % shards, []).append(entry)
                    held += 1
                    if held >= RUN:
                        yield flush()
                        held = 0
        if held:
            yield flush()

    runs = bodies(sorted_).mapInArrow(tidy(sort), "shard long, run binary")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blobs = None, []
        for batch in batches:
            for shard, run in zip(batch.column("shard").to_pylist(), batch.column("run").to_pylist(), strict=True):
                if shard != now and blobs:
                    yield from _merge_shard(blobs, length)
                    blobs = []
                now = shard
                blobs.append(run)
        if blobs:
            yield from _merge_shard(blobs, length)

    spans = runs.repartition("shard").sortWithinPartitions("shard").mapInArrow(tidy(merge), "e long, first long, last long")
    read: list[DataFrame] = []
    if not common.isEmpty():
        more, read = _hashed_spans(bodies(hashed), length)
        spans = spans.union(more)

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Overlapping and touching spans of a text become one; rows come sorted."""
        now: list[int] | None = None
        for batch in batches:
            rows = []
            for e, a, b in zip(*(batch.column(c).to_pylist() for c in ("e", "first", "last")), strict=True):
                if now is not None and now[0] == e and a <= now[2]:
                    now[2] = max(now[2], b)
                else:
                    if now is not None:
                        rows.append(now)
                    now = [e, a, b]
            yield _span_rows(rows)
        if now is not None:
            yield _span_rows([now])

    whole = spans.repartition("e").sortWithinPartitions("e", "first", "last").mapInArrow(tidy(unite), "e long, first long, last long")
    out = stored(whole.groupBy("e").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("spans")), "spans")
    discard(twice, common, *read)
    return out


def _span_rows(rows: list[list[int]]) -> pa.RecordBatch:
    values = np.array(rows, np.int64).reshape(-1, 3)
    return pa.RecordBatch.from_arrays([pa.array(values[:, i]) for i in range(3)], ["e", "first", "last"])


def remove_repeats(docs: DataFrame, length: int = 200, keep_columns: bool = False) -> DataFrame:
    """Every byte goes that a ``length``-byte string covers which also starts elsewhere.

    Strings are judged on the input, matches never cross documents, repeats in one document
    count. Returns ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, or with
    ``keep_columns`` the table's own columns, with ``text`` cut (a character that a cut splits is dropped) and
    ``n_removed`` added as ``_removed``. Null text is empty; a null doc_id stays; repeated rows
    are copies of each other, so all of them go where they are long enough.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, checks = zip(*(digest((t or "").encode()) for t in batch.column("text").to_pylist()), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(checks, pa.int64())], ["e", "check"])

    texts = docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text"))
    spans = repeated_spans(texts, length)
    copies = texts.mapInArrow(tidy(split), "e long, check long").groupBy("e").agg(
        F.count("e").alias("n"), F.min("check").alias("lo"), F.max("check").alias("hi")
    )
    copies = copies.where("n > 1").select(
        "e", F.when(F.col("lo") != F.col("hi"), F.raise_error(F.lit("two texts have one digest"))).otherwise(F.lit(True)).alias("copied")
    )
    verdict = stored(spans.join(copies, "e", "full"), "verdict")
    discard(spans)
    cut = IdFilter(verdict.where("spans is not null and copied is null"), "e")

    def prepare(texts: list[str]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
        data = [t.encode() for t in texts]
        names = np.array([digest(t)[0] for t in data], np.int64)
        return names, data, cut.may_hold(names) if len(names) else np.zeros(0, bool)

    def outcome(data: bytes | None, n_bytes: int, spans, copied) -> tuple[int, int, bytes | None]:
        """Bytes and spans removed, and what is kept (None: everything)."""
        if copied:
            return (n_bytes, 1, b"") if n_bytes >= length else (0, 0, None)
        if spans is None or not len(spans):
            return 0, 0, None
        ends = [0, *(x for s in spans for x in (s["first"], s["last"])), n_bytes]
        kept = b"".join(data[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True))
        return n_bytes - len(kept), len(spans), kept

    if keep_columns:
        # The text travels with its row here, as it has to come back cut.
        name = F.pandas_udf(lambda t: t.map(lambda x: digest((x or "").encode())[0]).astype("int64"), "long")

        @F.pandas_udf("text string, removed long")
        def clean(text, spans, copied):
            import pandas as pd

            out = []
            for t, s, c in zip(text, spans, copied, strict=True):
                data = (t or "").encode()
                removed, _, kept = outcome(data, len(data), s, bool(c) if c is not None else False)
                out.append((t if kept is None else kept.decode("utf-8", "ignore"), removed))
            return pd.DataFrame(out, columns=["text", "removed"])

        named = docs.select(F.struct(*docs.columns).alias("row"), name("text").alias("e"))
        touched, clear = parted(named, IdFilter(verdict, "e"), "e")
        done = touched.join(verdict, "e", "left").withColumn("cut", clean("row.text", "spans", "copied"))
        own = [c for c in docs.columns if c != "_removed"]
        cut_rows = done.select(
            *(F.col("cut.text").alias("text") if c == "text" else F.col("row")[c].alias(c) for c in own), F.col("cut.removed").alias("_removed")
        )
        return cut_rows.union(clear.select(*(F.col("row")[c].alias(c) for c in own), F.lit(0).cast("long").alias("_removed")))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, data, hit = prepare(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(names),
                    pa.array([len(t) for t in data], pa.int64()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in data], pa.string()),
                    pa.array([t if h else None for t, h in zip(data, hit.tolist(), strict=True)], pa.binary()),
                ],
                ["doc_id", "e", "n_bytes", "sha", "data"],
            )

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, count, sums = [], [], []
            for n, sha, data, s, c in zip(*(batch.column(x).to_pylist() for x in ("n_bytes", "sha", "data", "spans", "copied")), strict=True):
                gone, parts, kept = outcome(data, n, s, c)
                removed.append(gone)
                count.append(parts)
                sums.append(sha if kept is None else hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(sums, pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    rows = plain_texts(docs).mapInArrow(tidy(first), "doc_id long, e long, n_bytes long, sha string, data binary")
    joined = rows.join(verdict, "e", "left").select("doc_id", "n_bytes", "sha", "data", "spans", "copied")
    return joined.mapInArrow(tidy(second), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
