"""Packing token sequences into windows by Karmarkar-Karp multiway differencing.

Documents are cut into whole windows and small pieces while they are encoded. The pieces
are dealt by a hash into lots of about ``LOT`` windows, and each lot is partitioned on its
own: the partial partitions of largest imbalance are merged with their loads opposed until
one is left. If a window of it is over capacity, the lot gets one window more.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectrove.llm.common import map_arrow, plain_texts, stored, texts_of, tokenizer_file
from vectrove.llm.tokens import BYTE_LEVEL, token_ids

#: Windows of a lot: with more, less is lost to the last one; the work grows with its square.
LOT = 64


def cut_lengths(total: int, window: int, piece: int) -> list[int]:
    """Whole windows first, then what is left in near-equal pieces of at most ``piece``."""
    whole, rest = divmod(total, window)
    parts = -(-rest // piece)
    return [window] * whole + [rest // parts + (i < rest % parts) for i in range(parts)]


def document_pieces(
    docs: DataFrame, window: int = 2048, piece: int = 512, end_id: int = 1, path: str | None = None, keep: bool = True
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` of every piece of every document.

    A null text is empty: its one piece holds the end id. A null doc_id stays null. Rows are
    treated one by one, repeated ones too. Other columns are ignored. One map. Workers have the
    units they know from one task to the next if ``keep``.
    """
    path = path or tokenizer_file(BYTE_LEVEL)
    tail = np.array([end_id], "<u4").tobytes()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        owner, starts, lengths, sums, totals = [], [], [], [], []
        for i, body in enumerate(token_ids(texts_of(batch), path)):
            data = memoryview(body + tail)
            total, at = len(data) // 4, 0
            for length in cut_lengths(total, window, piece):
                owner.append(i)
                starts.append(at)
                lengths.append(length)
                sums.append(zlib.crc32(data[4 * at : 4 * (at + length)]))
                totals.append(total)
                at += length
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(owner, pa.int64()))]
            + [pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals)],
            ["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
        )

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    return map_arrow(plain_texts(docs), run, schema, keep)


def differenced(weights: list[int], ways: int) -> list[list[int]]:
    """Indices of ``weights`` in at most ``ways`` groups of near-equal sums.

    A partial partition is its loads, less the smallest, in falling order, with the groups
    that have them; ways it has not reached are empty.
    """
    heap = [(-w, i, [w], [[i]]) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    serial = len(weights)
    while len(heap) > 1:
        _, _, loads, groups = heapq.heappop(heap)
        _, _, other, others = heapq.heappop(heap)
        shared = len(loads) + len(other) - ways
        if shared > 0:  # the lightest of one side meet the heaviest of the other's last
            for k in range(shared):
                at = len(loads) - shared + k
                mate = len(other) - 1 - k
                loads[at] += other[mate]
                groups[at] = groups[at] + others[mate]
            other, others = other[: len(other) - shared], others[: len(others) - shared]
        loads, groups = loads + other, groups + others
        order = sorted(range(len(loads)), key=loads.__getitem__, reverse=True)
        base = loads[order[-1]] if len(loads) == ways else 0
        loads, groups = [loads[i] - base for i in order], [groups[i] for i in order]
        heapq.heappush(heap, (-loads[0] + (loads[-1] if len(loads) == ways else 0), serial, loads, groups))
        serial += 1
    return heap[0][3] if heap else []


def windows(weights: list[int], capacity: int) -> list[list[int]]:
    """The smallest number of windows from the lower bound up for which differencing fits."""
    ways = max(1, -(-sum(weights) // capacity))
    while True:
        groups = differenced(weights, ways)
        if all(sum(weights[i] for i in g) <= capacity for g in groups):
            return groups
        ways += 1


def pack_pieces(pieces: DataFrame, window: int = 2048, lot: int = LOT) -> DataFrame:
    """``sequence_id`` and ``offset`` for every piece; no window is over ``window`` tokens.

    A piece that fills a window is a sequence at once. The others go to lots of bounded size,
    whose number follows from the sum of their lengths, by a number that is stored with them
    and differs between repeated rows too, so no group grows with the input.
    """
    pieces = pieces.withColumn("_deal", F.xxhash64("doc_id", "start", "ids_crc32", F.monotonically_increasing_id()))
    pieces = stored(pieces, "pieces")
    small = pieces.where(F.col("length") < window)
    lots = max(1, -(-(small.agg(F.sum("length")).first()[0] or 0) // (lot * window)))
    dealt = small.withColumn("_lot", F.pmod("_deal", F.lit(lots))).drop("_deal")
    whole = pieces.where(F.col("length") >= window).drop("_deal")
    whole = whole.withColumn("sequence_id", F.monotonically_increasing_id() + F.lit(1 << 62)).withColumn("offset", F.lit(0).cast("long"))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "start", "ids_crc32"], kind="stable").reset_index(drop=True)
        lengths = rows["length"].to_numpy()
        slot, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for k, group in enumerate(windows(lengths.tolist(), window)):
            at = np.array(sorted(group), np.int64)
            slot[at] = k
            offset[at] = np.cumsum(lengths[at]) - lengths[at]
        rows["sequence_id"] = rows.pop("_lot").to_numpy(np.int64) * (1 << 32) + slot
        rows["offset"] = offset
        return rows

    schema = dealt.drop("_lot").schema.add("sequence_id", "long").add("offset", "long")
    return dealt.groupBy("_lot").applyInPandas(run, schema).unionByName(whole)


def pack_documents(
    docs: DataFrame, window: int = 2048, piece: int = 512, end_id: int = 1, path: str | None = None, keep: bool = True
) -> DataFrame:
    """All documents as pieces of sequences of at most ``window`` tokens.

    ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``: offsets are
    gapless from 0 in each sequence, and every id is in one piece. See
    :func:`document_pieces` for nulls, empty and repeated rows and for ``keep``; an empty table gives no rows.
    """
    return pack_pieces(document_pieces(docs, window, piece, end_id, path, keep), window)
