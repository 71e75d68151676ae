"""Token counts and ids of a byte-level vocabulary.

:func:`count_tokens` is rank-synchronous array merging: the new pre-tokens of a batch are
held as one ragged numpy array, and in every round each sequence applies the pair of lowest
rank it holds, all sequences at once, until no sequence holds a pair that merges.
:func:`token_ids` asks the tokenizers library for the ids of each different pre-token.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vectrove.llm import units
from vectrove.llm.common import map_arrow, plain_texts, texts_of, tokenizer_file

BYTE_LEVEL = "byte_bpe_50k.json"
_NONE = np.int64(1) << np.int64(62)


@lru_cache(maxsize=1)
def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary.

    Printable Latin-1 signs stand for themselves; the others follow from U+0100 on, in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Merges:
    """The merge table of a vocabulary file: (left, right) -> rank and merged symbol."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        self.special = [t["content"] for t in model["added_tokens"]]
        vocab = model["model"]["vocab"]
        self.width = np.int64(max(vocab.values()) + 1)
        self.of_byte = np.zeros(256, np.int64)
        for sign, byte in byte_alphabet().items():
            self.of_byte[byte] = vocab[sign]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["model"]["merges"]]
        keys = np.array([vocab[a] * int(self.width) + vocab[b] for a, b in pairs], np.int64)
        merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        keep = np.append(True, np.diff(keys[order]) != 0)  # the first rank of a pair counts
        order = order[keep]
        self.keys, self.ranks, self.merged = keys[order], order.astype(np.int64), merged[order]
        self.find = units.PairTable(self.keys).find


def merged_lengths(pre_tokens: list[bytes], merges: Merges) -> np.ndarray:
    """How many symbols of each byte string survive the merges, worked out together."""
    lengths = np.array([len(t) for t in pre_tokens], np.int64)
    symbols = merges.of_byte[np.frombuffer(b"".join(pre_tokens), np.uint8)]
    owner = np.repeat(np.arange(len(pre_tokens)), lengths)
    counts = lengths.copy()
    pair = np.where(owner[1:] == owner[:-1], merges.find(symbols[:-1] * merges.width + symbols[1:]), -1)
    while True:
        rank = np.where(pair >= 0, merges.ranks[pair], _NONE)
        bounds = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        if not len(rank):
            return counts
        padded = np.append(rank, _NONE)
        lowest = np.minimum.reduceat(padded, bounds)
        active = lowest < _NONE
        if not active.any():
            return counts
        sizes = np.diff(np.append(bounds, len(owner)))
        # Sequences that are done leave the array.
        if not active.all():
            keep = np.repeat(active, sizes)
            bounds_kept = sizes[active]
            padded, owner, symbols = padded[keep], owner[keep], symbols[keep]
            lowest, sizes = lowest[active], bounds_kept
            pair_at = np.append(pair, -1)[keep]
        else:
            pair_at = np.append(pair, -1)
        hit = padded == np.repeat(lowest, sizes)
        # Of overlapping equal pairs (aaa) the left one merges: every second of a run of hits.
        runs = np.flatnonzero(hit & ~np.append(False, hit[:-1]))
        if hit.sum() != len(runs):
            at = np.flatnonzero(hit)
            run_start = runs[np.searchsorted(runs, at, side="right") - 1]
            hit[at[(at - run_start) % 2 == 1]] = False
        at = np.flatnonzero(hit)
        symbols[at] = merges.merged[pair_at[at]]
        np.subtract.at(counts, owner[at], 1)
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        fresh = np.zeros(len(symbols), bool)
        fresh[at] = True
        symbols, owner, pair_at, fresh = symbols[keep], owner[keep], pair_at[keep], fresh[keep]
        pair = pair_at[:-1].copy()
        changed = fresh[:-1] | fresh[1:]
        todo = np.flatnonzero(changed)
        same = owner[todo] == owner[todo + 1]
        pair[todo] = np.where(same, merges.find(symbols[todo] * merges.width + symbols[todo + 1]), -1)


@lru_cache(maxsize=4)
def _counter(path: str) -> tuple[units.Memo, Merges]:
    merges = Merges(path)
    special = set(merges.special)

    def compute(new: list[str]) -> list[int]:
        counts = merged_lengths([x.encode("utf-8", "surrogatepass") for x in new], merges)
        return [1 if x in special else n for x, n in zip(new, counts.tolist(), strict=True)]

    return units.Memo(compute, _counter.cache_clear), merges


def count_texts(texts: list[str], path: str) -> np.ndarray:
    """Number of tokens of each text, special strings found as the library finds them."""
    memo, merges = _counter(path)

    def starts(codes, text, cuts):
        return units.byte_level_starts(codes, text, cuts, merges.special)

    return units.counted(texts, starts, memo)


def count_tokens(docs: DataFrame, limit: int = 1024, path: str | None = None) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document.

    Counts equal the tokenizers library's for the byte-level file at ``path``, without added
    begin or end tokens. A null text is empty and has 0 tokens; a null id stays null; rows
    are treated one by one, so repeated rows give repeated results. Other columns are
    ignored. The work is one map over the table.
    """
    path = path or tokenizer_file(BYTE_LEVEL)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = texts_of(batch)
        counts = count_texts(texts, path)
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64()),
                pa.array(counts, pa.int64()),
                pa.array(counts > limit),
            ],
            ["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )

    return map_arrow(plain_texts(docs), run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean", keep=True)


@lru_cache(maxsize=4)
def _encoder(path: str) -> tuple[units.IdMemo, list[str]]:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    special = [t.content for t in library.get_added_tokens_decoder().values()]

    def compute(new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, counts = [], []
        for i in range(0, len(new), 2_000):
            some = new[i : i + 2_000]
            encoded = library.encode(some, is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(encoded.ids, "<u4"))
            counts.append(np.bincount(np.array(encoded.word_ids, np.int64), minlength=len(some)))
        return np.concatenate(ids), np.concatenate(counts)

    return units.IdMemo(compute, _encoder.cache_clear), special


def token_ids(texts: list[str], path: str):
    """The ids of each text as little-endian unsigned 32-bit integers, as the library gives them."""
    memo, special = _encoder(path)

    def starts(codes, text, cuts):
        return units.byte_level_starts(codes, text, cuts, special)

    return units.joined(texts, starts, memo)
