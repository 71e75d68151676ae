"""Encoding and decoding with a sentencepiece vocabulary of the merge type.

The agenda holds adjacent symbol pairs in order of their scores. It is run for all new
units of an Arrow batch together: the best score is popped once, its leftmost live pair is
merged in every unit that holds one, and the pairs this makes are put on the agenda. Each
unit sees the same order as if it had an agenda of its own. What the agenda yields is
checked against the library before it is used.
"""

from __future__ import annotations

import hashlib
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vectrove.llm import units
from vectrove.llm.common import map_arrow, plain_texts, texts_of, tokenizer_file

PIECES = "piece_bpe_32k.model"
BLANK = "▁"
#: Chunks of text whose new units share an agenda.
AGENDA = 14


class Vocabulary:
    """Pieces, scores and the splits of each piece into two symbols."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        lib, size = self.library, self.library.get_piece_size()
        self.begin, self.end = lib.bos_id(), lib.eos_id()
        self.of_byte = [f"<0x{b:02X}>" for b in range(256)]
        self.of_byte = np.array([lib.piece_to_id(p) for p in self.of_byte], "<u4")
        normal = {
            lib.id_to_piece(i): i
            for i in range(size)
            if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i))
        }
        self.pieces = normal
        self.scores = np.array([lib.get_score(i) for i in range(size)])
        symbols = dict(normal)
        for c in sorted(set("".join(normal))):
            symbols.setdefault(c, len(symbols) + size)
        self.symbol_of = np.full(0x110000, -1, np.int64)
        for c, i in symbols.items():
            if len(c) == 1:
                self.symbol_of[ord(c)] = i
        self.width = np.int64(max(symbols.values()) + 1)
        splits = {
            symbols[p[:k]] * int(self.width) + symbols[p[k:]]: i
            for p, i in normal.items()
            for k in range(1, len(p))
            if p[:k] in symbols and p[k:] in symbols
        }
        self.splits = units.PairTable(np.array(list(splits), np.int64))
        self.merged = np.append(np.array(list(splits.values()), np.int64), -1)
        self.join = units.Joinable(list(normal))
        self.bytes_of = [b""] * size
        for p, i in normal.items():
            self.bytes_of[i] = p.replace(BLANK, " ").encode()
        for b, i in enumerate(self.of_byte.tolist()):
            self.bytes_of[i] = bytes([b])

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that two neighbouring symbols make, -1 for none."""
        known = (left >= 0) & (right >= 0)
        return np.where(known, self.merged[self.splits.find(left * self.width + right)], -1)


def agenda(new: list[str], vocab: Vocabulary) -> list[bytes]:
    """Ids of each unit (blanks already marked) as little-endian unsigned 32-bit integers."""
    lengths = np.array([len(u) for u in new], np.int64)
    codes = units.code_points("".join(new))
    n = len(codes)
    symbol = vocab.symbol_of[codes]
    owner = np.repeat(np.arange(len(new)), lengths)
    following = np.arange(1, n + 1)
    following[np.cumsum(lengths) - 1] = -1
    before = np.arange(-1, n - 1)
    before[np.cumsum(lengths) - lengths] = -1
    makes = np.full(n, -1, np.int64)
    inner = np.flatnonzero(following >= 0)
    makes[inner] = vocab.pair(symbol[inner], symbol[inner + 1])
    waiting: dict[int, list[np.ndarray]] = {}
    heap: list[tuple[float, int]] = []
    alive = np.ones(n, bool)

    def put(at: np.ndarray) -> None:
        kinds = makes[at]
        if len(at) > 1:
            order = np.argsort(kinds, kind="stable")
            at, kinds = at[order], kinds[order]
            cut = np.flatnonzero(kinds[1:] != kinds[:-1]) + 1
            groups = zip(kinds[np.append(0, cut)].tolist(), np.split(at, cut), strict=True)
        else:
            groups = [(int(kinds[0]), at)]
        for kind, places in groups:
            if kind in waiting:
                waiting[kind].append(places)
            else:
                waiting[kind] = [places]
                heapq.heappush(heap, (-vocab.scores[kind], kind))

    start = inner[makes[inner] >= 0]
    if len(start):
        put(start)
    while heap:
        _, piece = heapq.heappop(heap)
        lists = waiting.pop(piece)
        at = lists[0] if len(lists) == 1 else np.concatenate(lists)
        at = at[makes[at] == piece]
        if not len(at):
            continue
        if len(at) > 1:
            at = np.unique(at)
            mine = owner[at]
            first = np.append(True, mine[1:] != mine[:-1])
            if not first.all():  # the leftmost of a unit now, the others when it comes up again
                put(at[~first])
                at = at[first]
        gone = following[at]
        beyond = following[gone]
        symbol[at] = piece
        alive[gone] = False
        makes[gone] = -1
        makes[at] = -1
        following[at] = beyond
        more = beyond >= 0
        before[beyond[more]] = at[more]
        left = before[at]
        left = left[left >= 0]
        right = at[more]
        if len(left) + len(right):
            touched = np.concatenate([left, right])
            makes[touched] = vocab.pair(symbol[touched], symbol[following[touched]])
            touched = touched[makes[touched] >= 0]
            if len(touched):
                put(touched)
    kept = np.flatnonzero(alive)
    ids, mine, signs = symbol[kept], owner[kept], codes[kept]
    unknown = (ids < 0) | (ids >= len(vocab.scores))
    if unknown.any():  # a single sign without a piece becomes its bytes
        widths = np.ones(len(ids), np.int64)
        raw = [chr(c).encode() for c in signs[unknown].tolist()]
        widths[unknown] = [len(r) for r in raw]
        ids, mine = np.repeat(ids, widths), np.repeat(mine, widths)
        ids[np.repeat(unknown, widths)] = vocab.of_byte[np.frombuffer(b"".join(raw), np.uint8)]
    data = ids.astype("<u4").tobytes()
    ends = (4 * np.searchsorted(mine, np.arange(len(new)), side="right")).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def checked_agenda(new: list[str], vocab: Vocabulary) -> list[bytes]:
    """:func:`agenda`, compared with the library unit by unit."""
    got = agenda(new, vocab)
    # A line end joins with nothing, so what follows it is encoded on its own.
    wanted = vocab.library.encode(["\n" + u.replace(BLANK, " ") for u in new], num_threads=1)
    lead = len(vocab.library.encode("\n"))
    counts = [len(w) - lead for w in wanted]
    flat = np.fromiter((i for w in wanted for i in w[lead:]), "<u4", sum(counts)).tobytes()
    if counts != [len(g) // 4 for g in got] or flat != b"".join(got):
        raise ValueError("the agenda and the sentencepiece library differ")
    return got


@lru_cache(maxsize=2)
def _loaded(path: str, check: bool) -> tuple[Vocabulary, units.IdMemo]:
    vocab = Vocabulary(path)
    make = checked_agenda if check else agenda

    def compute(new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = make(new, vocab)
        return np.frombuffer(b"".join(found), "<u4"), np.array([len(x) // 4 for x in found], np.int64)

    return vocab, units.IdMemo(compute, _loaded.cache_clear)


def encode_texts(texts: list[str], path: str, check: bool = True):
    """Ids of each text without begin and end ids, as little-endian unsigned 32-bit integers."""
    vocab, memo = _loaded(path, check)
    marked = [BLANK + t.replace(" ", BLANK) if t else "" for t in texts]
    return units.joined(marked, lambda codes, _, cuts: vocab.join.starts(codes, cuts), memo, AGENDA)


def decode_ids(ids: bytes, path: str) -> bytes:
    """UTF-8 text of ids; the blank that encoding puts first is taken away again.

    Bytes that are not UTF-8 become U+FFFD; begin, end and other control ids give nothing.
    """
    vocab, _ = _loaded(path, True)
    text = b"".join(map(vocab.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))
    text = text[1:] if text.startswith(b" ") else text
    return text.decode("utf-8", "replace").encode()


def piece_tokens(docs: DataFrame, path: str | None = None, check: bool = True, with_ids: bool = False) -> DataFrame:
    """Ids of every document with begin and end ids, and the text they decode to, as digests.

    ``doc_id, n_tokens, ids_sha256, decoded_sha256``; ``with_ids`` adds ``ids`` and
    ``decoded`` themselves. ``check`` compares every different unit with the library. A null
    text is empty and has the begin and the end id; rows are treated one by one, repeated
    ones too; a null id stays null; other columns are ignored. One map over the table.
    """
    path = path or tokenizer_file(PIECES)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>, decoded string" if with_ids else ""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        vocab, _ = _loaded(path, check)
        begin, end = (np.array([i], "<u4").tobytes() for i in (vocab.begin, vocab.end))
        rows: list[list] = [[] for _ in range(5)]
        for body in encode_texts(texts_of(batch), path, check):
            ids = begin + body + end
            text = decode_ids(ids, path)
            rows[0].append(len(ids) // 4)
            rows[1].append(hashlib.sha256(ids).hexdigest())
            rows[2].append(hashlib.sha256(text).hexdigest())
            if with_ids:
                rows[3].append(np.frombuffer(ids, "<u4").astype(np.int32))
                rows[4].append(text.decode())
        columns = [batch.column("doc_id"), pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.string())]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if with_ids:
            columns += [pa.array(rows[3], pa.list_(pa.int32())), pa.array(rows[4], pa.string())]
            names += ["ids", "decoded"]
        return pa.RecordBatch.from_arrays(columns, names)

    return map_arrow(plain_texts(docs), run, schema, keep=True)
