"""Token counts, ids, sentencepiece, records and packing against the libraries."""

import hashlib
import random
import zlib

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vectrove.llm import packing, pieces, records, tokens, units
from vectrove.llm.common import scratch, tokenizer_file

BYTE, PIECE = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
LIBRARY = Tokenizer.from_file(BYTE)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def odd():
    draw = random.Random(1)
    signs = list(" \n\t'’sSrelvtmd.,!<|>a1²é漢　\xa0\x85\x1c​٣Ⅷ🙂\r▁")
    signs += ["  ", "'re", "'s", "<|endoftext|>", " '", "''", "aaaa", "<s>", "</s>", "<0x0A>", "the", "ing"]
    some = ["".join(draw.choice(signs) for _ in range(draw.randint(0, 40))) for _ in range(1500)]
    return some + ["", "a" * 5000, " " * 300, "\n\n x", "'", "'s", " 's"]


def test_ids_and_counts_are_the_librarys(odd):
    want = [ids_of(t) for t in odd]
    assert [np.frombuffer(x, "<u4").tolist() for x in tokens.token_ids(odd, BYTE)] == want
    assert tokens.count_texts(odd, BYTE).tolist() == [len(w) for w in want]


def test_every_character(odd):
    signs = "".join(map(chr, [*range(1, 0xD800, 7), *range(0xE000, 0x20000, 11)]))
    texts = [f"a{c}b {c}" for c in signs]
    assert tokens.count_texts(texts, BYTE).tolist() == [len(ids_of(t)) for t in texts]


def test_memo_limit_does_not_change_results(odd, monkeypatch):
    memo = units.Memo(lambda new: [len(x) for x in new], lambda: None, limit=5)
    cuts = units.counted(odd, lambda codes, text, cuts: units.byte_level_starts(codes, text, cuts, []), memo)
    assert cuts.tolist() == [len(t) for t in odd]


def test_pieces_are_the_librarys(odd):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    want = library.encode(odd, num_threads=1)
    assert [np.frombuffer(x, "<u4").tolist() for x in pieces.encode_texts(odd, PIECE)] == want
    for ids in want:
        ids = [1, *ids, 2]
        assert pieces.decode_ids(np.array(ids, "<u4").tobytes(), PIECE).decode() == library.decode(ids)


def test_count_tokens(docs, no_docs, rows):
    got = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.count_tokens(docs).collect()}
    want = {(d, len((t or "").encode()), len(ids_of(t)), len(ids_of(t)) > 1024) for d, t in rows}
    assert got == want and any(w[3] for w in want)
    assert tokens.count_tokens(docs).count() == len(rows)
    assert tokens.count_tokens(no_docs).collect() == []


def test_piece_tokens(docs, no_docs, rows):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    got = sorted(map(tuple, pieces.piece_tokens(docs).collect()), key=repr)
    want = []
    for d, t in rows:
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        digests = [hashlib.sha256(x).hexdigest() for x in (np.array(ids, "<u4").tobytes(), library.decode(ids).encode())]
        want.append((d, len(ids), *digests))
    assert got == sorted(want, key=repr)
    assert pieces.piece_tokens(no_docs).collect() == []
    full = pieces.piece_tokens(docs.where("doc_id = 10"), with_ids=True).first()
    assert full.decoded == rows[10][1].replace("▁", " ") and full.ids[0] == 1 and full.ids[-1] == 2


def test_records_round_trip(spark, docs, rows):
    root = scratch(spark, "records")
    known = docs.where("doc_id is not null")
    files = records.write_token_records(known, root)
    assert files.agg(F.sum("n_records")).first()[0] == len(rows) - 1
    index = records.record_index(spark, root)
    got = {r.doc_id: r for r in records.read_token_records(index.orderBy(F.rand(3)), root).collect()}
    at = 0
    for d, t in sorted(((d, t) for d, t in rows if d is not None), key=lambda r: r[0]):
        ids = [*ids_of(t), 2]
        assert got[d].ids == ids and got[d].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        if d != 20:  # there twice
            assert got[d].start == at
        at += len(ids)


def test_records_of_nothing_and_of_a_null_id(spark, docs, no_docs):
    root = scratch(spark, "records")
    records.write_token_records(no_docs, root)
    assert records.read_token_records(records.record_index(spark, root), root).collect() == []


def test_records_without_an_id_come_first(spark, docs, rows):
    root = scratch(spark, "records")
    records.write_token_records(docs, root)
    got = sorted(records.read_token_records(records.record_index(spark, root), root).collect(), key=lambda r: r.start)
    assert len(got) == len(rows) and got[0].doc_id is None and [r.doc_id for r in got[1:]] == sorted(d for d, _ in rows if d is not None)
    assert got[0].ids == [*ids_of(rows[-1][1]), 2]
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:i]) for i in range(len(got))]


def morse(a, b, n=1024):
    return "".join(a if bin(i).count("1") % 2 == 0 else b for i in range(n))


#: Texts whose sums of powers of one multiplier agree modulo 2**64.
TWINS = [morse("a", "b"), morse("b", "a")]


def test_texts_that_agree_in_powers_are_told_apart():
    codes = units.code_points("".join(TWINS))
    assert len(set(units.hashes(codes, np.array([0, 1024])).tolist())) == 2
    assert tokens.count_texts(TWINS, BYTE).tolist() == [len(ids_of(t)) for t in TWINS]
    assert [np.frombuffer(x, "<u4").tolist() for x in tokens.token_ids(TWINS, BYTE)] == [ids_of(t) for t in TWINS]
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    assert [np.frombuffer(x, "<u4").tolist() for x in pieces.encode_texts(TWINS, PIECE)] == library.encode(TWINS)


def test_units_that_share_a_hash_are_told_apart(odd, monkeypatch):
    monkeypatch.setattr(units, "hashes", lambda codes, starts, skip=None: codes[starts].astype(np.uint64) % np.uint64(7))
    assert [np.frombuffer(x, "<u4").tolist() for x in tokens.token_ids(odd, BYTE)] == [ids_of(t) for t in odd]


def test_a_worker_keeps_one_memo():
    gone = []
    one, two = (units.Memo(lambda new: [len(x) for x in new], lambda i=i: gone.append(i)) for i in range(2))
    for memo in (one, two, two):
        assert units.counted(["ab cd"], lambda codes, text, cuts: np.arange(len(codes)) % 2 == 0, memo).tolist() == [5]
    assert gone == [0] and not one.young and two.young
    units.release()
    assert gone == [0, 1] and not two.young


def test_texts_longer_than_a_chunk():
    draw = random.Random(8)
    words = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(1, 9))) for _ in range(4000)]
    long = " ".join(draw.choice(words) for _ in range(150_000))
    assert len(long) > units.CHUNK
    texts = [long, "x", long[::-1], "y" * 700_000]
    assert tokens.count_texts(texts, BYTE).tolist() == [len(ids_of(t)) for t in texts]
    assert [len(x) // 4 for x in tokens.token_ids(texts, BYTE)] == [len(ids_of(t)) for t in texts]


def test_whole_windows_need_no_group(make, monkeypatch):
    monkeypatch.setattr(packing, "windows", lambda weights, capacity: [[i] for i in range(len(weights))])
    pieces_ = make([(i, ("the " * 4095).strip()) for i in range(30)])
    got = packing.pack_documents(pieces_).collect()
    assert len(got) == 60 and {(r.length, r.offset) for r in got} == {(2048, 0)} and len({r.sequence_id for r in got}) == 60


def test_no_lot_is_larger_than_its_share(spark, monkeypatch):
    monkeypatch.setattr(packing, "windows", lambda weights, capacity: [[i] for i in range(len(weights))])
    same = spark.range(4000).selectExpr("1L as doc_id", "0L as start", "500L as length", "9L as ids_crc32", "500L as doc_tokens")
    got = packing.pack_pieces(same, lot=16).selectExpr("sequence_id >> 32 as lot").groupBy("lot").count().collect()
    assert len(got) == 62 and max(r["count"] for r in got) < 2.5 * 4000 / 62


def test_damage_is_found():
    data = bytearray(records.frame(b"payload"))
    assert bytes(records.payload_of(memoryview(bytes(data)))) == b"payload"
    for at in (0, 9, 14, len(data) - 1):
        bad = bytearray(data)
        bad[at] ^= 1
        with pytest.raises(ValueError, match="damaged"):
            records.payload_of(memoryview(bytes(bad)))


def test_packing(docs, no_docs, rows):
    got = packing.pack_documents(docs).collect()
    ids = {}
    for d, t in rows:
        ids.setdefault(d, [*ids_of(t), 1])
    parts, sequences = {}, {}
    for r in got:
        assert r.doc_tokens == len(ids[r.doc_id])
        assert zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32
        parts.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for d, spans in parts.items():
        spans = sorted(spans) if d != 20 else sorted(set(spans))
        assert [a for a, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))]
        assert sum(n for _, n in spans) == len(ids[d])
    for spans in sequences.values():
        spans.sort()
        assert [a for a, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))]
        assert sum(n for _, n in spans) <= 2048
    assert packing.pack_documents(no_docs).collect() == []


def test_differencing_balances_and_fits():
    draw = random.Random(4)
    for _ in range(20):
        weights = [draw.randint(1, 512) for _ in range(draw.randint(1, 300))]
        groups = packing.windows(weights, 2048)
        assert sorted(i for g in groups for i in g) == list(range(len(weights)))
        loads = [sum(weights[i] for i in g) for g in groups]
        assert max(loads) <= 2048 and len(groups) <= -(-sum(weights) // 2048) + 1
        if len(weights) > 100:
            assert max(loads) - min(loads) <= 64
    assert packing.windows([], 2048) == []
    assert packing.differenced([4, 5, 6, 7, 8], 2) and packing.windows([2048, 2048], 2048) == [[0], [1]]


def test_a_task_gives_back_what_earlier_ones_freed(spark, monkeypatch):
    from vectrove.llm import common, units

    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    run, given = [], []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, fn, *rest, **kw: run.append(fn))
    monkeypatch.setattr(units, "give_back", lambda: given.append(1))
    common.map_arrow(docs, lambda batch: batch, "doc_id long, text string")
    assert [b.num_rows for b in run[0](iter(docs.toArrow().to_batches()))] == [1] and given == [1]


def test_held_units_are_small():
    import tracemalloc

    words = ["".join(chr(97 + i // 26**k % 26) for k in range(4)) for i in range(7, 60_007)]
    list(tokens.token_ids(["a b"], BYTE))
    memo = tokens._encoder(BYTE)[0]
    memo.clear()
    tracemalloc.start()
    got = [np.frombuffer(x, "<u4").tolist() for x in tokens.token_ids(words[:100], BYTE)]
    assert got == [ids_of(w) for w in words[:100]]
    before = tracemalloc.get_traced_memory()[0]
    n = len(memo.young)
    for _ in tokens.token_ids([" ".join(words)], BYTE):
        pass
    grown, held = tracemalloc.get_traced_memory()[0] - before, len(memo.young) - n
    tracemalloc.stop()
    memo.clear()
    assert held > 59_000 and grown < 120 * held


def test_array_memo_tells_units_of_one_hash_apart_and_computes_each_once(monkeypatch):
    asked = []

    def compute(new):
        asked.extend(new)
        return np.concatenate([units.code_points(x) for x in new]), np.array([len(x) for x in new])

    def words(codes, text, cuts):
        start = np.append(True, codes[:-1] == 32)
        start[cuts] = True
        return start

    monkeypatch.setattr(units, "CHUNK", 4)
    memo = units.IdMemo(compute, lambda: None)

    def back(texts):
        return [np.frombuffer(x, "<u4").tobytes().decode("utf-32-le") for x in units.joined(texts, words, memo, 4)]

    texts = ["ab ", "", "cd ", "ab ", "ef ", "ab ", "x" * 300, "cd "]
    assert back(texts) == texts and sorted(asked) == ["ab ", "cd ", "ef ", "x" * 300]
    assert back(texts) == texts and asked.count("x" * 300) == 2 and asked.count("ab ") == 1
    memo.limit = 1  # what the old generation holds is not computed again
    assert back(texts[:6]) == texts[:6] and asked.count("ab ") == 1
    monkeypatch.setattr(units, "hashes", lambda codes, starts, skip=None: np.full(len(starts), 3, np.uint64))
    memo.clear()
    for some in (texts, texts[::-1], ["ab cd ef ", "gh ", "ab "]):
        assert back(some) == some
    assert back([""]) == [""] and back([]) == []


def test_a_task_leaves_its_worker_small(spark, monkeypatch):
    from vectrove.llm import common

    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    run, given = [], []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, fn, *rest, **kw: run.append(fn))
    batches = docs.toArrow().to_batches()

    def encode(batch):
        list(tokens.token_ids(common.texts_of(batch), BYTE))
        assert not given  # only when the task is done
        return batch

    for keep in (False, True):
        monkeypatch.setattr(units, "give_back", lambda: None)
        units.release()
        monkeypatch.setattr(units, "give_back", lambda: given.append(1))
        common.map_arrow(docs, encode, "doc_id long, text string", keep)
        assert [b.num_rows for b in run.pop()(iter(batches))] == [1] and given == [1]
        assert (units.Memo._live is not None) == keep
        given.clear()


def test_arrow_batches_are_bounded_unless_the_session_says_so(spark):
    from vectrove import session

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    new = spark.newSession()
    session.attach(new)
    assert int(new.conf.get(name)) == session.BATCH_BYTES
    new.conf.set(name, "1000000")
    session.attach(new)
    assert new.conf.get(name) == "1000000"
