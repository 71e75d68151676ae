"""Secrets in texts: three fixed forms, and random strings by their token efficiency.

A vocabulary of byte pairs spends few tokens on what people write and nearly one on every
character or two of a random string. Strings without white space that have few characters for
each token are reported, after digests, numbers and identifiers are set aside, which are
random or rare without being secret.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectrove.llm.common import map_arrow, plain_texts, texts_of, tokenizer_file

VOCABULARY = "byte_bpe_50k.tiktoken"
#: The kinds of spans, in the order in which spans that start together are listed.
KINDS = ("assign", "access", "hex", "dense")

# Fixed forms. A match that fails its length still uses up its characters.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
LEAST_ASSIGN, LEAST_ACCESS = 8, 16
#: Without one of these, in lower case, no text holds an assignment.
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: A random string: so many signs at least, and fewer than so many characters for each token.
LEAST_DENSE, MOST_DENSE = 20, 2.0
DENSE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % LEAST_DENSE)
#: Characters of a string that are encoded at a time, which bounds the work on a very long one.
PIECE = 1024

# Known digests and identifiers: hexadecimal numbers of any length (also after a prefix that
# names the digest), UUIDs, and words, numbers or short codes strung together by separators or
# by case.
DIGEST = re.compile(r"(?:0x|(?:md5|sha1|sha224|sha256|sha384|sha512|blake2b)[-_=])?[0-9A-Fa-f]+|[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
INTEGRITY = re.compile(r"(?:sha256-[A-Za-z0-9+/]{43}=|sha384-[A-Za-z0-9+/]{64}|sha512-[A-Za-z0-9+/]{86}==)")
SEPARATORS = re.compile(r"[+/_=-]+")
NAME = re.compile(r"[a-z]*|[A-Z]+|[0-9]+|[A-Za-z0-9]{1,5}|(?:[A-Z]?[a-z]{2,})+[0-9]{0,4}")


def identifier(string: str) -> bool:
    """Whether a string is a digest, a number, or a name made of words and numbers."""
    if DIGEST.fullmatch(string) or INTEGRITY.fullmatch(string):
        return True
    return all(NAME.fullmatch(part) for part in SEPARATORS.split(string))


@lru_cache(maxsize=2)
def encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def characters_per_token(string: str, path: str) -> float:
    encode = encoding(path).encode_ordinary
    return len(string) / sum(len(encode(string[i : i + PIECE])) for i in range(0, len(string), PIECE))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``start, kind number, end`` of the fixed forms in a text, in order."""
    found = []
    lower = text.lower()
    if any(name in lower for name in NAMES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def dense_spans(text: str, path: str, ratio: float = MOST_DENSE) -> list[tuple[int, int, int]]:
    """Spans of random strings, whatever the fixed forms find."""
    found = []
    for match in DENSE.finditer(text):
        string = match.group()
        if not identifier(string) and characters_per_token(string, path) < ratio:
            found.append((match.start(), 3, match.end()))
    return found


def secret_spans(text: str, path: str, ratio: float = MOST_DENSE) -> list[tuple[int, int, int]]:
    """``start, kind number, end`` of all spans: the fixed forms, and random strings that touch none of them."""
    base = base_spans(text)
    taken = np.array([(a, b) for a, _, b in base], np.int64).reshape(-1, 2)
    free = [s for s in dense_spans(text, path, ratio) if not np.any((taken[:, 0] < s[2]) & (taken[:, 1] > s[0]))]
    return sorted(base + free)


def find_secrets(docs: DataFrame, ratio: float = MOST_DENSE, path: str | None = None) -> DataFrame:
    """``doc_id, secrets``: the spans of every document, ``array<struct<kind, start, end, value>>``.

    Places are code points, the end exclusive; spans are in order of their start and then of
    :data:`KINDS`. The three fixed kinds are found as their forms say, leftmost first and
    without overlap within a kind; spans of different kinds may overlap, but for ``dense``,
    which is reported only where no other is. ``path`` is a tiktoken vocabulary. A null text
    is empty; a document without secrets has an empty array; a null id stays null; rows are
    treated one by one, repeated ones too; other columns are ignored. One map.
    """
    path = path or tokenizer_file(VOCABULARY)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ends, kinds, starts, stops, values = [0], [], [], [], []
        for text in texts_of(batch):
            for start, kind, stop in secret_spans(text, path, ratio):
                kinds.append(KINDS[kind])
                starts.append(start)
                stops.append(stop)
                values.append(text[start:stop])
            ends.append(len(kinds))
        columns = [pa.array(kinds, pa.string()), pa.array(starts, pa.int64()), pa.array(stops, pa.int64()), pa.array(values, pa.string())]
        spans = pa.StructArray.from_arrays(columns, ["kind", "start", "end", "value"])
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans)], ["doc_id", "secrets"])

    schema = "doc_id long, secrets array<struct<kind: string, start: long, end: long, value: string>>"
    return map_arrow(plain_texts(docs), run, schema)


def mask_secrets(docs: DataFrame, ratio: float = MOST_DENSE, path: str | None = None) -> DataFrame:
    """The table with every secret in ``text`` replaced by its kind in brackets; all rows and columns stay.

    Spans that overlap are replaced together, by the kind of the first. A null text stays null.
    """
    path = path or tokenizer_file(VOCABULARY)

    @F.pandas_udf("string")
    def masked(texts):
        return texts.map(lambda text: text if text is None else _masked(text, secret_spans(text, path, ratio)))

    return docs.withColumn("text", masked("text"))


def _masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind]}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def secret_report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` of every document.

    ``spans`` lists ``kind:start:end``, comma-joined; ``base_sha256`` is the digest of that
    list with the fixed kinds only. See :func:`find_secrets`.
    """
    found = find_secrets(docs)
    listed = F.transform("secrets", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    base = F.transform(
        F.filter("secrets", lambda s: s["kind"] != "dense"), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )

    def count(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(F.array_join(base, ","), 256).alias("base_sha256"), F.array_join(listed, ",").alias("spans")
    )
