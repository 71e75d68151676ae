"""The registered queries of the text operators: each over its whole table, at production settings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vectrove.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op7_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    from vectrove.llm.tokens import count_tokens

    return count_tokens(table(spark, sf, "documents"))


@query
def op5_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    from vectrove.llm.pieces import piece_tokens

    return piece_tokens(table(spark, sf, "documents"))


@query
def op2_token_records(spark: SparkSession, sf: str) -> DataFrame:
    from vectrove.llm.common import scratch
    from vectrove.llm.records import read_token_records, record_index, write_token_records

    root = scratch(spark, "records")
    write_token_records(table(spark, sf, "documents"), root)
    rows = read_token_records(record_index(spark, root), root, with_ids=False)
    return rows.select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op9_packing(spark: SparkSession, sf: str) -> DataFrame:
    from vectrove.llm.packing import pack_documents

    return pack_documents(table(spark, sf, "documents"))


@query
def op8_quality(spark: SparkSession, sf: str) -> DataFrame:
    from vectrove.llm.quality import fit_quality, score_quality

    docs = table(spark, sf, "documents")
    return score_quality(docs, fit_quality(docs, table(spark, sf, "labels")))


@query
def op6_nearest(spark: SparkSession, sf: str) -> DataFrame:
    from vectrove.llm.nearest import build_index, search_index

    vectors = table(spark, sf, "embeddings")
    return search_index(build_index(vectors), vectors.where("vec_id % 20 = 0"))


@query
def op10_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    from vectrove.llm.neardup import near_duplicates

    return near_duplicates(table(spark, sf, "embeddings"))


@query
def op3_ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    from vectrove.llm.jaccard import similar_documents

    return similar_documents(table(spark, sf, "documents"))


ORACLE["op3_ngram_jaccard"] = r"""
WITH RECURSIVE words AS MATERIALIZED (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS MATERIALIZED (
    SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') || ' ' ELSE array_to_string(w[i:i + 4], ' ') END AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS MATERIALIZED (
    SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id
    HAVING 100 * count(*) >= 75 * ((SELECT n FROM sizes s WHERE s.doc_id = a.doc_id) + (SELECT n FROM sizes s WHERE s.doc_id = b.doc_id) - count(*))),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.y, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id)
LEFT JOIN (SELECT x AS doc_id, min(y) AS y FROM reach GROUP BY x) m USING (doc_id)
"""


@query
def op4_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    from vectrove.llm.suffixes import remove_repeats

    return remove_repeats(table(spark, sf, "documents"))


@query
def op1_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import functions as F

    from vectrove.llm.lines import repeated_lines

    found = repeated_lines(table(spark, sf, "documents"))
    return found.select("doc_id", "n_lines", F.size("removed").alias("n_removed"), F.array_join("removed", ",").alias("removed"))


@query
def op11_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    from vectrove.llm.codes import coded_vectors

    return coded_vectors(table(spark, sf, "embeddings"))


def _codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """The rounds unrolled; a distance and its entry's number are compared as one integer."""
    nearest = f"""
    SELECT k.vec_id, k.p, k.v, min(CAST(list_sum(list_transform(range(1, len(k.v) + 1), lambda i: (k.v[i] - b.v[i]) * (k.v[i] - b.v[i]))) AS BIGINT) * {entries} + b.e) AS best
    FROM pieces k JOIN {{}} b USING (p) GROUP BY k.vec_id, k.p, k.v"""
    steps = []
    for i in range(1, rounds + 1):
        steps.append(f"near{i} AS MATERIALIZED ({nearest.format(f'book{i - 1}')})")
        steps.append(f"""mean{i} AS MATERIALIZED (SELECT p, e, list(m ORDER BY pos) AS v FROM (
    SELECT p, best % {entries} AS e, pos, CAST(floor(sum(v[pos]) / count(*)) AS BIGINT) AS m
    FROM near{i}, generate_series(1, (SELECT max(len(v)) FROM pieces)) t(pos) GROUP BY ALL) GROUP BY p, e)""")
        steps.append(f"book{i} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM book{i - 1} b LEFT JOIN mean{i} m ON b.p = m.p AND b.e = m.e)")
    return f"""
WITH kept AS MATERIALIZED (
    SELECT vec_id, label, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
pieces AS MATERIALIZED (SELECT vec_id, p, x[p * (len(x) // {parts}) + 1:(p + 1) * (len(x) // {parts})] AS v FROM kept, range({parts}) t(p)),
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, v FROM pieces JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS r FROM kept QUALIFY r <= {entries}) USING (vec_id)),
{', '.join(steps)},
last AS MATERIALIZED ({nearest.format(f'book{rounds}')}),
coded AS MATERIALIZED (SELECT vec_id, string_agg(printf('%02x', best % {entries}), '' ORDER BY p) AS code, CAST(sum(best // {entries}) AS BIGINT) AS error FROM last GROUP BY vec_id),
digest AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), digest
"""


ORACLE["op11_vector_codes"] = _codes_sql()


@query
def op12_whitening(spark: SparkSession, sf: str) -> DataFrame:
    from vectrove.llm.whitening import fit_whitening, whiten

    vectors = table(spark, sf, "embeddings")
    return whiten(vectors, fit_whitening(vectors))


@query
def op13_secrets(spark: SparkSession, sf: str) -> DataFrame:
    from vectrove.llm.leaks import secret_report

    return secret_report(table(spark, sf, "documents"))
