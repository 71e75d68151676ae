"""A corpus pipeline of the text operators over ``documents``, stage by stage.

Every stage takes all rows that the one before kept. Extra columns travel along; ``n_chars``,
where there is one, follows the text. An empty table passes all stages as one; the
operators' docstrings say what becomes of nulls, empty and repeated texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectrove import attach
from vectrove.llm.common import stored, table
from vectrove.llm.jaccard import one_of_each
from vectrove.llm.lines import dedup_lines
from vectrove.llm.packing import pack_documents
from vectrove.llm.quality import fit_quality, score_quality
from vectrove.llm.suffixes import remove_repeats

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` as the text is now."""
    if "n_chars" not in docs.columns:
        return docs
    kind = dict(docs.dtypes)["n_chars"]
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on ``labels``, does not reject."""
    attach(spark)
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model, keep_columns=True).where("_predicted = 1").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near-duplicate lines go, but for the first of each."""
    attach(spark)
    return _measured(dedup_lines(docs))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones stays."""
    attach(spark)
    return one_of_each(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of strings of 200 bytes that occur again go from the texts."""
    attach(spark)
    return _measured(remove_repeats(docs, keep_columns=True).select(*docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of 2048: one row a piece."""
    attach(spark)
    return pack_documents(docs, keep=False)  # other stages have workers idle beside these


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("suffix_dedup", suffix_dedup),
    ("packing", packing),
]

#: The first stage fits a model and the second finds lines by signatures; SQL can't express them.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
