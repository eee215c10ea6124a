"""The corpus pipeline: five stages over ``documents``, each one of the operators of scoreloom.llm.

Every stage gets what the one before kept, written and read again, and all but the last
return the columns of ``documents``.  Quality rules drop texts, near-duplicates leave one
document of each group, repeated passages are cut out of the texts, contaminated documents
are dropped, and the last stage encodes what is left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scoreloom.llm import bpe, decontaminate, quality, simhash, suffixes
from scoreloom.llm.common import stored
from scoreloom.llm.queries import table, tokenizer

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what fails the base rules or is probably bad; the rules are weighed on all of ``docs``."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of the smallest id of each group."""
    return simhash.drop_near_duplicates(docs, shingle=4, max_distance=4)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out bytes inside 50-byte strings of documents with smaller ids."""
    return suffixes.without_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents with a window of ten words, or the whole, of a benchmark text."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text that is left, and digests of them and of what they decode to."""
    file = tokenizer("word_bpe_49k.json")
    return bpe.encode(
        docs.select("doc_id", "text"), file, extra=bpe.ids_and_digests, fields=bpe.IDS_AND_DIGESTS
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

# EM, components and merges are not SQL; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
