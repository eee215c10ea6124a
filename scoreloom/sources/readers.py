"""Readers for the run, judgement, corpus, tweet and result formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from scoreloom.functions.text import strip_ends
from scoreloom.sources import schemas
from scoreloom.sources.quoted import quoted_records


def _csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True, mode="FAILFAST", enforceSchema=False)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Ranked results of any number of systems; a malformed row is an error."""
    return _csv(spark, path, schemas.RUNS)


def read_qrels(spark: SparkSession, path: str) -> DataFrame:
    """Graded judgements; a malformed row is an error."""
    return _csv(spark, path, schemas.QRELS)


def read_evaluation(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.EVALUATION)


def read_experiment(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.EXPERIMENT)


def parse_labelled_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Split ``label<TAB>text`` lines on the first tab, skipping blank ones.

    ``well_formed`` is false for a line without a tab; such a line has no text.
    """
    stripped = lines.select(strip_ends(F.col(line)).alias("_line")).filter(F.col("_line") != "")
    parts: Column = F.split("_line", "\t", 2)
    return stripped.select(
        F.get(parts, 0).alias("label"),
        F.get(parts, 1).alias("text"),
        (F.size(parts) == 2).alias("well_formed"),
    )


def read_labelled_corpus(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Labelled documents, one per line.

    In strict mode a line without a tab fails any query over the lines; otherwise
    such lines are left out here and found by :func:`rejected_corpus_lines`.
    """
    parsed = parse_labelled_lines(spark.read.text(path))
    if not strict:
        return parsed.filter("well_formed").select("label", "text")
    # A filter, since the error would go with a column that a query does not read.
    checked = F.when(F.col("well_formed"), F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("corpus line without a tab: "), F.col("label")))
    )
    return parsed.filter(checked).select("label", "text")


def rejected_corpus_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a labelled corpus that have no tab."""
    parsed = parse_labelled_lines(spark.read.text(path))
    return parsed.filter(~F.col("well_formed")).select(F.col("label").alias("line"))


def read_labelled_tweets(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Tab-separated ``id, category, text``; the first line of each file is dropped.

    A row with fewer or more fields fails the query that reads all of them.  A quoted
    field may hold tabs, doubled quotes and line ends; a large file is read by all cores
    all the same.  ``multi_line=False`` saves a pass if no field holds a line end.
    """
    options = {"sep": "\t", "quote": '"', "escape": '"', "mode": "FAILFAST"}
    if not multi_line:
        given = spark.read.schema(schemas.TWEETS).options(**options)
        return given.option("header", True).csv(path)
    records = quoted_records(spark, path, "\t").filter("NOT first AND record <> ''")
    parsed = F.from_csv("record", schemas.TWEETS.toDDL(), options | {"multiLine": "true"})
    return records.select(parsed.alias("row")).select("row.*")


def read_tweets_notebook(spark: SparkSession, path: str) -> DataFrame:
    """Latin-1 ``id, text, category`` without header or quoting; other widths are an error."""
    rows = (
        spark.read.schema(schemas.NOTEBOOK_TWEETS)
        .option("encoding", "ISO-8859-1")
        .option("sep", "\t")
        .option("quote", "")
        .option("escape", "")
        .option("mode", "FAILFAST")
        .csv(path)
    )
    return rows.select(
        strip_ends(F.col("id")).alias("id"), "text", strip_ends(F.col("category")).alias("category")
    )


def read_experiment_results(spark: SparkSession, path: str) -> DataFrame:
    """The result table kept by :func:`scoreloom.sources.writers.append_experiment_result`."""
    return spark.read.schema(schemas.EXPERIMENT).parquet(path)
