"""Inputs of the registered queries, derived from the given tables, in Spark and in SQL.

Runs: line number = system, supplier = query, part = document, dearer first.
Every line item is a row; ranks have gaps and documents may repeat, since only
the order of ranks counts and each occurrence is a result.  Judgements: larger
returned orders; suppliers in debt are left unjudged, so some answered queries
have no judgement.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.registry.base import table

RUNS_SQL = """
runs AS (
  SELECT CAST(l_linenumber AS INT) AS system_number, l_suppkey AS query_number,
         l_partkey AS doc_number,
         CAST(20000000 - round(l_extendedprice * 100) AS INT) AS rank_of_doc,
         l_extendedprice AS score
  FROM lineitem)
"""

QRELS_SQL = """
qrels AS (
  SELECT l_suppkey AS query_id, l_partkey AS doc_id,
         CAST(CASE WHEN l_quantity >= 48 THEN 3 WHEN l_quantity >= 40 THEN 2
                   WHEN l_quantity >= 30 THEN 1 ELSE 0 END AS INT) AS relevance
  FROM lineitem
  WHERE l_returnflag = 'R' AND l_quantity >= 25
    AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0))
"""

CORPUS_SQL = """
corpus AS (SELECT doc_id, lang AS label, text FROM documents)
"""

TWEETS_SQL = """
tweets AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS id, d.doc_id AS row_id,
         CASE WHEN l.toxic = 1 THEN 'negative' WHEN l.quality = 1 THEN 'positive'
              ELSE 'neutral' END AS category,
         d.text
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
"""

# Two rule-based classifiers over three splits, so that every scoring operator has
# right and wrong predictions of all classes to count.
PREDICTIONS_SQL = """
predictions AS (
  SELECT s.system, CASE WHEN d.source IN ('src0', 'src1') THEN 'dev'
                        WHEN d.source IN ('src2', 'src3', 'src4', 'src5') THEN 'test'
                        ELSE 'train' END AS split,
         d.doc_id AS id, d.text,
         CASE WHEN l.toxic = 1 THEN 'negative' WHEN l.quality = 1 THEN 'positive'
              ELSE 'neutral' END AS y_true,
         CASE WHEN s.system = 'improved' AND l.toxic = 1 AND d.lang <> 'de' THEN 'negative'
              WHEN d.n_chars < 400 THEN 'neutral'
              WHEN d.n_chars < 1200 AND d.lang <> 'en' THEN 'negative'
              ELSE 'positive' END AS y_pred
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
  CROSS JOIN (VALUES ('baseline'), ('improved')) s(system))
"""


def runs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_linenumber").cast("int").alias("system_number"),
        F.col("l_suppkey").alias("query_number"),
        F.col("l_partkey").alias("doc_number"),
        (20_000_000 - F.round(F.col("l_extendedprice") * 100)).cast("int").alias("rank_of_doc"),
        F.col("l_extendedprice").alias("score"),
    )


def qrels(spark: SparkSession, folder: str) -> DataFrame:
    judged = (
        table(spark, folder, "supplier")
        .filter("s_acctbal >= 0")
        .select(F.col("s_suppkey").alias("l_suppkey"))
    )
    return (
        table(spark, folder, "lineitem")
        .filter("l_returnflag = 'R' AND l_quantity >= 25")
        .join(judged, "l_suppkey", "left_semi")
        .select(
            F.col("l_suppkey").alias("query_id"),
            F.col("l_partkey").alias("doc_id"),
            F.expr(
                "CASE WHEN l_quantity >= 48 THEN 3 WHEN l_quantity >= 40 THEN 2 "
                "WHEN l_quantity >= 30 THEN 1 ELSE 0 END"
            ).alias("relevance"),
        )
    )


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", F.col("lang").alias("label"), "text")


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").withColumn(
        "category",
        F.when(F.col("toxic") == 1, "negative")
        .when(F.col("quality") == 1, "positive")
        .otherwise("neutral"),
    )
    return documents.join(labels, "doc_id")


def tweets(spark: SparkSession, folder: str) -> DataFrame:
    return _labelled(spark, folder).select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("doc_id").alias("row_id"),
        "category",
        "text",
    )


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _labelled(spark, folder)
        .withColumn("system", F.explode(F.array(F.lit("baseline"), F.lit("improved"))))
        .select(
            "system",
            F.expr(
                "CASE WHEN source IN ('src0', 'src1') THEN 'dev' "
                "WHEN source IN ('src2', 'src3', 'src4', 'src5') THEN 'test' ELSE 'train' END"
            ).alias("split"),
            F.col("doc_id").alias("id"),
            "text",
            F.col("category").alias("y_true"),
            F.expr(
                "CASE WHEN system = 'improved' AND toxic = 1 AND lang <> 'de' THEN 'negative' "
                "WHEN n_chars < 400 THEN 'neutral' "
                "WHEN n_chars < 1200 AND lang <> 'en' THEN 'negative' ELSE 'positive' END"
            ).alias("y_pred"),
        )
    )
