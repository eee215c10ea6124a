"""Explicit schemas; no reader infers types."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

RUNS = StructType([
    StructField("system_number", IntegerType()),
    StructField("query_number", LongType()),
    StructField("doc_number", LongType()),
    StructField("rank_of_doc", IntegerType()),
    StructField("score", DoubleType()),
])

QRELS = StructType([
    StructField("query_id", LongType()),
    StructField("doc_id", LongType()),
    StructField("relevance", IntegerType()),
])

TWEETS = StructType([
    StructField("id", StringType()),
    StructField("category", StringType()),
    StructField("text", StringType()),
])

NOTEBOOK_TWEETS = StructType([
    StructField("id", StringType()),
    StructField("text", StringType()),
    StructField("category", StringType()),
])

# Metric names, in the order of the evaluation file.
METRICS = ("P@10", "R@50", "r-precision", "AP", "nDCG@10", "nDCG@20")

EVALUATION = StructType(
    [StructField("system_number", IntegerType()), StructField("query_number", StringType())]
    + [StructField(metric, DoubleType()) for metric in METRICS]
)

# Class names with the suffix of their columns, and the score prefixes.
CLASS_SUFFIX = {"positive": "pos", "negative": "neg", "neutral": "neu"}
SCORE_COLUMNS = tuple(
    f"{score}-{suffix}" for suffix in (*CLASS_SUFFIX.values(), "macro") for score in "prf"
)

EXPERIMENT = StructType(
    [StructField("system", StringType()), StructField("split", StringType())]
    + [StructField(column, DoubleType()) for column in SCORE_COLUMNS]
)
