"""Topic profiles of labelled corpora."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark import RDD
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from scoreloom.functions.text import counted
from scoreloom.operators import lda
from scoreloom.operators.terms import TermModel, fit_terms
from scoreloom.plans.durable import cut, fresh_path
from scoreloom.plans.ordering import MAX_GROUP_ROWS, place_in_group
from scoreloom.plans.spreading import spread
from scoreloom.plans.unfolding import unfold

# Topics, passes over the corpus, seed, and the smallest reported probability.
TOPICS = 20
PASSES = 10
SEED = 42
MIN_PROBABILITY = 0.01
# Share of the documents each update of the model sees.
RATE = 0.1
ROWS_PER_TASK = 250


def build_vocabulary(docs: DataFrame, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Every token with an id (alphabetical), its documents and its occurrences."""
    per_doc = doc_to_bow(docs, "doc_id")
    tokens = per_doc.groupBy("token").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n_tokens")
    )
    # Written once: counting the rows, slicing and numbering would each tokenise the texts again.
    placed = place_in_group(
        cut(tokens), [], [F.asc("token")], place="_place", max_group_rows=max_group_rows
    )
    return placed.select("token", (F.col("_place") - 1).alias("token_id"), "n_docs", "n_tokens")


def doc_to_bow(docs: DataFrame, key: str) -> DataFrame:
    """Occurrences of each token per document, counted within the row: nothing is shuffled.

    ``key`` is a document's own; rows that share one are counted apart.
    """
    return unfold(docs, counted("tokens", "token"), "_token", key).select(
        key, "_token.token", "_token.n"
    )


@dataclass
class TopicModel:
    terms: TermModel
    weights: lda.TopicWeights


def fit_topics(
    docs: DataFrame,
    k: int = TOPICS,
    passes: int = PASSES,
    seed: int = SEED,
    rate: float = RATE,
    slots: int | None = None,
) -> TopicModel:
    """Online LDA over all corpora as one.

    An update sees the share ``rate`` of the documents, whatever their number, and
    there are as many updates as fill the passes.  ``slots`` folds the vocabulary.
    """
    docs = docs.select(F.col("tokens").alias("terms"))
    terms = fit_terms(docs, slots)
    n_docs = docs.count()
    counts = spread(terms.transform(docs).select("features"), n_docs, ROWS_PER_TASK)
    updates = math.ceil(passes / rate)
    size = len(terms.vocabulary)
    return TopicModel(terms, lda.fit(counts, "features", size, n_docs, k, updates, rate, seed))


def document_topics(model: TopicModel, docs: DataFrame) -> DataFrame:
    """Probability of each topic per document; those under the minimum become 0."""
    counted_docs = model.terms.transform(docs.withColumnRenamed("tokens", "terms"))
    fields = [docs.schema["doc_id"], docs.schema["label"]]
    fields.append(StructField("_shares", ArrayType(DoubleType())))
    spark, path = docs.sparkSession, fresh_path(docs.sparkSession, "shares")
    schema = StructType(fields)

    def keep(found: RDD) -> None:
        some = spark.createDataFrame(found, schema, verifySchema=False)
        some.write.mode("append").parquet(path)

    lda.distributions(model.weights, counted_docs, "features", keep, "doc_id", "label")
    scored = spark.read.schema(schema).parquet(path)
    long = scored.select("doc_id", "label", F.posexplode_outer("_shares").alias("topic", "p"))
    return long.select(
        "doc_id",
        "label",
        "topic",
        F.when(F.col("p") >= MIN_PROBABILITY, F.col("p")).otherwise(0.0).alias("probability"),
    )


def corpus_topic_average(doc_topics: DataFrame) -> DataFrame:
    """Mean probability of each topic over the documents of a label, zeros included."""
    return doc_topics.groupBy("label", "topic").agg(F.avg("probability").alias("avg_prob"))


def dominant_topic(averages: DataFrame) -> DataFrame:
    """Topic of the highest average per label; the lower number at equal averages."""
    best = Window.partitionBy("label").orderBy(F.desc("avg_prob"), F.asc("topic"))
    return (
        averages.withColumn("_nth", F.row_number().over(best)).filter("_nth = 1").drop("_nth")
    )


def topic_top_words(model: TopicModel, n: int = 10) -> DataFrame:
    """The ``n`` most probable words of each topic; k x n rows."""
    rows = [
        (topic, place, model.terms.name(index), weight)
        for topic, best in enumerate(lda.top_terms(model.weights, n))
        for place, (index, weight) in enumerate(best, start=1)
    ]
    return SparkSession.active().createDataFrame(
        rows, "topic INT, place INT, word STRING, probability DOUBLE"
    )


def topic_average_table(averages: DataFrame, labels: list[str]) -> DataFrame:
    """Topics as rows, the averages of the given labels as columns."""
    return averages.groupBy("topic").pivot("label", labels).agg(F.first("avg_prob"))


def shared_topics(averages: DataFrame, threshold: float, corpora: int = 2) -> DataFrame:
    """Topics prominent in exactly ``corpora`` labels, with those labels."""
    return (
        averages.filter(F.col("avg_prob") >= threshold)
        .groupBy("topic")
        .agg(F.array_sort(F.collect_set("label")).alias("labels"))
        .filter(F.size("labels") == corpora)
    )
