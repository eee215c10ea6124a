"""Registered queries: topic profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from scoreloom.operators import topics as ops
from scoreloom.plans.durable import written
from scoreloom.registry.base import once_per_data, register, with_ctes
from scoreloom.registry.inputs import CORPUS_SQL
from scoreloom.registry.text import TOKENS_SQL, corpus_docs

LABELS = ["de", "en", "es", "fr"]
PROMINENT = 0.05

BOW_SQL = """
bow AS (SELECT doc_id, token, count(*) AS n
        FROM (SELECT doc_id, unnest(tokens) AS token FROM docs) GROUP BY doc_id, token)
"""


@register(
    "build_vocabulary",
    with_ctes(
        CORPUS_SQL, TOKENS_SQL, BOW_SQL,
        select="""SELECT token, row_number() OVER (ORDER BY token) - 1 AS token_id,
                         count(*) AS n_docs, sum(n)::BIGINT AS n_tokens FROM bow GROUP BY token""",
    ),
)
def build_vocabulary(spark, sf_dir):
    return ops.build_vocabulary(corpus_docs(spark, sf_dir))


@register("doc_to_bow", with_ctes(CORPUS_SQL, TOKENS_SQL, BOW_SQL, select="SELECT * FROM bow"))
def doc_to_bow(spark, sf_dir):
    return ops.doc_to_bow(corpus_docs(spark, sf_dir), "doc_id")


@once_per_data
def _fitted(spark, sf_dir):
    """The stemmed corpus and its topic model."""
    docs = written(corpus_docs(spark, sf_dir, stem=True), "stemmed")
    return docs, ops.fit_topics(docs)


def _letter_topics(spark, sf_dir):
    """A topic table any engine can repeat: the share of a document's words by first letter.

    Shares are whole 1024ths, so that their sums don't depend on the order of addition.
    """
    docs = corpus_docs(spark, sf_dir)
    first = F.transform("tokens", lambda w: F.ascii(w) - 97)

    def share(letter):
        found = F.size(F.filter("first", lambda x: x == letter)).cast("long")
        return F.when(F.size("first") > 0, F.floor(found * 1024 / F.size("first")) / 1024)

    shares = F.transform(F.sequence(F.lit(0), F.lit(25)), share)
    rows = docs.select("doc_id", "label", first.alias("first")).select(
        "doc_id", "label", F.posexplode(shares).alias("topic", "p")
    )
    return rows.select("doc_id", "label", "topic", F.coalesce("p", F.lit(0.0)).alias("probability"))


AVERAGES_SQL = """
shares AS (
  SELECT label, CAST(t AS INTEGER) AS topic,
         CASE WHEN len(tokens) > 0
              THEN (1024 * len([w FOR w IN tokens IF ascii(w) - 97 = t])) // len(tokens) / 1024.0
              ELSE 0.0 END AS p
  FROM docs, unnest(range(26)) AS letters(t)),
averages AS (SELECT label, topic, avg(CAST(p AS DOUBLE)) AS avg_prob FROM shares GROUP BY ALL)
"""


def _averages(spark, sf_dir):
    return ops.corpus_topic_average(_letter_topics(spark, sf_dir))


def _averages_sql(select):
    return with_ctes(CORPUS_SQL, TOKENS_SQL, AVERAGES_SQL, select=select)


@register("fit_topics")
def fit_topics(spark, sf_dir):
    """Every topic with its most probable word, as a summary of the fitted model."""
    return ops.topic_top_words(_fitted(spark, sf_dir)[1], 1)


@register("document_topics")
def document_topics(spark, sf_dir):
    docs, model = _fitted(spark, sf_dir)
    return ops.document_topics(model, docs)


@register("corpus_topic_average", _averages_sql("SELECT * FROM averages"))
def corpus_topic_average(spark, sf_dir):
    return _averages(spark, sf_dir)


@register(
    "dominant_topic",
    _averages_sql(
        """SELECT label, topic, avg_prob FROM averages
           QUALIFY row_number() OVER (PARTITION BY label ORDER BY avg_prob DESC, topic) = 1"""
    ),
)
def dominant_topic(spark, sf_dir):
    return ops.dominant_topic(_averages(spark, sf_dir))


@register("topic_top_words")
def topic_top_words(spark, sf_dir):
    return ops.topic_top_words(_fitted(spark, sf_dir)[1])


@register(
    "topic_average_table",
    _averages_sql(
        "SELECT topic, "
        + ", ".join(f"max(avg_prob) FILTER (label = '{x}') AS {x}" for x in LABELS)
        + " FROM averages GROUP BY topic"
    ),
)
def topic_average_table(spark, sf_dir):
    return ops.topic_average_table(_averages(spark, sf_dir), LABELS)


@register(
    "shared_topics",
    _averages_sql(
        f"""SELECT topic, string_agg(label, ' ' ORDER BY label) AS labels FROM averages
            WHERE avg_prob >= {PROMINENT} GROUP BY topic HAVING count(label) = 2"""
    ),
)
def shared_topics(spark, sf_dir):
    shared = ops.shared_topics(_averages(spark, sf_dir), PROMINENT)
    return shared.withColumn("labels", F.array_join("labels", " "))
