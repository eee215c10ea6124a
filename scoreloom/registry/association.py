"""Registered queries: token/class association."""

from __future__ import annotations

from scoreloom.operators import association as ops
from scoreloom.plans.durable import cut, fresh_path
from scoreloom.registry.base import register, rounded, with_ctes
from scoreloom.registry.inputs import CORPUS_SQL
from scoreloom.registry.text import TOKENS_SQL, corpus_docs
from scoreloom.sources import writers

SEEN_SQL = """
seen AS (SELECT DISTINCT doc_id, label, unnest(tokens) AS token FROM docs)
"""
COUNTS_SQL = """
classes AS (SELECT label, count(*) AS n_c FROM docs GROUP BY label),
total AS (SELECT count(*) AS n FROM docs),
own AS (SELECT label, token, count(*) AS n11 FROM seen GROUP BY label, token),
every AS (SELECT token, count(*) AS df FROM seen GROUP BY token),
cells AS (
  SELECT c.label, e.token, coalesce(o.n11, 0) AS n11, c.n_c - coalesce(o.n11, 0) AS n10,
         e.df - coalesce(o.n11, 0) AS n01, n - c.n_c - (e.df - coalesce(o.n11, 0)) AS n00
  FROM every e CROSS JOIN classes c CROSS JOIN total
  LEFT JOIN own o ON o.label = c.label AND o.token = e.token)
"""


def _part(cell, row, column):
    return (
        f"CASE WHEN {cell} > 0 THEN {cell} / n * log2(n * {cell} / (({row}) * ({column}) + 1e-10))"
        " ELSE 0 END"
    )


SCORES_SQL = f"""
doubles AS (
  SELECT label, token, n11::DOUBLE AS a, n10::DOUBLE AS b, n01::DOUBLE AS c, n00::DOUBLE AS d,
         (n11 + n10 + n01 + n00)::DOUBLE AS n FROM cells),
scores AS (
  SELECT label, token,
         {_part('a', 'a + b', 'a + c')} + {_part('c', 'c + d', 'a + c')}
         + {_part('b', 'a + b', 'b + d')} + {_part('d', 'c + d', 'b + d')} AS mi,
         (a * d - b * c) * (a * d - b * c) * n
         / ((a + c) * (a + b) * (b + d) * (c + d) + 1e-10) AS chi2
  FROM doubles),
methods AS (
  SELECT label, token, 'mi' AS method, mi AS score FROM scores
  UNION ALL SELECT label, token, 'chi2', chi2 FROM scores),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY label, method ORDER BY score DESC, token) AS place
  FROM methods)
"""

CELLS = (CORPUS_SQL, TOKENS_SQL, SEEN_SQL, COUNTS_SQL)
SCORED = (*CELLS, SCORES_SQL)


def _scores(spark, sf_dir):
    return ops.association_scores(corpus_docs(spark, sf_dir))


@register(
    "doc_token_sets",
    with_ctes(CORPUS_SQL, TOKENS_SQL, SEEN_SQL, select="SELECT doc_id, label, token FROM seen"),
)
def doc_token_sets(spark, sf_dir):
    return ops.doc_token_sets(corpus_docs(spark, sf_dir))


@register(
    "class_doc_counts",
    with_ctes(
        CORPUS_SQL, TOKENS_SQL,
        """classes AS (SELECT label, count(*) AS n_docs FROM docs GROUP BY label)""",
        select="SELECT label, n_docs, (SELECT count(*) FROM docs) AS n_total FROM classes",
    ),
)
def class_doc_counts(spark, sf_dir):
    return ops.class_doc_counts(corpus_docs(spark, sf_dir))


@register("class_doc_frequency", with_ctes(*CELLS, select="SELECT label, token, n11 FROM own"))
def class_doc_frequency(spark, sf_dir):
    return ops.class_doc_frequency(corpus_docs(spark, sf_dir))


@register(
    "complement_doc_frequency",
    with_ctes(
        *CELLS,
        select="SELECT label, token, n01 FROM cells WHERE n11 > 0",
    ),
)
def complement_doc_frequency(spark, sf_dir):
    return ops.complement_doc_frequency(corpus_docs(spark, sf_dir))


@register("contingency_table", with_ctes(*CELLS, select="SELECT * FROM cells"))
def contingency_table(spark, sf_dir):
    return ops.contingency_table(corpus_docs(spark, sf_dir))


@register(
    "mutual_information",
    with_ctes(*SCORED, select="SELECT label, token, round(mi, 6) AS mi FROM scores"),
)
def mutual_information(spark, sf_dir):
    return rounded(_scores(spark, sf_dir).select("label", "token", "mi"), "mi")


@register(
    "chi_squared",
    with_ctes(*SCORED, select="SELECT label, token, round(chi2, 6) AS chi2 FROM scores"),
)
def chi_squared(spark, sf_dir):
    return rounded(_scores(spark, sf_dir).select("label", "token", "chi2"), "chi2")


@register(
    "rank_tokens",
    with_ctes(
        *SCORED,
        select="SELECT label, method, token, round(score, 6) AS score, place FROM ranked",
    ),
)
def rank_tokens(spark, sf_dir):
    return rounded(ops.rank_tokens(cut(_scores(spark, sf_dir))), "score")


@register(
    "top_tokens",
    with_ctes(
        *SCORED,
        select="""SELECT label, method, token, round(score, 6) AS score, place
                  FROM ranked WHERE place <= 10""",
    ),
)
def top_tokens(spark, sf_dir):
    return rounded(ops.top_tokens(_scores(spark, sf_dir), 10), "score")


@register(
    "method_rank_comparison",
    with_ctes(
        *SCORED,
        """places AS (
             SELECT label, token, max(CASE WHEN method = 'mi' THEN place END) AS mi_place,
                    max(CASE WHEN method = 'chi2' THEN place END) AS chi2_place
             FROM ranked GROUP BY label, token)""",
        select="""SELECT label, token, mi_place, chi2_place,
                         mi_place - chi2_place AS place_change,
                         mi_place <= 10 AND chi2_place <= 10 AS in_both_tops FROM places""",
    ),
)
def method_rank_comparison(spark, sf_dir):
    return ops.method_rank_comparison(cut(_scores(spark, sf_dir)))


@register(
    "write_ranked_scores",
    with_ctes(*SCORED, select="SELECT label, method, token, round(score, 6) AS score FROM methods"),
)
def write_ranked_scores(spark, sf_dir):
    path = fresh_path(spark, "token-scores")
    writers.write_ranked_scores(ops.method_scores(_scores(spark, sf_dir)), path)
    written = spark.read.schema("token STRING, score DOUBLE, label STRING, method STRING").csv(path)
    return rounded(written.select("label", "method", "token", "score"), "score")
