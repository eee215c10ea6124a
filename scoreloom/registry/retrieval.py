"""Registered queries: runs, judgements, rank metrics and significance."""

from __future__ import annotations

from pyspark.sql import functions as F

from scoreloom.operators import ranking, significance
from scoreloom.plans.durable import cut, fresh_path
from scoreloom.registry import inputs
from scoreloom.registry.base import register, rounded, with_ctes
from scoreloom.registry.inputs import QRELS_SQL, RUNS_SQL
from scoreloom.sources import readers, writers
from scoreloom.sources.schemas import METRICS

INDEX_SQL = """
idx AS (SELECT query_id, doc_id, max(relevance) AS relevance FROM qrels GROUP BY query_id, doc_id),
n AS (SELECT query_id, count(*) AS n_rel FROM idx GROUP BY query_id)
"""

PLACED_SQL = """
placed AS (
  SELECT r.system_number, r.query_number, r.doc_number, i.relevance, n.n_rel,
         CASE WHEN i.doc_id IS NULL THEN 0 ELSE 1 END AS hit,
         row_number() OVER (PARTITION BY r.system_number, r.query_number
                            ORDER BY r.rank_of_doc, r.doc_number) AS pos
  FROM runs r
  LEFT JOIN idx i ON i.query_id = r.query_number AND i.doc_id = r.doc_number
  LEFT JOIN n ON n.query_id = r.query_number),
counted AS (
  SELECT *, sum(hit) OVER (PARTITION BY system_number, query_number ORDER BY pos) AS hits
  FROM placed)
"""

IDEAL_SQL = """
best AS (
  SELECT query_id, relevance,
         row_number() OVER (PARTITION BY query_id ORDER BY relevance DESC, doc_id) AS nth
  FROM idx),
ideal AS (
  SELECT query_id,
         sum(CASE WHEN nth <= 10 THEN relevance / log2(nth + 1.0) ELSE 0 END) AS idcg_10,
         sum(CASE WHEN nth <= 20 THEN relevance / log2(nth + 1.0) ELSE 0 END) AS idcg_20
  FROM best GROUP BY query_id)
"""

PER_QUERY_SQL = """
dcg AS (
  SELECT system_number, query_number, max(n_rel) AS n_rel,
         sum(CASE WHEN pos <= 10 THEN hit ELSE 0 END) / 10.0 AS p10,
         sum(CASE WHEN pos <= 50 THEN hit ELSE 0 END) AS h50,
         sum(CASE WHEN pos <= n_rel THEN hit ELSE 0 END) AS hr,
         sum(CASE WHEN hit = 1 THEN CAST(hits AS DOUBLE) / pos ELSE 0 END) AS sp,
         sum(CASE WHEN hit = 1 AND pos <= 10 THEN relevance / log2(pos + 1.0) ELSE 0 END) AS d10,
         sum(CASE WHEN hit = 1 AND pos <= 20 THEN relevance / log2(pos + 1.0) ELSE 0 END) AS d20
  FROM counted GROUP BY system_number, query_number),
per_query AS (
  SELECT system_number, query_number, CAST(p10 AS DOUBLE) AS "P@10",
         coalesce(CAST(h50 AS DOUBLE) / n_rel, 0) AS "R@50",
         coalesce(CAST(hr AS DOUBLE) / n_rel, 0) AS "r-precision",
         coalesce(sp / n_rel, 0) AS "AP",
         CASE WHEN idcg_10 > 0 THEN d10 / idcg_10 ELSE 0.0 END AS "nDCG@10",
         CASE WHEN idcg_20 > 0 THEN d20 / idcg_20 ELSE 0.0 END AS "nDCG@20"
  FROM dcg LEFT JOIN ideal ON query_id = query_number)
"""

WITH_MEAN_SQL = """
with_mean AS (
  SELECT system_number, CAST(query_number AS VARCHAR) AS query_number,
         "P@10", "R@50", "r-precision", "AP", "nDCG@10", "nDCG@20" FROM per_query
  UNION ALL
  SELECT system_number, 'mean', avg("P@10"), avg("R@50"), avg("r-precision"), avg("AP"),
         avg("nDCG@10"), avg("nDCG@20") FROM per_query GROUP BY system_number)
"""

EVALUATION_SQL = (
    "evaluation AS (SELECT system_number, query_number, "
    + ", ".join(f'round_even("{m}", 3)::DOUBLE AS "{m}"' for m in METRICS)
    + " FROM with_mean)"
)

JUDGED = (RUNS_SQL, QRELS_SQL, INDEX_SQL, PLACED_SQL)
EVALUATED = (*JUDGED, IDEAL_SQL, PER_QUERY_SQL, WITH_MEAN_SQL, EVALUATION_SQL)

# Student's t by the closed form of each series coefficient (log-gamma), one row per term.
TESTS_SQL = """
long AS (
  UNPIVOT (SELECT * FROM evaluation WHERE query_number <> 'mean')
  ON "P@10", "R@50", "r-precision", "AP", "nDCG@10", "nDCG@20" INTO NAME metric VALUE score),
stats AS (
  SELECT i.system_number AS system_i, j.system_number AS system_j, i.metric, count(*) AS n,
         round(avg(round(i.score - j.score, 9)), 12) AS mean_diff,
         var_samp(round(i.score - j.score, 9)) AS var_diff
  FROM long i JOIN long j ON i.metric = j.metric AND i.query_number = j.query_number
                         AND i.system_number < j.system_number
  GROUP BY ALL),
t AS (
  SELECT *, n - 1 AS nu,
         CASE WHEN var_diff > 0 THEN mean_diff / sqrt(var_diff / n)
              WHEN mean_diff > 0 THEN 'Infinity'::DOUBLE
              WHEN mean_diff < 0 THEN '-Infinity'::DOUBLE END AS t_stat
  FROM stats),
angle AS (SELECT *, atan(abs(t_stat) / sqrt(nu)) AS theta FROM t),
terms AS (
  SELECT system_i, system_j, metric,
         sum(CASE WHEN nu % 2 = 1 AND k <= (nu - 3) / 2
                  THEN exp(2 * lgamma(k + 1.0) + 2 * k * ln(2.0) - lgamma(2 * k + 2.0))
                       * cos(theta) ** (2 * k + 1)
                  WHEN nu % 2 = 0 AND k <= (nu - 2) / 2
                  THEN exp(lgamma(2 * k + 1.0) - 2 * lgamma(k + 1.0) - 2 * k * ln(2.0))
                       * cos(theta) ** (2 * k) ELSE 0 END) AS total
  FROM angle, unnest(generate_series(0, nu // 2)) g(k) GROUP BY ALL),
tests AS (
  SELECT a.system_i, a.system_j, a.metric, a.n, a.mean_diff, a.t_stat,
         CASE WHEN isinf(a.t_stat) THEN 0.0
              WHEN a.nu % 2 = 1 THEN 1 - 2 / pi() * (theta + sin(theta) * total)
              ELSE 1 - sin(theta) * total END AS p_value
  FROM angle a JOIN terms USING (system_i, system_j, metric))
"""


def _evaluation(spark, sf_dir):
    return ranking.evaluate(inputs.runs(spark, sf_dir), inputs.qrels(spark, sf_dir))


def _judged(spark, sf_dir):
    return ranking.judged_results(inputs.runs(spark, sf_dir), inputs.qrels(spark, sf_dir))


@register("read_runs", with_ctes(RUNS_SQL, select="SELECT * FROM runs"))
def read_runs(spark, sf_dir):
    path = fresh_path(spark, "runs")
    inputs.runs(spark, sf_dir).write.csv(path, header=True)
    return readers.read_runs(spark, path)


@register("read_qrels", with_ctes(QRELS_SQL, select="SELECT * FROM qrels"))
def read_qrels(spark, sf_dir):
    path = fresh_path(spark, "qrels")
    inputs.qrels(spark, sf_dir).write.csv(path, header=True)
    return readers.read_qrels(spark, path)


@register(
    "index_qrels",
    with_ctes(QRELS_SQL, INDEX_SQL, select="SELECT query_id, doc_id, relevance FROM idx"),
)
def index_qrels(spark, sf_dir):
    return ranking.index_qrels(inputs.qrels(spark, sf_dir))


@register(
    "top_k_retrieved",
    with_ctes(
        *JUDGED,
        select="SELECT system_number, query_number, doc_number, pos FROM placed WHERE pos <= 10",
    ),
)
def top_k_retrieved(spark, sf_dir):
    return ranking.top_k_retrieved(inputs.runs(spark, sf_dir), 10).drop("rank_of_doc")


def _metric(name, metric, args, sql, source="per_query"):
    ctes = (*JUDGED, IDEAL_SQL, PER_QUERY_SQL)

    @register(
        name,
        with_ctes(*ctes, select=f"SELECT system_number, query_number, {sql} FROM {source}"),
    )
    def run(spark, sf_dir):
        return rounded(ranking.score_lists(_judged(spark, sf_dir), score=metric(*args)), "score")

    return run


_metric("precision_at_k", ranking.precision_at_k, (10,), 'round("P@10", 6) AS score')
_metric("recall_at_k", ranking.recall_at_k, (50,), 'round("R@50", 6) AS score')
_metric("r_precision", ranking.r_precision, (), 'round("r-precision", 6) AS score')
_metric("average_precision", ranking.average_precision, (), 'round("AP", 6) AS score')
_metric("dcg_at_k", ranking.dcg_at_k, (10,), "round(d10, 6)::DOUBLE AS score", "dcg")


@register(
    "idcg_at_k",
    with_ctes(
        QRELS_SQL, INDEX_SQL, IDEAL_SQL,
        select="""SELECT query_id, n_rel, round(idcg_10, 6)::DOUBLE AS idcg_10,
                         round(idcg_20, 6)::DOUBLE AS idcg_20
                  FROM n JOIN ideal USING (query_id)""",
    ),
)
def idcg_at_k(spark, sf_dir):
    ideal = ranking.idcg_at_k(ranking.index_qrels(inputs.qrels(spark, sf_dir)))
    return rounded(ideal, "idcg_10", "idcg_20")


@register(
    "ndcg_at_k",
    with_ctes(
        *JUDGED, IDEAL_SQL, PER_QUERY_SQL,
        select="""SELECT system_number, query_number, round("nDCG@10", 6)::DOUBLE AS ndcg_10,
                         round("nDCG@20", 6)::DOUBLE AS ndcg_20 FROM per_query""",
    ),
)
def ndcg_at_k(spark, sf_dir):
    scored = ranking.score_lists(
        _judged(spark, sf_dir), ndcg_10=ranking.ndcg_at_k(10), ndcg_20=ranking.ndcg_at_k(20)
    )
    return rounded(scored, "ndcg_10", "ndcg_20")


_ROUND_SIX = ", ".join(f'round("{m}", 6)::DOUBLE AS "{m}"' for m in METRICS)


@register(
    "evaluate_per_query",
    with_ctes(
        *JUDGED, IDEAL_SQL, PER_QUERY_SQL,
        select=f"SELECT system_number, query_number, {_ROUND_SIX} FROM per_query",
    ),
)
def evaluate_per_query(spark, sf_dir):
    scored = ranking.evaluate_per_query(inputs.runs(spark, sf_dir), inputs.qrels(spark, sf_dir))
    return rounded(scored, *METRICS)


@register(
    "system_mean",
    with_ctes(
        *JUDGED, IDEAL_SQL, PER_QUERY_SQL, WITH_MEAN_SQL,
        select=f"SELECT system_number, query_number, {_ROUND_SIX} FROM with_mean",
    ),
)
def system_mean(spark, sf_dir):
    scored = ranking.evaluate_per_query(inputs.runs(spark, sf_dir), inputs.qrels(spark, sf_dir))
    return rounded(ranking.system_mean(scored), *METRICS)


@register("round_scores", with_ctes(*EVALUATED, select="SELECT * FROM evaluation"))
def round_scores(spark, sf_dir):
    return _evaluation(spark, sf_dir)


@register("write_ir_eval", with_ctes(*EVALUATED, select="SELECT * FROM evaluation"))
def write_ir_eval(spark, sf_dir):
    path = fresh_path(spark, "ir-eval")
    writers.write_ir_eval(_evaluation(spark, sf_dir), path)
    return readers.read_evaluation(spark, path)


_TEST_COLUMNS = """system_i, system_j, metric, n, round(mean_diff, 6) AS mean_diff,
                   round(t_stat, 6) AS t_stat, round(p_value, 6) AS p_value"""


@register(
    "paired_t_test",
    with_ctes(*EVALUATED, TESTS_SQL, select=f"SELECT {_TEST_COLUMNS} FROM tests"),
)
def paired_t_test(spark, sf_dir):
    tests = significance.paired_t_test(cut(_evaluation(spark, sf_dir)))
    return rounded(tests, "mean_diff", "t_stat", "p_value")


@register(
    "significance_verdict",
    with_ctes(
        *EVALUATED, TESTS_SQL,
        select="""SELECT system_i, system_j, metric, round(p_value, 6) AS p_value,
                         coalesce(p_value < 0.05, false) AS significant,
                         CAST(sign(mean_diff) AS INT) AS direction FROM tests""",
    ),
)
def significance_verdict(spark, sf_dir):
    tests = significance.paired_t_test(cut(_evaluation(spark, sf_dir)))
    verdicts = significance.significance_verdict(tests)
    return rounded(
        verdicts.select("system_i", "system_j", "metric", "p_value", "significant", "direction"),
        "p_value",
    )


@register(
    "best_vs_second",
    with_ctes(
        *EVALUATED, TESTS_SQL,
        """means AS (
             UNPIVOT (SELECT * FROM evaluation WHERE query_number = 'mean')
             ON "P@10", "R@50", "r-precision", "AP", "nDCG@10", "nDCG@20"
             INTO NAME metric VALUE score),
           ranked AS (
             SELECT *, row_number() OVER (PARTITION BY metric
                                          ORDER BY score DESC, system_number) AS nth,
                       rank() OVER (PARTITION BY metric ORDER BY score DESC) AS place
             FROM means)""",
        select="""
SELECT b.metric, b.system_number AS best, s.system_number AS second, b.score AS best_mean,
       s.score AS second_mean, b.score = s.score AS tie, t.n,
       round(abs(t.t_stat) * sign(CASE WHEN b.system_number < s.system_number
                                       THEN t.mean_diff ELSE -t.mean_diff END), 6) AS t_stat,
       round(t.p_value, 6) AS p_value, coalesce(t.p_value < 0.05, false) AS significant
FROM ranked b JOIN ranked s ON b.metric = s.metric AND b.nth = 1 AND s.nth > 1 AND s.place <= 2
JOIN tests t ON t.metric = b.metric
 AND t.system_i = least(b.system_number, s.system_number)
 AND t.system_j = greatest(b.system_number, s.system_number)""",
    ),
)
def best_vs_second(spark, sf_dir):
    verdicts = significance.best_vs_second(cut(_evaluation(spark, sf_dir)))
    return rounded(verdicts.drop("mean_diff"), "t_stat", "p_value").select(
        "metric", "best", "second", "best_mean", "second_mean", "tie", "n", "t_stat", "p_value",
        "significant",
    )
