"""Registered queries: scores of predicted classes."""

from __future__ import annotations

from pyspark.sql import functions as F

from scoreloom.operators import scoring as ops
from scoreloom.plans.durable import fresh_path
from scoreloom.registry import inputs
from scoreloom.registry.base import register, rounded, with_ctes
from scoreloom.registry.inputs import PREDICTIONS_SQL, TWEETS_SQL
from scoreloom.sources import readers, writers
from scoreloom.sources.schemas import CLASS_SUFFIX, SCORE_COLUMNS

CLASSES = list(CLASS_SUFFIX)

PRF_SQL = """
met AS (
  SELECT system, split, c AS class,
         count(*) FILTER (y_true = c) AS support, count(*) FILTER (y_pred = c) AS predicted,
         count(*) FILTER (y_true = c AND y_pred = c) AS correct
  FROM predictions, unnest(['positive', 'negative', 'neutral']) u(c) GROUP BY ALL),
prf AS (
  SELECT system, split, class,
         CASE WHEN predicted > 0 THEN correct::DOUBLE / predicted ELSE 0.0 END AS precision,
         CASE WHEN support > 0 THEN correct::DOUBLE / support ELSE 0.0 END AS recall,
         CASE WHEN predicted + support > 0
              THEN 2.0::DOUBLE * correct / (predicted + support) ELSE 0.0 END AS f1,
         support, predicted, correct
  FROM met)
"""

MACRO_SQL = """
macro AS (
  SELECT system, split, avg(precision) AS macro_precision, avg(recall) AS macro_recall,
         avg(f1) AS macro_f1
  FROM prf WHERE support + predicted > 0 GROUP BY system, split)
"""

_PICKED = ", ".join(
    f"""round(max(CASE WHEN class = '{name}' THEN {of} END), 6) AS "{short}-{suffix}" """
    for name, suffix in CLASS_SUFFIX.items()
    for short, of in (("p", "precision"), ("r", "recall"), ("f", "f1"))
)
EXPERIMENT_SQL = f"""
experiment AS (
  SELECT p.system, p.split, {_PICKED},
         round(max(macro_precision), 6) AS "p-macro", round(max(macro_recall), 6) AS "r-macro",
         round(max(macro_f1), 6) AS "f-macro"
  FROM prf p JOIN macro USING (system, split) GROUP BY p.system, p.split)
"""


def _confusion(spark, sf_dir):
    return ops.confusion_matrix(inputs.predictions(spark, sf_dir))


@register(
    "majority_baseline",
    with_ctes(
        TWEETS_SQL,
        """winner AS (SELECT category FROM tweets GROUP BY category
                      ORDER BY count(*) DESC, category LIMIT 1)""",
        select="""SELECT id, category AS y_true, (SELECT category FROM winner) AS y_pred
                  FROM tweets""",
    ),
)
def majority_baseline(spark, sf_dir):
    rows = inputs.tweets(spark, sf_dir).select("id", "category")
    return ops.majority_baseline(rows, rows, "category")


@register(
    "accuracy",
    with_ctes(
        PREDICTIONS_SQL,
        select="""SELECT system, split,
                         round(avg(CASE WHEN y_true = y_pred THEN 1.0 ELSE 0.0 END), 6) AS accuracy
                  FROM predictions GROUP BY system, split""",
    ),
)
def accuracy(spark, sf_dir):
    return rounded(ops.accuracy(inputs.predictions(spark, sf_dir)), "accuracy")


@register(
    "class_prf",
    with_ctes(
        PREDICTIONS_SQL, PRF_SQL,
        select="""SELECT system, split, class, round(precision, 6) AS precision,
                         round(recall, 6) AS recall, round(f1, 6) AS f1, support, predicted
                  FROM prf""",
    ),
)
def class_prf(spark, sf_dir):
    return rounded(ops.class_prf(_confusion(spark, sf_dir), CLASSES), "precision", "recall", "f1")


@register(
    "macro_prf",
    with_ctes(
        PREDICTIONS_SQL, PRF_SQL, MACRO_SQL,
        select="""SELECT system, split, round(macro_precision, 6) AS macro_precision,
                         round(macro_recall, 6) AS macro_recall, round(macro_f1, 6) AS macro_f1
                  FROM macro""",
    ),
)
def macro_prf(spark, sf_dir):
    macro = ops.macro_prf(ops.class_prf(_confusion(spark, sf_dir)))
    return rounded(macro, "macro_precision", "macro_recall", "macro_f1")


@register(
    "confusion_matrix",
    with_ctes(
        PREDICTIONS_SQL,
        select="""SELECT system, split, c AS y_true,
                         count(*) FILTER (y_true = c AND y_pred = 'positive') AS positive,
                         count(*) FILTER (y_true = c AND y_pred = 'negative') AS negative,
                         count(*) FILTER (y_true = c AND y_pred = 'neutral') AS neutral
                  FROM predictions, unnest(list_distinct([y_true, y_pred])) u(c)
                  GROUP BY system, split, c""",
    ),
)
def confusion_matrix(spark, sf_dir):
    return ops.confusion_table(_confusion(spark, sf_dir), CLASSES)


@register(
    "misclassified_examples",
    with_ctes(
        PREDICTIONS_SQL,
        select="""SELECT id, text, y_true, y_pred FROM predictions
                  WHERE system = 'baseline' AND split = 'dev' AND y_true <> y_pred
                  ORDER BY id LIMIT 3""",
    ),
)
def misclassified_examples(spark, sf_dir):
    dev = inputs.predictions(spark, sf_dir).filter("system = 'baseline' AND split = 'dev'")
    return ops.misclassified_examples(dev.select("id", "text", "y_true", "y_pred"))


@register(
    "classification_report",
    with_ctes(
        PREDICTIONS_SQL, PRF_SQL,
        """present AS (SELECT * FROM prf WHERE support + predicted > 0)""",
        select="""
SELECT system, split, class AS "row", round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, support FROM present
UNION ALL
SELECT system, split, 'accuracy', round(sum(correct)::DOUBLE / sum(support), 6),
       round(sum(correct)::DOUBLE / sum(support), 6), round(sum(correct)::DOUBLE / sum(support), 6),
       sum(support)::BIGINT FROM present GROUP BY system, split
UNION ALL
SELECT system, split, 'macro avg', round(avg(precision), 6), round(avg(recall), 6),
       round(avg(f1), 6), sum(support)::BIGINT FROM present GROUP BY system, split
UNION ALL
SELECT system, split, 'weighted avg', round(sum(precision * support) / sum(support), 6),
       round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
       sum(support)::BIGINT FROM present GROUP BY system, split""",
    ),
)
def classification_report(spark, sf_dir):
    return rounded(
        ops.classification_report(_confusion(spark, sf_dir)), "precision", "recall", "f1"
    )


def _experiment(spark, sf_dir):
    return ops.experiment_table(inputs.predictions(spark, sf_dir))


EXPERIMENT = (PREDICTIONS_SQL, PRF_SQL, MACRO_SQL, EXPERIMENT_SQL)


@register("experiment_table", with_ctes(*EXPERIMENT, select="SELECT * FROM experiment"))
def experiment_table(spark, sf_dir):
    return rounded(_experiment(spark, sf_dir), *SCORE_COLUMNS)


@register(
    "improvement_delta",
    with_ctes(
        PREDICTIONS_SQL, PRF_SQL, MACRO_SQL,
        select="""SELECT b.split, round(b.macro_f1, 6) AS before, round(i.macro_f1, 6) AS after,
                         round(i.macro_f1 - b.macro_f1, 6) AS delta
                  FROM macro b JOIN macro i USING (split)
                  WHERE b.system = 'baseline' AND i.system = 'improved'""",
    ),
)
def improvement_delta(spark, sf_dir):
    delta = ops.improvement_delta(_experiment(spark, sf_dir))
    return rounded(delta, "before", "after", "delta")


@register("append_experiment_result", with_ctes(*EXPERIMENT, select="SELECT * FROM experiment"))
def append_experiment_result(spark, sf_dir):
    """The table written once per system, one of them twice: rows are replaced, not doubled."""
    path = fresh_path(spark, "experiment")
    rows = rounded(_experiment(spark, sf_dir), *SCORE_COLUMNS)
    for system in ("baseline", "improved", "baseline"):
        writers.append_experiment_result(rows.filter(F.col("system") == system), path)
    return readers.read_experiment_results(spark, path)
