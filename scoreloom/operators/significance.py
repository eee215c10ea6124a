"""Paired t-tests between systems."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.functions.numeric import student_t_two_sided
from scoreloom.sources.schemas import METRICS

ALPHA = 0.05
# Scores have three decimals; these clear the binary noise of their differences and means.
_DIFF_DIGITS = 9
_MEAN_DIGITS = 12


def _query_rows(evaluation: DataFrame) -> DataFrame:
    return evaluation.filter(F.col("query_number") != "mean")


def _test(stats: DataFrame) -> DataFrame:
    """t and p from ``n``, ``mean_diff`` and ``var_diff``.

    Without any difference there is no t; equal differences that are not zero
    give an infinite t and p = 0.
    """
    mean, var, n = F.col("mean_diff"), F.col("var_diff"), F.col("n")
    t = F.when(
        var == 0,
        F.when(mean > 0, F.lit(math.inf)).when(mean < 0, F.lit(-math.inf)),
    ).otherwise(F.try_divide(mean, F.sqrt(var / n)))
    return (
        stats.withColumn("t_stat", t)
        .withColumn("p_value", student_t_two_sided(F.col("t_stat"), F.col("n") - 1))
        .drop("var_diff")
    )


def paired_t_test(evaluation: DataFrame) -> DataFrame:
    """Two-sided paired t-test of every pair of systems, per metric, over shared queries.

    A pair is one join row per query with all metrics side by side, summed up
    before it is shuffled; the metrics become rows only once they are one number
    per pair.
    """
    scores = _query_rows(evaluation)
    left = scores.select(
        "query_number",
        F.col("system_number").alias("system_i"),
        *[F.col(m).alias(f"i_{k}") for k, m in enumerate(METRICS)],
    )
    right = scores.select(
        "query_number",
        F.col("system_number").alias("system_j"),
        *[F.col(m).alias(f"j_{k}") for k, m in enumerate(METRICS)],
    )
    pairs = left.join(right, "query_number").filter("system_i < system_j")
    moments = []
    for k in range(len(METRICS)):
        diff = F.round(F.col(f"i_{k}") - F.col(f"j_{k}"), _DIFF_DIGITS)
        moments += [
            F.round(F.avg(diff), _MEAN_DIGITS).alias(f"mean_{k}"),
            F.var_samp(diff).alias(f"var_{k}"),
        ]
    wide = pairs.groupBy("system_i", "system_j").agg(F.count(F.lit(1)).alias("n"), *moments)
    cells = F.array(
        *[
            F.struct(
                F.lit(m).alias("metric"),
                F.col(f"mean_{k}").alias("mean_diff"),
                F.col(f"var_{k}").alias("var_diff"),
            )
            for k, m in enumerate(METRICS)
        ]
    )
    stats = wide.select("system_i", "system_j", "n", F.inline(cells)).select(
        "system_i", "system_j", "metric", "n", "mean_diff", "var_diff"
    )
    return _test(stats)


def significance_verdict(tests: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Add ``significant`` and the sign of the mean difference to test rows."""
    return tests.withColumn(
        "significant", F.coalesce(F.col("p_value") < alpha, F.lit(False))
    ).withColumn("direction", F.signum("mean_diff").cast("int"))


def best_vs_second(evaluation: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Per metric: the best system by reported mean, each runner-up, and the test between them.

    Of several systems at the first place the lowest number is named best, and all
    others are runners-up of a tie.  If the first place is held alone, every system at
    the second is a runner-up.  There is one row per runner-up, none for a lone system,
    and the best system is compared with them only, not all pairs.
    """
    long = evaluation.unpivot(
        ["system_number", "query_number"], list(METRICS), "metric", "score"
    )
    by_mean = Window.partitionBy("metric").orderBy(F.desc("score"))
    by_name = Window.partitionBy("metric").orderBy(F.desc("score"), F.asc("system_number"))
    leaders = (
        long.filter(F.col("query_number") == "mean")
        .select(
            "metric",
            F.first("system_number").over(by_name).alias("best"),
            F.col("system_number").alias("second"),
            F.first("score").over(by_name).alias("best_mean"),
            F.col("score").alias("second_mean"),
            F.rank().over(by_mean).alias("_place"),
            F.row_number().over(by_name).alias("_nth"),
        )
        .filter("_place <= 2 AND _nth > 1")
        .drop("_place", "_nth")
    )
    scores = _query_rows(long)
    seconds = scores.withColumnsRenamed({"system_number": "second", "score": "s"}).join(
        leaders.select("metric", "best", "second"), ["metric", "second"]
    )
    firsts = scores.withColumnsRenamed({"system_number": "best", "score": "b"})
    paired = (
        seconds.join(firsts, ["metric", "best", "query_number"])
        .filter("b IS NOT NULL AND s IS NOT NULL")
        .withColumn("diff", F.round(F.col("b") - F.col("s"), _DIFF_DIGITS))
    )
    stats = paired.groupBy("metric", "best", "second").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("diff"), _MEAN_DIGITS).alias("mean_diff"),
        F.var_samp("diff").alias("var_diff"),
    )
    tested = significance_verdict(_test(stats), alpha).drop("direction")
    return leaders.withColumn("tie", F.col("best_mean") == F.col("second_mean")).join(
        tested, ["metric", "best", "second"], "left"
    )
