"""Paired t-tests against recorded scores with known outcomes."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from scoreloom.functions.numeric import harmonic, student_t_two_sided
from scoreloom.operators import significance
from scoreloom.sources.schemas import EVALUATION

# Recorded scores of ten queries per system.
RECORDED = {
    "AP": {
        3: [0.518, 0.75, 0.056, 0.69, 0.104, 0.465, 0.0, 1.0, 0.756, 0.174],
        6: [0.56, 0.615, 0.056, 0.69, 0.104, 0.465, 0.0, 1.0, 0.784, 0.174],
    },
    "nDCG@10": {
        3: [0.583, 0.835, 0.0, 0.718, 0.261, 0.148, 0.0, 0.83, 0.474, 0.311],
        5: [0.326, 0.607, 0.0, 0.548, 0.26, 0.225, 0.0, 0.717, 0.458, 0.156],
        6: [0.585, 0.648, 0.0, 0.625, 0.261, 0.148, 0.0, 0.755, 0.568, 0.311],
    },
    "nDCG@20": {
        3: [0.667, 0.911, 0.235, 0.734, 0.261, 0.514, 0.0, 0.83, 0.605, 0.394],
        6: [0.669, 0.724, 0.235, 0.658, 0.261, 0.514, 0.0, 0.755, 0.683, 0.394],
    },
}


def table(spark):
    zeros = [0.0] * 10
    rows = []
    for system in (3, 5, 6):
        ap, n10, n20 = (RECORDED[m].get(system, zeros) for m in ("AP", "nDCG@10", "nDCG@20"))
        rows += [
            (system, str(q + 1), 0.1, 0.5, 0.1 * (system == 6), ap[q], n10[q], n20[q])
            for q in range(10)
        ]
        means = [round(sum(v) / 10, 3) for v in (ap, n10, n20)]
        rows.append((system, "mean", 0.1, 0.5, 0.1 * (system == 6), *means))
    return spark.createDataFrame(rows, EVALUATION)


def results_by_key(spark):
    tested = significance.significance_verdict(significance.paired_t_test(table(spark)))
    return {(r["system_i"], r["system_j"], r["metric"]): r for r in tested.collect()}


@pytest.mark.parametrize(
    ("pair", "metric", "t", "p", "significant"),
    [
        ((3, 6), "AP", 0.4323, 0.6757, False),
        ((3, 6), "nDCG@10", 1.0840, 0.3065, False),
        ((3, 6), "nDCG@20", 1.1437, 0.2823, False),
        ((3, 5), "nDCG@10", 2.4097, 0.0393, True),
    ],
)
def test_recorded_pairs(spark, pair, metric, t, p, significant):
    row = results_by_key(spark)[(*pair, metric)]
    assert row["n"] == 10
    assert row["t_stat"] == pytest.approx(t, abs=5e-5)
    assert row["p_value"] == pytest.approx(p, abs=5e-5)
    assert row["significant"] is significant and row["direction"] == 1


def test_no_difference_and_constant_difference(spark):
    rows = results_by_key(spark)
    assert len(rows) == 3 * 6
    equal = rows[3, 5, "P@10"]
    assert (equal["t_stat"], equal["p_value"], equal["significant"]) == (None, None, False)
    constant = rows[3, 6, "r-precision"]
    assert constant["t_stat"] == -math.inf and constant["p_value"] == 0.0
    assert constant["significant"] and constant["direction"] == -1


def test_best_vs_second(spark):
    rows = {}
    for row in significance.best_vs_second(table(spark)).orderBy("second").collect():
        rows.setdefault(row["metric"], []).append(row)
    assert len(rows) == 6
    (ap,) = rows["AP"]
    assert (ap["best"], ap["second"], ap["tie"], ap["significant"]) == (3, 6, False, False)
    assert ap["t_stat"] == pytest.approx(0.4323, abs=5e-5)
    ties = [(r["best"], r["second"], r["tie"]) for r in rows["P@10"]]
    assert ties == [(3, 5, True), (3, 6, True)]
    assert rows["P@10"][0]["t_stat"] is None


def test_tied_runners_up(spark):
    means = [("1", 0.9), ("2", 0.5), ("3", 0.5), ("4", 0.1)]
    frame = table(spark)
    rows = [
        (int(system), query, *[value + step] * 6)
        for system, value in means
        for query, step in (("1", 0.01), ("2", -0.01), ("mean", 0.0))
    ]
    tied = spark.createDataFrame(rows, frame.schema)
    got = {(r["best"], r["second"], r["tie"], r["n"])
           for r in significance.best_vs_second(tied).collect()}
    assert got == {(1, 2, False, 2), (1, 3, False, 2)}
    assert significance.best_vs_second(tied.filter("system_number = 1")).isEmpty()


@pytest.mark.parametrize(
    ("nu", "critical"), [(1, 12.7062047), (2, 4.30265273), (4, 2.77644511), (9, 2.26215716)]
)
def test_tabulated_critical_values(spark, nu, critical):
    p = spark.range(1).select(student_t_two_sided(F.lit(critical), F.lit(nu))).first()[0]
    assert p == pytest.approx(0.05, abs=1e-8)


def tail_by_series(t, nu):
    """The finite trigonometric series for whole degrees of freedom."""
    theta = math.atan(t / math.sqrt(nu))
    cos, sin = math.cos(theta), math.sin(theta)
    odd = nu % 2
    terms = [1.0]
    for i in range(1, (nu - 2 - odd) // 2 + 1):
        grow = 2 * i / (2 * i + 1) if odd else (2 * i - 1) / (2 * i)
        terms.append(terms[-1] * grow * cos * cos)
    total = math.fsum(terms)
    if odd:
        return 1 - 2 / math.pi * (theta + (sin * cos * total if nu >= 3 else 0))
    return 1 - sin * total


def tail_by_normal(t, nu):
    """The normal tail and its first correction; the next is of the order of 1 / nu^2."""
    density = math.exp(-t * t / 2) / math.sqrt(2 * math.pi)
    return math.erfc(t / math.sqrt(2)) + density * (t**3 + t) / (2 * nu)


def test_tail_at_all_degrees(spark):
    sizes = (0.0, 1e-3, 0.3, 1.0, 1.5, 1.72, 1.733, 1.8, 1.96, 3.5, 6.0, 40.0)
    degrees = (1, 2, 3, 4, 9, 30, 101, 1999, 2000, 2001, 10_001, 100_000)
    points = [(sign * t, nu) for t in sizes for nu in (*degrees, 10_000_000) for sign in (1, -1)]
    frame = spark.createDataFrame(points, "t DOUBLE, nu INT")
    rows = frame.select("t", "nu", student_t_two_sided(F.col("t"), F.col("nu")).alias("p")).collect()
    for row in rows:
        way = tail_by_series if row["nu"] <= 100_000 else tail_by_normal
        assert row["p"] == pytest.approx(way(abs(row["t"]), row["nu"]), abs=1e-10), row


def test_tail_of_odd_input(spark):
    points = [(None, 3), (1.0, None), (1.0, 0), (math.inf, 3), (-math.inf, 1), (1e300, 1), (1e-300, 5)]
    frame = spark.createDataFrame(points, "t DOUBLE, nu INT")
    got = [r[0] for r in frame.select(student_t_two_sided(F.col("t"), F.col("nu"))).collect()]
    assert got[:5] == [None, None, None, 0.0, 0.0]
    assert 0 <= got[5] < 1e-140 and got[6] == 1.0


def test_harmonic(spark):
    ns = [0, 1, 64, 65, 1000]
    frame = spark.createDataFrame([(n,) for n in ns], "n LONG")
    got = [r[0] for r in frame.select(harmonic(F.col("n"))).collect()]
    assert got == pytest.approx([sum(1 / i for i in range(1, n + 1)) for n in ns], abs=1e-13)
