"""Numeric column expressions Spark has no function for."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Pairs of terms of the continued fraction of the t tail: 40 are exact to 1e-11 at all degrees.
FRACTION_TERMS = 60


def discount_sum(first: Column, last: Column) -> Column:
    """Sum of 1 / log2(place + 1) for the places ``first`` to ``last``; 0 if there are none."""
    return F.when(
        last >= first,
        F.aggregate(
            F.sequence(first.cast("long"), F.greatest(first, last).cast("long")),
            F.lit(0.0),
            lambda total, at: total + F.lit(1.0) / F.log2(at + F.lit(1.0)),
        ),
    ).otherwise(F.lit(0.0))


def harmonic(n: Column) -> Column:
    """H(n) = 1 + 1/2 + ... + 1/n; the Euler-Maclaurin form beyond 64 terms."""
    x = n.cast("double")
    small = F.aggregate(
        F.sequence(F.lit(0).cast("long"), F.least(n, F.lit(64)).cast("long")),
        F.lit(0.0),
        lambda total, i: total + F.when(i > 0, F.lit(1.0) / i).otherwise(0.0),
    )
    large = (
        F.log(x)
        + F.lit(0.5772156649015329)
        + 1 / (2 * x)
        - 1 / (12 * x * x)
        + 1 / (120 * F.pow(x, F.lit(4)))
        - 1 / (252 * F.pow(x, F.lit(6)))
    )
    return F.when(n <= 64, small).otherwise(large)


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom``, 0 where the denominator is 0 or missing."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def student_t_two_sided(t: Column, df: Column) -> Column:
    """Two-sided tail probability of Student's t for whole degrees of freedom.

    It is the regularised incomplete beta function of (df / 2, 1 / 2) at df / (df + t^2),
    by its continued fraction or, where that converges slowly, by the one of the mirrored
    form; either takes the same number of terms at all degrees.
    """
    # Beyond this size the square would leave the range of doubles.
    size = F.least(F.abs(t.cast("double")), F.lit(1e150))
    tail = _beta_tail(size * size / df.cast("double"), df.cast("double") / 2)
    return (
        F.when(t.isNull() | df.isNull() | (df < 1), F.lit(None).cast("double"))
        .when(F.abs(t.cast("double")) == F.lit(math.inf), F.lit(0.0))
        .otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), tail)))
    )


def _beta_tail(odds: Column, half: Column) -> Column:
    """I_x(half, 1/2) at x = 1 / (1 + odds)."""
    x, rest = 1 / (1 + odds), odds / (1 + odds)
    fast = x < (half + 1) / (half + 2.5)
    front = (
        F.exp(-half * F.log1p(odds)) * F.sqrt(rest) * _gamma_step(half) / math.sqrt(math.pi)
    )
    start = F.struct(
        F.lit(1.0).alias("value"),
        F.when(fast, half).otherwise(0.5).alias("a"),
        F.when(fast, F.lit(0.5)).otherwise(half).alias("b"),
        F.when(fast, x).otherwise(rest).alias("x"),
        front.alias("front"),
        fast.alias("fast"),
    )

    def step(state, m):
        # From the innermost pair of terms outwards.
        a, b, x = state["a"], state["b"], state["x"]
        odd = 1 - (a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)) / state["value"]
        even = 1 + m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)) / odd
        return state.withField("value", even)

    def finish(state):
        a, b, x = state["a"], state["b"], state["x"]
        part = state["front"] / a / (1 - (a + b) * x / (a + 1) / state["value"])
        return F.when(state["fast"], part).otherwise(1 - part)

    return F.aggregate(
        F.sequence(F.lit(FRACTION_TERMS), F.lit(1), F.lit(-1)), start, step, finish
    )


def _gamma_step(h: Column) -> Column:
    """Gamma(h + 1/2) / Gamma(h): its asymptotic series, 32 steps of the recurrence further up."""
    top = h + 32
    series = F.lit(1.0)
    # The series in powers of 1 / h.
    for power, term in enumerate(
        (-1 / 8, 1 / 128, 5 / 1024, -21 / 32768, -399 / 262144, 869 / 4194304), start=1
    ):
        series = series + term / F.pow(top, F.lit(float(power)))
    down = F.aggregate(
        F.sequence(F.lit(0), F.lit(31)),
        F.struct(F.lit(1.0).alias("value"), h.alias("h")),
        lambda state, i: state.withField(
            "value", state["value"] * (state["h"] + i) / (state["h"] + i + 0.5)
        ),
        lambda state: state["value"],
    )
    return F.sqrt(top) * series * down
