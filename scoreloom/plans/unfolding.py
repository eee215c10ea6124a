"""Arrays to rows without computing the array twice.

Spark infers ``size(array) > 0`` from a plain ``explode`` and pushes it below the
projection that computes the array, which then runs once for the filter and once
more for the rows; a computed array that other expressions use several times is
even inlined into each of them.  The outer form infers nothing, and the rows it
adds for empty arrays are dropped afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unfold(df: DataFrame, array: Column | str, name: str, *keep: str) -> DataFrame:
    """The columns ``keep`` and one row per element of ``array`` as ``name``."""
    rows = df.select(*keep, F.explode_outer(array).alias(name))
    return rows.filter(F.col(name).isNotNull())


def unfold_places(df: DataFrame, array: Column | str, at: str, name: str, *keep: str) -> DataFrame:
    """Like :func:`unfold`, with the 0-based place of the element as ``at``."""
    rows = df.select(*keep, F.posexplode_outer(array).alias(at, name))
    return rows.filter(F.col(name).isNotNull())
