"""Exact places and running totals within ordered groups, without one-task groups.

``row_number() over (partition by g order by o)`` sorts each group in one task.
That is the best plan while groups are of ordinary size, and it fails when one
group holds a large share of the data.  ``place_in_group`` counts the groups
first (partial aggregates, one number per group), keeps the plain window for
ordinary groups and spreads the others over range-partitioned slices of the
sort order:

1. range-partition the hot rows on (group, order) and write them out, so that
   the slice of every row is fixed;
2. total each slice and add up the totals of the slices before it;
3. number the rows inside each slice and add the offset.

Rows equal in every column cannot be separated by their order; with
``collapse=True`` they become one row with a ``copies`` count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.plans.durable import cut
from scoreloom.plans.sizing import SMALL_ROWS, small_table

MAX_GROUP_ROWS = 4_000_000


def place_in_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    running: Mapping[str, str] | None = None,
    place: str = "pos",
    collapse: bool = False,
    max_group_rows: int = MAX_GROUP_ROWS,
    largest: int | None = None,
) -> DataFrame:
    """Add the 1-based ``place`` of each row in its group, and running totals.

    ``running`` maps a new column to the numeric column whose total up to and
    including the row it holds.  With ``collapse`` the result has a ``copies``
    column, ``place`` is that of the first copy and the totals count each copy.
    ``largest`` is the size of the largest group, if the caller has counted it.
    """
    running = dict(running or {})
    group = list(group)
    if largest is None:
        largest = largest_group(df, group)
    if largest <= max_group_rows:
        return _by_window(df, group, order, running, place, collapse)
    if not group:
        return _by_slices(df, group, order, running, place, collapse, max_group_rows)

    hot = _hot_groups(df, group, max_group_rows)
    same_group = [F.col(c).eqNullSafe(F.col(f"_hot_{c}")) for c in group]
    ordinary = df.join(hot, same_group, "left_anti")
    crowded = df.join(hot, same_group, "left_semi")
    return _by_window(ordinary, group, order, running, place, collapse).unionByName(
        _by_slices(crowded, group, order, running, place, collapse, max_group_rows)
    )


def _sizes(df: DataFrame, group: Sequence[str]) -> DataFrame:
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows"))


def largest_group(df: DataFrame, group: Sequence[str]) -> int:
    """Rows of the largest group: one number, from counts combined before the shuffle."""
    return _sizes(df, group).agg(F.max("_rows")).first()[0] or 0


def _hot_groups(df: DataFrame, group: list[str], max_group_rows: int) -> DataFrame:
    hot = _sizes(df, group).filter(F.col("_rows") > max_group_rows)
    return small_table(hot.select(*[F.col(c).alias(f"_hot_{c}") for c in group]))


def _by_window(df, group, order, running, place, collapse):
    ordered = Window.partitionBy(*group).orderBy(*order)
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    columns = {place: F.row_number().over(ordered).cast("long")}
    columns |= {name: F.sum(of).over(upto) for name, of in running.items()}
    if collapse:
        columns["copies"] = F.lit(1).cast("long")
    return df.withColumns(columns)


def _by_slices(df, group, order, running, place, collapse, max_group_rows):
    original = df.columns
    if collapse:
        df = df.groupBy(*original).agg(F.count(F.lit(1)).alias("copies"))
    else:
        df = df.withColumn("copies", F.lit(1).cast("long"))
    rows = df.count()
    session_width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = max(session_width, -(-4 * rows // max_group_rows), 2)
    keys = [F.col(c) for c in group]
    sliced = cut(
        df.repartitionByRange(slices, *keys, *order).withColumn("_slice", F.spark_partition_id())
    )

    weight = {f"_w_{name}": F.col(of) * F.col("copies") for name, of in running.items()}
    sliced = sliced.withColumns({"_w_copies": F.col("copies")} | weight)
    totals = list(weight) + ["_w_copies"]
    slice_keys = group + ["_slice"]
    earlier = (
        Window.partitionBy(*group)
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        sliced.groupBy(*slice_keys)
        .agg(*[F.sum(c).alias(c) for c in totals])
        .select(
            *[F.col(c).alias(f"_o_{c}") for c in slice_keys],
            *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_before{c}") for c in totals],
        )
    )
    offsets = small_table(offsets, max_rows=SMALL_ROWS + slices)

    inside = (
        Window.partitionBy(*slice_keys)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    numbered = sliced.withColumns({f"_upto{c}": F.sum(c).over(inside) for c in totals}).join(
        offsets, [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in slice_keys]
    )
    total = {c: F.col(f"_before{c}") + F.col(f"_upto{c}") for c in totals}
    result = [F.col(c) for c in original]
    result.append((total["_w_copies"] - F.col("copies") + 1).cast("long").alias(place))
    result += [total[f"_w_{name}"].alias(name) for name in running]
    if collapse:
        result.append("copies")
    return numbered.select(*result)
