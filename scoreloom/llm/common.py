"""Helpers the corpus operators share: durable tables, row numbers, bounded slices of Arrow batches."""

from __future__ import annotations

import sys
from collections.abc import Callable, Hashable, Iterator, Sequence
from contextlib import contextmanager
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scoreloom.plans.durable import fresh_path

LAST_ID = (1 << 63) - 1
SLICE_BYTES = 1 << 20
RELEASE_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the cluster's shared folder and read again; its lineage ends there."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Jobs in this context delete the files of their shuffles once their result is written."""
    before = spark.conf.get(RELEASE_SETTING)
    spark.conf.set(RELEASE_SETTING, "true")
    try:
        yield
    finally:
        spark.conf.set(RELEASE_SETTING, before)


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def number_rows(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Add the global row number, from 0, in the order of the columns ``order`` (nulls first).

    The rows are sorted over range partitions and written out with their place in
    the partition; the rows of the partitions before are then added.  Rows equal in
    all of ``order`` are told apart by their place in the input, so that a range can
    end among them and no task gets them all; give enough columns that rows equal in
    them are interchangeable.  Pass few columns: all of them are shuffled.
    """
    keys = [F.col(f"`{c}`").asc_nulls_first() for c in order]
    placed = stored(
        df.withColumn("_tie", F.monotonically_increasing_id())
        .orderBy(*keys, "_tie")
        .drop("_tie")
        .withColumn("_place", F.monotonically_increasing_id()),
        "numbered",
    )
    # Spark's id is the partition above bit 33 and the place in the partition below.
    part, place = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")
    # One row for each partition of the sort: small whatever the input.
    offsets = F.broadcast(counts.select("_part", before.alias("_before")))
    return (
        placed.withColumn("_part", part)
        .join(offsets, "_part")
        .withColumn(name, F.col("_before") + place)
        .drop("_part", "_before", "_place")
    )


def slices(
    batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of the batches whose values of ``column`` take about ``most`` bytes.

    A longer value is a part by itself, so memory follows the longest text, not the batch.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(column)
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            gone = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, gone + most, "right")))
            yield batch.slice(start, end - start)
            start = end


def per_process(key: Hashable, make: Callable[[], object]) -> object:
    """A value that lives as long as the Python worker, over the tasks it runs.

    The code of a stage is unpickled for every task, so its own globals don't last.
    """
    state = sys.modules.setdefault("_scoreloom_worker", ModuleType("_scoreloom_worker")).__dict__
    if key not in state:
        state[key] = make()
    return state[key]


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The texts as UTF-8; a null is empty."""
    column = column_of(batch, name)
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]
