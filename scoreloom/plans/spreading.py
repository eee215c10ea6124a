"""Partitions for jobs that read the same rows many times."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, rows: int, rows_per_task: int) -> DataFrame:
    """``df`` over as many partitions as its ``rows`` can keep busy.

    Model fitting runs hundreds of short jobs over its input.  Input that came as
    a few files is shuffled once to use all cores; a table too small for them is
    merged, since the overhead of a task then exceeds its work.  Input already in
    as many partitions as there are cores, or more, stays where it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    useful = max(1, min(cores, -(-rows // rows_per_task)))
    present = df.rdd.getNumPartitions()
    if useful < cores:
        return df.coalesce(useful) if present > useful else df
    return df.repartition(cores) if present < cores else df


def spread_scan(df: DataFrame, key: str) -> DataFrame:
    """A table about to be worked on row by row, over all cores.

    A few files of few row groups would leave most cores idle during costly text
    work; such a table is shuffled by its key first.  A large one, which comes in
    more partitions than there are cores, is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df
