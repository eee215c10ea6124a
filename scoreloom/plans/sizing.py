"""Size-checked small tables.

Class counts, quotas and score margins are joined to data of any size on a key
with a handful of values, so shuffling the data on that key would put a whole
class in one task.  Such tables are broadcast, but only after a count shows
that they are small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL_ROWS = 10_000
BROADCAST_ROWS = 1_000_000


def small_table(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """Return ``df`` marked for broadcast if it has at most ``max_rows`` rows.

    The rows are computed once and kept as a local table, so later uses cost
    nothing.  A larger table comes back unchanged and is joined by shuffle,
    where adaptive execution splits skewed partitions.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def at_most(df: DataFrame, rows: int) -> bool:
    return df.count() <= rows
