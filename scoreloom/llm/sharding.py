"""Reproducible shuffle into shards by a Feistel permutation of global row numbers.

Rows are numbered 0 to n-1 by their key.  A Feistel network over pairs
``(left, right)`` with ``left < a`` and ``right < b`` permutes 0 to ``a*b - 1``;
numbers that land at n or beyond go through it again (cycle walking), which makes
it a permutation of 0 to n-1.  The row with image ``p`` gets shard ``p % shards``
and slot ``p // shards``: shard sizes differ by one at most, slots have no gaps,
and either can be computed from the row number, or the row number from them,
without looking at any other row.

Only DataFrame functions are used.  The rows that move are keys, not texts.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.llm.common import number_rows

ROUNDS = 4


def quotient(number: Column, by: int) -> Column:
    return F.call_function("div", number, F.lit(by))


@dataclass(frozen=True)
class Permutation:
    """A pseudo-random permutation of 0 to ``size - 1``, fixed by ``seed``."""

    size: int
    seed: int = 0
    rounds: int = ROUNDS

    @property
    def sides(self) -> tuple[int, int]:
        """The smallest near-square grid of ``size`` cells; fewer than its width are spare."""
        wide = math.isqrt(max(0, self.size - 1)) + 1
        return wide, max(1, -(-self.size // wide))

    def _noise(self, half: Column, turn: Column, which: int, side: int) -> Column:
        return F.pmod(F.xxhash64(half, turn, F.lit(2 * self.seed + which)), F.lit(side))

    def _network(self, number: Column, forward: bool) -> Column:
        wide, high = self.sides

        def turn(state: Column, at: Column) -> Column:
            left, right = state["left"], state["right"]
            if forward:
                left = F.pmod(left + self._noise(right, at, 0, wide), F.lit(wide))
                right = F.pmod(right + self._noise(left, at, 1, high), F.lit(high))
            else:
                right = F.pmod(right - self._noise(left, at, 1, high), F.lit(high))
                left = F.pmod(left - self._noise(right, at, 0, wide), F.lit(wide))
            return F.struct(left.alias("left"), right.alias("right"))

        turns = list(range(self.rounds)) if forward else list(range(self.rounds))[::-1]
        number = number.cast("long")
        start = F.struct(
            F.pmod(number, F.lit(wide)).cast("long").alias("left"),
            quotient(number, wide).alias("right"),
        )
        return F.aggregate(
            F.array(*map(F.lit, turns)), start, turn, lambda x: x["right"] * wide + x["left"]
        )

    def longest_walk(self, spark: SparkSession, forward: bool = True) -> int:
        """Passes through the network after which every number is inside.

        A walk can only go on from one of the spare cells, fewer than the square root of
        ``size``, so these alone are followed.  Spare cells that map among themselves in a
        circle never come in, and no walk from inside meets them: once a pass brings no further
        cell in, only those are left.
        """
        wide, high = self.sides
        outside = spark.range(self.size, wide * high).withColumnRenamed("id", "at")
        passes, left = 1, wide * high - self.size
        while left:
            outside = outside.select(self._network(F.col("at"), forward).alias("at"))
            outside = outside.filter(F.col("at") >= self.size)
            before, left = left, outside.count()
            if left == before:
                break
            passes += 1
        return passes

    def image(self, number: Column, passes: int, forward: bool = True) -> Column:
        """Where ``number`` goes (or comes from); ``passes`` as ``longest_walk`` found."""
        first = self._network(number, forward)
        if passes == 1:
            return first

        def walk(at: Column, _: Column) -> Column:
            inside = at < F.lit(self.size)
            return F.when(inside, at).otherwise(self._network(at, forward))

        return F.aggregate(F.sequence(F.lit(2), F.lit(passes)), first, walk)


def shard_rows(df: DataFrame, order: Sequence[str], shards: int, seed: int = 0) -> DataFrame:
    """``df`` with row_number, shard and slot.

    The order of the rows is that of the columns ``order``, nulls first; name enough of
    them that rows equal in all are interchangeable.  Repeated rows each get a place of
    their own.  An empty table gives an empty result.  Columns named like the three
    that are added are replaced.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    df = df.drop("row_number", "shard", "slot")
    numbered = number_rows(df, order, "row_number")
    size = numbered.count()
    permutation = Permutation(size, seed)
    passes = permutation.longest_walk(df.sparkSession) if size else 1
    place = permutation.image(F.col("row_number"), passes)
    return (
        numbered.withColumn("_image", place)
        .withColumn("shard", F.pmod("_image", F.lit(shards)).cast("int"))
        .withColumn("slot", quotient(F.col("_image"), shards))
        .drop("_image")
    )


def rows_at(places: DataFrame, size: int, shards: int, seed: int = 0) -> DataFrame:
    """The row numbers behind rows of (shard, slot): the way back, without the data."""
    permutation = Permutation(size, seed)
    passes = permutation.longest_walk(places.sparkSession, forward=False)
    image = F.col("slot") * shards + F.col("shard")
    return places.withColumn("row_number", permutation.image(image, passes, forward=False))


def document_keys(documents: DataFrame) -> DataFrame:
    """What moves of a document: doc_id, size in bytes with 16 of overhead, checksum.

    A null text has no bytes: size 16 and the checksum of nothing, 0.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return documents.select(
        F.col("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
