"""Sorted, coded blocks: how large relations of a slice of the corpus travel between tasks.

A slice (some megabytes of texts) states every distinct word or group it holds once, in one
block for each of a number of parts; the part of a word or group follows from its value, so
one task sees all blocks of a part, settles each distinct value once, and answers every
block in its own order.  A value brings one entry for each slice, however often it occurs:
no value can fill a task, and blocks take a fraction of the room of single rows.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from scoreloom.plans.durable import shared_folder

MAX_BUCKETS = 100_000


def part_count(spark: SparkSession) -> int:
    """As many parts as the session has shuffle partitions, which are to follow the input."""
    return min(MAX_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _fresh_table(spark: SparkSession, name: str) -> str:
    folder = f"{shared_folder(spark).rstrip('/')}/tables"
    database = f"scoreloom_{zlib.crc32(folder.encode()):08x}"
    # A database of the shared folder, so that dropping a table deletes its files.
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{folder}'")
    return f"{database}.{name}_{uuid.uuid4().hex}"


def as_table(df: DataFrame, name: str) -> str:
    """``df`` as a table in the shared folder.

    Returns the table's name; ``drop`` takes the table and its files away.
    """
    table = _fresh_table(df.sparkSession, name)
    df.write.saveAsTable(table)
    return table


def bucketed(df: DataFrame, key: str, name: str) -> str:
    """As ``as_table``, in buckets of ``key``, read without a shuffle."""
    table = _fresh_table(df.sparkSession, name)
    df.write.bucketBy(part_count(df.sparkSession), key).saveAsTable(table)
    return table


def drop(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE {table}")


def by_part(blocks: DataFrame) -> DataFrame:
    """Every part in a partition of its own."""
    return blocks.repartitionById(part_count(blocks.sparkSession), "part")


def slice_numbers() -> Iterator[int]:
    """Numbers that no other task uses."""
    first = TaskContext.get().partitionId() << 32
    at = 0
    while True:
        yield first + at
        at += 1


def packed(values: np.ndarray) -> bytes:
    """The array, byte by byte of all its items, compressed."""
    flat = np.ascontiguousarray(values)
    planes = np.ascontiguousarray(flat.view(np.uint8).reshape(-1, flat.itemsize).T)
    return packed_bytes(planes.tobytes())


def unpacked(data: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(unpacked_bytes(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(kind)


def packed_bytes(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unpacked_bytes(data: bytes) -> bytes:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], size, codec="zstd", asbytes=True) if size else b""


def packed_words(words: list[bytes]) -> bytes:
    sizes = np.fromiter(map(len, words), "<u4", len(words))
    return len(words).to_bytes(8, "little") + packed_bytes(sizes.tobytes() + b"".join(words))


def unpacked_words(data: bytes) -> pa.Array:
    """The words as an Arrow array of binaries."""
    n = int.from_bytes(data[:8], "little")
    raw = unpacked_bytes(data[8:])
    sizes = np.frombuffer(raw, "<u4", n)
    ends = np.zeros(n + 1, np.int64)
    np.cumsum(sizes, out=ends[1:])
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(raw[4 * n :])]
    )


def increasing(values: np.ndarray) -> bytes:
    """Values that never fall, coded by their steps."""
    return packed(np.diff(values.astype("<u4"), prepend=np.uint32(0)))


def restored(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, "<u4"), dtype=np.uint32)


def runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, …``, ``counts[i]`` of them, for each i in turn."""
    before = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) + np.repeat(starts - before, counts)
