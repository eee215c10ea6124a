"""Fixity audit of WARC archives with Merkle trees.

Records are hashed; every ``fan_out`` of them, in the order of file and offset, make a
node whose hash covers theirs and the range of offsets, and so on up to one root.  Two
replicas with equal roots are equal.  Otherwise the audit descends level by level, only
below nodes that differ, and ends at the damaged records.

Only DataFrame functions; a node is an aggregate over at most ``fan_out`` rows, so no
group grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.llm.common import number_rows, stored
from scoreloom.llm.sharding import quotient

FAN_OUT = 16
FILE_RECORDS = 1000
LINE = "\r\n"


def record(page_id: Column, url: Column, html: Column) -> Column:
    """A page as the bytes of a WARC resource record; nulls are empty."""
    url, html = F.coalesce(url, F.lit("")), F.coalesce(html, F.lit(""))
    name = F.coalesce(page_id.cast("string"), F.lit(""))
    head = F.concat(
        F.lit(f"WARC/1.0{LINE}WARC-Type: resource{LINE}WARC-Record-ID: <urn:page:"),
        name,
        F.lit(f">{LINE}WARC-Target-URI: "),
        url,
        F.lit(f"{LINE}Content-Type: text/html{LINE}Content-Length: "),
        F.octet_length(html).cast("string"),
        F.lit(LINE + LINE),
    )
    return F.concat(head, html, F.lit(LINE + LINE)).cast("binary")


def digest(data: Column) -> Column:
    return F.sha2(data, 256)


def manifest(
    records: DataFrame, order: list[str], size: str = "size", file_records: int = FILE_RECORDS
) -> DataFrame:
    """``records`` (narrow rows, without their bytes) with their place in the archive.

    Adds ordinal, file and offset: files of ``file_records`` records in the order of the
    columns ``order``, nulls first; a record starts where the one before it ends.
    """
    placed = number_rows(records.drop("ordinal", "file", "offset"), order, "ordinal")
    placed = placed.withColumn("file", quotient(F.col("ordinal"), file_records))
    before = Window.partitionBy("file").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(size).over(before), F.lit(0)).cast("long")
    return placed.withColumn("offset", offset)


def tree(leaves: DataFrame, fan_out: int = FAN_OUT) -> list[DataFrame]:
    """The levels of the Merkle tree, leaves first, each with node and hash.

    ``leaves`` has ordinal, file, offset, size and hash; a null hash is that of a record that
    can't be read.  A replica without records has one empty level.
    """
    level = leaves.select(
        F.col("ordinal").alias("node"),
        F.coalesce("hash", F.lit("")).alias("hash"),
        F.struct("file", "offset").alias("first"),
        F.struct("file", (F.col("offset") + F.col("size")).alias("offset")).alias("last"),
    )
    levels = [stored(level, "level")]
    # One more than the highest node of a level.
    width = (levels[0].agg(F.max("node")).first()[0] or 0) + 1
    while width > 1:
        children = F.array_sort(F.collect_list(F.struct("node", "hash")))
        parents = (
            levels[-1]
            .groupBy(quotient(F.col("node"), fan_out).alias("parent"))
            .agg(children.alias("children"), F.min("first").alias("first"), F.max("last").alias("last"))
        )
        named = F.transform(
            "children", lambda c: F.concat_ws(":", c["node"].cast("string"), c["hash"])
        )
        covered = F.concat_ws(
            "|",
            F.to_json("first"),
            F.to_json("last"),
            F.array_join(named, ","),
        )
        level = parents.select(
            F.col("parent").alias("node"),
            digest(covered.cast("binary")).alias("hash"),
            "first",
            "last",
        )
        levels.append(stored(level, "level"))
        width = -(-width // fan_out)
    return levels


def audit(one: list[DataFrame], other: list[DataFrame], fan_out: int = FAN_OUT) -> DataFrame:
    """(node) of the leaves in which two trees differ, or that only one of them has.

    Nodes are compared from the roots down, and only below nodes that differ.  Trees of
    unequal height are compared from the lower one's top.
    """
    height = min(len(one), len(other))
    suspects = None
    for level in range(height - 1, -1, -1):
        a, b = one[level].select("node", "hash"), other[level].select("node", "hash")
        if suspects is not None:
            parent = quotient(F.col("node"), fan_out)
            a = a.join(suspects, parent == F.col("suspect"), "left_semi")
            b = b.join(suspects, parent == F.col("suspect"), "left_semi")
        a = a.withColumnRenamed("hash", "_one")
        b = b.withColumnRenamed("hash", "_other")
        both = a.join(b, "node", "full").filter(~F.col("_one").eqNullSafe(F.col("_other")))
        suspects = stored(both.select(F.col("node").alias("suspect")), "suspects")
        if suspects.isEmpty():
            break
    return suspects.withColumnRenamed("suspect", "node")
