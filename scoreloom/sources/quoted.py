"""Records of large quoted files, read by all cores: a quoted field may hold line ends.

Spark splits a file at lines, and whether a line starts a record depends on all quotes before
it.  One pass finds for every split in which state, inside or outside quotes, it ends for
either state it may begin in; these small answers are composed along each file.  A second pass
then knows how its split begins and cuts it into records.  Of records that cross the edge of a
split the parts are put together, at most one for each split.
"""

from __future__ import annotations

import sys
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The code of the tasks travels with the plan: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUOTE = '"'
STATES = "file string, start long, from_outside boolean, from_inside boolean, closes boolean"
PARTS = "file string, start long, owner long, whole boolean, first boolean, record string"


def ends_inside(line: str, inside: bool, sep: str) -> bool:
    """Whether the line ends within quotes, if it begins ``inside`` them or at a field's start.

    Quotes open a field only at its start; two of them inside stand for one.
    """
    at, fresh = 0, not inside
    while True:
        if inside:
            at = line.find(QUOTE, at)
            if at < 0:
                return True
            if line.startswith(QUOTE, at + 1):
                at += 2
            else:
                inside, at = False, at + 1
        elif fresh and line.startswith(QUOTE, at):
            inside, fresh, at = True, False, at + 1
        else:
            at = line.find(sep, at)
            if at < 0:
                return False
            at, fresh = at + 1, True


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], list[str]]]:
    """Runs of lines of one split each, in the order of the file."""
    for batch in batches:
        files, starts, values = (batch.column(i) for i in range(3))
        files, starts = files.to_pylist(), starts.to_numpy()
        new = [i for i in range(1, len(starts)) if files[i] != files[i - 1]]
        edges = sorted({0, *new, *(np.flatnonzero(np.diff(starts)) + 1).tolist(), len(starts)})
        for a, b in zip(edges, edges[1:], strict=False):
            yield (files[a], int(starts[a])), values.slice(a, b - a).to_pylist()


def _states(sep: str):
    """For each split, where it ends for both states it may begin in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], tuple[bool, bool, bool]] = {}
        for split, lines in _lines(batches):
            outside, inside, closes = found.get(split, (False, True, False))
            for line in lines:
                if QUOTE in line:
                    # From where both states have met they stay the same.
                    met = outside == inside
                    inside = ends_inside(line, inside, sep)
                    outside = inside if met else ends_inside(line, outside, sep)
                    closes = closes or not inside
            found[split] = outside, inside, closes
        rows = [(*split, *state) for split, state in found.items()]
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = [pa.string(), pa.int64(), *[pa.bool_()] * 3]
        names = ["file", "start", "from_outside", "from_inside", "closes"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
        )

    return run


def _records(sep: str, shared):
    """The records of each split; parts of a record that crosses splits name where it begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins = shared.value
        out: list[tuple] = []
        split, held, inside, owner, first = None, [], False, None, False

        def close(whole: bool) -> None:
            complete = whole and owner == split[1]
            record = "\n".join(held)
            if complete and record.endswith("\r"):
                record = record[:-1].replace("\r\n", "\n")
            out.append((*split, owner, complete, first, record))

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[]] * 6
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
            names = ["file", "start", "owner", "whole", "first", "record"]
            made = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(made, names)

        for own, lines in _lines(batches):
            if own != split:
                if held:
                    close(False)
                split, held = own, []
                if own not in begins:
                    raise RuntimeError(f"{own} was not a split of the first pass; read again")
                inside, owner = begins[own]
                first = own[1] == 0
            for line in lines:
                held.append(line)
                if QUOTE in line:
                    inside = ends_inside(line, inside, sep)
                if not inside:
                    close(True)
                    held, owner, first = [], split[1], False
            if out:
                yield batch()
        if held:
            close(False)
        yield batch()

    return run


def quoted_records(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """(file, first, record): the records of all files; ``first`` marks a file's first record.

    Records end at a line feed outside quotes, or at a carriage return and a line feed; in a
    record that ends so, those inside quotes become line feeds.  Empty lines between records are records too.  A file that ends within
    quotes ends its last record.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        "value",
    )
    files = defaultdict(list)
    for row in lines.mapInArrow(_states(sep), STATES).collect():  # a row for each split
        files[row["file"]].append(row)
    begins = {}
    for file, splits in files.items():
        inside, owner = False, None
        for row in sorted(splits, key=lambda r: r["start"]):
            begins[file, row["start"]] = inside, owner if inside else row["start"]
            if not inside or row["closes"]:
                owner = row["start"]
            inside = row["from_inside"] if inside else row["from_outside"]
    shared = spark.sparkContext.broadcast(begins)
    found = lines.mapInArrow(_records(sep, shared), PARTS)
    whole = found.filter("whole").select("file", "first", "record")
    parts = F.array_sort(F.collect_list(F.struct("start", "first", "record")))
    joined = F.array_join("parts.record", "\n")
    ended = F.regexp_replace(F.replace(joined, F.lit("\r\n"), F.lit("\n")), "\r$", "")
    crossing = (
        found.filter("NOT whole")
        .groupBy("file", "owner")
        .agg(parts.alias("parts"))
        .select(
            "file",
            F.get("parts", F.lit(0))["first"].alias("first"),
            F.when(joined.endswith("\r"), ended).otherwise(joined).alias("record"),
        )
    )
    return whole.union(crossing)
