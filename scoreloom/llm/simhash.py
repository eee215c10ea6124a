"""SimHash near-duplicates by multi-index hashing.

A fingerprint holds 64 majority bits over the hashes of a text's word shingles.
Two fingerprints link at ``max_distance`` differing bits or fewer.  They are cut
into so many segments that linked ones differ by two bits at most in one of them;
each is then listed in a table under its own value of every segment and under all
values one bit away (a small Hamming ball), so linked ones meet under a common
value, and the full distance is verified there.

Copies and equal fingerprints are one row from the start.  Under one value only a
spanning forest of the verified links is emitted, never all pairs, and a value with
more fingerprints than fit one task is compared in pairs of blocks.  The links are
joined to components in Spark, by alternating stars.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import column_of, slices, stored, texts_of

BITS = 64
SEED = 42
SHINGLE_BLOCK = 1 << 16
BLOCK_FINGERPRINTS = 1 << 16
FINISH_EDGES = 1 << 20


def fingerprint(text: bytes, shingle: int) -> int:
    """The fingerprint of one UTF-8 text; 0 if it has no words."""
    words = text.lower().split()  # of bytes: ASCII letters and white space only
    if not words:
        return 0
    runs = max(1, len(words) - shingle + 1)
    ones = np.zeros(BITS, np.int64)
    for start in range(0, runs, SHINGLE_BLOCK):
        end = min(runs, start + SHINGLE_BLOCK)
        shifted = [words[start + i : end + i] for i in range(min(shingle, len(words)))]
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(b" ".join(x), SEED) for x in zip(*shifted, strict=True)),
            np.uint64,
            end - start,
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * ones > runs, bitorder="little")
    return int(majority.view(np.int64)[0])


def with_fingerprint(df: DataFrame, shingle: int, text: str = "text") -> DataFrame:
    """``df`` without its text, with ``fingerprint`` as a signed long.

    A null text has no words.  A column named fingerprint is replaced.
    """
    kept = [c for c in df.columns if c not in (text, "fingerprint")]
    schema = df.select(*(f"`{c}`" for c in kept)).schema.add("fingerprint", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            prints = [fingerprint(t, shingle) for t in texts_of(part, text)]
            columns = [column_of(part, c) for c in kept] + [pa.array(prints, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "fingerprint"])

    wanted = df.drop("fingerprint") if text != "fingerprint" else df
    return wanted.mapInArrow(run, schema)


def segments(max_distance: int) -> list[tuple[int, int]]:
    """(first bit, width) of segments, one of which holds two differing bits at most."""
    n = max_distance // 3 + 1
    edges = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def listed(prints: DataFrame, max_distance: int) -> DataFrame:
    """A row (part, value, fingerprint) for every value of every segment's small ball."""
    entries: list[Column] = []
    for part, (first, width) in enumerate(segments(max_distance)):
        mask = (1 << width) - 1 if width < BITS else -1
        own = F.shiftrightunsigned("fingerprint", first).bitwiseAND(F.lit(mask))
        ball = [own, *(own.bitwiseXOR(F.lit(_signed(1 << b))) for b in range(width))]
        entries += [F.struct(F.lit(part).alias("part"), v.alias("value")) for v in ball]
    rows = prints.select("fingerprint", F.explode(F.array(*entries)).alias("at"))
    return rows.select("at.part", "at.value", "fingerprint")


def _signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >= 1 << (BITS - 1) else bits


def forest(prints: np.ndarray, max_distance: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links (root, member) that connect what is connected within ``prints``, distinct values."""
    roots, members = [], []
    left = prints
    while left.size:
        root, left = left[0], left[1:]
        found = [root]
        while found and left.size:
            near = np.bitwise_count(left ^ found.pop()) <= max_distance
            if near.any():
                reached, left = left[near], left[~near]
                roots.append(np.full(reached.size, root))
                members.append(reached)
                found.extend(reached)
    return roots, members


LINKS = "part int, value long, a long, b long"


def _link(max_distance: int, limit: int | None):
    """Links of every (part, value); the rows of a value come one after the other.

    A value with more than ``limit`` fingerprints is passed on instead, as rows with a
    null b.
    """

    def table(part, value, a, b) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array(part, pa.int32()),
                pa.array(value, pa.int64()),
                pa.array(a, pa.int64()),
                pa.array(b, pa.int64()) if b is not None else pa.nulls(len(a), pa.int64()),
            ],
            ["part", "value", "a", "b"],
        )

    def links(prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        roots, members = forest(np.unique(prints.view(np.uint64)), max_distance)
        if roots:
            a = np.concatenate(roots).view(np.int64)
            zeros = np.zeros(a.size, np.int64)
            yield table(zeros.astype(np.int32), zeros, a, np.concatenate(members).view(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, held, held_rows, over = None, [], 0, False
        for batch in batches:
            part = column_of(batch, "part").to_numpy()
            value = column_of(batch, "value").to_numpy()
            prints = column_of(batch, "fingerprint").to_numpy()
            if not len(part):
                continue
            new = np.r_[True, (part[1:] != part[:-1]) | (value[1:] != value[:-1])]
            starts = np.flatnonzero(new)
            ends = np.r_[starts[1:], len(part)]
            pair_a, pair_b = [], []
            for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
                first, last = start == 0, end == len(part)
                if not first and not last:
                    if end - start == 1:
                        continue
                    if end - start == 2:
                        pair_a.append(start)
                        pair_b.append(start + 1)
                    elif limit is None or end - start <= limit:
                        yield from links(prints[start:end])
                    else:
                        yield table(part[start:end], value[start:end], prints[start:end], None)
                    continue
                key = (int(part[start]), int(value[start]))
                if key != open_key:
                    if held and held_rows > 1:
                        yield from links(np.concatenate(held))
                    open_key, held, held_rows, over = key, [], 0, False
                held.append(prints[start:end])
                held_rows += end - start
                if limit is not None and (over or held_rows > limit):
                    over = True
                    rows = np.concatenate(held)
                    yield table(
                        np.full(rows.size, key[0], np.int32), np.full(rows.size, key[1]), rows, None
                    )
                    held = []
            if pair_a:
                a, b = prints[pair_a], prints[pair_b]
                near = np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)) <= max_distance
                near &= a != b
                a, b = a[near], b[near]
                zeros = np.zeros(a.size, np.int64)
                yield table(zeros.astype(np.int32), zeros, a, b)
        if held and held_rows > 1:
            yield from links(np.concatenate(held))

    return run


def links(prints: DataFrame, max_distance: int, limit: int = BLOCK_FINGERPRINTS) -> DataFrame:
    """Links (a, b) between distinct fingerprints that connect exactly what is near.

    A link is left out only where others connect its ends.
    """
    rows = listed(prints, max_distance)
    by_value = rows.repartition("part", "value").sortWithinPartitions("part", "value")
    found = stored(by_value.mapInArrow(_link(max_distance, limit), LINKS), "links")
    hot = found.filter(F.col("b").isNull()).select("part", "value", F.col("a").alias("fingerprint"))
    near = found.filter(F.col("b").isNotNull()).select("a", "b")
    if not hot.isEmpty():
        # A hot value is cut into blocks of fingerprints, every two of which are compared.
        sizes = hot.groupBy("part", "value").agg(F.count("*").alias("n"))
        blocks = F.ceil(F.col("n") * 2 / F.lit(limit)).cast("int")
        block = F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        low, high = F.least("block", "other"), F.greatest("block", "other")
        pairs = (
            hot.join(sizes.withColumn("blocks", blocks), ["part", "value"])
            .select("part", "value", "fingerprint", "blocks", block.alias("block"))
            .select("*", other.alias("other"))
            .select(
                "fingerprint",
                F.xxhash64("part", "value").alias("value"),
                (low * F.col("blocks") + high).alias("part"),
            )
            .repartition("part", "value")
            .sortWithinPartitions("part", "value")
        )
        near = near.union(pairs.mapInArrow(_link(max_distance, None), LINKS).select("a", "b"))
    return near.distinct()


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root) of all edges of the task, by hooking larger roots on smaller ones."""
    parts = [(column_of(x, "a").to_numpy(), column_of(x, "b").to_numpy()) for x in batches]
    a = np.concatenate([x for x, _ in parts]) if parts else np.zeros(0, np.int64)
    b = np.concatenate([x for _, x in parts]) if parts else np.zeros(0, np.int64)
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, other = at[: len(a)], at[len(a) :]
    parent = np.arange(len(nodes))
    while True:
        low = np.minimum(parent[one], parent[other])
        high = np.maximum(parent[one], parent[other])
        open_ = low < high
        if not open_.any():
            break
        np.minimum.at(parent, high[open_], low[open_])
        while (parent[parent] != parent).any():
            parent = parent[parent]
    hung = parent != np.arange(len(nodes))
    yield pa.RecordBatch.from_arrays(
        [pa.array(nodes[hung]), pa.array(nodes[parent[hung]])], ["node", "root"]
    )


def components(
    edges: DataFrame, a: str = "a", b: str = "b", finish: int = FINISH_EDGES
) -> DataFrame:
    """(node, root) of every node of the edges but the roots; root is the smallest node connected to it.

    Large star and small star in turn, each a join and an aggregate, until no edge
    changes; then every node hangs on its root.  Each round is written to the shared
    folder.  Once at most ``finish`` edges are left, a bound that fits any task, one task
    joins them; the result is the same.
    """

    def digest(df: DataFrame) -> tuple:
        row = df.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        return row["n"], row["x"]

    now = edges.select(
        F.greatest(a, b).alias("a"), F.least(a, b).alias("b")
    ).filter("a <> b").distinct()
    now = stored(now, "edges")
    seen = digest(now)
    while seen[0]:
        if seen[0] <= finish:
            return now.coalesce(1).mapInArrow(_roots, "node long, root long")
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), "m")
        large = large.withColumnRenamed("m", "b").filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = (
            small.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b")))
            .filter("a <> b")
            .distinct()
        )
        now = stored(small, "edges")
        before, seen = seen, digest(now)
        if before == seen:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(
    documents: DataFrame, shingle: int = 4, max_distance: int = 4, key: str = "doc_id"
) -> DataFrame:
    """``documents`` without text, with fingerprint (signed long) and component_id.

    component_id is the smallest key reachable over links, the row's own included; a null
    key is never the smallest unless a component has no other, when it is null.  Texts
    without words (null, empty, white space) have fingerprint zero and are near each other.
    Repeated rows stay repeated.  An empty table gives an empty result.
    """
    return classified(documents, shingle, max_distance, key).drop("root")


def classified(
    documents: DataFrame, shingle: int = 4, max_distance: int = 4, key: str = "doc_id"
) -> DataFrame:
    """As near_duplicates, with ``root``, the fingerprint that stands for the component.

    Components of unlike texts can share a component_id (null, or a repeated key), but not a root.
    """
    printed = documents.drop("component_id", "root")
    printed = stored(with_fingerprint(printed, shingle), "fingerprints")
    first = printed.groupBy("fingerprint").agg(F.min(f"`{key}`").alias("_first"))
    first = stored(first, "distinct")
    rooted = components(links(first.select("fingerprint"), max_distance))
    rooted = rooted.withColumnRenamed("node", "fingerprint")
    classed = first.join(rooted, "fingerprint", "left").withColumn(
        "root", F.coalesce("root", "fingerprint")
    )
    smallest = classed.groupBy("root").agg(F.min("_first").alias("component_id"))
    classes = classed.join(smallest, "root").select("fingerprint", "root", "component_id")
    return printed.join(classes, "fingerprint")


def hexadecimal(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def drop_near_duplicates(
    documents: DataFrame, shingle: int = 4, max_distance: int = 4, key: str = "doc_id"
) -> DataFrame:
    """One row of each component: that of the smallest key, then of the smallest text hash.

    Null keys come last.  Of repeated rows one stays.  Columns are those of ``documents``.
    """
    names = documents.columns
    text_hash = F.xxhash64(F.col("text"))
    keyed = documents.select(F.col(f"`{key}`").alias("_key"), text_hash.alias("_hash"), "text")
    found = classified(keyed, shingle, max_distance, "_key").drop("fingerprint")
    found = found.withColumn("_null", F.col("_key").isNull())
    best = F.min(F.struct("_null", "_key", "_hash")).alias("_best")
    chosen = found.groupBy("root").agg(best).select("_best._key", "_best._hash")
    chosen = stored(chosen, "chosen")
    repeated = stored(
        found.groupBy("_key", "_hash").agg(F.count("*").alias("_n")).filter("_n > 1").drop("_n"),
        "repeated",
    )
    rows = documents.withColumns({"_row_key": F.col(f"`{key}`"), "_row_hash": text_hash})

    def same(other: DataFrame) -> Column:
        return F.col("_row_key").eqNullSafe(other["_key"]) & (F.col("_row_hash") == other["_hash"])

    kept = rows.join(chosen, same(chosen), "left_semi")
    if not repeated.isEmpty():
        several = kept.join(repeated, same(repeated), "left_semi")
        single = kept.join(repeated, same(repeated), "left_anti")
        kept = single.unionByName(several.dropDuplicates(["_row_key", "_row_hash"]))
    return kept.select(*(f"`{c}`" for c in names))

