"""Phrase collocation mining by relations of occurrences (SETM).

The corpus is held as sorted relations of occurrences, one for each phrase length: (piece,
place, phrase), in chunks of some megabytes of texts of one language.  A relation is grouped
and counted over all chunks; the occurrences of groups that are not frequent are dropped
(a semi-join); what is left is merge-joined with itself by piece and adjacent place, which
gives the occurrences of the phrases that are one word longer, written in their turn.

Groups are counted from coded blocks (see ``blocks``): a chunk states each group with its
count once, however often it occurs.  A frequent group gets a number; two numbers, of a
phrase's first and last words but one, name a longer phrase exactly.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.llm.blocks import (
    bucketed,
    by_part,
    drop,
    increasing,
    packed,
    packed_words,
    part_count,
    restored,
    slice_numbers,
    unpacked,
    unpacked_words,
)
from scoreloom.llm.common import column_of, slices, stored, texts_of
from scoreloom.plans.sizing import small_table

CHUNK = 16 << 20
NO_LANG = "und"
# Products of counts pass 64 bits.
SCORE = "CAST(1000 AS DECIMAL(38, 0)) * a * total div (CAST(l AS DECIMAL(38, 0)) * r)"
# Characters between pieces, and those between words.
BETWEEN_PIECES = b".,;:!?\n\x0b\x0c\r"
BETWEEN_WORDS = b" \t"
BREAK = b"\xff"  # in no UTF-8 text
CLEAN = bytes.maketrans(BETWEEN_PIECES + b"\t", BREAK * len(BETWEEN_PIECES) + b" ")

RELATION = (
    "chunk long, lang string, pieces binary, places binary, groups binary, "
    "blocks array<struct<part int, left binary, right binary, counts binary>>"
)
BLOCK = pa.list_(
    pa.struct(
        [
            ("part", pa.int32()),
            ("left", pa.binary()),
            ("right", pa.binary()),
            ("counts", pa.binary()),
        ]
    )
)
# An answer to the block of a chunk, a frequent group, or the words of a language in a part.
COUNTED = (
    "kind string, chunk long, part int, found binary, numbers binary, "
    "lang string, number long, left long, right long, word binary, n long"
)


def _row(
    chunk: int,
    lang: str,
    pieces: np.ndarray,
    places: np.ndarray,
    groups: np.ndarray,
    blocks: list[dict],
) -> list[pa.Array]:
    return [
        pa.array([chunk], pa.int64()),
        pa.array([lang], pa.string()),
        pa.array([increasing(pieces)], pa.binary()),
        pa.array([increasing(places)], pa.binary()),
        pa.array([packed(groups.astype("<u4"))], pa.binary()),
        pa.array([blocks], BLOCK),
    ]


NAMES = ["chunk", "lang", "pieces", "places", "groups", "blocks"]


class Chunk:
    """Occurrences of single words in texts of one language."""

    def __init__(self) -> None:
        self.words = {BREAK: 0}
        self.codes: list[np.ndarray] = []
        self.size = 0

    def add(self, text: bytes) -> None:
        known = self.words
        words = text.lower().translate(CLEAN).replace(BREAK, b" \xff ").split()
        codes = np.fromiter(
            (known.setdefault(w, len(known)) for w in words), np.int32, len(words)
        )
        self.codes += [codes, np.zeros(1, np.int32)]  # a text ends its last piece
        self.size += len(text)

    def row(self, number: int, lang: str, parts: int) -> list[pa.Array]:
        codes = np.concatenate([np.zeros(0, np.int32), *self.codes])
        pieces = np.cumsum(codes == 0)
        places = np.flatnonzero(codes)
        counts = np.bincount(codes, minlength=len(self.words))
        by_part: dict[int, list[tuple[bytes, int]]] = {}
        for pair in self.words.items():
            if pair[1]:
                by_part.setdefault(zlib.crc32(pair[0]) % parts, []).append(pair)
        order: list[int] = []
        blocks = []
        for part in sorted(by_part):
            pairs = sorted(by_part[part])
            own = [i for _, i in pairs]
            order += own
            block = {"part": part, "left": packed_words([w for w, _ in pairs])}
            blocks.append(block | {"counts": packed(counts[own].astype("<u4"))})
        rank = np.zeros(len(self.words), np.uint32)
        rank[np.array(order, np.int64)] = np.arange(len(order), dtype=np.uint32)
        return _row(number, lang, pieces[places], places, rank[codes[places]], blocks)


def _word_occurrences(parts: int, most: int):
    """The relation of single words; a chunk holds texts of one language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = slice_numbers()
        open_: dict[str, Chunk] = {}
        for part in slices(batches, "text", most):
            langs = column_of(part, "lang").to_pylist()
            for lang, text in zip(langs, texts_of(part), strict=True):
                chunk = open_.setdefault(lang, Chunk())
                chunk.add(text)
                if chunk.size >= most:
                    yield pa.RecordBatch.from_arrays(chunk.row(next(numbers), lang, parts), NAMES)
                    del open_[lang]
        for lang, chunk in open_.items():
            yield pa.RecordBatch.from_arrays(chunk.row(next(numbers), lang, parts), NAMES)

    return run


def _by_part(batches: Iterator[pa.RecordBatch]) -> dict[int, list[dict]]:
    """The blocks of a task by part: mostly of one, several where Spark merges partitions."""
    found: dict[int, list[dict]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            found.setdefault(row["part"], []).append(row)
    return found


def _answers(rows: list[dict], numbers: np.ndarray, group_of: np.ndarray, sizes: list[int]):
    """For each block, the places of its frequent groups and their numbers."""
    out, end = [], 0
    for row, size in zip(rows, sizes, strict=True):
        own = numbers[group_of[end : end + size]]
        end += size
        places = np.flatnonzero(own >= 0)
        if len(places):
            found = {"found": increasing(places), "numbers": packed(own[places].astype("<i8"))}
            out.append({"kind": "answer", "chunk": row["chunk"], "part": row["part"]} | found)
    return out


def _number(totals: np.ndarray, least: int, part: int, used: int) -> np.ndarray:
    """Numbers of the groups that are frequent, -1 for the rest; no other part gives them."""
    frequent = totals >= least
    numbers = np.full(len(totals), -1, np.int64)
    numbers[frequent] = (part << 40) + used + np.arange(frequent.sum())
    return numbers


def _count_words(least: int, schema: pa.Schema):
    """Count the words of each part over all chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _by_part(batches).items():
            out, used = [], 0
            for lang in sorted({r["lang"] for r in rows}):
                own = [r for r in rows if r["lang"] == lang]
                lists = [unpacked_words(r["left"]) for r in own]
                coded = pa.concat_arrays(lists).dictionary_encode()
                group_of = coded.indices.to_numpy()
                counts = np.concatenate([unpacked(r["counts"], "<u4") for r in own])
                totals = np.bincount(group_of, counts).astype(np.int64)
                numbers = _number(totals, least, part, used)
                used += int((numbers >= 0).sum())
                out += _answers(own, numbers, group_of, [len(x) for x in lists])
                out += [
                    {"kind": "group", "lang": lang, "number": number, "word": word, "n": n}
                    for word, number, n in zip(
                        coded.dictionary.to_pylist(), numbers.tolist(), totals.tolist(), strict=True
                    )
                    if number >= 0
                ]
                out.append({"kind": "total", "lang": lang, "n": int(totals.sum())})
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _count_pairs(least: int, schema: pa.Schema):
    """Count the groups that two numbers name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _by_part(batches).items():
            left, right, counts = (
                [unpacked(r[c], kind) for r in rows]
                for c, kind in (("left", "<i8"), ("right", "<i8"), ("counts", "<u4"))
            )
            sizes = [len(x) for x in left]
            keys = np.stack([np.concatenate(left), np.concatenate(right)], 1)
            order = np.lexsort((keys[:, 1], keys[:, 0]))
            new = np.ones(len(order), bool)
            new[1:] = (keys[order][1:] != keys[order][:-1]).any(1)
            group_of = np.empty(len(order), np.int64)
            group_of[order] = np.cumsum(new) - 1
            totals = np.bincount(group_of, np.concatenate(counts)).astype(np.int64)
            numbers = _number(totals, least, part, 0)
            out = _answers(rows, numbers, group_of, sizes)
            langs = np.repeat([r["lang"] for r in rows], sizes)[order][new]
            firsts = keys[order][new]
            for i in np.flatnonzero(numbers >= 0).tolist():
                group = {"kind": "group", "lang": str(langs[i]), "number": int(numbers[i])}
                pair = {"left": int(firsts[i, 0]), "right": int(firsts[i, 1])}
                out.append(group | pair | {"n": int(totals[i])})
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of two numbers."""
    with np.errstate(over="ignore"):
        a = left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        b = (right.astype(np.uint64) ^ (a >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return b >> np.uint64(31)


def _extend(parts: int):
    """Drop the occurrences of groups that are not frequent, and join each with the next one.

    Occurrences are sorted by piece and place, so that of the merge-join by piece and adjacent
    place is the next row, if any.
    """

    def run(relation: pa.Table, answers: pa.Table) -> pa.Table:
        names = relation.schema.names
        none = relation.slice(0, 0)
        if not answers.num_rows:
            return none
        row = relation.to_pylist()[0]
        sizes = [len(unpacked(b["counts"], "<u4")) for b in row["blocks"]]
        start = {b["part"]: s for b, s in zip(row["blocks"], np.cumsum(sizes) - sizes, strict=True)}
        number_of = np.full(sum(sizes), -1, np.int64)
        for answer in answers.to_pylist():
            places = restored(answer["found"]) + start[answer["part"]]
            number_of[places] = unpacked(answer["numbers"], "<i8")
        numbers = number_of[unpacked(row["groups"], "<u4")]
        frequent = numbers >= 0
        numbers = numbers[frequent]
        pieces, places = restored(row["pieces"])[frequent], restored(row["places"])[frequent]

        next_to = np.flatnonzero((pieces[1:] == pieces[:-1]) & (places[1:] == places[:-1] + 1))
        if not len(next_to):
            return none
        known, local = np.unique(numbers, return_inverse=True)
        pairs, groups, counts = np.unique(
            local[next_to] * len(known) + local[next_to + 1],
            return_inverse=True,
            return_counts=True,
        )
        left, right = known[pairs // len(known)], known[pairs % len(known)]
        part = (_mixed(left, right) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        blocks = []
        edges = np.flatnonzero(np.diff(part[order], prepend=-1))
        for own in np.split(order, edges[1:]):
            blocks.append(
                {
                    "part": int(part[own[0]]),
                    "left": packed(left[own].astype("<i8")),
                    "right": packed(right[own].astype("<i8")),
                    "counts": packed(counts[own].astype("<u4")),
                }
            )
        columns = _row(
            row["chunk"], row["lang"], pieces[next_to], places[next_to], rank[groups], blocks
        )
        return pa.Table.from_arrays(columns, names=names)

    return run


def frequent_phrases(
    documents: DataFrame,
    least: int,
    most_words: int,
    lang: str = "lang",
    text: str = "text",
    chunk_bytes: int = CHUNK,
) -> tuple[DataFrame, DataFrame]:
    """Phrases of up to ``most_words`` words that occur ``least`` times or more, and word totals.

    The first table has (lang, words, phrase, n): words counts the words of the phrase, which is
    joined with spaces; occurrences may overlap.  The second has (lang, total), the words of all
    texts, frequent or not.  Texts are cut and put in lower case as the module's fixed values
    say.  A null language is ``und``; a null or empty text has no words; repeated rows count as
    often as they stand; an empty table gives two empty ones; other columns are not read.
    """
    spark = documents.sparkSession
    given = documents.select(
        F.coalesce(F.col(f"`{lang}`"), F.lit(NO_LANG)).alias("lang"),
        F.col(f"`{text}`").alias("text"),
    )
    parts = part_count(spark)
    schema = spark.createDataFrame([], COUNTED).toArrow().schema
    occurrences = given.mapInArrow(_word_occurrences(parts, chunk_bytes), RELATION)
    written = bucketed(occurrences, "chunk", "occurrences")
    levels: list[DataFrame] = []
    totals = None
    for words in range(1, most_words + 1):
        if words > 1:
            extended = (
                spark.table(written)
                .groupBy("chunk")
                .cogroup(answers.groupBy("chunk"))  # noqa: F821
                .applyInArrow(_extend(parts), RELATION)
            )
            shorter, written = written, bucketed(extended, "chunk", "occurrences")
            drop(spark, shorter)  # nothing reads the shorter phrases' occurrences any more
        blocks = spark.table(written).select("chunk", "lang", F.inline("blocks"))
        count = _count_words if words == 1 else _count_pairs
        counted = stored(by_part(blocks).mapInArrow(count(least, schema), COUNTED), "counted")
        answers = counted.filter("kind = 'answer'").select("chunk", "part", "found", "numbers")
        groups = counted.filter("kind = 'group'")
        if words == 1:
            sums = counted.filter("kind = 'total'").groupBy("lang").agg(F.sum("n").alias("total"))
            totals = sums.filter("total > 0")
            phrase = F.col("word").cast("string")
            named = groups.select("lang", "number", phrase.alias("phrase"), phrase.alias("last"), "n")
        else:
            before = levels[-1]
            heads = before.select(F.col("number").alias("left"), F.col("phrase").alias("head"))
            tails = before.select(F.col("number").alias("right"), "last")
            phrase = F.concat_ws(" ", "head", "last")
            named = (
                groups.select("lang", "number", "left", "right", "n")
                .join(heads, "left")
                .join(tails, "right")
                .select("lang", "number", phrase.alias("phrase"), "last", "n")
            )
        levels.append(stored(named, "phrases"))
    drop(spark, written)
    found = None
    for words, level in enumerate(levels, 1):
        rows = level.select("lang", F.lit(words).alias("words"), "phrase", "n")
        found = rows if found is None else found.union(rows)
    return found, totals


def collocations(
    documents: DataFrame,
    least: int = 100,
    most_words: int = 5,
    covered: int = 100,
    top: int = 2000,
    lang: str = "lang",
    text: str = "text",
    chunk_bytes: int = CHUNK,
) -> DataFrame:
    """The ``top`` phrases of two or more words of each language: lang, rank, phrase, a, l, r, n, score.

    a, l and r are the occurrences of the phrase and of its two parts at the cut that scores
    least, n the words of the language, score = floor(1000 a n / (l r)); of equal cuts the one
    after fewer words counts.  A phrase inside a longer one that occurs at least ``covered`` in
    a hundred times as often is left out.  Order: score and a descending, phrase ascending by
    its bytes.  See ``frequent_phrases`` for nulls, empty texts and tables, and repeated rows.
    """
    found, totals = frequent_phrases(documents, least, most_words, lang, text, chunk_bytes)
    found = stored(found.withColumn("w", F.split("phrase", " ")), "frequent")
    # Phrases inside a longer one, and how often the longer one occurs at most.
    inside = found.filter("words > 2").select(
        "lang", "n", "w", "words", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("k")
    )
    starts = F.sequence(F.lit(1), F.col("words") - F.col("k") + 1)
    part = F.array_join(F.slice("w", F.col("at"), F.col("k")), " ")
    longer = (
        inside.select("lang", "n", "w", "k", F.explode(starts).alias("at"))
        .groupBy("lang", part.alias("phrase"))
        .agg(F.max("n").alias("longer"))
    )
    candidates = found.filter("words >= 2").join(longer, ["lang", "phrase"], "left")
    kept = candidates.filter(
        F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("n"))
    )
    cuts = kept.select(
        "lang", "phrase", "n", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    ).select(
        "lang",
        "phrase",
        F.col("n").alias("a"),
        "k",
        F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("rest"),
    )
    counts = found.select("lang", "phrase", "n")
    sides = cuts.join(
        counts.withColumnsRenamed({"phrase": "first", "n": "l"}), ["lang", "first"]
    ).join(counts.withColumnsRenamed({"phrase": "rest", "n": "r"}), ["lang", "rest"])
    # A row for each language: broadcast only if they are few.
    scored = sides.join(small_table(totals), "lang").withColumn("score", F.expr(SCORE))
    cut = F.struct("score", "k", "l", "r")
    best = scored.groupBy("lang", "phrase", "a", "total").agg(F.min(cut).alias("cut"))
    flat = best.select(
        "lang", "phrase", "a", "cut.l", "cut.r", F.col("total").alias("n"), "cut.score"
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = flat.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= top)
    return ranked.select(
        "lang", F.col("nth").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
