"""Benchmark decontamination by a broadcast hash set of n-grams.

Words are runs of letters, digits and characters beyond ASCII, with A-Z lower-cased.
Every window of ``window`` consecutive words of a benchmark text, or the whole of a
shorter one, is hashed; documents are scanned once, all their windows hashed with
array operations and looked up.  A window whose hash is found counts only if its
words are those of the benchmark window.

The set is broadcast in blocks of a stated number of windows, whatever the size of the
benchmark: usually one block; a larger benchmark takes one scan of the documents for
each block, and the hits are joined.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from scoreloom.llm.common import column_of, slices, stored, texts_of

WINDOW = 10
BLOCK_WINDOWS = 1 << 20
ADDED = ("n_words", "n_hit", "items", "spans")

# Lower case for A-Z, itself for other word bytes, 0 for the rest.
_LETTERS = np.zeros(256, np.uint8)
for _b in (*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)):
    _LETTERS[_b] = _b
for _b in range(0x41, 0x5B):
    _LETTERS[_b] = _b + 0x20

_STEP = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Words:
    """The words of several texts: normalised bytes, bounds, hashes, and the text of each."""

    def __init__(self, texts: list[bytes]):
        joined = b" ".join(texts) + b" "
        self.text_starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.bytes = _LETTERS[np.frombuffer(joined, np.uint8)]
        inside = np.r_[False, self.bytes != 0]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edges[0::2], edges[1::2]
        lengths = self.ends - self.starts
        # First word of every text, and one past the last word.
        self.first = np.searchsorted(self.starts, self.text_starts)
        if len(lengths):
            places = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            kept = self.bytes[self.bytes != 0].astype(np.uint64)
            terms = kept * _powers(_STEP | 1, int(lengths.max()))[places]
            sums = np.add.reduceat(terms, np.cumsum(lengths) - lengths)
            self.hashes = _mixed(sums + lengths.astype(np.uint64))
        else:
            self.hashes = np.zeros(0, np.uint64)

    def windows(self, size: int) -> np.ndarray:
        """A hash for every ``size`` consecutive words, also across texts."""
        n = len(self.hashes) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        total = np.zeros(n, np.uint64)
        for i, power in enumerate(_powers(0xD6E8FEB86659FD93, size).tolist()):
            total += self.hashes[i : i + n] * np.uint64(power)
        return _mixed(total + np.uint64(size))

    def phrase(self, at: int, size: int) -> bytes:
        pairs = zip(self.starts[at : at + size], self.ends[at : at + size], strict=True)
        return b" ".join(self.bytes[a:b].tobytes() for a, b in pairs)


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows (size, hash, phrase, item_id as string) of the distinct windows of each item.

    Items without words have none; a null item_id is the empty string.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            items = column_of(part, "item_id").to_pylist()
            texts = texts_of(part)
            rows = set()
            for item, text in zip(items, texts, strict=True):
                words = Words([text])
                n = len(words.hashes)
                size = min(window, n)
                if not n:
                    continue
                for at, value in enumerate(words.windows(size).view(np.int64).tolist()):
                    rows.add((size, value, words.phrase(at, size), item or ""))
            size, value, phrase, item = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(size, pa.int32()),
                    pa.array(value, pa.int64()),
                    pa.array(phrase, pa.binary()),
                    pa.array(item, pa.string()),
                ],
                ["size", "hash", "phrase", "item_id"],
            )

    given = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    schema = "size int, hash long, phrase binary, item_id string"
    return given.mapInArrow(run, schema).distinct()


BITMAP_BITS = 20


def hash_set(rows: list) -> dict[int, tuple[np.ndarray, np.ndarray, dict]]:
    """Per window size: a bitmap that most words fail, sorted hashes, phrases with their items."""
    items: dict = defaultdict(lambda: defaultdict(list))
    hashes: dict = defaultdict(set)
    for row in rows:
        items[row["size"]][bytes(row["phrase"])].append(row["item_id"])
        hashes[row["size"]].add(row["hash"])
    sizes = {}
    for size, by_phrase in items.items():
        ordered = np.unique(np.array(list(hashes[size]), np.int64).view(np.uint64))
        seen = np.zeros(1 << BITMAP_BITS, bool)
        seen[ordered >> np.uint64(64 - BITMAP_BITS)] = True
        sizes[size] = (seen, ordered, {k: tuple(v) for k, v in by_phrase.items()})
    return sizes


def hits(sizes: dict, words: Words) -> Iterator[tuple[int, int, tuple[str, ...]]]:
    """(first word, size, items) of every verified window; it may run over a text's end."""
    for size, (seen, hashes, found) in sizes.items():
        values = words.windows(size)
        at = np.flatnonzero(seen[values >> np.uint64(64 - BITMAP_BITS)])
        if not at.size:
            continue
        place = np.searchsorted(hashes, values[at])
        place[place == len(hashes)] = 0
        for start in at[hashes[place] == values[at]].tolist():
            items = found.get(words.phrase(start, size))
            if items:
                yield start, size, items


def _scan(sizes: dict, present: list[str], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            words = Words(texts_of(part))
            n = part.num_rows
            spans: list[dict] = [dict() for _ in range(n)]
            items: list[set] = [set() for _ in range(n)]
            for start, size, found in hits(sizes, words):
                text = int(np.searchsorted(words.first, start, "right")) - 1
                if start + size > words.first[text + 1]:
                    continue
                spans[text][start] = max(size, spans[text].get(start, 0))
                items[text].update(found)
            if "spans" in present:  # what earlier blocks have found
                before = column_of(part, "spans").to_pylist()
                had = column_of(part, "items").to_pylist()
            else:
                before, had = [[]] * n, [[]] * n
            counts = np.diff(words.first)
            hit_words, all_spans, all_items = [], [], []
            for i in range(n):
                found = [(s, s + k) for s, k in spans[i].items()]
                base = int(words.text_starts[i])
                merged: list[list[int]] = []
                for a, b in sorted(found):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(b, merged[-1][1])
                    else:
                        merged.append([a, b])
                pieces = [
                    (int(words.starts[a]) - base, int(words.ends[b - 1]) - base)
                    for a, b in merged
                ]
                joined = _merged([*pieces, *((x["start"], x["end"]) for x in before[i])])
                lo, hi = int(words.first[i]), int(words.first[i + 1])
                own = words.starts[lo:hi] - base
                hit_words.append(
                    sum(int(np.searchsorted(own, b) - np.searchsorted(own, a)) for a, b in joined)
                )
                all_spans.append([{"start": a, "end": b} for a, b in joined])
                all_items.append(sorted(items[i].union(had[i])))
            added = {
                "n_words": pa.array(counts, pa.int64()),
                "n_hit": pa.array(hit_words, pa.int64()),
                "items": pa.array(all_items, pa.list_(pa.string())),
                "spans": pa.array(
                    all_spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                ),
            }
            columns = [added[c] if c in added else column_of(part, c) for c in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def find_contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """``documents`` with n_words, n_hit, items and spans.

    items: sorted ids, as strings, of the benchmark items with a window in the text; spans:
    byte ranges of the UTF-8 text that the windows cover, merged.  A null or empty text has
    no words and no hits; equal texts have equal results; repeated or equal items count under
    each of their ids.  An empty benchmark hits nothing.  Columns named like the four that are
    added are replaced.  A block holds ``block_windows`` windows; the items of one window, that
    is equal passages, stay together.
    """
    names = [c for c in documents.columns if c not in ADDED]
    result = documents.select(*(f"`{c}`" for c in names))
    added = StructType.fromDDL(
        "n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>"
    )
    schema = StructType([*result.schema.fields, *added.fields])
    spark = documents.sparkSession
    windows = stored(benchmark_windows(benchmark, window), "windows")
    blocks = max(1, -(-windows.count() // block_windows))
    for block in range(blocks):
        chosen = windows
        if blocks > 1:
            mine = F.pmod(F.xxhash64("size", "phrase"), F.lit(blocks)) == block
            chosen = windows.filter(mine)
        # Bounded: about block_windows rows.
        rows = chosen.collect()
        shared = spark.sparkContext.broadcast(hash_set(rows))
        result = result.mapInArrow(_shipped(shared, result.columns, schema.names), schema)
    return result


def _shipped(shared, present: list[str], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _scan(shared.value, present, names)(batches)

    return run


def drop_contaminated(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW
) -> DataFrame:
    """The documents without any hit, with their columns, whatever the names of these."""
    others = [F.col(f"`{c}`") for c in documents.columns if c != "text"]
    wrapped = documents.select(F.struct(*others).alias("row"), "text")
    clean = find_contamination(wrapped, benchmark, window).filter("n_hit = 0")
    return clean.select(
        *(
            (F.col("text") if c == "text" else F.col("row").getField(c)).alias(c)
            for c in documents.columns
        )
    )


def remove_spans(found: DataFrame, text: str = "text") -> DataFrame:
    """The documents of ``find_contamination`` with the covered words taken out of the text.

    A span becomes one space, so that the words around it stay apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            kept = []
            nulls = column_of(part, text).is_null().to_pylist()
            spans = column_of(part, "spans").to_pylist()
            for value, null, cut in zip(texts_of(part, text), nulls, spans, strict=True):
                at, pieces = 0, []
                for x in cut:
                    pieces.append(value[at : x["start"]])
                    at = x["end"]
                pieces.append(value[at:])
                kept.append(None if null else b" ".join(pieces).decode("utf-8", "replace"))
            columns = [
                pa.array(kept, pa.string()) if c == text else column_of(part, c)
                for c in part.schema.names
            ]
            yield pa.RecordBatch.from_arrays(columns, part.schema.names)

    return found.mapInArrow(run, found.schema)


