"""Token ids in files: frequency-ranked, byte-aligned, with the control bytes apart.

Ids are replaced by their rank in the corpus, the most frequent first, and a rank is
written in as few whole bytes as it needs.  How many, one to four, stands in two bits of
a control byte, four ids to each; control and data bytes are two streams, so a table
from control bytes to lengths decodes both with array operations.

Token files are a folder with two Parquet tables: ``ranks`` (rank, id, n) and ``blocks``,
whose rows are runs of documents in ascending order of their key:

    part, before   place of the block: parts are ranges of the key in order, ``before``
                   counts the ids of the part that come before the block
    keys, sizes    key and number of ids of each document
    control, data  the two streams, each document from a control byte of its own

Texts are cut at white space into pieces that the tokenizer treats on their own, and those
into its words; the model of the tokenizers library encodes each distinct word of a worker
once.  Texts with special tokens or unusual white space go through the library whole.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scoreloom.llm.common import column_of, per_process, slices
from scoreloom.plans.durable import fresh_path

KEPT_PIECES = 600_000
KEPT_LETTERS = 256
# A letter that no plain text has.
START = "\r"
BLOCK_IDS = 1 << 18
NULL_KEY = -(1 << 63)
SLICE = 4 << 20
# The pre-tokenizer this module can stand in for, and its pattern.
PRE_TOKENIZER = {
    "type": "ByteLevel",
    "add_prefix_space": False,
    "trim_offsets": True,
    "use_regex": True,
}
WORD = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

# White space other than single spaces and line ends between words.
SPACES = "\t\v\f\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
OTHER_SPACE = rf"\A\z|[{SPACES}]|[ \n][ \n]|\A[ \n]|[ \n]\z"

BLOCKS = "part int, before long, keys array<long>, sizes array<long>, control binary, data binary"
CODED = "part int, key long, tie long, size long, control binary, data binary"


def byte_letters() -> dict[int, str]:
    """The letter that byte-level tokenizers write for each byte: itself where it prints."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class PieceEncoder:
    """Ids of texts by a byte-level tokenizer; equal to encoding each text as a whole."""

    def __init__(self, file: str, kept: int = KEPT_PIECES):
        with open(file, encoding="utf-8") as f:
            given = json.load(f)
        if given["pre_tokenizer"] != PRE_TOKENIZER or given["normalizer"]:
            raise ValueError(f"{file} is not a plain byte-level tokenizer")
        self.library = Tokenizer.from_file(file)
        self.library.no_padding()
        self.library.no_truncation()
        self.model = self.library.model
        self.bytes_of = [i.to_bytes(4, "little") for i in range(self.library.get_vocab_size())]
        self.special = [t["content"] for t in given["added_tokens"]]
        self.letters = {chr(b): c for b, c in byte_letters().items()}
        self.table = str.maketrans(self.letters)
        self.space = self.letters[" "]
        self.kept = kept
        self.words: dict[str, bytes] = {}
        # Pieces after a space, or with START or the line end that stands before them.
        self.pieces: dict[str, bytes] = {}
        self.line_end = self._whole("\n")

    def _whole(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def plain(self, texts: pa.Array) -> np.ndarray:
        """Whether only single spaces and line ends stand between the words of a text, and no
        special token in it.

        The tokenizer's pattern never joins such a space or line end to what stands before it.
        """
        other = pc.match_substring_regex(texts, OTHER_SPACE)
        for special in self.special:
            other = pc.or_(other, pc.match_substring(texts, special))
        return ~other.to_numpy(zero_copy_only=False)

    def _learn(self, piece: str) -> bytes:
        """Cut a piece into the tokenizer's words."""
        ids, word, space = b"", piece, " "
        if piece[0] == "\n" or piece[0] == START:
            ids, word, space = self.line_end if piece[0] == "\n" else b"", piece[1:], ""
        # Mostly a word of letters, or one with a sign after it.
        if word.isalpha():
            ids += self._word(space + word)
        elif word[:-1].isalpha() and word[-1] in ".,;:!?":
            ids += self._kept_word(space + word[:-1]) + self._kept_word(word[-1])
        else:
            ids += b"".join(map(self._kept_word, WORD.findall(space + word)))
        if len(piece) <= KEPT_LETTERS:
            if len(self.pieces) >= self.kept:
                self.pieces.clear()
            self.pieces[piece] = ids
        return ids

    def _kept_word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            ids = self._word(word)
            if len(word) <= KEPT_LETTERS:
                if len(self.words) >= self.kept:
                    self.words.clear()
                self.words[word] = ids
        return ids

    def _word(self, word: str) -> bytes:
        if word.isascii() and word[1:].isalpha() and word[0] == " ":
            letters = self.space + word[1:]
        else:
            letters = word.encode().decode("latin-1").translate(self.table)
        bytes_of = self.bytes_of
        return b"".join([bytes_of[t.id] for t in self.model.tokenize(letters)])

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Little-endian 32-bit ids of each text; a null has none."""
        texts = pc.fill_null(texts, "")
        plain = self.plain(texts)
        out: list[bytes] = [b""] * len(texts)
        for i in np.flatnonzero(~plain).tolist():
            out[i] = self._whole(texts[i].as_py())
        chosen = np.flatnonzero(plain)
        if not len(chosen):
            return out
        # A piece keeps what stands before it, START or a line end, unless that is a space.
        marked = pc.replace_substring(texts.take(pa.array(chosen)), "\n", " \n")
        marked = pc.binary_join_element_wise(START, marked, "")
        cut = pc.split_pattern(marked, " ")
        coded = cut.flatten().dictionary_encode()
        # Without spaces in them, the distinct pieces are handed to Python as one string.
        distinct = pa.ListArray.from_arrays(
            pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary
        )
        pieces = pc.binary_join(distinct, " ")[0].as_py().split(" ")
        known, learn = self.pieces, self._learn
        ids = [known.get(p) or learn(p) for p in pieces]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
        flat = np.frombuffer(b"".join(ids), "<u4")
        begins = np.cumsum(sizes) - sizes
        code = coded.indices.to_numpy()
        lengths = sizes[code]
        ends = np.cumsum(lengths)
        all_ids = flat[np.arange(int(ends[-1])) + np.repeat(begins[code] - (ends - lengths), lengths)]
        bounds = np.r_[0, ends][cut.offsets.to_numpy()].tolist()
        for i, start, end in zip(chosen.tolist(), bounds[:-1], bounds[1:], strict=True):
            out[i] = all_ids[start:end].tobytes()
        return out


# --- the code ---------------------------------------------------------------------------------

# Lengths of the four ids of each control byte.
LENGTHS = np.array([[(c >> 2 * i & 3) + 1 for i in range(4)] for c in range(256)], np.uint8)


def pack_all(ranks: np.ndarray, sizes: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """(control, data) of documents with ``sizes`` ranks each, one after the other in ``ranks``."""
    ranks = ranks.astype("<u4")
    extra = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    # A document's control bytes are filled up to four ids.
    full = -(-sizes // 4) * 4
    filled = np.cumsum(full)
    ends = np.cumsum(sizes)
    padded = np.zeros(int(filled[-1]), np.uint8)
    padded[np.arange(len(ranks)) + np.repeat(filled - full - (ends - sizes), sizes)] = extra
    control = (padded.reshape(-1, 4) @ np.array([1, 4, 16, 64], np.uint8)).astype(np.uint8)
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]]
    width = np.r_[0, np.cumsum(extra.astype(np.int64) + 1)]

    def cut(ends: np.ndarray, values: np.ndarray) -> pa.Array:
        offsets = pa.py_buffer(np.r_[0, ends].astype(np.int32))
        return pa.BinaryArray.from_buffers(
            pa.binary(), len(ends), [None, offsets, pa.py_buffer(np.ascontiguousarray(values))]
        )

    return cut(filled // 4, control), cut(width[ends], data)


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of one document's ranks."""
    control, data = pack_all(ranks, np.array([len(ranks)]))
    return control[0].as_py(), data[0].as_py()


def unpack(sizes: np.ndarray, control: bytes, data: bytes) -> np.ndarray:
    """The ranks of a block, all documents after each other."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].ravel()
    # Each document's control bytes are filled up to four ids; drop what is beyond.
    full = -(-sizes // 4) * 4
    within = np.arange(full.sum()) - np.repeat(np.cumsum(full) - full, full)
    lengths = lengths[within < np.repeat(sizes, full)].astype(np.int64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(4, np.uint8)])
    ranks = raw[starts].astype(np.uint32)
    for i in range(1, 4):
        longer = lengths > i
        if longer.any():
            ranks[longer] |= raw[starts[longer] + i].astype(np.uint32) << np.uint32(8 * i)
    return ranks


# --- files ------------------------------------------------------------------------------------


def encode_rows(documents: DataFrame, file: str, end_id: int, key: str, text: str) -> DataFrame:
    """(key, tie, ids) of each document: its ids with the end id, as unsigned 16-bit integers if
    all fit, else 32-bit; tie is a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_process(("byte pieces", file), lambda: PieceEncoder(file))
        end = np.array([end_id], "<u4").tobytes()
        kind = "<u2" if _short(encoder.library.get_vocab_size(), end_id) else "<u4"
        for part in slices(batches, "text", SLICE):
            ids = [
                np.frombuffer(x + end, "<u4").astype(kind).tobytes()
                for x in encoder.encode(column_of(part, "text"))
            ]
            yield pa.RecordBatch.from_arrays(
                [column_of(part, "key"), column_of(part, "tie"), pa.array(ids, pa.binary())],
                ["key", "tie", "ids"],
            )

    given = documents.select(
        F.col(f"`{key}`").cast("long").alias("key"),
        F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("tie"),
        F.col(f"`{text}`").alias("text"),
    )
    return given.mapInArrow(run, "key long, tie long, ids binary")


def _short(vocabulary: int, end_id: int) -> bool:
    return max(vocabulary, end_id + 1) <= 1 << 16


def count_ids(encoded: DataFrame, kind: str) -> DataFrame:
    """(id, n): how often each id occurs in the rows of ``encode_rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for part in slices(batches, "ids", SLICE):
            ids = np.frombuffer(b"".join(column_of(part, "ids").to_pylist()), kind)
            counts = np.bincount(ids, minlength=len(total))
            counts[: len(total)] += total
            total = counts
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["id", "n"])

    counted = encoded.select("ids").mapInArrow(run, "id long, n long")
    return counted.groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(
    documents: DataFrame,
    path: str,
    file: str,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
    parts: int | None = None,
) -> None:
    """Write the token files of ``documents`` (long ``key``) to the new folder ``path``.

    A null or empty text has the end id only.  Rows come in ascending order of the key, a null
    key first, rows of one key by a hash of their text; repeated rows are all written.  An
    empty table gives files without rows.  ``file`` is the tokenizer's, at the same path on
    every machine.  ``parts`` ranges of the key, by quantiles, are what tasks work on.

    Texts are encoded once: the ids are kept in the shared folder until all are counted.
    """
    spark = documents.sparkSession
    held = fresh_path(spark, "ids")
    encoded = encode_rows(documents, file, end_id, key, text)
    encoded.write.option("compression", "zstd").parquet(held)
    encoded = spark.read.schema(encoded.schema).parquet(held)
    vocabulary = Tokenizer.from_file(file).get_vocab_size()
    kind = "<u2" if _short(vocabulary, end_id) else "<u4"

    # As many rows as the vocabulary has at most.
    counts = sorted(count_ids(encoded, kind).collect(), key=lambda r: (-r["n"], r["id"]))
    rank_of = np.zeros(max([end_id, *(r["id"] for r in counts)]) + 1, np.uint32)
    for rank, row in enumerate(counts):
        rank_of[row["id"]] = rank
    rows = [(rank, r["id"], r["n"]) for rank, r in enumerate(counts)]
    spark.createDataFrame(rows, "rank long, id long, n long").coalesce(1).write.parquet(
        f"{path}/ranks"
    )

    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = [i / parts for i in range(1, parts)]
    # Null keys come first and have their share of the parts.
    ordered_key = F.coalesce("key", F.lit(NULL_KEY))
    edges_of = F.percentile_approx(ordered_key, cuts, 10 * parts)
    found = encoded.agg(edges_of).first()[0] if cuts else None
    shared = spark.sparkContext.broadcast((rank_of, np.array(found or [], np.int64)))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, edges = shared.value
        for part in slices(batches, "ids", SLICE):
            keys, ties = column_of(part, "key"), column_of(part, "tie").to_numpy()
            values = keys.fill_null(NULL_KEY).to_numpy(zero_copy_only=False)
            # A key that holds several parts is spread over them by the hash of the text.
            low, high = np.searchsorted(edges, values), np.searchsorted(edges, values, "right")
            places = low + (ties.view(np.uint64) % (high - low + 1).astype(np.uint64)).astype(int)
            own = column_of(part, "ids")
            sizes = pc.binary_length(own).to_numpy() // np.dtype(kind).itemsize
            control, data = pack_all(
                ranks[np.frombuffer(b"".join(own.to_pylist()), kind)], sizes.astype(np.int64)
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(places.astype(np.int32)),
                    keys,
                    pa.array(ties),
                    pa.array(sizes, pa.int64()),
                    control,
                    data,
                ],
                ["part", "key", "tie", "size", "control", "data"],
            )

    ordered = encoded.mapInArrow(code, CODED).repartition("part").sortWithinPartitions(
        "part", F.col("key").asc_nulls_first(), "tie"
    )
    blocks = ordered.mapInArrow(_blocks, BLOCKS)
    blocks.write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of about BLOCK_IDS ids, each within one part; rows come sorted."""
    part, before, held, ids = None, 0, [], 0

    def block() -> pa.RecordBatch:
        keys, sizes, control, data = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([part], pa.int32()),
                pa.array([before], pa.int64()),
                pa.array([list(keys)], pa.list_(pa.int64())),
                pa.array([list(sizes)], pa.list_(pa.int64())),
                pa.array([b"".join(control)], pa.binary()),
                pa.array([b"".join(data)], pa.binary()),
            ],
            ["part", "before", "keys", "sizes", "control", "data"],
        )

    for batch in batches:
        columns = ("part", "key", "size", "control", "data")
        for row in zip(*(column_of(batch, c).to_pylist() for c in columns), strict=True):
            if held and (row[0] != part or ids >= BLOCK_IDS):
                yield block()
                before, held, ids = before + ids, [], 0
            if row[0] != part:
                part, before = row[0], 0
            held.append(row[1:])
            ids += row[2]
    if held:
        yield block()


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(key, start, ids) of each document: ids as little-endian 32-bit, start the ids before it."""
    table = spark.read.parquet(f"{path}/ranks").select("rank", "id").collect()
    ids_of = np.zeros(len(table), np.uint32)
    for row in table:
        ids_of[row["rank"]] = row["id"]
    shared = spark.sparkContext.broadcast(ids_of)
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    own = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    totals = blocks.groupBy("part").agg(F.sum(own).alias("n"))
    offset = F.sum("n").over(Window.orderBy("part")) - F.col("n")
    # A row for each part that the files were written in.
    offsets = F.broadcast(totals.select("part", offset.alias("offset")))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: column_of(batch, c)[i].as_py() for c in batch.schema.names}
                sizes = np.array(row["sizes"], np.int64)
                ids = known[unpack(sizes, row["control"], row["data"])].astype("<u4")
                ends = np.cumsum(sizes)
                cut = [ids[e - n : e].tobytes() for e, n in zip(ends, sizes, strict=True)]
                starts = row["offset"] + row["before"] + ends - sizes
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["keys"], pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array(cut, pa.binary()),
                    ],
                    ["key", "start", "ids"],
                )

    placed = blocks.join(offsets, "part")
    return placed.mapInArrow(decode, "key long, start long, ids binary")


