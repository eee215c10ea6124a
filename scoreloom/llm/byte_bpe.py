"""Byte-level BPE by a global shuffle of the distinct words.

Texts are cut into pre-tokens.  A slice of the corpus keeps, for every pre-token in its
place, a number into the slice's distinct words, and sends each distinct word once to the
part that the word's checksum names.  There each distinct word of the corpus is encoded
once; the ids go back to the slices and are put in place of the numbers.  Slices lie in
buckets, so only distinct words and their ids are shuffled, no text and no position.

Decoding joins ids with the table of token bytes, which has a row for each token of the
vocabulary and is part of the code that is sent to the tasks.
"""

from __future__ import annotations

import base64
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from scoreloom.llm.blocks import (
    bucketed,
    by_part,
    packed,
    packed_bytes,
    packed_words,
    part_count,
    runs,
    slice_numbers,
    unpacked,
    unpacked_bytes,
    unpacked_words,
)
from scoreloom.llm.common import column_of, per_process, slices, texts_of

SLICE = 5 << 20
KNOWN_BYTES = 64 << 20

OCCURRENCES = (
    "slice long, carried binary, counts binary, codes binary, "
    "blocks array<struct<part int, words binary>>"
)
ANSWERS = "slice long, part int, counts binary, ids binary"


def read_ranks(file: str) -> dict[bytes, int]:
    """Bytes and id of each token of a rank file."""
    with open(file, "rb") as f:
        pairs = (line.split() for line in f if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


def pre_token_pattern(pattern: str) -> regex.Pattern:
    """The pattern with white space as Unicode has it, which is what the rank files' own engine
    takes it for; ``regex`` alone adds four control characters."""
    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


class _Pieces(dict):
    """Numbers of the pieces between single spaces; a new piece is cut into its pre-tokens."""

    def __init__(self, cut: Callable[[str], list[str]], words: _Words, before: str):
        self.cut, self.words, self.before = cut, words, before

    def __missing__(self, piece: str) -> int:
        if not piece or piece[0].isspace() or piece[-1].isspace():
            number = -1
        else:
            number = self.words.add_piece(self.cut(self.before + piece))
        self[piece] = number
        return number


class _Words(dict):
    """Numbers of the distinct words, and the words of each piece one after the other."""

    def __init__(self) -> None:
        self.flat, self.sizes = array("i"), array("i")

    def add_piece(self, words: list[str]) -> int:
        self.flat.extend([self.setdefault(w, len(self)) for w in words])
        self.sizes.append(len(words))
        return len(self.sizes) - 1


class Slice:
    """The pre-tokens of some texts, as numbers into the distinct ones.

    What stands between two single spaces is cut the same way wherever it stands, so each
    such piece is cut once; a text with other white space at the edge of a piece is cut whole.
    """

    def __init__(self, pattern: regex.Pattern):
        self.cut = pattern.findall
        self.words = _Words()
        self.first = _Pieces(self.cut, self.words, "")
        self.later = _Pieces(self.cut, self.words, " ")
        self.texts: list[np.ndarray] = []

    def add(self, text: str) -> None:
        if not text:
            self.texts.append(np.zeros(0, np.int32))
            return
        pieces = text.split(" ")
        numbers = np.fromiter(map(self.later.__getitem__, pieces), np.int32, len(pieces))
        numbers[0] = self.first[pieces[0]]
        if numbers.min() < 0:
            numbers = np.array([self.words.add_piece(self.cut(text))], np.int32)
        self.texts.append(numbers)

    def occurrences(self, parts: int) -> tuple[bytes, bytes, list[dict]]:
        """(pre-tokens of each text, numbers of the pre-tokens, blocks of distinct words).

        Words are numbered in the order of the blocks.
        """
        sizes, flat = np.array(self.words.sizes), np.array(self.words.flat)
        lengths = np.fromiter(map(len, self.texts), np.int64, len(self.texts))
        numbers = np.concatenate([np.zeros(0, np.int32), *self.texts])
        per_piece = sizes[numbers]
        codes = flat[runs((np.cumsum(sizes, dtype=np.int64) - sizes)[numbers], per_piece)]
        before = np.concatenate([[0], np.cumsum(per_piece, dtype=np.int64)])
        ends = np.cumsum(lengths)
        counts = before[ends] - before[ends - lengths]

        used = np.bincount(codes, minlength=len(self.words)) > 0
        found = [(w.encode(), i) for w, i in self.words.items() if used[i]]
        by_part: dict[int, list[tuple[bytes, int]]] = {}
        for pair in found:
            by_part.setdefault(zlib.crc32(pair[0]) % parts, []).append(pair)
        order: list[int] = []
        blocks = []
        for part in sorted(by_part):
            pairs = sorted(by_part[part])
            order += [i for _, i in pairs]
            blocks.append({"part": part, "words": packed_words([w for w, _ in pairs])})
        place = np.zeros(len(self.words), np.uint32)
        place[np.array(order, np.int64)] = np.arange(len(order), dtype=np.uint32)
        return packed(counts.astype("<u4")), packed(place[codes]), blocks


def _occurrences(names: list[str], text: str, pattern: str, parts: int, most: int):
    """Slices of about ``most`` bytes of texts; the other columns are carried along, as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, numbers = pre_token_pattern(pattern), slice_numbers()
        held: list[pa.RecordBatch] = []
        at, size = Slice(cut), 0

        def row() -> pa.RecordBatch:
            counts, codes, blocks = at.occurrences(parts)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema) as writer:
                for batch in held:
                    writer.write_batch(batch)
            carried = packed_bytes(sink.getvalue().to_pybytes())
            kind = pa.list_(pa.struct([("part", pa.int32()), ("words", pa.binary())]))
            columns = [
                pa.array([next(numbers)], pa.int64()),
                *(pa.array([x], pa.binary()) for x in (carried, counts, codes)),
                pa.array([blocks], kind),
            ]
            return pa.RecordBatch.from_arrays(
                columns, ["slice", "carried", "counts", "codes", "blocks"]
            )

        for part in slices(batches, text, most):
            for value in column_of(part, text).to_pylist():
                at.add(value or "")
            size += pc.sum(pc.binary_length(column_of(part, text))).as_py() or 0
            columns = [column_of(part, c) for c in names]
            places = pa.array(np.arange(part.num_rows))  # a batch needs a column to have rows
            held.append(pa.RecordBatch.from_arrays([*columns, places], [*names, ""]))
            if size >= most:
                yield row()
                held, at, size = [], Slice(cut), 0
        if held:
            yield row()

    return run


def _answer(file: str, pattern: str):
    """The ids of every word of every block; a word that many blocks hold is encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = per_process(
            ("ranks", file, pattern),
            lambda: tiktoken.Encoding(
                "ranks", pat_str=pattern, mergeable_ranks=read_ranks(file), special_tokens={}
            ),
        )
        known: dict[bytes, list[int]] = {}
        room = KNOWN_BYTES
        for batch in batches:
            answers = []
            for words in column_of(batch, "words").to_pylist():
                lists = []
                for word in unpacked_words(words).to_pylist():
                    ids = known.get(word)
                    if ids is None:
                        ids = encoding.encode_ordinary(word.decode())
                        room -= 100 + 5 * len(word)
                        if room < 0:  # parts are far larger than they should be
                            known, room = {}, KNOWN_BYTES
                        known[word] = ids
                    lists.append(ids)
                counts = np.fromiter(map(len, lists), "<u4", len(lists))
                flat = np.array([i for ids in lists for i in ids], "<u4")
                answers.append((packed(counts), packed(flat)))
            yield pa.RecordBatch.from_arrays(
                [
                    column_of(batch, "slice"),
                    column_of(batch, "part"),
                    pa.array([c for c, _ in answers], pa.binary()),
                    pa.array([i for _, i in answers], pa.binary()),
                ],
                ["slice", "part", "counts", "ids"],
            )

    return run


def _reassemble(names: list[str], schema: StructType):
    """The rows of one slice, with the ids of their pre-tokens in the places of these."""

    def run(occurrences: pa.Table, answers: pa.Table) -> pa.Table:
        row = {c: occurrences.column(c)[0].as_py() for c in ("carried", "counts", "codes")}
        carried = pa.ipc.open_stream(unpacked_bytes(row["carried"])).read_all()
        per_text = unpacked(row["counts"], "<u4").astype(np.int64)
        codes = unpacked(row["codes"], "<u4")
        answers = answers.sort_by("part")
        none = [np.zeros(0, "<u4")]
        counts, flat = (
            np.concatenate(none + [unpacked(x, "<u4") for x in answers.column(c).to_pylist()])
            for c in ("counts", "ids")
        )
        counts = counts.astype(np.int64)
        per_code = counts[codes]
        ids = flat[runs((np.cumsum(counts) - counts)[codes], per_code)].astype("<u4")
        before = np.concatenate([[0], np.cumsum(per_code)])
        ends = np.concatenate([[0], before[np.cumsum(per_text)]]) * 4
        made = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(per_text), [None, pa.py_buffer(ends), pa.py_buffer(ids)]
        )
        columns = [carried.column(c) for c in names] + [made.cast(pa.binary())]
        return pa.Table.from_arrays(columns, names=schema.names)

    return run


def encode(
    documents: DataFrame, file: str, pattern: str, text: str = "text", slice_bytes: int = SLICE
) -> DataFrame:
    """``documents`` with the text replaced by ``ids`` (little-endian, 32-bit).

    ``file`` has the ranks, at the same path on every machine, and ``pattern`` cuts a text
    into pre-tokens, each of which is encoded by itself, without special tokens.  A null or
    empty text has no ids; equal texts have equal ids and repeated rows all stay; an empty
    table gives no rows; a column named ``ids`` is replaced, all others are kept as they are.
    A text longer than ``slice_bytes`` is a slice by itself.
    """
    names = [c for c in documents.columns if c not in (text, "ids")]
    kept = documents.select(*(f"`{c}`" for c in names))
    schema = StructType([*kept.schema.fields, StructField("ids", BinaryType())])
    wanted = documents.select(*(f"`{c}`" for c in [*names, text]))
    parts = part_count(documents.sparkSession)
    occurrences = wanted.mapInArrow(
        _occurrences(names, text, pattern, parts, slice_bytes), OCCURRENCES
    )
    found = documents.sparkSession.table(bucketed(occurrences, "slice", "pre_tokens"))
    blocks = found.select("slice", F.inline("blocks"))
    answers = by_part(blocks).mapInArrow(_answer(file, pattern), ANSWERS)
    return (
        found.select("slice", "carried", "counts", "codes")
        .groupBy("slice")
        .cogroup(answers.groupBy("slice"))
        .applyInArrow(_reassemble(names, schema), schema)
    )


def decode(encoded: DataFrame, file: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes of its ``ids`` added as ``decoded``, joined with the token table.

    A null has no ids and gives no bytes; an id that the table does not have gives none.
    """
    names = [c for c in encoded.columns if c != decoded]
    kept = encoded.select(*(f"`{c}`" for c in names))
    schema = StructType([*kept.schema.fields, StructField(decoded, BinaryType())])

    def table() -> pa.Array:
        ranks = read_ranks(file)
        rows = [b""] * (max(ranks.values(), default=-1) + 2)
        for token, rank in ranks.items():
            rows[rank] = token
        return pa.array(rows, pa.large_binary())  # the last one is for ids beyond

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = per_process(("token bytes", file), table)
        for part in slices(batches, ids, 4 << 20):
            given = texts_of(part, ids)
            numbers = np.frombuffer(b"".join(given), "<u4")
            joined = tokens.take(pa.array(np.minimum(numbers, len(tokens) - 1)))
            reach = np.frombuffer(joined.buffers()[1], np.int64, len(numbers) + 1)
            sizes = np.fromiter(map(len, given), np.int64, len(given)) // 4
            ends = reach[np.concatenate([[0], np.cumsum(sizes)])]
            made = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(given), [None, pa.py_buffer(ends), joined.buffers()[2]]
            )
            columns = [column_of(part, c) for c in names] + [made.cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return kept.mapInArrow(run, schema)
