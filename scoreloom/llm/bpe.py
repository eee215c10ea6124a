"""BPE encoding and decoding with a prefix-sharing trie of the distinct words.

The last token of the encoding of every prefix of a word decides the whole encoding:
it is the one token that ends the prefix and is compatible with the last token of what
is left before it, that is, merging the two tokens' symbols by rank gives the same two
tokens again.  The distinct words of a slice of the corpus are put in a trie, and a
depth-first walk computes the last token of each node once, whichever words share it;
the encoding of a word is then read off backwards.

Normalisation and the cut into words are those of the tokenizer file, applied once to
each distinct run of characters between white space.  Encodings of words are kept for a
bounded number of words in each worker.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from scoreloom.llm.common import column_of, per_process, slices

KEPT_PIECES = 800_000
# White space as the tokenizer's pattern has it; str.split() also cuts at four control characters.
SPACE = regex.compile(r"[\t-\r \x85\p{Z}]+")
CONTROLS = regex.compile("[\x1c-\x1f]")


class WordTrie:
    """Encodes words, given as symbols, by the last tokens of their prefixes."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], end: str):
        self.ids = vocabulary
        self.ranks = {pair: rank for rank, pair in enumerate(merges)}
        self.end = end
        # By the last character and the mark: the lengths of the entries, longest first.
        ends: dict[str, set[int]] = {}
        for token in vocabulary:
            body = token.removesuffix(end) if end and token != end else token
            ends.setdefault(body[-1] + token[len(body) :], set()).add(len(body))
        self.lengths = {last: sorted(found, reverse=True) for last, found in ends.items()}
        self.compatible: dict[tuple[str, str], bool] = {}
        self.symbols: dict[str, tuple[str, ...]] = {}

    def symbols_of(self, token: str) -> tuple[str, ...]:
        """The characters of a token; the last one carries the end of the word, if it has it."""
        found = self.symbols.get(token)
        if found is None:
            body = token.removesuffix(self.end) if self.end and token != self.end else token
            found = tuple(body[:-1]) + (body[-1] + token[len(body) :],)
            self.symbols[token] = found
        return found

    def merge(self, symbols: list[str]) -> list[str]:
        """Merge by rank, the plain way; used on the symbols of two tokens at a time."""
        ranks, none = self.ranks, len(self.ranks)
        parts = list(symbols)
        while len(parts) > 1:
            best, at = min((ranks.get(p, none), i) for i, p in enumerate(zip(parts, parts[1:])))
            if best == none:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: str, right: str) -> bool:
        """Whether the two tokens stay as they are when one follows the other."""
        pair = (left, right)
        known = self.compatible.get(pair)
        if known is None:
            if len(self.compatible) > 500_000:
                self.compatible.clear()
            merged = self.merge([*self.symbols_of(left), *self.symbols_of(right)])
            known = self.compatible[pair] = merged == [left, right]
        return known

    def whole(self, token: str) -> bool:
        """Whether the token is what its own symbols merge to."""
        pair = (token, "")
        known = self.compatible.get(pair)
        if known is None:
            known = self.compatible[pair] = self.merge(list(self.symbols_of(token))) == [token]
        return known

    def encode(self, words: list[str]) -> dict[str, list[str]]:
        """The tokens of each distinct word."""
        found: dict[str, list[str]] = {}
        states: list[str] = []  # last token of each prefix of the word at hand
        before = ""
        # The sorted words are the trie's leaves in depth-first order: what the next word
        # shares with the last one are the nodes that stay on the path.
        for word in sorted(set(words)):
            shared = 0
            for a, b in zip(before, word, strict=False):
                if a != b:
                    break
                shared += 1
            del states[min(shared, len(word) - 1) :]
            while len(states) < len(word) - 1:
                states.append(self._last(word, states, len(states) + 1, ""))
            before = word
            last = self._last(word, states, len(word), self.end)
            tokens, at = [], len(word)
            while True:
                tokens.append(last)
                at -= len(self.symbols_of(last))
                if not at:
                    break
                last = states[at - 1]
            found[word] = tokens[::-1]
        return found

    def _last(self, word: str, states: list[str], end: int, mark: str) -> str:
        """The last token of ``word[:end]``, whose last character carries ``mark``."""
        ids = self.ids
        for length in self.lengths.get(word[end - 1] + mark, ()):
            start = end - length
            if start < 0:
                continue
            token = word[start:end] + mark
            if token in ids and (self.fits(states[start - 1], token) if start else self.whole(token)):
                return token
        return word[end - 1] + mark


class Encoder:
    """Encodes and decodes texts by the file of a word-level BPE tokenizer without a decoder."""

    def __init__(self, file: str, kept: int = KEPT_PIECES):
        with open(file, encoding="utf-8") as f:
            given = json.load(f)
        model = given["model"]
        if model["type"] != "BPE" or not model.get("end_of_word_suffix") or given["decoder"]:
            raise ValueError(f"{file} is not a BPE of words with an end mark and no decoder")
        self.library = Tokenizer.from_file(file)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.trie = WordTrie(model["vocab"], merges, model["end_of_word_suffix"])
        self.added = {t["content"]: t["id"] for t in given["added_tokens"]}
        strings = sorted(map(regex.escape, self.added), key=len, reverse=True)
        self.cut = regex.compile("|".join(strings)) if strings else None
        self.marks = {s[0] for s in self.added}
        self.kept = kept
        self.known: dict[str, tuple[bytes, str]] = {}

    def pieces(self, text: str) -> list[str]:
        """Special tokens, and runs of characters without white space between them."""
        if self.cut and any(m in text for m in self.marks) and self.cut.search(text):
            found, at = [], 0
            for match in self.cut.finditer(text):
                found += self.pieces(text[at : match.start()])
                found.append(match.group())
                at = match.end()
            rest = text[at:]
            return found + (self.pieces(rest) if rest else [])
        if CONTROLS.search(text):
            return [x for x in SPACE.split(text) if x]
        return text.split()

    def learn(self, pieces: set[str]) -> None:
        """Encode pieces not seen yet: their words together, over one trie."""
        new = [p for p in pieces if p not in self.known]
        if len(self.known) + len(new) > self.kept:
            self.known.clear()
            new = list(pieces)
        normal, split = self.library.normalizer, self.library.pre_tokenizer
        words = {}
        for piece in new:
            if piece in self.added:
                continue
            clean = normal.normalize_str(piece)
            words[piece] = [w for w, _ in split.pre_tokenize_str(clean)] if clean else []
        tokens = self.trie.encode([w for found in words.values() for w in found])
        ids = self.trie.ids
        for piece in new:
            if piece in self.added:
                own, numbers = [piece], [self.added[piece]]
            else:
                own = [t for w in words[piece] for t in tokens[w] if t in ids]
                numbers = [ids[t] for t in own]
            self.known[piece] = (np.array(numbers, "<u4").tobytes(), " ".join(own))

    def encode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """For each text its ids, as little-endian 32-bit integers, and the text they decode to.

        With no decoder in the file, decoding joins the tokens with spaces.
        """
        cut = [self.pieces(t) for t in texts]
        self.learn({p for found in cut for p in found})
        out = []
        for found in cut:
            pairs = [self.known[p] for p in found]
            ids = b"".join([i for i, _ in pairs])
            out.append((ids, " ".join([d for _, d in pairs if d])))
        return out


def encode(
    documents: DataFrame, file: str, text: str = "text", extra=None, fields: str = ""
) -> DataFrame:
    """``documents`` with the text replaced by ``ids`` (little-endian 32-bit) and ``decoded``.

    A null or empty text, or one of white space only, has no ids and decodes to nothing;
    equal texts have equal ids; columns named like the two are replaced.  ``file`` is the
    tokenizer's, at the same path on every machine.  Instead of the two columns, ``extra``
    may turn the lists of ids and decoded texts into other columns, named by ``fields``.
    """
    made = StructType.fromDDL(fields or "ids binary, decoded string")
    names = [c for c in documents.columns if c != text and c not in made.names]
    kept = documents.select(*(f"`{c}`" for c in names))
    schema = StructType([*kept.schema.fields, *made.fields])

    def plain(ids: list[bytes], decoded: list[str]) -> list[pa.Array]:
        return [pa.array(ids, pa.binary()), pa.array(decoded, pa.string())]

    columns_of = extra or plain

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_process(("word pieces", file), lambda: Encoder(file))
        for part in slices(batches, text, 4 << 20):
            texts = [t or "" for t in column_of(part, text).to_pylist()]
            pairs = encoder.encode(texts)
            added = columns_of([i for i, _ in pairs], [d for _, d in pairs])
            columns = [column_of(part, c) for c in names] + added
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    wanted = documents.select(*(f"`{c}`" for c in [*names, text]))
    return wanted.mapInArrow(run, schema)


def digests(ids: list[bytes], decoded: list[str]) -> list[pa.Array]:
    """Columns n_tokens, ids_sha256 and decoded_sha256."""
    return [
        pa.array([len(x) // 4 for x in ids], pa.int64()),
        pa.array([sha256(x).hexdigest() for x in ids], pa.string()),
        pa.array([sha256(x.encode()).hexdigest() for x in decoded], pa.string()),
    ]


DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def ids_and_digests(ids: list[bytes], decoded: list[str]) -> list[pa.Array]:
    """The ids themselves, then the columns of ``digests``."""
    return [pa.array(ids, pa.binary()), *digests(ids, decoded)]


IDS_AND_DIGESTS = f"ids binary, {DIGESTS}"
