"""Collocations, byte-level BPE and whitening against brute force, with nulls, ties and odd tables."""

from __future__ import annotations

import functools
import random
import re
from collections import Counter, defaultdict
from decimal import Decimal

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from scoreloom.llm import bpe, byte_bpe, collocations, whitening
from scoreloom.llm.queries import tokenizer

# --- byte-level BPE ---------------------------------------------------------------------------

RANKS = tokenizer("byte_bpe_50k.tiktoken")
ODD_TEXTS = [
    None,
    "",
    " ",
    "\n",
    "a",
    " a",
    "a ",
    "a  b",
    "a   b\n\n c",
    "a\n\n\nb",
    "a \n b",
    "tab\tand\x0bother\x0cspace\r\n",
    "no break   wide　space\x85next",
    "control\x1c\x1dsigns\x1f \x1e here",
    "it's we'll I'M 'tis ''s x'",
    "straße café ١٢٣ 42nd ½ ② 漢字かな 👩‍👩‍👧 é",
    "!!! ... --- #$% a.b,c;d",
    "<|endoftext|> is plain text",
    "x" * 3000,
    "ab " * 3000,
    " ".join(["word"] * 500) + "\n",
    "\x00 nul \x00",
]


@functools.cache
def reference() -> tiktoken.Encoding:
    ranks = byte_bpe.read_ranks(RANKS)
    pattern = public_tokenizers.PATTERN
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def reference_ids(text: str | None) -> list[int]:
    return reference().encode_ordinary(text or "")


def as_bytes(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def odd_texts() -> list[str | None]:
    rng = random.Random(3)
    alphabet = "ab' \n\t.1é漢  \x1c"
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(200)]
    return ODD_TEXTS + made + ["twice", "twice"]


@pytest.mark.parametrize("slice_bytes", [400, 16 << 20])
def test_ids_are_those_of_the_library_and_decode_to_the_text(spark, slice_bytes):
    rows = [(i, t, f"mine {i}", b"x", [i]) for i, t in enumerate(odd_texts())]
    schema = "doc_id long, text string, codes string, slice binary, counts array<int>"
    documents = spark.createDataFrame(rows, schema).repartition(3)
    encoded = byte_bpe.encode(
        documents, RANKS, public_tokenizers.PATTERN, slice_bytes=slice_bytes
    )
    decoded = byte_bpe.decode(encoded, RANKS)
    assert decoded.dtypes == [
        ("doc_id", "bigint"),
        ("codes", "string"),
        ("slice", "binary"),
        ("counts", "array<int>"),
        ("ids", "binary"),
        ("decoded", "binary"),
    ]
    got = {r["doc_id"]: r for r in decoded.collect()}
    assert len(got) == len(rows)
    for i, text, name, blob, listed in rows:
        row = got[i]
        assert (row["codes"], bytes(row["slice"]), row["counts"]) == (name, blob, listed)
        assert bytes(row["ids"]) == as_bytes(reference_ids(text)), repr(text)
        assert bytes(row["decoded"]).decode() == (text or "")


def test_repeated_rows_null_keys_and_empty_tables(spark):
    documents = spark.createDataFrame(
        [(None, "same"), (None, "same"), (1, None)], "doc_id long, text string"
    )
    got = byte_bpe.encode(documents, RANKS, public_tokenizers.PATTERN).collect()
    same = as_bytes(reference_ids("same"))
    assert sorted((str(r["doc_id"]), bytes(r["ids"])) for r in got) == [
        ("1", b""),
        ("None", same),
        ("None", same),
    ]
    none = byte_bpe.encode(documents.limit(0), RANKS, public_tokenizers.PATTERN)
    assert byte_bpe.decode(none, RANKS).collect() == []


def test_text_alone_and_ids_beyond_the_table(spark):
    alone = spark.createDataFrame([("a b",), (None,)], "text string")
    got = byte_bpe.encode(alone, RANKS, public_tokenizers.PATTERN)
    assert sorted(bytes(r["ids"]) for r in got.collect()) == [b"", as_bytes(reference_ids("a b"))]
    given = [(as_bytes([10**9, *reference_ids("hi")]), 1), (None, 2)]
    decoded = byte_bpe.decode(spark.createDataFrame(given, "ids binary, decoded int"), RANKS)
    assert sorted(bytes(r["decoded"]) for r in decoded.collect()) == [b"", b"hi"]


# --- collocations -----------------------------------------------------------------------------


def brute_collocations(rows, least, most_words, covered, top):
    counts: dict[str, Counter] = defaultdict(Counter)
    totals: Counter = Counter()
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(upper)):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, most_words + 1):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, found in counts.items():
        frequent = {p: n for p, n in found.items() if n >= least}
        dropped = set()
        for longer, n in frequent.items():
            for k in range(2, len(longer)):
                for i in range(len(longer) - k + 1):
                    inner = longer[i : i + k]
                    if 100 * n >= covered * frequent[inner]:
                        dropped.add(inner)
        scored = []
        for phrase, a in frequent.items():
            if len(phrase) < 2 or phrase in dropped:
                continue
            cuts = []
            for k in range(1, len(phrase)):
                left, right = frequent[phrase[:k]], frequent[phrase[k:]]
                cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            scored.append((-score, -a, " ".join(phrase).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def phrase_rows():
    rng = random.Random(11)
    words = ["The", "of", "and", "data", "Modèle", "x\x1cy", "ÀB", "10", "\x00"]
    rows = []
    for i in range(300):
        text = "".join(
            rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", " new york city "])
            for _ in range(rng.randint(0, 60))
        )
        rows.append((rng.choice(["en", "en", "fr", None]), text))
    rows += [("en", None), (None, ""), ("und", "of of of of of of"), ("de", "alone"), ("fr", "a b " * 800)]
    return rows + rows[:3]


@pytest.mark.parametrize("chunk_bytes, covered", [(3000, 100), (16 << 20, 60)])
def test_collocations_against_brute_force(spark, chunk_bytes, covered):
    rows = phrase_rows()
    data = [(lang, text, 1, "p", 2.0) for lang, text in rows]
    documents = spark.createDataFrame(data, "lang string, text string, n int, phrase string, w double")
    got = collocations.collocations(
        documents.repartition(5), least=8, covered=covered, top=40, chunk_bytes=chunk_bytes
    )
    want = brute_collocations(rows, 8, 5, covered, 40)
    assert len(want) > 60
    assert sorted(tuple(r) for r in got.collect()) == want
    assert all(kind in ("string", "bigint") for _, kind in got.dtypes)


def test_frequent_phrases_and_totals(spark):
    documents = spark.createDataFrame([("en", "a a a a. a")], "lang string, text string")
    found, totals = collocations.frequent_phrases(documents, least=2, most_words=3)
    assert sorted(tuple(r) for r in found.collect()) == [
        ("en", 1, "a", 5),
        ("en", 2, "a a", 3),
        ("en", 3, "a a a", 2),
    ]
    assert [tuple(r) for r in totals.collect()] == [("en", 5)]


def test_no_phrases(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(empty).collect() == []
    null = spark.createDataFrame([(None, None)], "lang string, text string")
    assert collocations.collocations(null, least=1).collect() == []


def test_scores_beyond_64_bits_are_exact(spark):
    wide = spark.sql("SELECT 4000000000000L AS a, 9000000000000L AS total, 4000000000001L AS l, 7L AS r")
    got = wide.selectExpr(f"{collocations.SCORE} AS score").first()["score"]
    assert got == 1000 * 4000000000000 * 9000000000000 // (4000000000001 * 7)


# --- whitening --------------------------------------------------------------------------------


def brute_whitening(vectors):
    x = np.floor(1024 * np.array(vectors, np.float64)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(0)
    deviation = [int(sum(int(v) ** 2 for v in row)) for row in (n * x - sums).astype(object)]
    centred = x - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    return deviation, centred, values[::-1], axes[:, ::-1]


def test_whitening_against_numpy(spark, monkeypatch):
    monkeypatch.setattr(whitening, "ROWS", 16)  # many blocks
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(200, 6)) @ rng.normal(size=(6, 6))).astype(np.float32).tolist()
    vectors[7] = vectors[8]
    odd = [
        None,
        [],
        [1.0, 2.0],
        [1.0, None, 3.0, 4.0, 5.0, 6.0],
        [float("nan"), 0.0, 0.0, 0.0, 0.0, 0.0],
        [0.0, float("-inf"), 0.0, 0.0, 0.0, 0.0],
    ]
    rows = [(i, v, "mine", i) for i, v in enumerate(vectors)]
    rows += [(1000 + i, v, "odd", i) for i, v in enumerate(odd)]
    schema = "vec_id long, embedding array<float>, whitened string, x int"
    table = spark.createDataFrame(rows, schema).repartition(4)
    got = whitening.whiten(table, components=4)
    assert dict(got.dtypes)["x"] == "int"
    found = {r["vec_id"]: r for r in got.collect()}
    assert sorted(found) == list(range(200))
    deviation, centred, values, axes = brute_whitening(vectors)
    want = centred @ axes[:, :4] / np.sqrt(values[:4])
    have = np.array([found[i]["whitened"] for i in range(200)])
    signs = np.sign((want * have).sum(0))
    assert np.abs(have * signs - want).max() < 1e-9
    assert have[7].tolist() == have[8].tolist()
    for i, row in found.items():
        assert row["deviation"] == deviation[i] and row["deviation_exact"] == Decimal(deviation[i])
        assert row["n"] == 200 and row["x"] == i and row["embedding"] == pytest.approx(vectors[i])
        assert np.allclose(row["explained"], values[:4] / values.sum(), rtol=1e-9)
        assert row["identity_error"] < 1e-9


def test_whitening_without_variance_and_without_rows(spark):
    schema = "vec_id long, embedding array<float>"
    same = spark.createDataFrame([(1, [0.5, 0.25])] * 3, schema)
    for row in whitening.whiten(same).collect():
        assert row["whitened"] == [0.0, 0.0] and row["explained"] == [0.0, 0.0]
        assert row["deviation"] == 0 and row["identity_error"] == 0.0
    assert whitening.whiten(same.limit(0)).collect() == []
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(50)], schema)
    rows = whitening.whiten(line).collect()
    assert all(r["whitened"][1:] == [0.0, 0.0] for r in rows)
    assert rows[0]["identity_error"] < 1e-9 and rows[0]["explained"][0] == pytest.approx(1)


def test_deviation_beyond_a_long_is_null_and_exact_as_decimal(spark):
    rows = [(1, [0.0]), (2, [float(1 << 40)])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    for row in got.collect():
        assert row["deviation"] is None
        assert row["deviation_exact"] == Decimal((1 << 50) ** 2)


def test_the_trie_looks_up_only_lengths_that_end_as_the_prefix_does():
    class Counted(dict):
        looked = 0

        def __contains__(self, key):
            Counted.looked += 1
            return super().__contains__(key)

    merges = [("a", "b"), ("ab", "ab"), ("abab", "c</w>")]
    tokens = ["a", "b", "x", "x</w>", "c</w>", *(a + b for a, b in merges)]
    trie = bpe.WordTrie(Counted({t: i for i, t in enumerate(tokens)}), merges, "</w>")
    assert trie.encode(["x" * 30]) == {"x" * 30: ["x"] * 29 + ["x</w>"]}
    assert Counted.looked == 30
    assert trie.encode(["ababc", "ababx"]) == {"ababc": ["ababc</w>"], "ababx": ["abab", "x</w>"]}
