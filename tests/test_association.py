"""Token association against plain counting."""

from __future__ import annotations

import math
import random

import pytest

from scoreloom.operators import association as ops
from scoreloom.plans.ordering import place_in_group

SCHEMA = "doc_id INT, label STRING, tokens ARRAY<STRING>"


def plain(docs):
    labels = {label for _, label, _ in docs}
    vocabulary = {t for _, _, tokens in docs for t in tokens}
    n = len(docs)
    table = {}
    for label in labels:
        n_c = sum(1 for _, other, _ in docs if other == label)
        for token in vocabulary:
            n11 = sum(1 for _, other, ts in docs if other == label and token in ts)
            n01 = sum(1 for _, other, ts in docs if other != label and token in ts)
            n10, n00 = n_c - n11, n - n_c - n01
            mi = 0.0
            for cell, row, column in (
                (n11, n11 + n10, n11 + n01), (n01, n01 + n00, n11 + n01),
                (n10, n11 + n10, n10 + n00), (n00, n01 + n00, n10 + n00),
            ):
                if cell:
                    mi += cell / n * math.log2(n * cell / (row * column + 1e-10))
            margins = (n11 + n01) * (n11 + n10) * (n10 + n00) * (n01 + n00)
            chi2 = (n11 * n00 - n10 * n01) ** 2 * n / (margins + 1e-10)
            table[label, token] = (n11, n10, n01, n00, mi, chi2)
    return table


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(30)]
    rows = []
    for i in range(60):
        tokens = [w for k, w in enumerate(words) if rng.random() < 1 / (1 + k % 7)]
        rows.append((i, rng.choice("abc"), [*tokens, *tokens[:3], "everywhere"]))
    return [*rows, (60, "a", []), (61, "b", [])]


def test_scores(spark, docs):
    got = ops.association_scores(spark.createDataFrame(docs, SCHEMA)).collect()
    want = plain(docs)
    assert len(got) == len(want)
    for row in got:
        expected = want[row["label"], row["token"]]
        assert (row["n11"], row["n10"], row["n01"], row["n00"]) == expected[:4]
        assert (row["mi"], row["chi2"]) == pytest.approx(expected[4:], abs=1e-9)


def test_emptied_documents_count(spark, docs):
    counts = {
        r["label"]: r for r in ops.class_doc_counts(spark.createDataFrame(docs, SCHEMA)).collect()
    }
    assert sum(r["n_docs"] for r in counts.values()) == 62
    assert {r["n_total"] for r in counts.values()} == {62}


def test_degenerate_margins(spark):
    rows = [(1, "a", ["t", "u"]), (2, "a", ["t"])]
    for row in ops.association_scores(spark.createDataFrame(rows, SCHEMA)).collect():
        assert (row["mi"], row["chi2"]) == pytest.approx((0, 0), abs=1e-6)


def test_large_counts_do_not_overflow(spark):
    cells = spark.createDataFrame(
        [(10**6, 10**6, 10**6, 3 * 10**6)], "n11 LONG, n10 LONG, n01 LONG, n00 LONG"
    )
    got = cells.select(ops.chi_squared().alias("x")).first()["x"]
    assert got == pytest.approx((3e12 - 1e12) ** 2 * 6e6 / (2e6 * 2e6 * 4e6 * 4e6))


def test_frequencies(spark, docs):
    frame = spark.createDataFrame(docs, SCHEMA)
    want = plain(docs)
    own = {(r["label"], r["token"]): r["n11"] for r in ops.class_doc_frequency(frame).collect()}
    assert own == {k: v[0] for k, v in want.items() if v[0]}
    other = {
        (r["label"], r["token"]): r["n01"] for r in ops.complement_doc_frequency(frame).collect()
    }
    assert other == {k: v[2] for k, v in want.items() if v[0]}


@pytest.mark.parametrize("limit", [10, 10**6])
def test_places_of_large_and_ordinary_lists(spark, docs, limit):
    """A limit below the vocabulary sends every list through the slices."""
    scores = ops.association_scores(spark.createDataFrame(docs, SCHEMA))
    rows = ops.rank_tokens(scores, max_group_rows=limit).collect()
    lists = {}
    for r in rows:
        lists.setdefault((r["label"], r["method"]), []).append(r)
    assert len(lists) == 6
    for ranked in lists.values():
        ranked.sort(key=lambda r: r["place"])
        assert [r["place"] for r in ranked] == list(range(1, len(ranked) + 1))
        assert ranked == sorted(ranked, key=lambda r: (-r["score"], r["token"]))
    compared = ops.method_rank_comparison(scores, max_group_rows=limit).collect()
    places = {(r["label"], r["method"], r["token"]): r["place"] for r in rows}
    for r in compared:
        assert r["mi_place"] == places[r["label"], "mi", r["token"]]
        assert r["chi2_place"] == places[r["label"], "chi2", r["token"]]


def test_top_tokens(spark, docs):
    scores = ops.association_scores(spark.createDataFrame(docs, SCHEMA))
    top = {(r["label"], r["method"], r["token"]) for r in ops.top_tokens(scores, 4).collect()}
    ranked = ops.rank_tokens(scores).filter("place <= 4").collect()
    assert top == {(r["label"], r["method"], r["token"]) for r in ranked}


def test_running_totals_with_null_groups_and_mixed_sizes(spark):
    rows = [(None if i % 3 == 0 else i % 3, i, 1 + i % 4) for i in range(200)] + [(7, 1, 5)]
    frame = spark.createDataFrame(rows, "g INT, at INT, w LONG")
    placed = place_in_group(
        frame, ["g"], [frame["at"].asc()], running={"total": "w"}, max_group_rows=30
    ).collect()
    assert len(placed) == len(rows)
    for g in {None, 1, 2, 7}:
        total = 0
        group = sorted((r for r in placed if r["g"] == g), key=lambda r: r["at"])
        for nth, r in enumerate(group, start=1):
            total += r["w"]
            assert (r["pos"], r["total"]) == (nth, total)
