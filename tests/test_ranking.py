"""Rank metrics against hand-made cases and a plain Python evaluation."""

from __future__ import annotations

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from scoreloom.operators import ranking
from scoreloom.sources.schemas import METRICS, QRELS, RUNS


def make(spark, runs, qrels):
    run_rows = [(s, q, d, r, 0.0) for s, q, d, r in runs]
    return spark.createDataFrame(run_rows, RUNS), spark.createDataFrame(qrels, QRELS)


def plain_scores(runs, qrels):
    """The six metrics, one list at a time."""
    grades = defaultdict(dict)
    for q, d, g in qrels:
        grades[q][d] = max(g, grades[q].get(d, g))
    lists = defaultdict(list)
    for s, q, d, r in runs:
        lists[s, q].append((r, d))
    scores = {}
    for (s, q), rows in lists.items():
        docs = [d for _, d in sorted(rows)]
        judged = grades.get(q, {})
        n_rel = len(judged)
        hit = [d in judged for d in docs]

        def share(k, n_rel=n_rel, hit=hit):
            return sum(hit[:k]) / n_rel if n_rel else 0.0

        ap = sum(sum(hit[: i + 1]) / (i + 1) for i, h in enumerate(hit) if h)

        def ndcg(k, docs=docs, judged=judged):
            def gain(values):
                return sum(v / math.log2(i + 2) for i, v in enumerate(values[:k]))

            ideal = gain(sorted(judged.values(), reverse=True))
            return gain([judged.get(d, 0) for d in docs]) / ideal if ideal > 0 else 0.0

        scores[s, q] = (
            sum(hit[:10]) / 10, share(50), share(n_rel), ap / n_rel if n_rel else 0.0,
            ndcg(10), ndcg(20),
        )
    return scores


def engine_scores(spark, runs, qrels, **options):
    rows = ranking.evaluate_per_query(*make(spark, runs, qrels), **options).collect()
    return {(r["system_number"], r["query_number"]): tuple(r[m] for m in METRICS) for r in rows}


def assert_same(got, want):
    assert got.keys() == want.keys()
    for key, scores in want.items():
        assert got[key] == pytest.approx(scores, abs=1e-9), key


def random_case(seed, rank_ties=1, repeats=0.0):
    rng = random.Random(seed)
    runs, qrels = [], []
    for q in range(1, 8):
        for d in rng.sample(range(200), rng.choice([0, 1, 5, 60])):
            qrels.append((q, d, rng.choice([0, 1, 1, 2, 3])))
        for s in (1, 2, 3):
            if rng.random() < 0.2:
                continue
            docs = rng.sample(range(200), rng.choice([1, 7, 30, 150]))
            for i, d in enumerate(docs):
                runs.append((s, q, d, i // rank_ties))
                if rng.random() < repeats:
                    runs += [(s, q, d, i // rank_ties)] * rng.choice([1, 90])
    return runs, qrels


@pytest.mark.parametrize("seed", [1, 2])
def test_random_lists(spark, seed):
    runs, qrels = random_case(seed)
    assert_same(engine_scores(spark, runs, qrels), plain_scores(runs, qrels))


@pytest.mark.parametrize(("ties", "repeats"), [(1, 0.0), (5, 0.0), (3, 0.1)])
def test_hot_lists_are_split_and_exact(spark, ties, repeats):
    """Lists above the limit go through slices; ranks, ties and copies stay exact."""
    runs, qrels = random_case(7, ties, repeats)
    want = plain_scores(runs, qrels)
    assert_same(engine_scores(spark, runs, qrels, max_group_rows=20), want)


def test_a_third_of_all_rows_in_one_list_of_copies(spark):
    runs = [(1, 1, 5, 3)] * 400 + [(1, 1, d, d) for d in range(10, 400)]
    runs += [(s, q, d, d) for s in (1, 2) for q in (2, 3) for d in range(1, 100)]
    qrels = [(1, 5, 2), (1, 390, 1), (2, 50, 3)]
    want = plain_scores(runs, qrels)
    assert_same(engine_scores(spark, runs, qrels, max_group_rows=50), want)
    assert want[1, 1][1] > 1  # each copy is a hit


def test_edge_cases(spark):
    runs = [
        (1, 1, 10, 0), (1, 1, 11, 5),  # ranks from 0, with a gap; shorter than k
        (1, 2, 10, 1),  # not judged
        (1, 3, 10, 1), (1, 3, 12, 2),  # judged with grade 0 only
    ]
    qrels = [(1, 11, 1), (3, 10, 0), (9, 1, 1)]
    got = engine_scores(spark, runs, qrels)
    assert set(got) == {(1, 1), (1, 2), (1, 3)}
    assert got[1, 1] == pytest.approx((0.1, 1.0, 0.0, 0.5, 1 / math.log2(3), 1 / math.log2(3)))
    assert got[1, 2] == (0,) * 6
    assert got[1, 3] == pytest.approx((0.1, 1.0, 1.0, 1.0, 0.0, 0.0))


def test_perfect_ranking(spark):
    qrels = [(1, d, 3 if d < 3 else 1) for d in range(12)]
    got = engine_scores(spark, [(1, 1, d, d) for d in range(12)], qrels)
    assert got[1, 1] == pytest.approx((1.0, 1.0, 1.0, 1.0, 1.0, 1.0))


def test_the_only_judged_document_at_place_18(spark):
    runs = [(1, 3, d, d) for d in range(1, 31)]
    rounded = ranking.evaluate(*make(spark, runs, [(3, 18, 3)]))
    row = rounded.filter("query_number = '3'").first()
    assert (row["AP"], row["nDCG@10"], row["nDCG@20"]) == (0.056, 0.0, 0.235)


def test_means_count_unjudged_queries_and_use_unrounded_values(spark):
    runs = [(1, q, 1, 1) for q in (1, 2, 3)]
    table = ranking.evaluate(*make(spark, runs, [(1, 1, 1), (2, 7, 1)]))
    mean = table.filter("query_number = 'mean'").collect()
    assert len(mean) == 1
    assert mean[0]["P@10"] == 0.033 and mean[0]["R@50"] == 0.333


def test_last_line_wins_with_line_numbers(spark):
    rows = spark.createDataFrame(
        [(1, 1, 3, 1), (1, 1, 1, 2)], "query_id LONG, doc_id LONG, relevance INT, line LONG"
    )
    assert ranking.index_qrels(rows, "line").first()["relevance"] == 1
    assert ranking.index_qrels(rows).first()["relevance"] == 3


def test_rounding_is_half_to_even(spark):
    values = spark.createDataFrame([(0.0625,), (0.0125,), (0.0375,)], "x DOUBLE")
    got = [r[0] for r in values.select(F.bround("x", 3)).collect()]
    assert got == [0.062, 0.012, 0.038]


def test_top_k_limits_before_the_shuffle(spark, capsys):
    runs, _ = make(spark, [(1, 1, d, -d) for d in range(30)], [(1, 1, 1)])
    top = ranking.top_k_retrieved(runs, 3)
    assert sorted((r["pos"], r["doc_number"]) for r in top.collect()) == [(1, 29), (2, 28), (3, 27)]
    top.explain()
    assert "WindowGroupLimit" in capsys.readouterr().out
