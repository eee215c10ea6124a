"""Stored and merged sketches against the exact summary of a corpus."""

from __future__ import annotations

import random

from scoreloom.operators import corpus

# Three times the relative standard error of 2^12 registers.
BOUND = 3 * 1.04 / 4096**0.5
SCHEMA = "split STRING, category STRING, tokens ARRAY<STRING>"


def deliveries():
    rng = random.Random(9)
    return [
        [
            (
                rng.choice(["train", "train", "dev", None]),
                f"c{rng.randrange(14)}",
                [f"w{int(rng.paretovariate(0.4)) % 200_000}" for _ in range(rng.randint(0, 80))],
            )
            for _ in range(1500)
        ]
        for _ in range(3)
    ]


def test_merged_sketches_are_near_the_exact_counts(spark, tmp_path):
    every = []
    for i, rows in enumerate(deliveries()):
        docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
        # Each delivery is read once, when it comes.
        stored = corpus.corpus_sketches(docs, "split", "category")
        stored.write.mode("append").parquet(str(tmp_path / "sketches"))
        every += rows
        docs = spark.createDataFrame(every, SCHEMA)
        exact = {}
        for split in {r[0] for r in every}:
            own = [r for r in every if r[0] == split]
            tokens = {t for r in own for t in r[2]}
            exact[split] = (len(own), len(tokens), len({r[1] for r in own}))
        kept = spark.read.parquet(str(tmp_path / "sketches"))
        assert kept.count() == 3 * (i + 1)
        got = corpus.summary_of_sketches(kept, "split").collect()
        assert {r["split"] for r in got} == set(exact)
        for row in got:
            documents, vocabulary, categories = exact[row["split"]]
            assert row["documents"] == documents and row["categories"] == categories
            assert abs(row["vocabulary"] - vocabulary) <= BOUND * vocabulary


def test_a_split_without_tokens_and_an_empty_corpus(spark):
    rows = [("train", "a", []), ("train", None, None), ("dev", None, ["x", None])]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = corpus.summary_of_sketches(corpus.corpus_sketches(docs, "split", "category"), "split")
    assert sorted(map(tuple, got.collect())) == [("dev", 1, 1, 0), ("train", 2, 0, 1)]
    none = corpus.corpus_sketches(docs.limit(0), "split", "category")
    assert corpus.summary_of_sketches(none, "split").collect() == []
