"""Every stage of the pipeline against brute force, row by row."""

from __future__ import annotations

import hashlib
import random

from test_documents import (
    by_key,
    classes,
    counts_by_brute_force,
    fingerprint_by_brute_force,
    hits_by_brute_force,
    library,
    removed_by_brute_force,
)

import corpus_pipeline
from scoreloom.llm.common import stored


def fixture():
    rng = random.Random(5)

    def words(n: int) -> str:
        return " ".join(f"w{rng.getrandbits(20)}" for _ in range(n))

    passage, benchmark = words(12), [(0, words(14)), (1, words(4)), (None, None)]
    texts = [words(100) for _ in range(16)]
    rows: list = [(i, t) for i, t in enumerate(texts[:6])]
    rows += [(i, f"{words(60)} {passage} {words(60)}") for i in (10, 11, 12)]
    rows += [(None, f"{words(60)} {passage} {words(60)}"), (None, texts[6]), (None, texts[7])]
    rows += [(20, texts[8]), (20, texts[9]), (20, texts[9])]  # one id, unlike texts and a copy
    rows += [(None, texts[0]), (30, texts[1]), (None, texts[7]), (None, texts[10])]  # copies
    rows += [(40, texts[11] + " " + benchmark[0][1] + " end"), (41, f"{texts[12]} {benchmark[1][1]}")]
    rows += [(50, words(20)), (51, "one two three " * 40), (52, None), (None, ""), (None, words(30))]
    rows += [(53, " ".join("#|#|" + w for w in words(90).split()))]
    return rows, benchmark


def good(rows):
    """No text is near a bound of a rule: what breaks none is good, what breaks one is bad."""
    kept = []
    for i, t in rows:
        n_words, _, symbols, _, repeats = counts_by_brute_force(t)
        if n_words >= 50 and 2 * repeats <= n_words and 5 * symbols <= n_words:
            kept.append((i, t))
    return kept


def one_of_each(rows):
    prints = {fingerprint_by_brute_force(t): [fingerprint_by_brute_force(t)] for _, t in rows}
    root, best = classes(prints, 4), {}
    for i, t in rows:
        own = (i is None, i or 0, t)
        group = root[fingerprint_by_brute_force(t)]
        best[group] = min(best.get(group, own), own)
    return [(None if null else i, t) for null, i, t in best.values()]


def without_passages(rows):
    return [(r[0], r[4].decode("utf-8", "ignore")) for r in removed_by_brute_force(rows, 50)]


def test_rows_of_every_stage(spark, tmp_path):
    rows, benchmark = fixture()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    given = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    spark.createDataFrame(given, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    items = spark.createDataFrame(benchmark, "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")

    def clean(rows):
        return [(i, t) for i, t in rows if not hits_by_brute_force(t, benchmark, 10)[1]]

    want, docs = rows, corpus_pipeline.table(spark, str(tmp_path), "documents")
    expected = [good, one_of_each, without_passages, clean]
    for (name, stage), brute_force in zip(corpus_pipeline.STAGES[:-1], expected, strict=True):
        before, want = want, brute_force(want)
        docs = stored(stage(spark, docs, str(tmp_path)), name)
        assert by_key(before) != by_key(want), name
        found = [tuple(r) for r in docs.collect()]
        assert by_key(found) == by_key((i, t, "en", "s", len(t)) for i, t in want), name

    of = library("word_bpe_49k.json")
    encoded = []
    for i, t in want:
        ids = of.encode(t, add_special_tokens=False).ids
        told = of.decode(ids, skip_special_tokens=False)
        encoded.append((i, len(ids), hashlib.sha256(told.encode()).hexdigest()))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert by_key((r["doc_id"], r["n_tokens"], r["decoded_sha256"]) for r in got) == by_key(encoded)
