"""Topics and classifiers: invariants on small corpora."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from scoreloom.operators import classify, lda, scoring, topics
from scoreloom.operators.terms import fit_terms
from scoreloom.plans.durable import shared_folder

WORDS = {"pos": "good great fine nice".split(), "neg": "bad poor awful sad".split(),
         "neu": "table chair window door".split()}


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(5)
    rows = []
    for i in range(90):
        label = ("pos", "neg", "neu")[i % 3]
        tokens = rng.choices(WORDS[label], k=6) + rng.choices(["film", "plot", "the"], k=3)
        rows.append((i, label, tokens, "dev" if i % 10 == 0 else "train"))
    frame = spark.createDataFrame(rows, "doc_id INT, label STRING, tokens ARRAY<STRING>, split STRING")
    return frame.persist()


def test_topics(docs):
    model = topics.fit_topics(docs, k=3, passes=20)
    per_doc = topics.document_topics(model, docs.select("doc_id", "label", "tokens"))
    assert per_doc.count() == 90 * 3
    assert per_doc.filter("probability < 0.01 AND probability > 0").isEmpty()
    sums = per_doc.groupBy("doc_id").agg(F.sum("probability").alias("p"))
    assert sums.filter("abs(p - 1) > 0.03").isEmpty()
    averages = topics.corpus_topic_average(per_doc)
    best = {r["label"]: r for r in topics.dominant_topic(averages).collect()}
    assert set(best) == set(WORDS)
    table = topics.topic_average_table(averages, ["neg", "neu", "pos"])
    assert table.columns == ["topic", "neg", "neu", "pos"] and table.count() == 3
    top = topics.topic_top_words(model, 4).collect()
    assert len(top) == 12
    shared = topics.shared_topics(averages, 0.0, 3)
    assert shared.count() == 3


def test_vocabulary_and_bags(spark):
    docs = spark.createDataFrame([(1, ["b", "a", "b"]), (2, ["b"])], "doc_id INT, tokens ARRAY<STRING>")
    got = [tuple(r) for r in topics.build_vocabulary(docs).orderBy("token_id").collect()]
    assert got == [("a", 0, 1, 1), ("b", 1, 2, 3)]
    bags = {(r["doc_id"], r["token"]): r["n"] for r in topics.doc_to_bow(docs, "doc_id").collect()}
    assert bags == {(1, "a"): 1, (1, "b"): 2, (2, "b"): 1}


def test_the_vocabulary_is_exact_up_to_its_bound(docs):
    terms = docs.select("doc_id", F.col("tokens").alias("terms"))
    assert len(fit_terms(terms, max_terms=15).vocabulary) == 15
    with pytest.raises(ValueError, match="15 distinct terms"):
        fit_terms(terms, max_terms=14)


def test_asked_slots_fold_and_do_not_cut(docs):
    terms = docs.select("doc_id", F.col("tokens").alias("terms"))
    model = fit_terms(terms, slots=5)
    assert model.slots == 5 and len(model.vocabulary) <= 5
    counted = model.transform(terms)
    total = counted.select(
        F.aggregate(
            _values(), F.lit(0.0),
            lambda a, x: a + x,
        ).alias("n")
    ).agg(F.sum("n")).first()[0]
    assert total == 90 * 9
    assert {model.name(i) for i in range(len(model.vocabulary))} <= {
        w for words in WORDS.values() for w in words} | {"film", "plot", "the"}


def _values():
    from pyspark.ml.functions import vector_to_array

    return vector_to_array("features")


def test_classifiers_beat_the_majority(docs):
    train = docs.filter("split = 'train'")
    terms = classify.learn_terms(train, "label", 1)
    for model in (
        classify.train_linear_svm(train, "label", terms),
        classify.train_random_forest(train, "label", terms, trees=10),
    ):
        predicted = classify.predict(model, docs, "label")
        assert predicted.count() == 90
        assert {r["y_pred"] for r in predicted.collect()} <= set(WORDS)
        accuracy = {r["split"]: r["accuracy"]
                    for r in scoring.accuracy(predicted, ["split"]).collect()}
        assert accuracy["train"] > 0.9 and accuracy["dev"] > 0.8


def test_experiment(docs):
    stacked = classify.run_experiment(docs, "label")
    assert stacked.count() == 2 * 90
    accuracy = scoring.accuracy(stacked).collect()
    assert len(accuracy) == 4 and all(r["accuracy"] > 0.8 for r in accuracy)


def test_numbering_words_tokenises_each_text_once(spark):
    from scoreloom.operators import features

    seen = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def cut_up(text):
        seen.add(1)
        return text.split()

    texts = spark.createDataFrame([(i, f"w{i} w{i % 7} the") for i in range(40)], "doc_id INT, t STRING")
    docs = texts.select("doc_id", cut_up("t").alias("tokens"))
    got = topics.build_vocabulary(docs, max_group_rows=10).collect()
    assert len(got) == 41 and seen.value == 40
    words = docs.select(F.explode_outer("tokens").alias("token")).distinct()
    ids = features.word_ids(words, max_group_rows=10).orderBy("word_id").collect()
    assert [r["token"] for r in ids] == sorted(r["token"] for r in ids) and seen.value == 80


def test_topic_weights_stay_in_blocks(docs):
    model = topics.fit_topics(docs, k=3, passes=5)
    blocks = dict(model.weights.blocks.mapValues(lambda x: x[1]).collect())
    assert len(blocks) == model.weights.n_blocks > 1
    assert sum(len(b) for b in blocks.values()) == len(model.terms.vocabulary) == 15
    total = sum(b.sum(0) for b in blocks.values())
    assert abs(total / model.weights.total - 1).max() < 1e-9
    assert all(b.min() > 0 for b in blocks.values())


def _left(spark) -> tuple[int, int]:
    """Shuffle files on this machine, and checkpoints."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    shuffles = sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    return shuffles, len([p for p in Path(folder).iterdir() if p.name.startswith("rdd-")])


def test_updates_leave_no_files_behind(spark, docs, monkeypatch):
    monkeypatch.setattr(lda, "CHECKPOINT_EVERY", 3)
    shared_folder(spark)
    rows = fit_terms(docs.select(F.col("tokens").alias("terms")))
    counts = rows.transform(docs.select(F.col("tokens").alias("terms"))).select("features").repartition(4)
    before = _left(spark)
    lda.fit(counts, "features", rows.size, 90, 3, 12, 0.5, 7)
    after = _left(spark)
    assert after[0] - before[0] < 30 and after[1] - before[1] == 1


def test_topics_of_documents_are_found_in_parts(spark, docs, monkeypatch):
    model = topics.fit_topics(docs, k=3, passes=5)
    dealt = docs.select("doc_id", "label", "tokens").repartition(5)
    want = {(r["doc_id"], r["topic"]): r["probability"] for r in topics.document_topics(model, dealt).collect()}
    monkeypatch.setattr(lda, "PARTS_AT_ONCE", 2)
    got = topics.document_topics(model, dealt).collect()
    assert len(got) == len(want) == 270
    assert all(abs(want[r["doc_id"], r["topic"]] - r["probability"]) < 1e-12 for r in got)
