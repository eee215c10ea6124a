"""Text preparation: the edge cases of each step."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from scoreloom.functions import text as tx
from scoreloom.functions.stemming import porter_stem
from scoreloom.operators import corpus


def apply(spark, expression, value):
    return spark.createDataFrame([(value,)], "t STRING").select(expression(F.col("t"))).first()[0]


@pytest.mark.parametrize(
    ("text", "tokens"),
    [
        ("I don't", ["i", "dont"]),
        ("awwww so", ["a", "so"]),
        ("#car", ["car"]),
        ("hey @me_é2 hi", ["hey", "hi"]),
        ("I cannot, gonna", ["i", "can", "not", "gon", "na"]),
        ("two words apart\x1cnow", ["two", "words", "apart", "now"]),
        ("see http://x.y/z?q=1 www.a.b end", ["see", "end"]),
        ("", []),
    ],
)
def test_tweet_tokens(spark, text, tokens):
    assert apply(spark, tx.tweet_tokens, text) == tokens


def test_corpus_tokens_drop_stop_words_after_punctuation(spark):
    got = apply(spark, tx.corpus_tokens, "The dogs don't see WANNA-be cannot")
    assert got == ["dogs", "dont", "see", "wannabe"]


def test_whitespace_class_is_that_of_unicode_regexes(spark):
    spaces = [chr(c) for c in range(0x110000) if re.match(r"\s", chr(c))]
    assert len(spaces) == 29
    text = "a" + "b".join(spaces) + "c"
    assert apply(spark, tx.split_whitespace, text) == re.split(r"\s+", text)


def test_strip_punctuation_keeps_the_backslash(spark):
    assert apply(spark, tx.strip_punctuation, "a\\b[c]!\"#$%&'()*+,-./:;<=>?@^_`{|}~") == "a\\bc"


def test_notebook_tokens(spark):
    assert apply(spark, tx.notebook_tokens, "Hello, World!  #Tweets") == [
        "hello", "world", "tweets"
    ]


@pytest.mark.parametrize(
    ("max_n", "terms"),
    [
        (1, ["to", "be", "not"]),
        (2, ["to", "be", "not", "to be", "be not"]),
        (3, ["to", "be", "not", "to be", "be not", "to be not"]),
        (4, ["to", "be", "not", "to be", "be not", "to be not"]),
    ],
)
def test_terms_close_over_short_words(spark, max_n, terms):
    docs = spark.createDataFrame([(["to", "x", "be", "not"],)], "tokens ARRAY<STRING>")
    assert tx.with_terms(docs, max_n).first()["terms"] == terms


@pytest.mark.parametrize(
    ("word", "stem"),
    [
        ("caresses", "caress"), ("ponies", "poni"), ("ties", "tie"), ("dies", "die"),
        ("cats", "cat"), ("feed", "feed"), ("agreed", "agre"), ("plastered", "plaster"),
        ("motoring", "motor"), ("sing", "sing"), ("conflated", "conflat"), ("troubled", "troubl"),
        ("sized", "size"), ("hopping", "hop"), ("falling", "fall"), ("filing", "file"),
        ("happy", "happi"), ("sky", "sky"), ("relational", "relat"), ("rational", "ration"),
        ("triplicate", "triplic"), ("hopefulness", "hope"), ("goodness", "good"),
        ("adjustable", "adjust"), ("adoption", "adopt"), ("probate", "probat"), ("rate", "rate"),
        ("cease", "ceas"), ("controll", "control"), ("roll", "roll"), ("skies", "sky"),
        ("enjoy", "enjoy"), ("dying", "die"), ("cried", "cri"), ("by", "by"), ("", ""),
    ],
)
def test_porter_stem(word, stem):
    assert porter_stem(word) == stem


def test_preprocess_corpus_keeps_nulls_and_empty_texts(spark):
    docs = spark.createDataFrame(
        [(1, "Running dogs ran"), (2, None), (3, "the"), (4, "flies")], "id INT, text STRING"
    )
    got = {r["id"]: r["tokens"] for r in corpus.preprocess_corpus(docs).collect()}
    assert got == {1: ["run", "dog", "ran"], 2: None, 3: [], 4: ["fli"]}


def test_stem_vocabulary(spark):
    docs = spark.createDataFrame([(["dogs", "dogs", "dog"],)], "tokens ARRAY<STRING>")
    got = {r["token"]: r["stem"] for r in corpus.stem_vocabulary(docs).collect()}
    assert got == {"dogs": "dog", "dog": "dog"}


def test_lemmas_keep_order_repeats_and_empty_documents(spark):
    docs = spark.createDataFrame(
        [("a", ["mice", "eat", "mice", "cats"]), ("b", []), ("c", ["x"])],
        "id STRING, tokens ARRAY<STRING>",
    )
    lemmas = spark.createDataFrame([("mice", "mouse"), ("cats", "cat"), ("x", "x")], "form STRING, lemma STRING")
    got = {r["id"]: r["tokens"] for r in corpus.lemmatize_vocabulary(docs, lemmas, "id").collect()}
    assert got == {"a": ["mouse", "eat", "mouse", "cat"], "b": [], "c": ["x"]}


def test_preprocess_tweets(spark):
    docs = spark.createDataFrame([("1", "@you LOVE the #cats!! http://t.co/x")], "id STRING, text STRING")
    lemmas = spark.createDataFrame([("cats", "cat")], "form STRING, lemma STRING")
    assert corpus.preprocess_tweets(docs, lemmas=lemmas).first()["clean_text"] == "love the cat"


def test_summary_and_histogram(spark):
    docs = spark.createDataFrame(
        [("train", "x", ["a", "b"]), ("train", "y", ["b"]), ("test", "x", [])],
        "split STRING, category STRING, tokens ARRAY<STRING>",
    )
    got = {tuple(r) for r in corpus.corpus_summary(docs, "split", "category").collect()}
    assert got == {("train", 2, 2, 2), ("test", 1, 0, 1)}
    assert [tuple(r) for r in corpus.category_histogram(docs, "category").collect()] == [
        ("x", 2), ("y", 1)
    ]


def test_stems_of_the_sql_twin():
    import duckdb

    from scoreloom.functions import stemming
    from scoreloom.registry.stem_sql import stems_cte

    heads = ["", "y", "yy", "ay", "sky", "tr", "tree", "oats", "hop", "fil", "cri", "syzyg",
             "toy", "yyy", "controll", "prob", "roll", "fiv", "box", "xvii", "q1z", "adopt"]
    tails = [s for s, _ in stemming.DERIVATIONAL + stemming.ADJECTIVAL] + [
        *stemming.RESIDUAL, "", "s", "ss", "sses", "ies", "ied", "eed", "ed", "ing", "ationalli",
        "ating", "bled", "izing", "tted", "lling", "ssed", "zzing", "y", "ay", "e", "ll", "lle",
    ]
    words = {h + t + e for h in heads for t in tails for e in ("", "s", "ed", "ing", "ly")}
    words = sorted((words | set(stemming.IRREGULAR)) - {""})
    db = duckdb.connect()
    db.execute("CREATE TABLE words AS SELECT unnest(?) AS token", [words])
    got = dict(db.execute(f"WITH {stems_cte('words')} SELECT token, stem FROM stems").fetchall())
    assert got == {word: porter_stem(word) for word in words}
