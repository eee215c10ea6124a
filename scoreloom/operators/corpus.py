"""Corpus-level text operators: pipelines, vocabulary mappings and summaries."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.functions import text as tx
from scoreloom.functions.stemming import stem_tokens, stem_words
from scoreloom.plans.unfolding import unfold, unfold_places

# Registers of a sketch, as a power of two: a relative standard error of about 1.6 %.
SKETCH_LG_SIZE = 12
# Four standard errors.
SKETCH_BOUND = 4 * 1.04 / 2 ** (SKETCH_LG_SIZE / 2)


def vocabulary(docs: DataFrame, tokens: str = "tokens") -> DataFrame:
    """The distinct tokens of a corpus."""
    return unfold(docs, F.array_distinct(tokens), "token").distinct()


def stem_vocabulary(docs: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Every distinct token with its stem; the stemmer sees each token once."""
    return vocabulary(docs, tokens).withColumn("stem", stem_words("token"))


def lemmatize_vocabulary(
    docs: DataFrame, lemmas: DataFrame, doc_key: str | Sequence[str], tokens: str = "tokens"
) -> DataFrame:
    """Replace tokens by the lemma of a ``(form, lemma)`` table; others stay as they are.

    The dictionary is first cut down to forms that change and occur.  The join
    leaves the choice between broadcast and shuffle to the measured size, and
    adaptive execution splits the partitions of very frequent tokens.
    """
    keys = [doc_key] if isinstance(doc_key, str) else list(doc_key)
    forms = (
        lemmas.filter(F.col("form") != F.col("lemma"))
        .groupBy(F.col("form").alias("_token"))
        .agg(F.min("lemma").alias("_lemma"))
    )
    placed = unfold_places(docs, tokens, "_at", "_token", *keys)
    mapped = (
        placed.join(forms, "_token", "left")
        .groupBy(*keys)
        .agg(
            F.array_sort(
                F.collect_list(F.struct("_at", F.coalesce("_lemma", "_token").alias("_word")))
            )["_word"].alias("_mapped")
        )
    )
    empty = F.array().cast("array<string>")
    return docs.join(mapped, keys, "left").withColumn(
        tokens, F.coalesce("_mapped", empty)
    ).drop("_mapped")


def preprocess_corpus(
    docs: DataFrame,
    text: str = "text",
    stop_words: Iterable[str] = tx.ENGLISH_STOP_WORDS,
    stem: bool = True,
) -> DataFrame:
    """Add ``tokens``: lower-case letters, split, stop words removed, stemmed."""
    tokens = tx.corpus_tokens(F.col(text), stop_words)
    return docs.withColumn("tokens", stem_tokens(tokens) if stem else tokens)


def preprocess_tweets(
    docs: DataFrame,
    text: str = "text",
    lemmas: DataFrame | None = None,
    doc_key: str = "id",
) -> DataFrame:
    """Add ``tokens`` and ``clean_text``: no links, mentions, hash signs or punctuation."""
    tokens = docs.withColumn("tokens", tx.tweet_tokens(F.col(text)))
    if lemmas is not None:
        tokens = lemmatize_vocabulary(tokens, lemmas, doc_key)
    return tokens.withColumn("clean_text", tx.rejoin_tokens(F.col("tokens")))


def corpus_summary(
    docs: DataFrame, split: str, category: str, tokens: str = "tokens"
) -> DataFrame:
    """Documents, distinct tokens and categories per split.

    Distinct tokens are counted over (split, token) rows, so no task ever holds
    the vocabulary of a split.
    """
    sizes = docs.groupBy(split).agg(
        F.count(F.lit(1)).alias("documents"), F.count_distinct(category).alias("categories")
    )
    words = (
        unfold(docs, F.array_distinct(tokens), "_token", split)
        .distinct()
        .groupBy(split)
        .agg(F.count(F.lit(1)).alias("_vocabulary"))
    )
    return sizes.join(words, split, "left").select(
        split,
        "documents",
        F.coalesce("_vocabulary", F.lit(0)).alias("vocabulary"),
        "categories",
    )


def corpus_sketches(
    docs: DataFrame, split: str, category: str, tokens: str = "tokens", lg_size: int = SKETCH_LG_SIZE
) -> DataFrame:
    """What ``corpus_summary`` tells of each split, in a form that can be stored and merged.

    (split, documents, token_sketch, category_sketch): the sketches are small whatever the
    corpus, and are built before the shuffle, so that a split has one row for each task there.
    """
    # One sketch for each document would cost more than its tokens: they are unfolded instead.
    words = unfold(docs, F.array_distinct(tokens), "_token", split).groupBy(split).agg(
        F.hll_sketch_agg("_token", lg_size).alias("token_sketch")
    )
    sizes = docs.groupBy(split).agg(
        F.count(F.lit(1)).alias("documents"),
        F.hll_sketch_agg(category, lg_size).alias("category_sketch"),
    )
    joined = sizes.withColumnRenamed(split, "_split").join(
        words, F.col("_split").eqNullSafe(F.col(split)), "left"
    )
    return joined.select(
        F.col("_split").alias(split), "documents", "token_sketch", "category_sketch"
    )


def merge_sketches(sketches: DataFrame, split: str) -> DataFrame:
    """One row for each split from the stored rows of any number of deliveries.

    No document may stand in two deliveries if ``documents`` is to be right; the sketches are
    the same however often one does.
    """
    return sketches.groupBy(split).agg(
        F.sum("documents").alias("documents"),
        F.hll_union_agg("token_sketch").alias("token_sketch"),
        F.hll_union_agg("category_sketch").alias("category_sketch"),
    )


def summary_of_sketches(sketches: DataFrame, split: str) -> DataFrame:
    """Like ``corpus_summary``, with distinct tokens and categories as the sketches estimate them."""
    merged = merge_sketches(sketches, split)
    return merged.select(
        split,
        "documents",
        F.coalesce(F.hll_sketch_estimate("token_sketch"), F.lit(0).cast("long")).alias("vocabulary"),
        F.coalesce(F.hll_sketch_estimate("category_sketch"), F.lit(0).cast("long")).alias("categories"),
    )


def category_histogram(docs: DataFrame, category: str) -> DataFrame:
    """Documents per category, most common first."""
    return (
        docs.groupBy(category)
        .agg(F.count(F.lit(1)).alias("documents"))
        .orderBy(F.desc("documents"), F.asc(category))
    )
