"""Registered queries: text preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from scoreloom.functions import text as tx
from scoreloom.operators import corpus as ops
from scoreloom.plans.durable import cut, fresh_path
from scoreloom.plans.spreading import spread_scan
from scoreloom.registry import inputs
from scoreloom.registry.base import joined, register, table, with_ctes
from scoreloom.registry.inputs import CORPUS_SQL, TWEETS_SQL
from scoreloom.registry.stem_sql import stems_cte
from scoreloom.sources import readers

WS = tx.WHITESPACE


def _literal(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


STOP_SQL = "[" + ", ".join(_literal(w) for w in tx.ENGLISH_STOP_WORDS) + "]"

# The same cleaning in the other dialect, built up step by step.
def _letters(sql: str) -> str:
    return f"regexp_replace({sql}, '[^a-z{WS}]', '', 'g')"


def _urls(sql: str) -> str:
    return f"regexp_replace({sql}, 'http[^{WS}]+|www[^{WS}]+|https[^{WS}]+', '', 'g')"


def _mentions(sql: str) -> str:
    return rf"regexp_replace({sql}, '@[\p{{L}}\p{{N}}_]+', '', 'g')"


def _split(sql: str) -> str:
    return f"[x FOR x IN string_split_regex({sql}, '[{WS}]+') IF x <> '']"


def _no_punctuation(sql: str) -> str:
    return f"translate({sql}, {_literal(tx.PUNCTUATION)}, '')"


def _pairs(sql: str) -> str:
    words = (("can", "not"), ("gim", "me"), ("lem", "me"), ("gon", "na"), ("wan", "na"),
             ("got", "ta"))
    for a, b in words:
        sql = rf"regexp_replace({sql}, '\b{a}{b}\b', '{a} {b}', 'g')"
    return sql


LOWER_SQL = "lower(text)"
LETTERS_SQL = _letters(LOWER_SQL)
WORDS_SQL = _split(_pairs(LETTERS_SQL))
CORPUS_TOKENS_SQL = f"[y FOR y IN {WORDS_SQL} IF NOT list_contains({STOP_SQL}, y)]"
URLS_SQL = _urls(LOWER_SQL)
MENTIONS_SQL = _mentions(URLS_SQL)
HASHTAGS_SQL = f"replace({MENTIONS_SQL}, '#', '')"
TWEET_TOKENS_SQL = _split(_pairs(_letters(HASHTAGS_SQL)))
NOTEBOOK_TOKENS_SQL = _split("lower(" + _no_punctuation("text") + ")")

TOKENS_SQL = f"""
docs AS (SELECT doc_id, label, {CORPUS_TOKENS_SQL} AS tokens FROM corpus)
"""
TWEET_DOCS_SQL = f"""
tweet_docs AS (SELECT id, row_id, category, text, {TWEET_TOKENS_SQL} AS tokens FROM tweets)
"""


def _string(sql: str) -> str:
    return f"array_to_string({sql}, ' ')"


def _column(name, expression, sql):
    """Register a text expression applied to every document."""

    @register(name, with_ctes(CORPUS_SQL, select=f"SELECT doc_id, {sql} AS result FROM corpus"))
    def run(spark, sf_dir):
        docs = inputs.corpus(spark, sf_dir)
        return docs.select("doc_id", expression(F.col("text")).alias("result"))

    return run


_column("lowercase", tx.lowercase, LOWER_SQL)
_column("keep_letters", lambda t: tx.keep_letters(tx.lowercase(t)), LETTERS_SQL)
_column("strip_urls", lambda t: tx.strip_urls(tx.lowercase(t)), URLS_SQL)
_column("strip_mentions", tx.strip_mentions, _mentions("text"))
_column("unwrap_hashtags", tx.unwrap_hashtags, "replace(text, '#', '')")
_column(
    "tokenize_words",
    lambda t: joined(tx.tokenize_words(tx.keep_letters(tx.lowercase(t)))),
    _string(WORDS_SQL),
)
_column("remove_stop_words", lambda t: joined(tx.corpus_tokens(t)), _string(CORPUS_TOKENS_SQL))
_column(
    "rejoin_tokens",
    lambda t: tx.rejoin_tokens(tx.split_whitespace(t)),
    _string(_split("text")),
)
_column("strip_punctuation", tx.strip_punctuation, _no_punctuation("text"))
_column(
    "split_whitespace",
    lambda t: F.array_join(tx.split_whitespace(t), "|"),
    f"array_to_string({_split('text')}, '|')",
)


def corpus_docs(spark, sf_dir, stem=False):
    docs = spread_scan(inputs.corpus(spark, sf_dir), "doc_id")
    return ops.preprocess_corpus(docs, stem=stem).drop("text")


def tweet_docs(spark, sf_dir):
    return ops.preprocess_tweets(spread_scan(inputs.tweets(spark, sf_dir), "row_id"))


@register(
    "read_labelled_corpus",
    with_ctes(
        CORPUS_SQL,
        f"""lines AS (
          SELECT unnest(string_split(text, chr(10))) AS line, label FROM corpus),
        trimmed AS (
          SELECT regexp_replace(label || chr(9) || line, '\\A[{WS}]+|[{WS}]+\\z', '', 'g') AS line
          FROM lines)""",
        select="""
SELECT left(line, strpos(line, chr(9)) - 1) AS label, substr(line, strpos(line, chr(9)) + 1) AS text
FROM trimmed WHERE contains(line, chr(9))""",
    ),
)
def read_labelled_corpus(spark, sf_dir):
    """Every line of every document, written as a labelled corpus and read back.

    Blank document lines lose their tab by stripping and are rejected.
    """
    path = fresh_path(spark, "corpus")
    lines = inputs.corpus(spark, sf_dir).select("label", F.explode(F.split("text", "\n")).alias("t"))
    lines.select(F.concat_ws("\t", "label", "t")).write.text(path)
    return readers.read_labelled_corpus(spark, path, strict=False)


@register("read_labelled_tweets", with_ctes(TWEETS_SQL, select="SELECT id, category, text FROM tweets"))
def read_labelled_tweets(spark, sf_dir):
    path = fresh_path(spark, "tweets")
    rows = inputs.tweets(spark, sf_dir).select("id", "category", "text")
    rows.write.csv(path, sep="\t", header=True, quote='"', escape='"', quoteAll=True)
    return readers.read_labelled_tweets(spark, path)


@register(
    "read_tweets_notebook",
    with_ctes(
        TWEETS_SQL,
        select=f"SELECT id, regexp_replace(text, '[{WS}]+', ' ', 'g') AS text, category FROM tweets",
    ),
)
def read_tweets_notebook(spark, sf_dir):
    path = fresh_path(spark, "tweets14")
    rows = inputs.tweets(spark, sf_dir).select(
        "id", F.regexp_replace("text", f"[{WS}]+", " ").alias("text"), "category"
    )
    rows.select(F.concat_ws("\t", "id", "text", "category")).write.csv(
        path, encoding="ISO-8859-1", sep="\u0001", quote="", escape="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    return readers.read_tweets_notebook(spark, path)


STEMS_SQL = stems_cte("(SELECT DISTINCT unnest(tokens) AS token FROM docs)")


@register(
    "stem_vocabulary",
    with_ctes(CORPUS_SQL, TOKENS_SQL, STEMS_SQL, select="SELECT token, stem FROM stems"),
)
def stem_vocabulary(spark, sf_dir):
    return ops.stem_vocabulary(corpus_docs(spark, sf_dir))


# A lemma table from the data itself: plural-looking words whose singular also occurs.
LEMMAS_SQL = f"""
words AS (SELECT DISTINCT unnest(tokens) AS w FROM tweet_docs),
lemmas AS (
  SELECT p.w AS form, s.w AS lemma FROM words p JOIN words s ON p.w = s.w || 's')
"""


def _lemmas(docs):
    words = ops.vocabulary(docs)
    singular = words.select(F.concat("token", F.lit("s")).alias("form"), F.col("token").alias("lemma"))
    return singular.join(words.select(F.col("token").alias("form")), "form")


@register(
    "lemmatize_vocabulary",
    with_ctes(
        TWEETS_SQL, TWEET_DOCS_SQL, LEMMAS_SQL,
        """placed AS (SELECT id, unnest(tokens) AS w, generate_subscripts(tokens, 1) AS nth
                      FROM tweet_docs),
           mapped AS (SELECT id, string_agg(coalesce(lemma, w), ' ' ORDER BY nth) AS result
                      FROM placed LEFT JOIN lemmas ON form = w GROUP BY id)""",
        select="SELECT id, coalesce(result, '') AS result FROM tweets LEFT JOIN mapped USING (id)",
    ),
)
def lemmatize_vocabulary(spark, sf_dir):
    docs = tweet_docs(spark, sf_dir)
    lemmatized = ops.lemmatize_vocabulary(docs.select("id", "tokens"), _lemmas(docs), "id")
    return lemmatized.select("id", joined("tokens").alias("result"))


@register(
    "preprocess_corpus",
    with_ctes(
        CORPUS_SQL, TOKENS_SQL, STEMS_SQL,
        """placed AS (SELECT doc_id, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS nth
                      FROM docs),
           stemmed AS (SELECT doc_id, string_agg(stem, ' ' ORDER BY nth) AS result
                       FROM placed JOIN stems USING (token) GROUP BY doc_id)""",
        select="""SELECT doc_id, label, coalesce(result, '') AS tokens
                  FROM docs LEFT JOIN stemmed USING (doc_id)""",
    ),
)
def preprocess_corpus(spark, sf_dir):
    return corpus_docs(spark, sf_dir, stem=True).withColumn("tokens", joined("tokens"))


@register(
    "preprocess_tweets",
    with_ctes(
        TWEETS_SQL, TWEET_DOCS_SQL,
        select=f"SELECT id, category, {_string('tokens')} AS clean_text FROM tweet_docs",
    ),
)
def preprocess_tweets(spark, sf_dir):
    return tweet_docs(spark, sf_dir).select("id", "category", "clean_text")


_SPLITS_SQL = f"""
split_docs AS (
  SELECT source AS split, lang, {NOTEBOOK_TOKENS_SQL} AS tokens FROM documents),
words AS (SELECT split, count(DISTINCT w) AS vocabulary
          FROM (SELECT split, unnest(tokens) AS w FROM split_docs) GROUP BY split)
"""


@register(
    "corpus_summary",
    with_ctes(
        _SPLITS_SQL,
        select="""SELECT split, count(*) AS documents, coalesce(max(vocabulary), 0) AS vocabulary,
                         count(DISTINCT lang) AS categories
                  FROM split_docs LEFT JOIN words USING (split) GROUP BY split""",
    ),
)
def corpus_summary(spark, sf_dir):
    docs = spread_scan(table(spark, sf_dir, "documents"), "doc_id").select(
        F.col("source").alias("split"), "lang", tx.notebook_tokens(F.col("text")).alias("tokens")
    )
    return ops.corpus_summary(docs, "split", "lang")


@register(
    "corpus_sketches",
    with_ctes(
        _SPLITS_SQL,
        select="""SELECT split, count(*) AS documents, count(DISTINCT lang) AS categories,
                         true AS vocabulary_within_bound
                  FROM split_docs GROUP BY split""",
    ),
)
def corpus_sketches(spark, sf_dir):
    """Stored sketches of each source, merged; the estimate is held against the exact count."""
    docs = spread_scan(table(spark, sf_dir, "documents"), "doc_id").select(
        F.col("source").alias("split"), "lang", tx.notebook_tokens(F.col("text")).alias("tokens")
    )
    told = ops.summary_of_sketches(cut(ops.corpus_sketches(docs, "split", "lang")), "split")
    exact = ops.corpus_summary(docs, "split", "lang").select(
        F.col("split").alias("_split"), F.col("vocabulary").alias("_exact")
    )
    gap = F.abs(F.col("vocabulary") - F.col("_exact"))
    return told.join(exact, F.col("split").eqNullSafe(F.col("_split"))).select(
        "split",
        "documents",
        "categories",
        (gap <= F.col("_exact") * ops.SKETCH_BOUND).alias("vocabulary_within_bound"),
    )


@register(
    "category_histogram",
    "SELECT lang AS label, count(*) AS documents FROM documents GROUP BY lang",
)
def category_histogram(spark, sf_dir):
    return ops.category_histogram(inputs.corpus(spark, sf_dir), "label")
