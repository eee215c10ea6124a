"""Text preparation as column expressions; every step stays in the JVM."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The 29 characters Unicode-aware ``\s`` matches, as a regex class body.
WHITESPACE = (
    r"\t-\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)

# The same characters one by one.
WHITESPACE_CHARACTERS = "".join(
    chr(code)
    for first, last in (
        (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
        (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
    )
    for code in range(first, last + 1)
)
_OTHER_SPACES = WHITESPACE_CHARACTERS.replace(" ", "")

# English stop words, as published with the common NLP toolkits.
ENGLISH_STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself
    yourselves he him his himself she she's her hers herself it it's its itself they them their
    theirs themselves what which who whom this that that'll these those am is are was were be been
    being have has had having do does did doing a an the and but if or because as until while of at
    by for with about against between into through during before after above below to from up down
    in out on off over under again further then once here there when where why how all any both
    each few more most other some such no nor not only own same so than too very s t can will just
    don don't should should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't
    doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't
    needn needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
    """.split()
)

# The words the word tokenizer splits in two.
_CONTRACTIONS = r"\b(?:(can)(not)|(gim|lem)(me)|(gon|wan)(na)|(got)(ta))\b"

# ASCII punctuation; the backslash is kept.
PUNCTUATION = string.punctuation.replace("\\", "")


def lowercase(text: Column) -> Column:
    return F.lower(text)


def keep_letters(text: Column) -> Column:
    """Delete everything but a-z and whitespace; the neighbours close up."""
    return F.regexp_replace(text, f"[^a-z{WHITESPACE}]+", "")


def strip_urls(text: Column) -> Column:
    """Delete from ``http`` or ``www`` to the next whitespace, also inside a word."""
    return F.regexp_replace(text, f"(?:http|www)[^{WHITESPACE}]+", "")


def strip_mentions(text: Column) -> Column:
    """Delete ``@`` and the word characters of any script after it."""
    return F.regexp_replace(text, r"@[\p{L}\p{N}_]+", "")


def unwrap_hashtags(text: Column) -> Column:
    """Delete ``#`` and keep the word."""
    return F.translate(text, "#", "")


def strip_punctuation(text: Column) -> Column:
    return F.translate(text, PUNCTUATION, "")


def strip_ends(text: Column) -> Column:
    """Delete whitespace of any kind at both ends."""
    return F.btrim(text, F.lit(WHITESPACE_CHARACTERS))


def split_whitespace(text: Column) -> Column:
    """Words between runs of whitespace, none of them empty.

    Every whitespace character becomes a plain space first: splitting on one
    literal character needs no regular expression and is several times faster.
    """
    spaced = F.translate(text, _OTHER_SPACES, " " * len(_OTHER_SPACES))
    return F.filter(F.split(spaced, " "), lambda word: word != "")


def tokenize_words(text: Column) -> Column:
    """Words of letters-only text, with ``cannot``, ``gonna`` and the like split in two."""
    return split_whitespace(F.regexp_replace(text, _CONTRACTIONS, "$1$3$5$7 $2$4$6$8"))


def remove_stop_words(tokens: Column, stop_words: Iterable[str] = ENGLISH_STOP_WORDS) -> Column:
    stop_words = list(stop_words)
    return F.filter(tokens, lambda word: ~word.isin(stop_words))


def rejoin_tokens(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def corpus_tokens(text: Column, stop_words: Iterable[str] = ENGLISH_STOP_WORDS) -> Column:
    """Tokens for corpus comparison, before stemming."""
    return remove_stop_words(tokenize_words(keep_letters(lowercase(text))), stop_words)


def tweet_tokens(text: Column) -> Column:
    """Tokens for the classification experiment, before lemmas; stop words stay."""
    text = strip_mentions(strip_urls(lowercase(text)))
    return tokenize_words(keep_letters(unwrap_hashtags(text)))


def notebook_tokens(text: Column) -> Column:
    """Tokens of the plain bag-of-words variant: no punctuation, lower case, split."""
    return split_whitespace(lowercase(strip_punctuation(text)))


def _joined_runs(words: str, n: int) -> Column:
    """Every ``n`` neighbouring words of an array column, joined by spaces."""
    runs = F.size(words) - (n - 1)
    return F.when(
        runs >= 1,
        F.transform(
            F.sequence(F.lit(1), F.greatest(F.lit(1), runs)),
            lambda at: F.array_join(F.slice(words, at, n), " "),
        ),
    ).otherwise(F.array().cast("array<string>"))


def with_terms(docs: DataFrame, max_n: int = 1, tokens: str = "tokens") -> DataFrame:
    """Add ``terms``: words of two letters or more, then their n-grams up to ``max_n``.

    Shorter words go first, so an n-gram closes over the gap they leave.  The
    words are a column of their own, so that they are filtered once per document
    and not once per n-gram.
    """
    docs = docs.withColumn("_words", F.filter(tokens, lambda word: F.length(word) >= 2))
    grams = [F.col("_words")]
    for n in range(2, max_n + 1):
        grams.append(_joined_runs("_words", n))
    return docs.withColumn("terms", F.concat(*grams)).drop("_words")


def counted(words: Column | str, word: str = "term", n: str = "n") -> Column:
    """The distinct words of an array with how often each stands in it, sorted by word.

    The array is sorted and the lengths of its runs are taken, within the row: nothing is
    shuffled to be counted.
    """

    def run_lengths(ordered: Column) -> Column:
        size = F.size(ordered)
        places = F.sequence(F.lit(0), size - 1)
        starts = F.filter(
            places, lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1))
        )
        return F.when(size > 0, _bound(starts, lambda found: _runs(ordered, found, size)))

    def _runs(ordered: Column, starts: Column, size: Column) -> Column:
        ends = F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(size))
        return F.zip_with(
            starts,
            ends,
            lambda a, b: F.struct(F.get(ordered, a).alias(word), (b - a).cast("long").alias(n)),
        )

    return _bound(F.array_sort(F.filter(words, lambda w: w.isNotNull())), run_lengths)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
