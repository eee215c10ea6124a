"""Porter stemming, with the irregular forms and extra rules of the common toolkit variant."""

from __future__ import annotations

import sys
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# The executors need not have this package: its functions travel with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Words whose stems a worker remembers between batches.
MOST_KNOWN = 1 << 18

# Words whose stem the rules would miss.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}

# Suffix and replacement, tried in this order, for stems with a measure above 0.
DERIVATIONAL = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("fulli", "ful"), ("logi", "log"),
)
ADJECTIVAL = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
)
# Suffixes dropped from stems with a measure above 1, tried in this order.
RESIDUAL = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
)


def _shape(word: str) -> str:
    """The word as c's and v's: y is a vowel after a consonant."""
    shape = ""
    for letter in word:
        if letter in "aeiou" or (letter == "y" and shape.endswith("c")):
            shape += "v"
        else:
            shape += "c"
    return shape


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _ends_short(stem: str) -> bool:
    shape = _shape(stem)
    if shape == "vc":
        return True
    return shape.endswith("cvc") and stem[-1] not in "wxy"


def _doubled(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _plural(word: str) -> str:
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("sses"):
        return word[:-2]
    if word.endswith("s") and not word.endswith("ss"):
        return word[:-1]
    return word


def _past(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        if word.endswith(suffix) and "v" in _shape(word[: -len(suffix)]):
            stem = word[: -len(suffix)]
            break
    else:
        return word
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if _doubled(stem):
        return stem if stem[-1] in "lsz" else stem[:-1]
    if _measure(stem) == 1 and _ends_short(stem):
        return stem + "e"
    return stem


def _final_y(word: str) -> str:
    if word.endswith("y") and len(word) > 2 and _shape(word[:-1])[-1] == "c":
        return word[:-1] + "i"
    return word


def _derivational(word: str) -> str:
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        return _derivational(word[:-2])
    for suffix, new in DERIVATIONAL:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            measured = word[:-3] if suffix == "logi" else stem
            return stem + new if _measure(measured) > 0 else word
    return word


def _adjectival(word: str) -> str:
    for suffix, new in ADJECTIVAL:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            return stem + new if _measure(stem) > 0 else word
    return word


def _residual(word: str) -> str:
    for suffix in RESIDUAL:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            drop = _measure(stem) > 1 and (suffix != "ion" or stem[-1:] in ("s", "t"))
            return stem if drop else word
    return word


def _final_e(word: str) -> str:
    if word.endswith("e"):
        stem = word[:-1]
        measure = _measure(stem)
        if measure > 1 or (measure == 1 and not _ends_short(stem)):
            return stem
    return word


def _final_l(word: str) -> str:
    return word[:-1] if word.endswith("ll") and _measure(word[:-1]) > 1 else word


def porter_stem(word: str) -> str:
    word = word.lower()
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    for step in (_plural, _past, _final_y, _derivational, _adjectival, _residual, _final_e,
                 _final_l):
        word = step(word)
    return word


def _known_stems() -> dict[str, str]:
    """Stems this Python worker has made, kept over its tasks and emptied when full.

    The functions are unpickled for every task, so their own globals don't last.
    """
    home = sys.modules.setdefault("_scoreloom_stems", ModuleType("_scoreloom_stems")).__dict__
    known = home.setdefault("known", {})
    if len(known) > MOST_KNOWN:
        known.clear()
    return known


def _stem_values(words: pa.Array) -> pa.Array:
    """Stem each distinct word of a batch, unless the worker knows it, and look the others up."""
    known = _known_stems()

    def stem(word: str | None) -> str | None:
        if word not in known:
            known[word] = porter_stem(word)
        return known[word]

    coded = words.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    stems = pa.array([stem(word) for word in coded.dictionary.to_pylist()], pa.string())
    return stems.take(coded.indices)


@F.arrow_udf(StringType())
def stem_words(words: pa.Array) -> pa.Array:
    """Stem of each word of a string column."""
    return _stem_values(words)


@F.arrow_udf(ArrayType(StringType()))
def stem_tokens(tokens: pa.Array) -> pa.Array:
    """Stem of each word of a token-array column; the text is not shuffled."""
    stems = _stem_values(tokens.flatten())
    lengths = tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    return pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), stems, mask=tokens.is_null() if tokens.null_count else None
    )
