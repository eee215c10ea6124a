"""The stemmer's SQL twin: its rule tables written out as steps over a table of words."""

from __future__ import annotations

from scoreloom.functions import stemming


def _shape(word: str) -> str:
    """c's and v's of a word; the v put in front makes a first y a consonant and is cut off."""
    letters = f"regexp_replace(regexp_replace({word}, '[^aeiouy]', 'c', 'g'), '[aeiou]', 'v', 'g')"
    return f"""substr(list_reduce(['v'] || string_split({letters}, ''), lambda seen, x: seen ||
        CASE WHEN x <> 'y' THEN x WHEN right(seen, 1) = 'c' THEN 'v' ELSE 'c' END), 2)"""


def _cut(letters: int | str, of: str = "w") -> str:
    return f"left({of}, greatest(length({of}) - {letters}, 0))"


def _ends(*suffixes: str, word: str = "w") -> str:
    return "(" + " OR ".join(f"ends_with({word}, '{s}')" for s in suffixes) + ")"


def _measure(shape: str) -> str:
    """Times a vowel is followed by a consonant."""
    return f"((length({shape}) - length(replace({shape}, 'vc', ''))) // 2)"


def _short(word: str, shape: str) -> str:
    return (
        f"({shape} = 'vc' OR (ends_with({shape}, 'cvc') AND right({word}, 1) NOT IN ('w', 'x', 'y')))"
    )


def _cases(*cases: tuple[str, str]) -> str:
    """The first case that holds; the word as it is if none does."""
    return "CASE " + " ".join(f"WHEN {test} THEN {value}" for test, value in cases) + " ELSE w END"


def _if(test: str, value: str) -> str:
    return f"CASE WHEN {test} THEN {value} ELSE w END"


def _replacing(rules) -> str:
    """The first suffix that fits is replaced if what stands before it has a measure above 0."""
    return _cases(*[
        (
            _ends(suffix),
            # The l of -logi belongs to what is measured.
            _if(
                f"{_measure(_cut(3 if suffix == 'logi' else len(suffix), 's'))} > 0",
                f"{_cut(len(suffix))} || '{new}'",
            ),
        )
        for suffix, new in rules
    ])


def _residual() -> str:
    def drop(suffix: str) -> str:
        left = f" AND right({_cut(len(suffix))}, 1) IN ('s', 't')" if suffix == "ion" else ""
        return _if(f"{_measure(_cut(len(suffix), 's'))} > 1{left}", _cut(len(suffix)))

    return _cases(*[(_ends(suffix), drop(suffix)) for suffix in stemming.RESIDUAL])


_I_FOR_Y = f"CASE WHEN length(w) = 4 THEN {_cut(1)} ELSE {_cut(2)} END"

# Letters of -ed or -ing after a stem with a vowel; 0 for all other words.
_SUFFIX = f"""CASE WHEN {_ends('ied', 'eed')} THEN 0
    WHEN {_ends('ed')} AND contains({_cut(2, 's')}, 'v') THEN 2
    WHEN {_ends('ing')} AND contains({_cut(3, 's')}, 'v') THEN 3 ELSE 0 END"""

_MENDED = _cases(
    ("cut = 0", "w"),
    (_ends("at", "bl", "iz"), "w || 'e'"),
    (
        "length(w) > 1 AND right(w, 1) = left(right(w, 2), 1) AND right(s, 1) = 'c'",
        _if("right(w, 1) NOT IN ('l', 's', 'z')", _cut(1)),
    ),
    (f"{_measure('s')} = 1 AND {_short('w', 's')}", "w || 'e'"),
)

_E_MEASURE = _measure(_cut(1, "s"))

# Each step makes the word w of the next one; s is its shape.
_STEPS = (
    ("plural", _cases(
        (_ends("ies"), _I_FOR_Y),
        (_ends("sses"), _cut(2)),
        (f"{_ends('s')} AND NOT {_ends('ss')}", _cut(1)),
    )),
    ("past", _cases(
        (_ends("ied"), _I_FOR_Y),
        (_ends("eed"), _if(f"{_measure(_cut(3, 's'))} > 0", _cut(1))),
    )),
    ("mended", _MENDED),
    ("final_y", _if(
        f"{_ends('y')} AND length(w) > 2 AND right({_cut(1, 's')}, 1) = 'c'", f"{_cut(1)} || 'i'"
    )),
    ("alli", _if(f"{_ends('alli')} AND {_measure(_cut(4, 's'))} > 0", _cut(2))),
    ("derivational", _replacing(stemming.DERIVATIONAL)),
    ("adjectival", _replacing(stemming.ADJECTIVAL)),
    ("residual", _residual()),
    ("final_e", _if(
        f"{_ends('e')} AND ({_E_MEASURE} > 1 OR ({_E_MEASURE} = 1 AND NOT {_short(_cut(1), _cut(1, 's'))}))",
        _cut(1),
    )),
    ("final_l", _if(f"{_ends('ll')} AND {_measure(_cut(1, 's'))} > 1", _cut(1))),
)


def stems_cte(words: str) -> str:
    """CTEs that end in ``stems (token, stem)`` for the lower-case ``token`` column of ``words``."""
    ctes = [f"shaped AS (SELECT token, token AS w, {_shape('token')} AS s FROM {words})"]
    before = "shaped"
    for name, step in _STEPS:
        if name == "mended":
            ctes.append(
                f"suffixed AS (SELECT token, w AS whole, s AS shape, {_SUFFIX} AS cut FROM {before}),"
                f" cut_off AS (SELECT token, cut, {_cut('cut', 'whole')} AS w,"
                f" {_cut('cut', 'shape')} AS s FROM suffixed)"
            )
            before = "cut_off"
        ctes.append(
            f"{name} AS (SELECT token, v AS w, {_shape('v')} AS s"
            f" FROM (SELECT token, {step} AS v FROM {before}))"
        )
        before = name
    irregular = " ".join(f"WHEN '{w}' THEN '{stem}'" for w, stem in stemming.IRREGULAR.items())
    ctes.append(
        f"stems AS (SELECT token, CASE token {irregular} ELSE"
        f" CASE WHEN length(token) <= 2 THEN token ELSE w END END AS stem FROM {before})"
    )
    return ",\n".join(ctes)
