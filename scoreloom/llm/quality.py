"""Quality rules as weak supervision: rules vote or abstain, EM weighs them.

Every rule looks at a few counts of a text and votes 1 (good), -1 (bad) or
abstains (0).  The true kind of a text is hidden: good, or bad in the way that
one of the rules is there to find; given the kind, rules vote independently.
Expectation-maximisation over all documents estimates how each rule votes on
each kind, and a document is kept by its posterior probability of being good, so
a failed rule that others contradict does not reject it.

The counts are DataFrame expressions in the JVM.  EM needs only how often each
combination of votes occurs, a table of at most 3^rules rows whatever the input.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import bind, stored

SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE_RUN), lambda w: w != "")


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the list.

    The windows are sorted with their places; a window equal to a neighbour is
    repeated.  Then the places are sorted and the words they cover added up.
    """

    def windows(w: Column) -> Column:
        return F.sort_array(
            F.transform(
                F.sequence(F.lit(0), F.size(w) - 3),
                lambda i: F.struct(
                    F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("w"),
                    i.alias("at"),
                ),
            )
        )

    def places(s: Column) -> Column:
        def place(i: Column) -> Column:
            here = F.get(s, i)["w"]
            twin = (F.get(s, i - 1)["w"] == here) | (F.get(s, i + 1)["w"] == here)
            return F.when(twin, F.get(s, i)["at"])

        numbers = F.transform(F.sequence(F.lit(0), F.size(s) - 1), place)
        return F.sort_array(F.filter(numbers, lambda x: x.isNotNull()))

    def covered(p: Column) -> Column:
        return F.aggregate(
            p,
            F.struct(F.lit(-3).alias("last"), F.lit(0).alias("total")),
            lambda a, x: F.struct(
                x.alias("last"), (a["total"] + F.least(F.lit(3), x - a["last"])).alias("total")
            ),
            lambda a: a["total"],
        )

    return F.when(F.size(words) < 3, 0).otherwise(
        bind(windows(words), lambda s: bind(places(s), covered))
    )


def count_columns(text: Column) -> dict[str, Column]:
    """The counts of one text (null: empty), all long."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: _without(x, SPACES) != "")
    counts = {
        "words": bind(
            words_of(text),
            lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("repeated")),
        ),
        "word_chars": F.char_length(_without(text, SPACES)),
        "n_symbols": F.char_length(text) - F.char_length(_without(text, SYMBOLS)),
        "lines": bind(
            lines,
            lambda x: F.struct(
                F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("repeated")
            ),
        ),
    }
    return counts


def with_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words."""
    added = {f"_{k}": v for k, v in count_columns(F.col(f"`{text}`")).items()}
    named = {
        "n_words": F.col("_words.n"),
        "word_chars": F.col("_word_chars"),
        "n_symbols": F.col("_n_symbols"),
        "n_lines": F.col("_lines.n"),
        "n_dup_lines": F.col("_lines.repeated"),
        "n_repeat_words": F.col("_words.repeated"),
    }
    counted = df.withColumns(added)
    return counted.withColumns({k: v.cast("long") for k, v in named.items()}).drop(*added)


def base_failed() -> Column:
    """Too short, or more than half of the words in repeated windows."""
    repeats = F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words")
    return (F.col("n_words") < 50) | repeats


@dataclass(frozen=True)
class Rule:
    """Votes bad beyond ``bad``, good within ``good``, and abstains between and on null."""

    name: str
    good: Callable[[], Column]
    bad: Callable[[], Column]

    def vote(self) -> Column:
        vote = F.when(self.bad(), -1).when(self.good(), 1).otherwise(0)
        return vote.cast("int").alias(self.name)


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.when(F.col(whole) > 0, F.col(whole))


def _within(value: Callable[[], Column], good: tuple, bad: tuple) -> tuple[Callable, Callable]:
    return (
        lambda: value().between(*good),
        lambda: ~value().between(*bad),
    )


RULES: tuple[Rule, ...] = (
    Rule("length", lambda: F.col("n_words") >= 80, lambda: F.col("n_words") < 50),
    Rule("word_length", *_within(lambda: _share("word_chars", "n_words"), (3.0, 10.0), (2.0, 15.0))),
    Rule("symbols", *_within(lambda: _share("n_symbols", "n_words"), (0.0, 0.05), (0.0, 0.2))),
    Rule("lines", *_within(lambda: _share("n_dup_lines", "n_lines"), (0.0, 0.3), (0.0, 0.5))),
    Rule("repeats", *_within(lambda: _share("n_repeat_words", "n_words"), (0.0, 0.4), (0.0, 0.5))),
)


@dataclass(frozen=True)
class VoteModel:
    """What EM found: how common each kind of text is, and how each rule votes on it.

    The first kind is good text; each further one is the kind of bad text that the rule
    of its name is there to find.
    """

    kinds: tuple[str, ...]
    priors: tuple[float, ...]
    chances: dict[str, dict[int, tuple[float, ...]]] = field(default_factory=dict)

    def accuracy(self, rule: str) -> tuple[float, float]:
        """Chance that the rule doesn't vote bad on good text, and votes bad on its own kind."""
        bad = self.chances[rule][-1]
        return 1 - bad[0], bad[self.kinds.index(rule)]

    def posterior(self, column: Callable[[str], Column] = F.col) -> Column:
        """The probability of good text, from the vote columns."""
        weights = []
        for kind, prior in enumerate(self.priors):
            weight = F.lit(math.log(prior))
            for rule, by_vote in self.chances.items():
                own = F.lit(math.log(by_vote[0][kind]))
                for vote in (1, -1):
                    own = F.when(column(rule) == vote, math.log(by_vote[vote][kind])).otherwise(own)
                weight = weight + own
            weights.append(weight)
        good, *bad = weights
        odds = F.lit(1.0)
        for weight in bad:
            odds = odds + F.exp(weight - good)
        return F.lit(1.0) / odds


def fit_votes(
    patterns: Sequence[tuple[tuple[int, ...], int]],
    names: Sequence[str],
    steps: int = 50,
    smoothing: float = 1.0,
    doubt: float = 0.05,
    trust: float = 0.9,
) -> VoteModel:
    """EM over counted vote patterns.

    Bad texts are of as many kinds as there are rules, so that rules for unrelated faults
    need not agree with each other.  It starts from "good unless a rule says bad": a bad
    vote is trusted by ``trust``, shared by the rules that cast one, and a text without bad
    votes is bad with chance ``doubt``.  A rule that others contradict loses weight, one
    that nothing speaks for or against keeps its start.  Counts are smoothed by rules better
    than chance, worth ``smoothing`` texts each, so that an empty table still gives a model.
    """
    total = sum(count for _, count in patterns)
    kinds = ("good", *names)
    belief = {}
    for votes, _ in patterns:
        accusers = votes.count(-1)
        if accusers:
            bad = [trust / accusers if v == -1 else 0.0 for v in votes]
            belief[votes] = [1 - trust, *bad]
        else:
            belief[votes] = [1 - doubt, *(doubt / len(names) for _ in names)]
    # Chance of a vote before any text is seen: on other texts, on texts of the rule's kind.
    assumed = {1: (0.6, 0.1), 0: (0.35, 0.1), -1: (0.05, 0.8)}

    def estimate() -> VoteModel:
        sizes = [sum(belief[v][k] * c for v, c in patterns) for k in range(len(kinds))]
        priors = tuple(
            (n + smoothing * (1 - doubt if k == 0 else doubt / len(names))) / (total + smoothing)
            for k, n in enumerate(sizes)
        )
        chances = {
            name: {
                vote: tuple(
                    (
                        sum(belief[v][k] * c for v, c in patterns if v[at] == vote)
                        + smoothing * start[kinds[k] == name]
                    )
                    / (sizes[k] + smoothing)
                    for k in range(len(kinds))
                )
                for vote, start in assumed.items()
            }
            for at, name in enumerate(names)
        }
        return VoteModel(kinds, priors, chances)

    model = estimate()
    for _ in range(steps if total else 0):
        for votes, _ in patterns:
            logs = [
                math.log(prior)
                + sum(math.log(model.chances[n][v][k]) for n, v in zip(names, votes, strict=True))
                for k, prior in enumerate(model.priors)
            ]
            most = max(logs)
            odds = [math.exp(x - most) for x in logs]
            belief[votes] = [x / sum(odds) for x in odds]
        model = estimate()
    return model


def learn_rules(counted: DataFrame, rules: Sequence[Rule] = RULES) -> VoteModel:
    """Fit the model on every row of ``counted``."""
    names = [r.name for r in rules]
    votes = counted.select(*(r.vote() for r in rules)).groupBy(*names).agg(F.count("*").alias("_n"))
    # At most 3^rules rows.
    rows = [(tuple(r[n] for n in names), r["_n"]) for r in votes.collect()]
    return fit_votes(sorted(rows), names)


def judge(
    counted: DataFrame,
    model: VoteModel,
    rules: Sequence[Rule] = RULES,
    threshold: float = 0.5,
) -> DataFrame:
    """Add base_failed, quality (the posterior) and kept to a table with counts.

    A null or empty text has no words, fails the base rules and is not kept.  Equal texts
    get equal verdicts.  Columns named like the added ones are replaced.
    """
    names = [f"_vote_{r.name}" for r in rules]
    voted = counted.withColumns({f"_vote_{r.name}": r.vote() for r in rules})
    return (
        voted.withColumn("base_failed", base_failed())
        .withColumn("quality", model.posterior(lambda name: F.col(f"_vote_{name}")))
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))
        .drop(*names)
    )


def keep_good(
    documents: DataFrame,
    model: VoteModel | None = None,
    text: str = "text",
    rules: Sequence[Rule] = RULES,
    threshold: float = 0.5,
) -> DataFrame:
    """The documents that are kept, with their columns; without a model it is fitted on them.

    The texts are counted once: rows and counts are written to the shared folder, the model
    is fitted on the counts and the rows are chosen by them.  A filter on counts still to be
    made would be given copies of their expressions, one for every mention.
    """
    names = documents.columns
    row = documents.select(F.struct(*(f"`{c}`" for c in names)).alias("_row"))
    counted = with_counts(row.withColumn("_text", F.col(f"_row.`{text}`")), "_text")
    counted = stored(counted.drop("_text"), "counted")
    model = model or learn_rules(counted, rules)
    kept = judge(counted, model, rules, threshold).filter("kept")
    return kept.select(*(F.col(f"_row.`{c}`").alias(c) for c in names))
