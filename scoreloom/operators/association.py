"""Token/class association: document frequencies, mutual information, chi-squared.

All counts of a token are gathered on one row (its frequency per label and in
total), so the zero-filled table of every label and token comes from exploding
the list of labels, without a cross join of vocabulary and labels or a second
join with the counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.plans.ordering import MAX_GROUP_ROWS, largest_group, place_in_group
from scoreloom.plans.unfolding import unfold

# Fixed value: keeps degenerate margins from dividing by zero.
EPSILON = 1e-10


def doc_token_sets(docs: DataFrame, tokens: str = "tokens") -> DataFrame:
    """One row per document and distinct token; other columns are kept."""
    kept = [c for c in docs.columns if c != tokens]
    return unfold(docs, F.array_distinct(tokens), "token", *kept)


def class_doc_counts(docs: DataFrame) -> DataFrame:
    """Documents per label, also those left without tokens, and the total of all labels."""
    counts = docs.groupBy("label").agg(F.count(F.lit(1)).alias("n_docs"))
    return counts.withColumn("n_total", counts.agg(F.sum("n_docs")).scalar())


def class_doc_frequency(docs: DataFrame) -> DataFrame:
    """Documents of each label that hold the token (pairs that occur)."""
    pairs = doc_token_sets(docs.select("label", "tokens"))
    return pairs.groupBy("label", "token").agg(F.count(F.lit(1)).alias("n11"))


def _token_rows(docs: DataFrame) -> DataFrame:
    """Per token: total document frequency and a map from label to frequency."""
    return (
        class_doc_frequency(docs)
        .groupBy("token")
        .agg(
            F.sum("n11").alias("df"),
            F.map_from_entries(F.collect_list(F.struct("label", "n11"))).alias("_by_label"),
        )
    )


def complement_doc_frequency(docs: DataFrame) -> DataFrame:
    """Documents of all other labels that hold the token: its total less the label's own."""
    rows = _token_rows(docs).select("token", "df", F.explode("_by_label").alias("label", "n11"))
    return rows.select("label", "token", (F.col("df") - F.col("n11")).alias("n01"))


def contingency_table(docs: DataFrame) -> DataFrame:
    """The four document counts for every label and every token of the joint vocabulary."""
    labels = (
        class_doc_counts(docs).agg(F.collect_list(F.struct("label", "n_docs", "n_total"))).scalar()
    )
    cells = (
        _token_rows(docs)
        .withColumn("_class", F.explode(labels))
        .select(
            F.col("_class.label").alias("label"),
            "token",
            F.coalesce(F.try_element_at("_by_label", F.col("_class.label")), F.lit(0)).alias("n11"),
            "df",
            F.col("_class.n_docs").alias("n_c"),
            F.col("_class.n_total").alias("n"),
        )
    )
    n11, df, n_c, n = (F.col(c) for c in ("n11", "df", "n_c", "n"))
    return cells.select(
        "label",
        "token",
        "n11",
        (n_c - n11).alias("n10"),
        (df - n11).alias("n01"),
        (n - n_c - (df - n11)).alias("n00"),
    )


def _cells() -> tuple[Column, Column, Column, Column]:
    # Doubles: the product of four margins exceeds a 64-bit integer.
    return tuple(F.col(c).cast("double") for c in ("n11", "n10", "n01", "n00"))


def mutual_information() -> Column:
    """Mutual information, in bits, of token and label from the four counts."""
    n11, n10, n01, n00 = _cells()
    total = n11 + n10 + n01 + n00

    def part(cell: Column, row: Column, column: Column) -> Column:
        share = cell / total * F.log2(total * cell / (row * column + EPSILON))
        return F.when(cell > 0, share).otherwise(0.0)

    in_class, out_class = n11 + n10, n01 + n00
    with_token, without_token = n11 + n01, n10 + n00
    return (
        part(n11, in_class, with_token)
        + part(n01, out_class, with_token)
        + part(n10, in_class, without_token)
        + part(n00, out_class, without_token)
    )


def chi_squared() -> Column:
    """Chi-squared of token and label from the four counts."""
    n11, n10, n01, n00 = _cells()
    cross = n11 * n00 - n10 * n01
    margins = (n11 + n01) * (n11 + n10) * (n10 + n00) * (n01 + n00)
    return cross * cross * (n11 + n10 + n01 + n00) / (margins + EPSILON)


def association_scores(docs: DataFrame) -> DataFrame:
    """Contingency counts with both scores for every label and token."""
    return contingency_table(docs).withColumns(
        {"mi": mutual_information(), "chi2": chi_squared()}
    )


def method_scores(scores: DataFrame) -> DataFrame:
    """Scores as rows of (label, method, token, score)."""
    return scores.select("label", "token", "mi", "chi2").unpivot(
        ["label", "token"], ["mi", "chi2"], "method", "score"
    )


def rank_tokens(scores: DataFrame, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Place of each token by score within its label and method; equal scores by token."""
    return place_in_group(
        method_scores(scores), ["label", "method"], [F.desc("score"), F.asc("token")],
        place="place", max_group_rows=max_group_rows,
    )


def top_tokens(scores: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best tokens per label and method; each task sends at most ``k`` per list."""
    best = Window.partitionBy("label", "method").orderBy(F.desc("score"), F.asc("token"))
    return (
        method_scores(scores)
        .withColumn("place", F.row_number().over(best))
        .filter(F.col("place") <= k)
    )


def method_rank_comparison(
    scores: DataFrame, k: int = 10, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Places of each token under both methods, their difference, and top-``k`` membership."""
    pairs = scores.select("label", "token", "mi", "chi2")
    largest = largest_group(scores, ["label"])
    for method in ("mi", "chi2"):
        pairs = place_in_group(
            pairs, ["label"], [F.desc(method), F.asc("token")],
            place=f"{method}_place", max_group_rows=max_group_rows, largest=largest,
        )
    return pairs.select(
        "label",
        "token",
        "mi_place",
        "chi2_place",
        (F.col("mi_place") - F.col("chi2_place")).alias("place_change"),
        ((F.col("mi_place") <= k) & (F.col("chi2_place") <= k)).alias("in_both_tops"),
    )
