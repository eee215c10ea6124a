"""Rank metrics per system and query, and their means.

The judgements are indexed once with everything a hit needs to know of its
query (number of judged documents, ideal gains).  A ranked row then takes one
join, one window and one aggregate for all six metrics; a query without a hit
scores zero everywhere and needs no look-up of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.functions.numeric import discount_sum, harmonic, ratio
from scoreloom.plans.ordering import MAX_GROUP_ROWS, largest_group, place_in_group
from scoreloom.plans.sizing import BROADCAST_ROWS, at_most
from scoreloom.sources.schemas import METRICS

# Cut-offs of the reported metrics.
PRECISION_K = 10
RECALL_K = 50
NDCG_KS = (10, 20)

RUN_KEY = ["system_number", "query_number"]


def index_qrels(qrels: DataFrame, line_no: str | None = None) -> DataFrame:
    """One row per judged (query, document).

    With ``line_no`` the grade of the last line wins; files read without line
    numbers have no last line, and the highest grade is taken.  A document with
    grade 0 is still judged.
    """
    grade = F.max_by("relevance", line_no) if line_no else F.max("relevance")
    return qrels.groupBy("query_id", "doc_id").agg(grade.alias("relevance"))


def idcg_at_k(index: DataFrame, ks: tuple[int, ...] = NDCG_KS) -> DataFrame:
    """Judged documents and ideal gain per query, as ``n_rel`` and ``idcg_<k>``.

    Works on the number of documents per grade, so a query with any number of
    judgements is as many rows as there are grades.
    """
    grades = index.groupBy("query_id", "relevance").agg(F.count(F.lit(1)).alias("docs"))
    best_first = (
        Window.partitionBy("query_id")
        .orderBy(F.desc("relevance"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ideal = [
        F.sum(
            F.col("relevance") * discount_sum(F.col("_first"), F.least(F.col("_last"), F.lit(k)))
        ).alias(f"idcg_{k}")
        for k in ks
    ]
    return (
        grades.withColumn("_last", F.sum("docs").over(best_first))
        .withColumn("_first", F.col("_last") - F.col("docs") + 1)
        .groupBy("query_id")
        .agg(F.sum("docs").alias("n_rel"), *ideal)
    )


def judged_index(qrels: DataFrame, line_no: str | None = None) -> DataFrame:
    """Judged documents with the count and ideal gains of their query."""
    index = index_qrels(qrels, line_no)
    return index.join(idcg_at_k(index), "query_id")


def top_k_retrieved(runs: DataFrame, k: int) -> DataFrame:
    """First ``k`` rows of each ranked list.

    The limit reaches below the shuffle: every task sends at most ``k`` rows of
    a list, so lists of any length are cheap.
    """
    in_list = Window.partitionBy(*RUN_KEY).orderBy("rank_of_doc", "doc_number")
    return (
        runs.select(*RUN_KEY, "doc_number", "rank_of_doc")
        .withColumn("pos", F.row_number().over(in_list))
        .filter(F.col("pos") <= k)
    )


def judged_results(
    runs: DataFrame, qrels: DataFrame, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Ranked rows with position, copies, hits up to and including the row, and judgement.

    With few enough judgements to broadcast and no oversized list, the bare runs
    are partitioned by list before the join: this is the only shuffle of the runs,
    it moves four columns, and the window and the metrics reuse it.
    """
    index = judged_index(qrels)
    lists = runs.select(*RUN_KEY, "doc_number", "rank_of_doc")
    largest = largest_group(lists, RUN_KEY)
    if at_most(qrels, BROADCAST_ROWS):
        index = F.broadcast(index)
        if largest <= max_group_rows:
            lists = lists.repartition(*RUN_KEY)
    judged = lists.join(
        index.withColumnsRenamed({"query_id": "query_number", "doc_id": "doc_number"}),
        ["query_number", "doc_number"],
        "left",
    ).withColumn("hit", F.when(F.col("n_rel").isNotNull(), 1).otherwise(0))
    return place_in_group(
        judged, RUN_KEY, [F.asc("rank_of_doc"), F.asc("doc_number")],
        running={"hits": "hit"}, collapse=True, max_group_rows=max_group_rows, largest=largest,
    )


def _copies_upto(k: Column) -> Column:
    return F.greatest(F.lit(0), F.least(F.col("copies"), k - F.col("pos") + 1))


def hits_at(k: Column | int) -> Column:
    """Aggregate: hits among the first ``k`` of a list."""
    k = F.lit(k) if isinstance(k, int) else k
    return F.coalesce(F.sum(F.when(F.col("hit") == 1, _copies_upto(k))), F.lit(0))


def precision_at_k(k: int = PRECISION_K) -> Column:
    """Aggregate: hits in the first ``k``, over ``k`` even if the list is shorter."""
    return hits_at(k) / F.lit(float(k))


def recall_at_k(k: int = RECALL_K) -> Column:
    """Aggregate: hits in the first ``k``, over the judged documents of the query."""
    return ratio(hits_at(k), F.max("n_rel"))


def r_precision() -> Column:
    """Aggregate: precision at the number of judged documents."""
    return ratio(hits_at(F.col("n_rel")), F.max("n_rel"))


def average_precision() -> Column:
    """Aggregate: precision at each hit of the whole list, over the judged documents.

    ``m`` copies from position p after c hits add the sum of (c + i) / (p + i - 1)
    for i = 1..m, which is m + (c + 1 - p) (H(p + m - 1) - H(p - 1)).
    """
    copies, pos = F.col("copies"), F.col("pos")
    before = F.col("hits") - copies
    many = copies + (before + 1 - pos) * (harmonic(pos + copies - 1) - harmonic(pos - 1))
    at_hit = F.when(copies == 1, F.col("hits") / pos).otherwise(many)
    return ratio(F.sum(F.when(F.col("hit") == 1, at_hit)), F.max("n_rel"))


def dcg_at_k(k: int) -> Column:
    """Aggregate: graded gain of the first ``k``, discounted by log2(position + 1)."""
    copies, pos = F.col("copies"), F.col("pos")
    discount = F.when(copies == 1, 1 / F.log2(pos + F.lit(1.0))).otherwise(
        discount_sum(pos, F.least(pos + copies - 1, F.lit(k)))
    )
    gain = F.when((F.col("hit") == 1) & (pos <= k), F.col("relevance") * discount)
    return F.coalesce(F.sum(gain), F.lit(0.0))


def ndcg_at_k(k: int) -> Column:
    """Aggregate: gain over the ideal gain; 0 if the ideal gain is not positive."""
    ideal = F.max(f"idcg_{k}")
    return F.when(ideal > 0, ratio(dcg_at_k(k), ideal)).otherwise(F.lit(0.0))


def score_lists(judged: DataFrame, **metrics: Column) -> DataFrame:
    """Chosen metrics per system and query from the rows of :func:`judged_results`."""
    return judged.groupBy(*RUN_KEY).agg(*[m.alias(name) for name, m in metrics.items()])


def evaluate_per_query(
    runs: DataFrame, qrels: DataFrame, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """All six metrics, unrounded, for each (system, query) with results."""
    judged = judged_results(runs, qrels, max_group_rows)
    return score_lists(
        judged,
        **{
            "P@10": precision_at_k(PRECISION_K),
            "R@50": recall_at_k(RECALL_K),
            "r-precision": r_precision(),
            "AP": average_precision(),
            "nDCG@10": ndcg_at_k(10),
            "nDCG@20": ndcg_at_k(20),
        },
    )


def system_mean(per_query: DataFrame) -> DataFrame:
    """Per-query rows plus a ``mean`` row per system, from the unrounded values.

    One pass of grouping sets; the per-query values are not computed twice.
    """
    averaged = per_query.groupingSets(
        [["system_number", "query_number"], ["system_number"]], "system_number", "query_number"
    ).agg(
        F.grouping("query_number").alias("_mean"),
        *[F.avg(f"`{metric}`").alias(metric) for metric in METRICS],
    )
    return averaged.select(
        "system_number",
        F.when(F.col("_mean") == 1, F.lit("mean"))
        .otherwise(F.col("query_number").cast("string"))
        .alias("query_number"),
        *METRICS,
    )


def round_scores(evaluation: DataFrame, digits: int = 3) -> DataFrame:
    """Metrics rounded half to even."""
    return evaluation.withColumns({m: F.bround(F.col(m), digits) for m in METRICS})


def evaluate(
    runs: DataFrame, qrels: DataFrame, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """The evaluation file: rounded scores per query and their rounded means."""
    return round_scores(system_mean(evaluate_per_query(runs, qrels, max_group_rows)))
