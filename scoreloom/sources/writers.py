"""Writers for evaluation, token-score and experiment results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.sources import schemas


def evaluation_rows(evaluation: DataFrame) -> DataFrame:
    """The eight evaluation columns by system, queries in number order, the mean last."""
    is_mean = (F.col("query_number") == "mean").cast("int")
    return evaluation.select(*schemas.EVALUATION.fieldNames()).orderBy(
        "system_number", is_mean, F.expr("try_cast(query_number AS BIGINT)"), "query_number"
    )


def write_ir_eval(evaluation: DataFrame, path: str) -> None:
    """CSV with a header.

    Adaptive execution merges the sorted partitions of a table of ordinary size
    into one, so it becomes one file; a very large one becomes several in order.
    """
    evaluation_rows(evaluation).write.mode("overwrite").csv(path, header=True)


def write_ranked_scores(scores: DataFrame, path: str) -> None:
    """``token,score`` lines per label and method, best first, without a header.

    The rows are range-partitioned, so that a large label is written by many
    tasks; the files of a folder, read in name order, keep the ranking.
    """
    order = [F.col("label"), F.col("method"), F.col("score").desc(), F.col("token")]
    (
        scores.select("label", "method", "token", "score")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .partitionBy("label", "method")
        .csv(path)
    )


def append_experiment_result(rows: DataFrame, path: str) -> None:
    """Add result rows to a table; a repeated (system, split) replaces its former row."""
    (
        rows.select(*schemas.EXPERIMENT.fieldNames())
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("system", "split")
        .parquet(path)
    )
