"""Checks of result files; each gives rows of (rule, key, detail), none if the file is right."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.functions.text import strip_ends
from scoreloom.sources.schemas import EVALUATION, EXPERIMENT, METRICS, SCORE_COLUMNS

# What a score may look like: a decimal number, an infinity or not-a-number.
_DIGITS = r"\d+(?:_\d+)*"
NUMBER = (
    rf"(?i)\A[+-]?(?:nan|inf|infinity|(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})"
    rf"(?:e[+-]?{_DIGITS})?)\z"
)


@dataclass(frozen=True)
class Contract:
    """Columns in order, allowed values of the key columns, and the score columns."""

    columns: Sequence[str]
    domains: Mapping[str, Sequence[str]]
    scores: Sequence[str] = field(default=())

    @property
    def header(self) -> str:
        return ",".join(self.columns)


# The two result files.
EVALUATION_CONTRACT = Contract(
    EVALUATION.fieldNames(),
    {
        "system_number": [str(n) for n in range(1, 7)],
        "query_number": [*[str(n) for n in range(1, 11)], "mean"],
    },
    METRICS,
)
EXPERIMENT_CONTRACT = Contract(
    EXPERIMENT.fieldNames(),
    {"system": ["baseline", "improved"], "split": ["train", "dev", "test"]},
    SCORE_COLUMNS,
)


def parse_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Fields of the data lines of a file: ``line``, ``fields`` and ``width``."""
    stripped = lines.select(strip_ends(F.col(line)).alias("line"))
    fields = F.split("line", ",")
    return stripped.withColumn("fields", fields).withColumn("width", F.size("fields"))


def _violation(df: DataFrame, rule: str, key, detail) -> DataFrame:
    return df.select(
        F.lit(rule).alias("rule"), key.alias("key"), detail.cast("string").alias("detail")
    )


def _key(contract: Contract) -> Column:
    return F.concat_ws(",", *[F.col(f"`{c}`") for c in contract.domains])


def _right_width(contract: Contract) -> Column:
    return F.col("width") == len(contract.columns)


def _field(contract: Contract, column: str) -> Column:
    return F.get("fields", list(contract.columns).index(column))


def _entry(rule: str, key: Column, detail: Column) -> Column:
    return F.struct(
        F.lit(rule).alias("rule"), key.alias("key"), detail.cast("string").alias("detail")
    )


def _line_entries(contract: Contract, rule: str) -> list[Column]:
    """What can be wrong with a line on its own; NULL where it is right."""
    if rule == "column_count":
        return [F.when(~_right_width(contract), _entry(rule, F.col("line"), F.col("width")))]
    key = F.concat_ws(",", *[_field(contract, c) for c in contract.domains])

    def wrong(column: str, test: Column) -> Column:
        detail = F.concat(F.lit(f"{column}="), _field(contract, column))
        return F.when(_right_width(contract) & test, _entry(rule, key, detail))

    if rule == "domain":
        return [
            wrong(column, ~_field(contract, column).isin(list(allowed)))
            for column, allowed in contract.domains.items()
        ]
    return [
        wrong(column, ~strip_ends(_field(contract, column)).rlike(NUMBER))
        for column in contract.scores
    ]


def _line_violations(parsed: DataFrame, contract: Contract, *rules: str) -> DataFrame:
    """Violations of line rules, all found in one pass over the lines."""
    entries = [entry for rule in rules for entry in _line_entries(contract, rule)]
    found = parsed.select(F.explode_outer(F.array_compact(F.array(*entries))).alias("_found"))
    return found.filter(F.col("_found").isNotNull()).select("_found.*")


def _key_counts(parsed: DataFrame, contract: Contract) -> DataFrame:
    keys = [_field(contract, c).alias(c) for c in contract.domains]
    return parsed.filter(_right_width(contract)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def check_header(headers: DataFrame, contract: Contract, line: str = "value") -> DataFrame:
    """Header lines that differ from the column names in their order; an empty key if none is there."""
    wrong = headers.filter(strip_ends(F.col(line)) != contract.header)
    none = headers.agg(F.count(F.lit(1)).alias("_n")).filter("_n = 0")
    return _violation(wrong, "header", F.col(line), F.lit(contract.header)).unionByName(
        _violation(none, "header", F.lit(""), F.lit(contract.header))
    )


def check_column_count(parsed: DataFrame, contract: Contract) -> DataFrame:
    """Lines of another width than the contract, blank ones included."""
    return _line_violations(parsed, contract, "column_count")


def check_domain(parsed: DataFrame, contract: Contract) -> DataFrame:
    """Key fields of a line outside the allowed values."""
    return _line_violations(parsed, contract, "domain")


def check_numeric(parsed: DataFrame, contract: Contract) -> DataFrame:
    """Scores that do not read as a number; every score column is checked."""
    return _line_violations(parsed, contract, "numeric")


def check_unique_key(parsed: DataFrame, contract: Contract) -> DataFrame:
    """Keys that occur more than once, with the number of lines."""
    repeated = _key_counts(parsed, contract).filter("_n > 1")
    return _violation(repeated, "unique_key", _key(contract), F.col("_n"))


def check_complete(parsed: DataFrame, contract: Contract) -> DataFrame:
    """Keys of the contract that no line has."""
    wanted = parsed.sparkSession.range(1).select()
    for column, allowed in contract.domains.items():
        values = F.array(*[F.lit(v) for v in allowed])
        wanted = wanted.select("*", F.explode(values).alias(column))
    # Keeping the count makes this the same aggregate as for repeated keys.
    found = _key_counts(parsed, contract).filter("_n > 0")
    missing = wanted.join(found, list(contract.domains), "left_anti")
    return _violation(missing, "complete", _key(contract), F.lit("missing"))


def check_all(headers: DataFrame, lines: DataFrame, contract: Contract) -> DataFrame:
    """All violations of a file given as header and data lines.

    The line rules share one pass, and the key rules one count of the keys.
    """
    parsed = parse_lines(lines)
    found = (
        check_header(headers, contract),
        _line_violations(parsed, contract, "column_count", "domain", "numeric"),
        check_unique_key(parsed, contract),
        check_complete(parsed, contract),
    )
    return reduce(DataFrame.unionByName, found)


def check_file(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """All violations of the file at ``path``: its first line is the header, an empty file has none.

    ``path`` is one file; it may be of any size and is read in parts.
    """
    rows = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"),
    )
    header = (
        rows.filter("_start = 0")
        .agg(F.min(F.struct("_at", "value")).alias("_first"))
        .filter("_first IS NOT NULL")
        .select("_first.*")
    )
    # The header is one row.
    lines = rows.join(F.broadcast(header.select("_at")), "_at", "left_anti")
    return check_all(header.select("value"), lines.select("value"), contract)


def contract_verdict(violations: DataFrame) -> DataFrame:
    """Number of violations; the file is valid if there is none."""
    return violations.agg(F.count(F.lit(1)).alias("violations")).withColumn(
        "valid", F.col("violations") == 0
    )
