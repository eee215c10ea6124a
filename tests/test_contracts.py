"""Result-file checks: each defect gives its violation."""

from __future__ import annotations

import pytest

from scoreloom.operators import contracts as ops

KEYS = {
    "evaluation": [(s, q) for s in range(1, 7) for q in [*range(1, 11), "mean"]],
    "experiment": [(s, p) for s in ("baseline", "improved") for p in ("train", "dev", "test")],
}
CONTRACTS = {"evaluation": ops.EVALUATION_CONTRACT, "experiment": ops.EXPERIMENT_CONTRACT}
SCORES = {"evaluation": 6, "experiment": 12}


def good_lines(kind):
    return [f"{a},{b}" + ",0.5" * SCORES[kind] for a, b in KEYS[kind]]


def violations(spark, kind, lines, header=None):
    contract = CONTRACTS[kind]
    headers = spark.createDataFrame([(header or contract.header,)], "value STRING")
    data = spark.createDataFrame([(line,) for line in lines], "value STRING")
    found = ops.check_all(headers, data, contract)
    verdict = ops.contract_verdict(found).first()
    rows = sorted((r["rule"], r["key"], r["detail"]) for r in found.collect())
    assert verdict["valid"] is (not rows) and verdict["violations"] == len(rows)
    return rows


@pytest.mark.parametrize("kind", list(KEYS))
def test_valid_file(spark, kind):
    assert violations(spark, kind, good_lines(kind)) == []


def test_header(spark):
    rows = violations(spark, "evaluation", good_lines("evaluation"), "system_number,query")
    assert [r[0] for r in rows] == ["header"]


def test_blank_and_short_lines(spark):
    rows = violations(spark, "evaluation", [*good_lines("evaluation"), "", "1,1,0.5"])
    assert rows == [("column_count", "", "1"), ("column_count", "1,1,0.5", "3")]


def test_repeated_unknown_and_missing_keys(spark):
    lines = good_lines("evaluation")[1:]
    lines += [lines[-1], "7,mean" + ",1" * 6, "1,eleven" + ",1" * 6]
    rows = violations(spark, "evaluation", lines)
    assert rows == [
        ("complete", "1,1", "missing"),
        ("domain", "1,eleven", "query_number=eleven"),
        ("domain", "7,mean", "system_number=7"),
        ("unique_key", "6,mean", "2"),
    ]


def test_every_score_is_checked(spark):
    lines = good_lines("experiment")
    fields = lines[0].split(",")
    for i in range(2, 14):
        broken = ",".join([*fields[:i], "n/a", *fields[i + 1:]])
        rows = violations(spark, "experiment", [broken, *lines[1:]])
        column = CONTRACTS["experiment"].columns[i]
        assert rows == [("numeric", "baseline,train", f"{column}=n/a")]


def test_numbers_as_python_reads_them(spark):
    lines = good_lines("evaluation")
    lines[0] = "1,1,1e-3, .5 ,-5.,+inf,NaN,1_000"
    assert violations(spark, "evaluation", lines) == []
    lines[0] = "1,1,1d,0x1,,1e,in,_1"
    assert len(violations(spark, "evaluation", lines)) == 6


def test_file_by_path(spark, tmp_path):
    contract = ops.EVALUATION_CONTRACT
    path = tmp_path / "ir_eval.csv"

    def found(content):
        path.write_text(content)
        rows = ops.check_file(spark, str(path), contract).collect()
        return sorted((r["rule"], r["key"], r["detail"]) for r in rows)

    lines = good_lines("evaluation")
    assert found("\n".join([contract.header, *lines]) + "\n") == []
    # Read in parts, the header is still the first line of the file.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        assert found("\n".join([contract.header, *lines])) == []
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found("\n".join(lines)) == [
        ("complete", lines[0].split(",0.5")[0], "missing"), ("header", lines[0], contract.header)
    ]
    assert [r for r in found("") if r[0] == "header"] == [("header", "", contract.header)]
    assert found("\n".join([contract.header, *lines, "", "x"]))[-1][0] == "column_count"
