"""One large quoted file is read in splits and gives the records of a reader that is not split."""

from __future__ import annotations

import csv
import io
import random

import pytest

from scoreloom.sources import quoted, readers, schemas

EDGES = [
    'id\tcategory\ttext\n1\tpos\t"a ""quoted""\ttab\nand line"\n2\tneu\tplain\n',
    'id\tcategory\ttext\r\n1\tpos\t"one\r\ntwo"\r\n2\tneu\tplain\r\n',
    'id\tcategory\t"te\nxt"\n1\tpos\t"' + "line\n" * 60 + '"\n2\tneu\t"""\n"""\n',
    'id\tcategory\ttext\n1\tpos\tstray " quote\n\n2\tneu\t""\n3\tneg\t"a""\n""b"\n',
    "id\tcategory\ttext\n1\tpos\tno line end",
    "id\tcategory\ttext\n",
    "",
]


def plain(spark, path):
    """The reader that reads a file in one task."""
    given = spark.read.schema(schemas.TWEETS).option("header", True).option("multiLine", True)
    options = {"sep": "\t", "quote": '"', "escape": '"', "mode": "FAILFAST"}
    return sorted(map(tuple, given.options(**options).csv(path).collect()), key=repr)


@pytest.fixture(params=["40b", "300b", "128m"])
def splits(spark, request):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    yield request.param
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_records_across_splits(spark, tmp_path, splits):
    for i, text in enumerate(EDGES):
        path = tmp_path / f"{i}.tsv"
        path.write_bytes(text.encode())
        got = sorted(map(tuple, readers.read_labelled_tweets(spark, str(path)).collect()), key=repr)
        assert got == plain(spark, str(path)), text
    folder = tmp_path / "many"
    folder.mkdir()
    rng = random.Random(1)
    want = []
    for part in range(3):
        rows = [
            (f"{part}-{i}", rng.choice("abc"), "".join(rng.choice('xy \t"\n.é') for _ in range(rng.randint(1, 60))))
            for i in range(60)
        ]
        out = io.StringIO()
        csv.writer(out, delimiter="\t", lineterminator="\n").writerows([("id", "category", "text"), *rows])
        (folder / f"{part}.tsv").write_bytes(out.getvalue().encode())
        want += rows
    got = readers.read_labelled_tweets(spark, str(folder))
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_one_file_keeps_many_tasks_busy(spark, tmp_path):
    path = tmp_path / "large.tsv"
    path.write_text("id\tcategory\ttext\n" + '1\tpos\t"two\nlines"\n' * 20_000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000b")
    try:
        records = quoted.quoted_records(spark, str(path), "\t")
        assert records.count() == 20_001
        assert records.rdd.getNumPartitions() >= 8
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_where_a_line_ends(spark):
    assert quoted.ends_inside('a\t"b', False, "\t")
    assert not quoted.ends_inside('a\tb"c', False, "\t")
    assert not quoted.ends_inside('x"\ty', True, "\t")
    assert quoted.ends_inside('x""y', True, "\t")
    assert quoted.ends_inside('x"\t"y', True, "\t")
    assert not quoted.ends_inside("", False, "\t") and quoted.ends_inside("", True, "\t")
