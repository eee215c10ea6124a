"""Readers and writers on files."""

from __future__ import annotations

import pytest

from scoreloom.sources import readers, writers
from scoreloom.sources.schemas import EVALUATION, EXPERIMENT, METRICS


def test_runs_and_qrels(spark, tmp_path):
    (tmp_path / "runs.csv").write_text(
        "system_number,query_number,doc_number,rank_of_doc,score\n1,2,3,4,5.5\n"
    )
    assert tuple(readers.read_runs(spark, str(tmp_path / "runs.csv")).first()) == (1, 2, 3, 4, 5.5)
    (tmp_path / "bad.csv").write_text("query_id,doc_id,relevance\n1,x,2\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_qrels(spark, str(tmp_path / "bad.csv")).collect()


def test_labelled_corpus(spark, tmp_path):
    path = tmp_path / "corpus.tsv"
    path.write_text(" OT\tin the\tbeginning \n\n   \nno tab here\nNT\tword\n", encoding="utf-8")
    loose = readers.read_labelled_corpus(spark, str(path), strict=False)
    assert [tuple(r) for r in loose.collect()] == [("OT", "in the\tbeginning"), ("NT", "word")]
    rejected = readers.rejected_corpus_lines(spark, str(path))
    assert [r["line"] for r in rejected.collect()] == ["no tab here"]
    with pytest.raises(Exception, match="without a tab"):
        readers.read_labelled_corpus(spark, str(path)).collect()


def test_labelled_tweets(spark, tmp_path):
    path = tmp_path / "train.txt"
    path.write_text('x\ty\tz\n1\tpositive\t"a ""quoted""\ttab\nand line"\n2\tneutral\tplain\n')
    rows = [tuple(r) for r in readers.read_labelled_tweets(spark, str(path)).collect()]
    assert rows == [("1", "positive", 'a "quoted"\ttab\nand line'), ("2", "neutral", "plain")]


def test_notebook_tweets(spark, tmp_path):
    path = tmp_path / "tweets"
    path.write_bytes('1\tcaf\xe9 "x\\y\tFood \n\n 2\tz\tPets & Animals\n'.encode("latin-1"))
    rows = [tuple(r) for r in readers.read_tweets_notebook(spark, str(path)).collect()]
    assert rows == [("1", 'café "x\\y', "Food"), ("2", "z", "Pets & Animals")]
    (tmp_path / "bad").write_bytes(b"1\tonly two\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_tweets_notebook(spark, str(tmp_path / "bad")).collect()


def test_evaluation_file(spark, tmp_path):
    rows = [(s, q, *[0.1] * 6) for s in (2, 1) for q in ("10", "mean", "2")]
    writers.write_ir_eval(spark.createDataFrame(rows, EVALUATION), str(tmp_path / "out"))
    files = sorted((tmp_path / "out").glob("part-*.csv"))
    assert len(files) == 1
    lines = files[0].read_text().splitlines()
    assert lines[0] == "system_number,query_number," + ",".join(METRICS)
    assert [line.split(",")[:2] for line in lines[1:]] == [
        ["1", "2"], ["1", "10"], ["1", "mean"], ["2", "2"], ["2", "10"], ["2", "mean"]
    ]


def test_ranked_scores(spark, tmp_path):
    rows = [(label, method, f"t{i:03}", float(i % 50)) for label in ("a", "b")
            for method in ("mi", "chi2") for i in range(200)]
    frame = spark.createDataFrame(rows, "label STRING, method STRING, token STRING, score DOUBLE")
    writers.write_ranked_scores(frame, str(tmp_path / "out"))
    for label in ("a", "b"):
        for method in ("mi", "chi2"):
            folder = tmp_path / "out" / f"label={label}" / f"method={method}"
            lines = [line for f in sorted(folder.glob("part-*")) for line in f.read_text().split()]
            want = sorted(((-float(i % 50), f"t{i:03}") for i in range(200)))
            assert lines == [f"{token},{-score}" for score, token in want]


def test_results_are_replaced_not_doubled(spark, tmp_path):
    path = str(tmp_path / "table")
    first = spark.createDataFrame(
        [("baseline", s, *[0.1] * 12) for s in ("train", "dev")], EXPERIMENT
    )
    writers.append_experiment_result(first, path)
    again = spark.createDataFrame([("baseline", "dev", *[0.2] * 12)], EXPERIMENT)
    writers.append_experiment_result(again, path)
    rows = readers.read_experiment_results(spark, path).collect()
    got = {(r["system"], r["split"]): r["p-pos"] for r in rows}
    assert len(rows) == 2 and got == {("baseline", "train"): 0.1, ("baseline", "dev"): 0.2}


def test_strict_corpus_fails_whatever_is_read(spark, tmp_path):
    from pyspark.errors import PySparkException

    (tmp_path / "corpus.tsv").write_text("en\tone\nno tab here\nfr\tdeux\n")
    strict = readers.read_labelled_corpus(spark, str(tmp_path / "corpus.tsv"))
    for query in (strict.count, strict.groupBy("label").count().collect, strict.collect):
        with pytest.raises(PySparkException):
            query()


@pytest.mark.parametrize("line", ["1\tpositive", "1\tpositive\tgood\tmore"])
def test_tweets_of_another_width_fail(spark, tmp_path, line):
    (tmp_path / "tweets.tsv").write_text(f"id\tcategory\ttext\n{line}\n")
    tweets = readers.read_labelled_tweets(spark, str(tmp_path / "tweets.tsv"))
    with pytest.raises(Exception, match="FAILED_READ_FILE|MALFORMED"):
        tweets.collect()
