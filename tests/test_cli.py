"""Every command line job, run in the test session."""

import json
import os

import pytest

from termtide import __main__ as cli


@pytest.fixture
def reviews_csv(tmp_path):
    path = str(tmp_path / "reviews.csv")
    with open(path, "w") as out:
        out.write('review,sentiment\n"good, good film",Pos\nbad film,neg\n,neg\n')
    return path


def run(*argv):
    cli.main([str(a) for a in argv])


def test_batch_jobs(spark, reviews_csv, tmp_path, capfd):
    run("load", reviews_csv)
    run("words", reviews_csv, "--top", 2)
    run("words", reviews_csv, "--lines", "--first-field", "--out", tmp_path / "counts")
    run("labels", reviews_csv)
    run("sweep", reviews_csv, tmp_path / "results", "--sizes", 2)
    result = next(f for f in os.listdir(tmp_path / "results") if f.endswith(".csv"))
    run("series", tmp_path / "results" / result)
    shown = capfd.readouterr().out
    assert "review: string" in shown and "|film|2    |" in shown
    assert "|neg      |2    |66.7   |" in shown
    assert spark.read.parquet(str(tmp_path / "counts")).where("word = 'film'").first()["count"] == 1


def test_stream_jobs(spark, reviews_csv, tmp_path):
    inbox = tmp_path / "inbox"
    run("send", reviews_csv, "--out", inbox)
    sent = [json.loads(r.value) for r in spark.read.text(str(inbox)).collect()]
    assert sorted(m["sentiment"] for m in sent) == ["Pos", "neg"]
    assert all(m["created_at"] for m in sent)
    for kind in ("analysis", "broker-words", "labels", "total", "running"):
        run("watch", kind, "--files", inbox, "--checkpoint", tmp_path / kind, "--bounded")
        assert (tmp_path / kind).is_dir() and not spark.streams.active


def test_stream_ends_after_silence(spark, reviews_csv, tmp_path):
    inbox = tmp_path / "inbox"
    run("send", reviews_csv, "--out", inbox)
    options = ("--files", inbox, "--checkpoint", tmp_path / "idle", "--normalize", "--idle", 5)
    run("watch", "labels", *options)
    assert (tmp_path / "idle" / "commits" / "0").exists() and not spark.streams.active
