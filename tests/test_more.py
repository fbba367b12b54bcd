"""Golden rows of the smaller operators."""

import pytest
from pyspark.sql import functions as F

from grainloom.operators import messages as M
from grainloom.plans import reports
from grainloom.sources import crawl


def test_fields(spark):
    df = spark.createDataFrame([("", "b", "Level 5", "Number Theory"), (None, "b", "Level 3", "Precalculus"), ("a", "b", "4", "Precalculus")], "x string, y string, level string, subject string")
    got = df.select(M.first_filled(F.col("x"), F.col("y")).alias("f"), M.level_number(F.col("level")).alias("n"), M.subject_key(F.col("subject")).alias("s"), M.hard_problem(F.col("level"), F.col("subject")).alias("h")).collect()
    assert [tuple(r) for r in got] == [("b", "5", "number_theory", True), ("b", "3", "precalculus", False), ("a", "4", "precalculus", False)]


def test_labels_are_checked(spark):
    labels = lambda v: spark.createDataFrame([(v,)], "l array<int>").select(M.trainable_tokens(F.col("l")).alias("n"), M.checked_labels(F.col("l")).alias("l"))
    assert labels([-100, 3, 4]).first().n == 2
    with pytest.raises(Exception, match="no trainable token"):
        labels([-100]).collect()


def test_reports(spark, tmp_path):
    assert [r.bar for r in reports.with_bars(spark.createDataFrame([(7.9,), (0.0,)], "percent double")).collect()] == ["███", ""]
    rows = spark.range(30).select("id", F.when(F.col("id") % 2 == 0, "bad").alias("parse_error"))
    assert [r.id for r in reports.first_errors(rows, "id").collect()] == list(range(0, 20, 2)) and reports.error_count(rows).first().n_errors == 15
    assert reports.flagged_path("/x/out.jsonl") == "/x/out.flagged.jsonl" and reports.preview(rows)[1][0].id == 0


def test_crawl_parts(spark):
    searches = spark.createDataFrame([(2020, "http://f/", "".join(f'<a href="/community/c{k}">t</a><a href="/x">n</a>' for k in range(12))), (2021, "http://f/", '<a href="/community/c99">t</a>')], "year int, url string, page string")
    links = [r.link for r in crawl.forum_threads(searches).collect()]
    assert len(links) == 11 and links[0] == "http://f/community/c0" and links[-1] == "http://f/community/c99" and crawl.forum_threads(searches, max_threads=3).count() == 3
    listing = spark.createDataFrame([("r", '{"tree": [{"path": "a/b.tex"}, {"path": "c.pdf"}]}'), ("s", "not json"), ("t", "{}")], "repository string, body string")
    assert [tuple(r) for r in crawl.tree_files(listing).collect()] == [("r", "a/b.tex", "a_b.tex")]
    urls = spark.createDataFrame([("http://x/a/n.tex",), ("http://x/m.tex",)], "url string")
    assert [r.url for r in crawl.not_on_disk(urls, spark.createDataFrame([("n.tex",)], "file_name string")).collect()] == ["http://x/m.tex"]
    contests = spark.createDataFrame([("imo",), ("amc",)], "contest string")
    assert crawl.restrict_contests(contests, ["imo"]).count() == 1 and crawl.restrict_contests(contests, ["imo"], all_contests=True).count() == 2 and crawl.restrict_contests(contests, ["imo"], names=["amc", "zzz"], all_contests=True).count() == 1
    gates = spark.createDataFrame([(b"\\documentclass" + b"x" * 300,), (b"x" * 400,), (b"%",)], "c binary").select(crawl.looks_like_tex(F.col("c")).alias("t"), crawl.large_enough(F.col("c")).alias("l")).collect()
    assert [tuple(g) for g in gates] == [(True, True), (False, True), (False, False)]
    assert [r.x for r in spark.createDataFrame([("ok",), (crawl.NO_TEXT,)], "p string").select(crawl.has_text(F.col("p")).alias("x")).collect()] == [True, False]
