"""Stages from files to files, the command line, loading, crawling and generation."""

import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from grainloom import __main__ as cli
from grainloom.operators import extract, messages as M, quality as Q
from grainloom.plans import reports, stages
from grainloom.sources import crawl, jsonl
from grainloom.streaming import incremental

LONG = "We see that the number is odd. " * 30 + "Therefore the answer is \\boxed{7}."


def chat(problem, solution, **more):
    return {"messages": [{"role": "user", "content": problem}, {"role": "assistant", "content": solution}], **more}


def write(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join((r if isinstance(r, str) else json.dumps(r, ensure_ascii=False)) + "\n" for r in rows), encoding="utf-8")
    return str(path)


def read(path):
    return [json.loads(line) for f in sorted(path.glob("part-*")) for line in f.read_text(encoding="utf-8").splitlines()]


@pytest.fixture
def folder(tmp_path):
    d = tmp_path / "in"
    write(d / "a.jsonl", [chat("P1", LONG), chat("P1", "short"), chat("P2", "short"), {"messages": None}, "no json", chat("Problem: P3", "Solution: " + LONG)])
    write(d / "b.jsonl", [chat("p1 ", LONG + " Thus it ends."), chat("P3", "cut...")])
    write(d / "merged_all.jsonl", [chat("P9", LONG)])
    write(d / "raw.jsonl", [chat("P8", LONG)])
    write(d / "sub" / "c.jsonl", [chat("P7", LONG)])
    return d


def test_organize_writes_its_sinks_and_counts(spark, folder, tmp_path):
    out = tmp_path / "out"
    counts = stages.organize(spark, str(folder), str(out), raw_files=["raw.jsonl"], categories=spark.createDataFrame([("a.jsonl", "complete")], "source string, category string"))
    assert counts == {"files": 2, "files_skipped": 2, "examples": 7, "good": 2, "broken_only": 1, "pairs": 2}
    good, broken, pairs = (read(out / n) for n in ("good_solutions", "broken_only", "dpo_pairs"))
    assert len(good) == 2 and len(broken) == 1 and "<|im_start|>user\nProblem:\nP2<|im_end|>" in broken[0]["text"]
    assert {(p["problem"], p["chosen_source"], p["rejected_source"]) for p in pairs} == {("p1", "b.jsonl", "a.jsonl"), ("P3", "a.jsonl", "b.jsonl")} and all(p["chosen"].startswith("We see") for p in pairs)
    report = {r["source_file"]: (r["good_unique"], r["broken_unique"]) for r in spark.read.csv(str(out / "source_report"), header=True).collect()}
    assert report == {"a.jsonl": ("1", "2"), "b.jsonl": ("1", "1")}
    files = {r["source"]: r for r in spark.read.csv(str(out / "file_report"), header=True).collect()}
    assert files["a.jsonl"]["total"] == "5" and files["a.jsonl"]["skipped"] == "1" and files["a.jsonl"]["category"] == "complete" and files["b.jsonl"]["category"] == "unknown"


def test_rendered_texts_are_read_by_organize(spark, tmp_path):
    text = M.SYSTEM_PROMPT and f"<|im_start|>user\nProblem:\nP1<|im_end|>\n<|im_start|>assistant\nSolution:\n{LONG}<|im_end|>"
    write(tmp_path / "in" / "t.jsonl", [{"text": text}])
    assert stages.organize(spark, str(tmp_path / "in"), str(tmp_path / "out"))["good"] == 1


def test_repair(spark, tmp_path):
    rows = [chat("P", LONG, index=1), chat("Q", LONG, index=1), chat("R", "short", index=2), chat("S", LONG.replace("\\boxed{7}", "7"), index=None), chat("T", LONG), '{"index": 9}', "bad {", json.dumps(chat("U", LONG, index=5)) + json.dumps(chat("V", LONG, index=6))]
    source = write(tmp_path / "in.jsonl", rows)
    counts = stages.repair(spark, source, str(tmp_path / "v1.jsonl"), flag_filter=["NO_BOXED", "MISSING_INDEX"])
    assert counts == {"objects": 8, "errors": 1, "unique": 7, "clean": 5, "flagged": 3}
    clean, flagged = read(tmp_path / "v1.jsonl"), read(tmp_path / "v1.jsonl.flagged.jsonl")
    assert not any("_flags" in r for r in clean) and {tuple(r["_flags"]) for r in flagged} == {("TOO_SHORT", "NO_BOXED"), ("NO_BOXED",), ("MISSING_INDEX",)}
    assert any(r["messages"][0]["content"] == "S" for r in clean) and any(r["messages"][0]["content"] == "S" for r in flagged)  # both outputs have it; a null index is there
    counts = stages.repair(spark, source, str(tmp_path / "v2"), version=2)
    assert sum(counts[k] for k in ("clean", "flagged", "truncated")) == counts["unique"] and (tmp_path / "v2" / "route=clean").exists()


def test_flags_are_added_to_the_record_as_it_was(spark):
    df = spark.createDataFrame([('{"b": 1, "a": {"x": "}"} } ', ["A", "B"]), ("{ }", ["A"])], "raw string, flags array<string>")
    assert [r.x for r in df.select(stages.flagged(F.col("raw"), F.col("flags")).alias("x")).collect()] == ['{"b": 1, "a": {"x": "}"} , "_flags": ["A","B"]}', '{ "_flags": ["A"]}']


def test_command_line(spark, folder, tmp_path, capsys):
    small = write(tmp_path / "small.jsonl", [chat("P1", "x"), {"messages": []}])
    large = write(tmp_path / "large.jsonl", [chat("P1 ", "y"), chat("P2", "z", extra=[1]), chat("P2", "z", extra=[1])])
    cli.main(["exclude", "--large", large, "--small", small, "--output", str(tmp_path / "kept")])
    assert json.loads(capsys.readouterr().out) == {"kept": 2, "skipped": 1} and all(r["extra"] == [1] for r in read(tmp_path / "kept"))
    cli.main(["format", large, str(tmp_path / "texts")])
    assert json.loads(capsys.readouterr().out) == {"read": 3, "written": 3} and len(stages.jsonl.training_texts(spark, str(tmp_path / "texts")).collect()) == 3
    cli.main(["organize", str(folder), str(tmp_path / "o")])
    assert json.loads(capsys.readouterr().out)["files"] == 3
    pages = [{"url": "u", "problem": " P ", "solutions": ["s" * 210, " t" + "s" * 220]}, {"url": "v", "problem": "P", "solutions": ["s" * 199]}, {"url": "w", "problem": "", "solutions": ["s" * 300]}, {"url": "x", "problem": "p", "solutions": None}, {"url": "y", "problem": "P", "solutions": ["r" * 500]}]
    write(tmp_path / "raw" / "aops_imo.jsonl", [*pages, "broken"])
    cli.main(["scrape-pairs", str(tmp_path / "raw"), str(tmp_path / "p1"), "--glob", "aops_*.jsonl"])
    first = read(tmp_path / "p1")
    assert len(first) == 2 and first[0]["messages"][0]["content"] == M.PROBLEM_PREFIX + "P" and first[0]["messages"][1]["content"].startswith(" t")
    capsys.readouterr()
    cli.main(["scrape-pairs", str(tmp_path / "raw"), str(tmp_path / "p2"), "--distinct"])
    assert json.loads(capsys.readouterr().out) == {"written": 1}
    with pytest.raises(SystemExit):
        cli.main(["unknown"])


def test_loading(spark, tmp_path):
    path = write(tmp_path / "x.jsonl", [chat("a", "b"), "", "no", {"messages": [{"role": "user", "content": "x"}]}, chat("c", "d")])
    rows, seen = stages.load_records(spark, path)
    assert rows.count() == 2 and (seen.get["n"], seen.get["n_errors"], seen.get["n_short"]) == (4, 1, 1)
    assert [(r.line_no, r.line[:3]) for r in jsonl.numbered_lines(spark, path).orderBy("line_no").collect()][1:3] == [(2, ""), (3, "no")]
    with pytest.raises(Exception, match="(?i)malformed"):
        jsonl.read_strict(spark, path, "messages string").collect()
    assert stages.first_rows(rows, "ord", 1).count() == 1 and stages.first_rows(rows, "ord", 0).count() == 2
    both = stages.union_splits(spark.createDataFrame([(1, "a")], "i int, s string"), spark.createDataFrame([(2,)], "i int"))
    assert {(r.i, r.s) for r in both.collect()} == {(1, "a"), (2, None)}
    assert reports.checkpoint_path("/x/out.jsonl") == "/x/out.checkpoint"
    histogram = spark.createDataFrame([("b", 1), ("a", 1), ("c", 5)], "flag string, n int")
    assert [r.flag for r in stages.sorted_histogram(histogram).collect()] == ["c", "a", "b"]
    label = spark.range(1).select(stages.contest_label(F.lit("aops_imo_shortlist.jsonl")).alias("x")).first().x
    assert label == "IMO_SHORTLIST"


def test_index_may_be_null_but_not_absent(spark):
    df = spark.createDataFrame([('{"index": null}',), ('{"a": 1}',), ('{"index": 0}',)], "raw string")
    assert [r.x for r in df.select(stages.has_key(F.col("raw"), "index").alias("x")).collect()] == [True, False, True]


def test_threads():
    page = '<div class="cmty-post-body big">First<br>problem &amp; all</div><p>no</p><div class="post-body"><div>So <b>it</b> is</div></div><span class="post_text"></span>'
    assert extract.thread_posts(page) == ["First\nproblem & all", "So \nit\n is", ""] and extract.thread_posts(None) == []
    assert extract.links('<a href="x?a=1&amp;b=2">t</a><A HREF=y/><a name="z">') == ["x?a=1&b=2", "y/"]


def test_thread_pairs(spark):
    proof = "Proof: " + "it is so. " * 20
    pages = [("u", f'<div class="post_text">Find $x$.</div><div class="post_text">{proof}</div><div class="post_text">thanks</div>'), ("v", '<div class="post_text">Find $x$.</div>'), ("w", None)]
    rows = extract.thread_pairs(spark.createDataFrame(pages, "url string, page string")).collect()
    assert [(r.url, r.problem, len(r.solutions)) for r in rows] == [("u", "Find $x$.", 1)]


TEX = "\\documentclass{article} % notes\n" + "x" * 400


class Site(BaseHTTPRequestHandler):
    seen: list = []

    def do_GET(self):  # noqa: N802
        Site.seen.append(dict(self.headers))
        body = {"/index.html": '<a href="/more/EXTRA.tex">x</a>', "/a/IMO-2001.tex": TEX, "/more/EXTRA.tex": TEX, "/a/IMO-2002.tex": "<html>"}.get(self.path)
        self.send_response(200 if body else 404)
        self.end_headers()
        self.wfile.write((body or "").encode())

    def log_message(self, *_):
        pass


@pytest.fixture
def site():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Site)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_crawl_of_notes(spark, site, tmp_path, monkeypatch):
    monkeypatch.setenv("SITE_TOKEN", "secret")
    client = crawl.HttpClient({"User-Agent": "grainloom-test"}, timeout=5, token_variable="SITE_TOKEN")
    grid = {"bases": [f"{site}/a/"], "patterns": ["IMO-{year}.tex", "X-{year}.tex"], "first_year": 2001, "last_year": 2002}
    dry = crawl.crawl_notes(spark, client, **grid)
    assert [r.file_name for r in dry.collect()] == ["IMO-2001.tex", "IMO-2002.tex", "X-2001.tex", "X-2002.tex"] and not Site.seen
    at_hand = spark.createDataFrame([("X-2001.tex",)], "file_name string")
    got = crawl.crawl_notes(spark, client, **grid, indexes=[f"{site}/index.html"], files=at_hand, folder=str(tmp_path / "tex"), attempts=1, delay=0, sleep=lambda s: None)
    assert {r.file_name: r.n_bytes for r in got.collect()} == {"IMO-2001.tex": len(TEX), "EXTRA.tex": len(TEX)}
    assert sorted(p.name for p in (tmp_path / "tex").iterdir()) == ["EXTRA.tex", "IMO-2001.tex"]
    assert crawl.bearer("NO_SUCH_VARIABLE") == {} and crawl.bearer("SITE_TOKEN") == {"Authorization": "Bearer secret"}
    assert "secret" not in got._jdf.queryExecution().toString()


def test_crawl_of_a_wiki(spark):
    solution = "It follows at once. " * 10
    page = f'<div id="mw-content-text"><p>Problem</p>\n<p>Find x.</p>\n<p>Solution</p>\n<p>{solution}</p></div>'
    pages = {"http://w/2001/1": (200, page), "http://w/2001/2": (200, crawl.NO_TEXT), "http://w/2002/1": (404, "")}
    contests = spark.createDataFrame([("imo", "http://w/{year}/{n}", 2001, 2002, 2)], "contest string, template string, from_year int, to_year int, n_problems int")
    cached = spark.createDataFrame([("http://w/2002/2",)], "url string")
    rows = crawl.crawl_wiki(contests, lambda u: pages[u], cached=cached, attempts=1, delay=0, sleep=lambda s: None).collect()
    assert [(r.url, r.problem) for r in rows] == [("http://w/2001/1", "Find x.")]


def test_generation(spark, tmp_path):
    rows = [(i, [("user", f"P{i}"), ("assistant", f"S{i} ")]) for i in range(6)]
    df = spark.createDataFrame(rows, "index bigint, messages array<struct<role:string,content:string>>")

    def client(prompt, budget):
        if "P3" in prompt:
            raise incremental.RateLimited
        return f"[{budget}]{prompt[-3:]}"

    made = incremental.generate(df, client, order="index", system="SYS", limit=5, done=spark.createDataFrame([(0,)], "index bigint"), sleep=lambda s: None, wait=incremental.limited_wait)
    got = {r["index"]: r for r in made.collect()}
    assert set(got) == {1, 2, 4} and [m.role for m in got[1].messages] == ["system", "user", "assistant"] and got[1].original_solution == "S1 " and got[1].messages[2].content == "[4000]S1 "
    more = {r["index"]: r for r in incremental.generate(df, client, order="index", sleep=lambda s: None).collect()}
    assert set(more) == {0, 1, 2, 4, 5} and more[5].messages[1].content == "S5[3000]\nS5"
    assert incremental.limited_wait(incremental.RateLimited(), 1) == 60 and incremental.limited_wait(ValueError(), 1) == 5 and incremental.growing_wait(ValueError(), 2) == 30
    sink, ids = str(tmp_path / "out"), str(tmp_path / "ids")
    for _ in range(2):
        incremental.append_with_ids(df.filter("index < 3"), sink, ids)
    incremental.append_with_ids(df, sink, ids)
    assert sorted(r["index"] for r in read(tmp_path / "out")) == list(range(6)) and jsonl.read_integers(spark, ids).count() == 6


def test_stream_stops_early(spark, tmp_path):
    for k in range(6):
        spark.range(k * 10, k * 10 + 10).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    n = incremental.stream_until(spark, str(tmp_path / "in"), "id bigint", lambda b: b.filter("id % 2 = 0"), str(tmp_path / "out"), str(tmp_path / "state"), 12)
    assert n == 12 and spark.read.parquet(str(tmp_path / "out")).count() == 12


def test_progress():
    class Event:
        class progress:  # noqa: N801
            numInputRows, processedRowsPerSecond = 50, 10.0

        exception = None

    p = incremental.Progress(total=100)
    assert p.seconds_left is None
    p.onQueryProgress(Event)
    p.onQueryTerminated(Event)
    assert (p.rows, p.seconds_left, p.failed) == (50, 5.0, False)


def test_tokenize_and_mask(spark):
    df = spark.createDataFrame([("ab Solution:\nxy",), ("no template",), (None,)], "text string")
    rows = M.tokenize_and_mask(df, lambda t: [ord(c) for c in t], most=14).collect()
    assert len(rows[0].input_ids) == 14 and rows[0].labels == [-100] * 13 + [ord("x")] and rows[0].attention_mask == [1] * 14
    assert set(rows[1].labels) == {-100} and rows[2].input_ids == []


def test_new_entries(spark):
    long = "s" * 150
    rows = [(1, "P", long, "olympiads"), (2, "P", long, "olympiads"), (3, "Q", "short", "olympiads"), (4, "R", long, None), (5, "E", long, "imo_shortlist"), (6, "Z", long, "x olympiads")]
    df = spark.createDataFrame(rows, "id int, q string, s string, source string")
    existing = spark.createDataFrame([(M.PROBLEM_PREFIX + "E",)], "k string")
    pairs, counts = stages.new_entries(df, existing, order="id", question=F.col("q"), solution=F.col("s"), source=F.col("source"), sources=("olympiads", "imo_"), most=1)
    assert [r.ord for r in pairs.collect()] == [1] and counts.first().asDict() == {"n_new": 2, "n_dupes": 2, "n_invalid": 1, "n_other": 1}
    assert Q.FIRST.missing_index
