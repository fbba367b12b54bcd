"""Rows that fail to parse: reasons by hand, and damage of known kinds put into good lines."""

import json
import random
import time

import pytest

from grainloom.operators.rowparse import SHAPE_EDITS, csv_edits, json_edits, json_record, parse_line, parse_rows

GOOD = '{"index": 7, "source": "s", "messages": [{"role": "user", "content": "a \\"b\\" {c}, [d]: é"}, {"role": "assistant", "content": "x"}], "more": {"k": [1, null]}}'
M = '"messages": [{"role": "user", "content": "a"}]'

CASES = [
    ("jsonl", GOOD, None), ("jsonl", GOOD[:-1], "shape"), ("jsonl", GOOD[:60], "shape"), ("jsonl", GOOD + " ok", "shape"), ("jsonl", GOOD + GOOD, "shape"), ("jsonl", GOOD + "}", "shape"), ("jsonl", "null", "shape"),
    ("jsonl", "[" + GOOD + "]", "shape"), ("jsonl", "warning: retry 77", "shape"), ("jsonl", '"x"', "shape"), ("jsonl", GOOD.replace('\\"b\\"', '"b"'), "quoting"), ("jsonl", GOOD.replace('"source"', "'source'"), "quoting"),
    ("jsonl", GOOD.replace('"s"', "s"), "quoting"), ("jsonl", GOOD.replace("é", "\\q"), "quoting"), ("jsonl", GOOD.replace("é", "\t"), "quoting"), ("jsonl", GOOD.replace('"index"', "index"), "quoting"), ("jsonl", GOOD.replace('"source"', "“source”"), "quoting"),
    ("jsonl", GOOD.replace('"s",', '"s,'), "quoting"), ("jsonl", '{"index": 1, "source": "s"}', "columns"), ("jsonl", '{"source": "s", ' + M + "}", "columns"), ("jsonl", '{"index": "x", "messages": 3}', "columns"),
    *[("jsonl", f'{{"index": {i}, "source": null, {M}}}', r) for i, r in [("0", None), ("null", None), ('"12"', None), ("-1", "value"), ("1.5", "value"), ("true", "value"), ('""', "value"), ('"1a"', "value"), ("[1]", "value"), ("{}", "value")]],
    *[("jsonl", f'{{"index": 1, "source": "s", "messages": {m}}}', "value") for m in ("[]", "null", '"x"', "{}", '[{"role": "bot", "content": "x"}]', '[{"role": "user"}]', '[{"role": "user", "content": null}]', "[1]")],
    ("csv", '1,s,"a, ""b""",c', None), ("csv", ",s,a,b", None), ("csv", '"",s,,', None), ("csv", '1,s,"a,b', "quoting"), ("csv", '1,s,a"b,c', "quoting"), ("csv", '1,s,"a"b,c', "quoting"), ("csv", '1,s,"a "b" c",d', "quoting"),
    ("csv", "1,s,a", "columns"), ("csv", "1,s,a,b,c", "columns"), ("csv", "1;s;a;b", "columns"), ("csv", "x,s,a", "columns"), ("csv", "-1,s,a,b", "value"), ("csv", "n/a,s,a,b", "value"), ("csv", "1 2,s,a,b", "value"),
]


@pytest.mark.parametrize("fmt,line,reason", CASES)
def test_reasons(fmt, line, reason):
    assert parse_line(fmt, line)[0] == reason


def test_the_cheapest_edits_are_found():
    assert json_edits('{"a": "b"c"}') == [("escape quote", 8)]
    assert json_edits('{"a": "\\q"}') == [("escape backslash", 7)]
    assert json_edits('{"a": [1, 2') == [("close", 11), ("close", 11)]
    assert json_edits('{"a": 1} x') == [("drop rest", 9)]
    assert json_edits('{"a": 1}') == [] and json_edits("[1]") is None
    assert csv_edits('1,s,"a,b')[0] == [("delete quote", 4)] and csv_edits('1,s,a,"b,c')[0] == [("insert quote", 10)] and csv_edits("1,s,a")[0] == [("insert delimiter", 5)] and csv_edits('1,s,"a",b') == ([], ["1", "s", "a", "b"])


def test_damage_is_named():
    rng = random.Random(3)
    for _ in range(150):
        content = "".join(rng.choice("ab ,:{}[]é$\\n") for _ in range(rng.randint(5, 60)))
        line = json.dumps({"index": rng.randint(0, 99), "source": "src", "messages": [{"role": "user", "content": content}, {"role": "assistant", "content": "fine words"}]}, ensure_ascii=False)
        assert parse_line("jsonl", line)[0] is None
        assert parse_line("jsonl", line[: rng.randint(2, len(line) - 1)])[0] == "shape"
        assert parse_line("jsonl", line + " " + line)[0] == "shape"
        assert parse_line("jsonl", line.replace("fine", 'say "fine"'))[0] == "quoting"
        assert parse_line("jsonl", line.replace("fine", "\\fine\\d"))[0] == "quoting"


@pytest.mark.parametrize("more", ["NaN", "[Infinity]", '{"a": -Infinity}'])
def test_constants_that_are_no_json_do_not_load(more):
    line = GOOD.replace("[1, null]", more)
    reason, edits, record = parse_line("jsonl", line)
    assert record is None and edits and reason == ("shape" if any(e in SHAPE_EDITS for e, _ in edits) else "quoting")


def test_valid_lines_of_any_size_load():
    digits, deep = "7" * 5000, "[" * 30_000 + "]" * 30_000
    line = lambda **x: "{" + ", ".join(f'"{k}": {v}' for k, v in ({"index": "7", "source": '"s"'} | x).items()) + ", " + M + "}"
    for more, index, source in [({"more": digits}, "7", "s"), ({"more": "-" + digits}, "7", "s"), ({"more": deep}, "7", "s"), ({"index": digits}, digits, "s"), ({"source": digits}, "7", digits), ({"source": deep}, "7", deep), ({"more": deep, "index": "-0"}, "0", "s")]:
        reason, edits, record = parse_line("jsonl", line(**more))
        assert (reason, edits) == (None, []) and (str(record["index"]), record["source"]) == (index, source)
        assert record["messages"] == [{"role": "user", "content": "a"}]
    assert parse_line("jsonl", line(index="-" + digits))[0] == "value" and parse_line("jsonl", line(index=digits + ".5"))[0] == "value" and parse_line("jsonl", line(index=deep))[0] == "value"
    assert parse_line("jsonl", line(more=digits)[:-1])[0] == "shape"


def test_cost_0_is_what_the_parse_says():
    rng = random.Random(9)
    for _ in range(3000):
        line = list('{"a": [1, -2.5e3, {"b": "x\\n"}, [], {}, null], "c": true}')
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(len(line))
            line[at : at + rng.randint(0, 1)] = rng.choice(["", ",", '"', "]", "}", "1", " ", "-", "{", "[", ":", "٣"])
        line = "".join(line)
        assert (json_record(line) is not None) == (json_edits(line) == []), line


def test_parse_rows(spark):
    rows = [(k, "f", k, fmt, line) for k, (fmt, line, _) in enumerate(CASES)] + [(900, "f", 1, "jsonl", None), (901, "f", 1, "csv", "  \t"), (902, "f", 1, None, GOOD), (903, "f", 1, "csv", "1,s," + "x" * 200_000 + ",y"), (0, "f", 0, "jsonl", GOOD)]
    df = spark.createDataFrame(rows, "line_id bigint, status string, line_no bigint, fmt string, line string")
    got = parse_rows(df).collect()
    assert len(got) == len(rows)
    by = {r.line_id: r for r in got}
    for k, (_, _, reason) in enumerate(CASES):
        assert (by[k].status, by[k].reason) == ("failed" if reason else "loaded", reason)
    assert by[900].status == by[901].status == "blank" and by[902].status == by[903].status == "loaded"
    assert by[0]["index"] == "7" and by[0].messages[0].content == 'a "b" {c}, [d]: é' and by[0].source == "s"
    assert parse_rows(df.limit(0)).count() == 0


def test_bounded_search_finds_what_the_whole_one_finds():
    rng = random.Random(11)
    for _ in range(400):
        line = list(GOOD)
        for _ in range(rng.randint(1, 6)):
            i = rng.randrange(len(line))
            line[i : i + rng.randint(0, 1)] = rng.choice('"\\,:{}[] x')
        line = "".join(line)
        assert json_edits(line) == json_edits(line, lead=10**6)


def test_work_grows_with_the_length_of_the_line():
    words = 'word "x and y, it is so ' * 8000
    began = time.perf_counter()
    assert len(json_edits('{"index": 1, "source": "a", "messages": [{"role": "user", "content": "' + words + '"}]}')) == 8000
    assert parse_line("csv", f'1,s,"{words}",b')[0] == "quoting"
    assert time.perf_counter() - began < 20  # a tenth of it where the machine is idle; minutes if it were quadratic
    assert json_edits('{"a": ' + "[" * 50_000 + " x") is not None
