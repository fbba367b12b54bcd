"""Cut texts, repetition, formatting duplicates: rows against brute force and by hand."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from grainloom.llm import arrays, canonical, queries, repetition, truncation
from grainloom.llm.endings import judge, with_endings

CHAT = "rec_id bigint, index string, source string, messages array<struct<role:string,content:string>>, extra string, row_id string, text int"


def chat(spark, rows):
    """rows: (rec_id, source, [(role, content)] or None, extra); two columns have names that the operators use too."""
    return spark.createDataFrame([(i, "0", s, m, e, "x", 1) for i, s, m, e in rows], CHAT)


def cut_ids(df):
    return {(r.row_id, r.turn) for r in truncation.cut_contents(df)[0].collect()}


def test_cut_contents(spark):
    whole = [[("user", f"Find all numbers x with ${k}x = 4$."), ("assistant", f"The sum ${k}$ is odd. Answer: {w}")] for k, w in enumerate(["yes", "none", "the second player"] * 10)]
    rows = [(i, "a", m, None) for i, m in enumerate(whole)]
    cut = {
        100: "The sum $3$ is odd. The graph conta", 101: "The sum $3$ is odd. We have $x^2 + ", 102: "The sum $3$ is odd. The graph…", 103: "The sum $3$ is odd. It follows that [...]",
        104: "The sum $3$ is odd. Answer: the sec", 105: "The sum $3$ is odd. Das ist gr\ufffd", 106: "The sum $3$ is odd. The value &am",
    }
    fine = {200: "So it is.", 201: "**So it is.**", 202: "<p>So it is.</p>", 203: "", 204: None, 205: "   \n", 206: "It is done! ∎", 207: "Answer: 12", 208: "Final answer: $\\boxed{5}$", 209: "The sum $3$ is odd", 210: "So it is.”"}
    rows += [(i, None, [("user", "Is it so?"), ("assistant", t)], None) for i, t in {**cut, **fine}.items()]
    rows += [(300, "a", None, None), (301, "a", [], None), (302, "a", [("system", "Answer in")], None), (303, "b", [("user", "Find all n f"), ("assistant", "None exist.")], None), (304, "b", [("assistant", "The sum $9$ is odd.")], None)]
    assert cut_ids(chat(spark, rows)) == {(i, 1) for i in cut} | {(303, 0)}
    assert cut_ids(chat(spark, [])) == set()
    shares = {r.source: r for r in truncation.source_shares(chat(spark, rows)).collect()}
    assert shares[None].n_cut == len(cut) and shares["b"].n_cut == 1 and shares["a"].share == 0.0


def test_hidden_limit_is_found_in_its_encoding(spark):
    rng = random.Random(4)
    text = lambda: " ".join("".join(rng.choice("abcdefgh<&") for _ in range(rng.randint(3, 9))) for _ in range(120))
    rows = []
    for i in range(40):
        full, n = text(), 0
        while len(full[: n + 1]) + 4 * full[: n + 1].count("&") + 3 * full[: n + 1].count("<") <= 400:
            n += 1
        rows.append((i, "s", [("assistant", full[:n])], None))
    rows += [(1000 + i, "s", [("assistant", text() + " end.")], None) for i in range(40)]
    limits = truncation.cut_contents(chat(spark, rows))[1].orderBy(F.desc("n_texts")).collect()
    assert limits and limits[0].encoding.startswith("entities") and limits[0].field_limit in range(395, 401)


def test_a_cut_record_delivered_often_is_still_cut(spark):
    rows = [(i, "s", [("assistant", "We see that the graph conta")], None) for i in range(400)] + [(1000 + i, "s", [("assistant", f"Case {i}: the graph is whole.")], None) for i in range(50)]
    assert len(cut_ids(chat(spark, rows))) == 400


def test_encoded_lengths(spark):
    text = 'a<b & "c"\né😀'
    got = spark.createDataFrame([(text,)], "t string").select(truncation.encoded_lengths(F.col("t")).alias("x")).first().x
    got = dict(zip(truncation.ENCODINGS, got))
    assert got["code points"] == len(text) and got["utf-8"] == len(text.encode()) and got["utf-16"] == len(text.encode("utf-16-le")) // 2
    assert got["json ascii"] == len(json.dumps(text)) - 2 and got["json"] == len(json.dumps(text, ensure_ascii=False)) - 2
    assert got["crlf"] == len(text) + 1 and got["entities"] == len(text.replace("&", "&amp;").replace("<", "&lt;"))


STORED = {
    "code points": lambda t: t, "utf-8": lambda t: t.encode(), "entities": lambda t: t.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;"),
    "json ascii": lambda t: json.dumps(t)[1:-1], "crlf": lambda t: t.replace("\n", "\r\n"),
}


@pytest.mark.parametrize("encoding", list(STORED))
def test_hidden_limits(spark, encoding):
    """A source with a limit in one encoding, another one without; some texts are cut where only the limit tells it."""
    rng = random.Random(3)
    size, stored = 240, STORED[encoding]

    def text(k):
        return f"Let {k} < n & m.\n" + " ".join(rng.choice(["größe", "sum", "5 < 7", 'the "odd" one', "graph", "is & was"]) for _ in range(rng.randint(10, 40))) + "."

    def fill(t):
        """Words before the text, so that it ends exactly at the limit."""
        while (gap := size - len(stored(t))) > 0:
            t = "x" * min(gap, 9) + (" " if gap > 12 else "") + t
        return t if gap == 0 else None

    rows, cut, only = [], set(), set()
    for k in range(300):
        t = text(k)
        rows.append((k, "free", [("assistant", t)], None))
        while len(stored(t)) > size:
            t = t[:-1]
        if len(stored(t)) == size and not t.rstrip().endswith((".", "n")):
            cut.add(1000 + k)
        rows.append((1000 + k, "limited", [("assistant", t if 1000 + k in cut else text(k)[:100].rsplit(" ", 1)[0] + " holds.")], None))
    for k in range(6):  # part of the answer 5861; a whole word as an answer; a whole sentence
        for base, end in ((2000, f"We are done with {k}. Answer: 58"), (3000, f"It is clear by {k}. Answer: none"), (4000, f"It is clear by {k}.")):
            rows.append((base + k, "limited", [("assistant", fill(f"Number {k}. {end}"))], None))
            rows.append((base + 500 + k, "free", [("assistant", f"Number {k}. {end}")], None))
        only.add(2000 + k)
    found, limits = truncation.cut_contents(chat(spark, rows))
    found = {r.row_id: r for r in found.collect()}
    kept = limits.collect()
    assert [(r.source, r.field_limit) for r in kept] == [("limited", size)] and len(cut) > 20
    assert kept[0].encoding == encoding
    assert only <= {i for i, r in found.items() if r.by_limit} <= only | cut
    assert cut - set(found) == set() and not {i for i in found if i >= 3000 or i < 1000}


@pytest.mark.parametrize("most", [100, 0])
def test_limits_of_a_source_are_looked_up_alike(spark, most):
    texts = spark.createDataFrame([(i, [None, "a", "b"][i % 3], i, [i, 2 * i]) for i in range(12)], "i int, source string, sample bigint, lengths array<int>")
    limits = spark.createDataFrame([("a", 0, 4, 9), ("a", 1, 8, 5), (None, 1, 6, 2), ("b", 0, 99, 7)], "source string, encoding int, n int, k int")
    got = {r.i: (r["at"].encoding, r["at"].n) for r in truncation.at_limits(texts, limits, most=most).collect() if r["at"]}
    assert got == {4: (0, 4), 3: (1, 6)}


def test_ends_are_judged_alike_after_reformatting(spark):
    texts = ["It holds. This proves the claim.", "IT HOLDS; THIS PROVES  THE CLAIM…", "It holds. This proves the claim”"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    assert {r.i: r.whole for r in judge(with_endings(df)).collect()} == {0: True, 1: True, 2: True}


def brute_repeated(text, run=6):
    words = text.lower().split()
    seen, hit = set(), [False] * len(words)
    for i in range(len(words) - run + 1):
        key = tuple(words[i : i + run])
        if key in seen:
            hit[i : i + run] = [True] * run
        seen.add(key)
    return len(words), sum(hit)


def test_repetition_against_brute_force(spark):
    rng = random.Random(7)
    texts = ["", None, " \n ", "one", "a b c d e f " * 5, "Ä B c d e f\u00a0ä b C D E F", "x " * 3000]
    for _ in range(150):
        words = [rng.choice("abcdefghijkl") + str(rng.randint(0, 30)) for _ in range(rng.randint(1, 200))]
        for _ in range(rng.randint(0, 6)):
            at, n = rng.randrange(len(words)), rng.randint(1, 20)
            words[rng.randrange(len(words)) :][:0] = words[at : at + n]
            words = words + words[at : at + n]
        texts.append(" ".join(words))
    df = spark.createDataFrame([(i, t, "z", 0) for i, t in enumerate(texts)], "id int, text string, band string, n_words int")
    got = {r.id: r for r in repetition.measure_repetition(df, keys=("id",)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        n, hit = brute_repeated(t or "")
        assert (got[i].n_words, got[i].n_repeated) == (n, hit), t
        if n and hit / n >= 0.35:
            assert got[i].band == "repetitive"
    assert repetition.measure_repetition(df.limit(0), keys=("id",)).count() == 0


def test_only_bands_are_measured(spark):
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words), " ".join(words + words[:250]), ""]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r.id: r for r in repetition.measure_repetition(df, keys=("id",), banded_only=True).collect()}
    assert got[0].band != "repetitive" and got[0].repeated_share is None
    assert got[1].band == "repetitive" and got[1].n_repeated == 250 and got[2].repeated_share == 0
    long = {r.id: r for r in repetition.measure_repetition(df, keys=("id",), longest=500, banded_only=True).collect()}
    assert long[1].band == "unsure" and long[1].ratio is None and long[1].n_repeated == 250 and long[0].band == got[0].band


def with_share(n, where, rng):
    """Random words of which 35.2 % stood earlier: in shortest runs spread over the text, at its end, near by, or one far copy."""
    k = -(-n * 352 // 1000)
    fresh = [int(x) for x in rng.integers(0, 2**32, n - k)]
    if where == "far":
        return fresh + fresh[:k]
    out, rest = (fresh, []) if where == "end" else (fresh[:12], fresh[12:])
    repeated = 0
    while rest or repeated < k:
        if repeated < k and (not rest or where == "end" or repeated < 0.352 * (len(out) + 6)):
            start = int(rng.integers(max(0, len(out) - 40), len(out) - 6)) if where == "near" else int(rng.integers(0, min(len(out), n - k) - 6))
            out += out[start : start + 6]
            repeated += 6
        else:
            out.append(rest.pop())
    return out


@pytest.mark.parametrize("where", ["spread", "end", "near", "far"])
@pytest.mark.parametrize("n", [40, 60, 100, 400, 1000, 12_000, 31_250, 200_000])
def test_limit_of_the_band_is_below_every_case(n, where):
    rng = np.random.default_rng(n)
    for _ in range(20 if n < 5000 else 1):
        words = np.array(with_share(n, where, rng), dtype=np.uint32)
        share = repetition.repeated_words(words.astype(np.uint64), np.array([0, len(words)]), 6)[0] / len(words)
        if share >= 0.35:
            assert repetition.ratio_of(words.tobytes()) >= repetition.least_ratio(len(words), 0.35, 6)


def test_limit_holds_for_two_million_words():
    words = np.random.default_rng(0).integers(0, 2**32, 1_000_000, dtype=np.uint32)
    coded = np.concatenate([words, words]).tobytes()
    assert repetition.ratio_of(coded) >= repetition.least_ratio(2_000_000, 0.35, 6)


def test_repeats_after_a_long_distinct_part_are_found(spark, tmp_path):
    rng = random.Random(5)
    rows = []
    for i, (n, share) in enumerate([(12_000, 0.42), (20_000, 0.50), (20_000, 0.30)]):
        words = [f"w{k}" for k in range(n - round(n * share / 6) * 6)]
        runs = [words[at : at + 6] for at in (rng.randrange(len(words) - 6) for _ in range(round(n * share / 6)))]
        rows.append((i, "a", [("assistant", " ".join(words + sum(runs, [])))], None))
    chat(spark, rows).write.parquet(f"{tmp_path}/chat_records.parquet")
    spark.createDataFrame([(7, rows[1][2][0][1]), (8, None)], "pair_id bigint, chosen string").write.parquet(f"{tmp_path}/dpo_pairs.parquet")
    assert [brute_repeated(m[0][1])[1] >= 0.35 * n for (_, _, m, _), n in zip(rows, (12_000, 20_000, 20_000))] == [True, True, False]
    assert {(r.tab, r.row_id) for r in queries.p5_found(spark, str(tmp_path)).collect()} == {("chat_records", 0), ("chat_records", 1), ("dpo_pairs", 7)}


def brute_canonical(text):
    if text is None:
        return None
    out = []
    for i, ch in enumerate(text):
        if ch.isspace() or ch in canonical.MARKS and ch not in ".,":
            continue
        if ch in ".," and not (0 < i < len(text) - 1 and text[i - 1].isdigit() and text[i + 1].isdigit()):
            continue
        out.append(ch)
    return "".join(out).casefold()


def test_canonical_text(spark):
    texts = ["Größe: 3.5, x", "GRÖSSE 3.5 X", "a. b,c", "1,2,3.4.", "3 .5", "ΟΔΟΣ οδος", "\u2003a\u00a0b\x85", "–—…“”‘’", "", None, "x!y?z;'\"", "½.5 ٣.٤"]
    got = [r.c for r in spark.createDataFrame([(t,) for t in texts], "t string").select(canonical.canonical_text(F.col("t")).alias("c")).collect()]
    assert got == [brute_canonical(t) for t in texts]


@pytest.mark.parametrize("limits", [{}, {"hot_least": 2}, {"hot_least": 10**6}])
def test_formatting_duplicates(spark, limits):
    rows = [
        (5, "a", [("user", "Find x."), ("assistant", "It is 1.5!")], '{"a": 1, "b": [1, 2]}'), (3, "b", [("user", "find  X"), ("assistant", "it is 1.5")], '{"b":[1,2],"a":1}'),
        (4, "b", [("user", "find  X"), ("assistant", "it is 15")], '{"b":[1,2],"a":1}'), (6, "b", [("user", "find X"), ("assistant", "it is 1.5")], '{"b":[2,1],"a":1}'),
        (7, "b", [("user", "find X"), ("assistant", "it is 1.5")], None), (8, "b", [("assistant", "find X"), ("user", "it is 1.5")], None), (9, "c", None, None), (10, "c", None, None),
        (11, "c", [], None), (12, "d", [], None), (13, "d", [("user", None)], None), (14, "d", [("user", "")], None), (5, "a", [("user", "Find x."), ("assistant", "It is 1.5!")], '{"a": 1, "b": [1, 2]}'),
        (20, "e", [("user", "y" * 100_000)], "no json"), (21, "e", [("user", "Y " * 100_000)], "no json"),
    ]
    got = {(r.row_id, r.keep_id, r.n_copies) for r in canonical.formatting_duplicates(chat(spark, rows), **limits).collect()}
    assert got == {(5, 3, 2), (3, 3, 2), (4, 4, 1), (6, 6, 1), (7, 7, 1), (8, 8, 1), (11, 11, 2), (12, 11, 2), (13, 13, 1), (14, 14, 1), (20, 20, 2), (21, 20, 2)}
    assert canonical.formatting_duplicates(chat(spark, [])).count() == 0


def test_word_names_are_equal_wherever_a_word_stands():
    names, _, _, ranges = arrays.words(["ab cd", "", "cd ab ab", "é1"], arrays.alnum_table())
    assert list(ranges) == [0, 2, 2, 5, 6]
    assert names[0] == names[3] == names[4] and names[1] == names[2] and len(set(names.tolist())) == 3
