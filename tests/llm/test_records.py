"""Broken pairs, survivors, markup and mixing."""

import datetime as dt

import numpy as np
import pytest

from grainloom.llm import markup, mixing, pairs, survivor, wrappers

EN = "Let us consider the set of all numbers that satisfy this condition and show that the sum of the first terms is odd for every choice."
DE = "Wir betrachten die Menge aller Zahlen, die diese Bedingung erfüllen, und zeigen, dass die Summe der ersten Glieder für jede Wahl ungerade ist."
ES = "Consideremos el conjunto de todos los números que cumplen esta condición y mostremos que la suma de los primeros términos es impar."
QUESTION = "Find all positive integers $n$ such that the number $n^2+5$ is divisible by the sum of its digits."


def cot(spark, rows):
    return spark.createDataFrame([(i, m, 0, "x") for i, m in rows], "cot_id bigint, messages array<struct<role:string,content:string>>, turn int, answer string")


def labelled(spark, rows=None):
    return spark.createDataFrame(rows if rows is not None else [(k, t, lang) for k, (t, lang) in enumerate([(EN, "en"), (DE, "de"), (ES, "es"), (None, "en"), (EN, None)])], "doc_id bigint, text string, lang string")


def test_broken_pairs(spark):
    good = "Let us consider the sum. It is odd for every choice."
    answers = {
        1: (None, "empty"), 2: ("  \n", "empty"), 3: ("Solution:", "empty"), 4: ("N/A", "empty"), 5: ("**Answer:** ...", "empty"), 6: ("I must decline to answer this one. I hope you understand.", "refusal"),
        7: ("Es tut mir leid, aber ich kann bei dieser Aufgabe nicht helfen.", "refusal"), 8: (QUESTION + " Unfortunately, I can't help with this problem.", "refusal"), 9: (QUESTION, "copy"),
        10: ("> " + QUESTION.upper(), "copy"), 11: ("Proof:\n" + QUESTION.rstrip("."), "copy"), 12: (QUESTION + "\n\nSolution: " + good, None), 13: ("Let us consider the sum. It is odd for ev", "truncated"), 14: ("The value is $x^2+", "truncated"),
        15: (DE, "language"), 16: ("Lösung: " + EN, None), 17: ("$42$", None), 18: ("\\boxed{7}", None), 19: ("We cannot have $n = 4$. Hence the number is odd.", None), 20: (good, None), 21: ("28.", None),
    }
    rows = [(i, [("system", "Be exact."), ("user", QUESTION), ("assistant", a)]) for i, (a, _) in answers.items()]
    rows += [(50, [("user", QUESTION)]), (51, [("user", QUESTION), ("user", QUESTION), ("assistant", good)]), (52, None), (53, []), (54, [("user", None), ("assistant", good)]), (50, [("user", QUESTION)])]
    rows += [(60, [("user", QUESTION), ("assistant", good), ("user", ES), ("assistant", EN + " " + EN)])]
    got = {(r.row_id, r.turn): r.defect for r in pairs.broken_pairs(cot(spark, rows), labelled(spark)).collect()}
    assert got == {(i, 1): d for i, (_, d) in answers.items() if d} | {(50, 0): "empty", (51, 0): "empty", (60, 2): "language"}
    assert pairs.broken_pairs(cot(spark, []), labelled(spark)).count() == 0
    assert "language" not in {r.defect for r in pairs.broken_pairs(cot(spark, rows), labelled(spark, [])).collect()}


@pytest.mark.parametrize("answer", [
    "I'd rather not answer that.", "I do not feel comfortable answering this question.", "Lo siento, prefiero no contestar.", "Ich möchte darauf lieber nicht antworten.", "Je préfère ne pas répondre à cela.", "Я не хочу отвечать на этот вопрос.",
    "As an assistant I am not able to help with that.", "A point lies at $x+y$. A circle of radius $r_4$ is given. Sorry, but I will not be giving an answer here.",
])
def test_ordinary_refusals(answer):
    assert pairs.is_refusal("what is the smallest distance of the given point from the circle that goes through the two other points".split(), answer)


@pytest.mark.parametrize("answer", [
    "I can't give a smaller bound, but $n=5$ works. Answer: 5", "We cannot solve it by hand, so x = 4.", "The sum $a+b$ is odd. Then $c$ is even. Hence $d$ is odd. I cannot give a shorter proof.", "Answer: 7. I will not give a second proof.", "It is impossible for the sum to be even.",
])
def test_answers_that_decline_nothing(answer):
    assert not pairs.is_refusal("is the sum odd".split(), answer)


def test_refusals_are_learned(spark):
    """A sentence in no list, that recurs in answers which say nothing; one that solutions have too; one that one question has."""
    rows = []
    for k in range(12):
        q = f"Find all numbers n such that $n^{k}$ divides the sum of its digits in base {k + 2}."
        solution = f"The sum of digits is small, so $n<{k}$. Hence $n={k}$ is the only one. Questo non si discute mai oggi. Answer: {k}"
        answers = {0: "Mi dispiace, purtroppo su questo tema taccio volentieri. Buona fortuna a tutti voi.", 1: "Questo non si discute mai oggi.", 2: solution}
        rows += [(100 * j + k, [("user", q), ("assistant", a)]) for j, a in answers.items()]
    rows += [(900 + k, [("user", "What is the least number?"), ("assistant", "Il libro dice tutto quanto.")]) for k in range(5)]
    got = {r.row_id for r in pairs.broken_pairs(cot(spark, rows), labelled(spark)).filter("defect = 'refusal'").collect()}
    assert got == set(range(12))


def test_copies_of_the_question():
    q = "On a board of 20 rows some cells are marked so that no two of them touch in any row or column of the board . What is the smallest number of marked cells in a row".lower().split()
    assert pairs.is_copy(q, q) and pairs.is_copy(q, q + q) and pairs.is_copy(q, q + ["solution"] + q) and pairs.is_copy(q, q * 3)
    assert not pairs.is_copy(q, q[:8]) and not pairs.is_copy(q, q + ["we"] * 12) and not pairs.is_copy([], q) and not pairs.is_copy(q, []) and not pairs.is_copy(q, q[::-1])


def test_long_refusals(spark):
    reasons = " ".join(["The statement leaves open what is counted, and every reading of it leads somewhere else."] * 6)
    refuse = "I am sorry, but I cannot help with this problem."
    answers = {
        1: (f"{refuse} {reasons} You may want to ask a teacher.", True), 2: (f"{reasons} Unfortunately, {refuse}", True), 3: ("I must decline to answer the question about $n^2+5$.", True), 4: (f"{refuse} {reasons} It is about $n^2 + 5$.", True),
        5: (f"{refuse} {reasons} But $n=4$ works.", False), 6: (f"{refuse} {reasons}\nAnswer: 12", False), 7: (f"{refuse} {reasons} Hence n = 7.", False), 8: (reasons, False), 9: (f"{refuse} {reasons} We get \\boxed{{7}}.", False), 10: ("I cannot help with this, but $m=3$.", False),
    }
    rows = [(i, [("user", QUESTION), ("assistant", a)]) for i, (a, _) in answers.items()]
    got = {r.row_id for r in pairs.broken_pairs(cot(spark, rows), labelled(spark)).filter("defect = 'refusal'").collect()}
    assert got == {i for i, (_, refused) in answers.items() if refused}


def test_common_subsequence():
    def slow(a, b):
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        return table[-1][-1]

    rng = np.random.default_rng(3)
    for _ in range(60):
        a, b = (list(map(str, rng.integers(0, 6, rng.integers(0, 25)))) for _ in range(2))
        assert pairs.common(a, b) == slow(a, b)


def test_languages_on_held_out_texts(spark, small):
    docs = [(r.lang, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").filter("lang is not null").collect()]
    model = pairs.Languages(docs[::2])
    held = [(lang, model.scores(model.words(t))) for lang, t in docs[1::2]]
    assert np.mean([max(s, key=s.get) == lang for lang, s in held]) >= 0.97


MERGE = "row_id bigint, index string, source string, messages array<struct<role:string,content:string>>, final_answer string, url string, updated_at timestamp, value string, kind string"


def merge(spark, rows):
    day = lambda n: None if n is None else dt.datetime(2024, 1, n)
    return spark.createDataFrame([(i, k, s, [("user", "q"), ("assistant", a)], f, u, day(t), "v", "k") for i, k, s, a, f, u, t in rows], MERGE)


def sources(spark):
    return spark.createDataFrame([("top", 1, "x"), ("low", 5, "x")], "source string, trust_rank int, category string")


def test_surviving_rows(spark):
    rows = [
        (1, "a", "low", " longest text \n", "7", "https://h.example/1", 5), (2, "a", "top", "long", "N/A", "unknown", 9), (3, "a", "top", "", "8", "https://h.example/3", 5), (4, "a", "new", "longest text", "9", " ", 3),
        (5, "b", "top", None, " ", None, 1), (6, "b", "low", "TBD", "?", "-", 2), (7, "c", "top", "alone", "1", "https://h.example/7", 1), (8, None, "top", "x", "1", "u", 1), (9, None, "top", "y", "1", "u", 1),
        (7, "c", "top", "alone", "1", "https://h.example/7", 1), (10, "d", "zzz", "t", "1", "https://h.example/10", None), (11, "d", None, "t", "2", "https://h.example/11", None),
    ]
    got = {(r["index"], r.field): r.row_id for r in survivor.surviving_rows(merge(spark, rows), sources(spark)).collect()}
    assert got == {("a", "solution"): 1, ("a", "final_answer"): 3, ("a", "url"): 1, ("d", "solution"): 10, ("d", "final_answer"): 10, ("d", "url"): 10}
    assert survivor.surviving_rows(merge(spark, []), sources(spark)).count() == 0
    assert [r.asDict() for r in survivor.survivors(merge(spark, rows), sources(spark)).filter("index = 'a'").collect()] == [{"index": "a", "solution": "longest text", "final_answer": "8", "url": "https://h.example/1"}]


@pytest.mark.parametrize("hot", [10_000, 2])
def test_latest_value_without_times_follows_learned_transitions(spark, hot):
    rows = [(10 * g + k, f"g{g}", "top", "s", "1", f"https://{h}.example/{g}", 1 + k) for g in range(6) for k, h in enumerate(["old", "mid", "new"])]
    rows += [(900, "z", "top", "s", "1", "https://new.example/z", None), (899, "z", "top", "s", "1", "https://old.example/z", None), (901, "z", "top", "s", "1", "https://mid.example/z", None)]
    got = {r["index"]: r.row_id for r in survivor.surviving_rows(merge(spark, rows), sources(spark)).filter("field = 'url'").collect()}
    assert got["z"] == 900 and got["g0"] == 2
    values = merge(spark, rows).selectExpr("index key", "row_id", "substring(url, 9, 3) kind", "unix_micros(updated_at) at")
    levels = {r.kind: r.level for r in survivor.transition_precedence(values.drop("value"), hot=hot, salts=1).collect()}
    assert levels["old"] < levels["new"]


def test_latest_value_is_topologically_latest(spark):
    steps = ["xa", "ya", "za", "ab", "bc", "pq", "qr", "rp"]
    rows = [(10 * g + k, f"g{g}", "top", "s", "1", f"https://{h}.example/{g}", 1 + k) for g, pair in enumerate(steps) for k, h in enumerate(pair)]
    # the smallest row_id decides where nothing is learned (u), or where the group's own kinds are in a cycle
    undated = {"ab": "b", "ba": "b", "ac": "c", "ua": "u", "au": "a", "qp": "q", "pq": "q", "rqp": "r", "uxc": "c", "axu": "a"}
    rows += [(1000 + 10 * g + k, f"n{kinds}", "top", "s", "1", f"https://{h}.example/{g}", None) for g, kinds in enumerate(undated) for k, h in enumerate(kinds)]
    got = {r["index"][1:]: r.value[8] for r in survivor.surviving_rows(merge(spark, rows), sources(spark)).filter("field = 'url' and index like 'n%'").collect()}
    assert got == undated
    values = merge(spark, rows).selectExpr("index key", "row_id", "substring(url, 9, 1) kind", "unix_micros(updated_at) at")
    levels = {r.kind: r.level for r in survivor.transition_precedence(values).collect()}
    assert levels == {"x": 0, "y": 0, "z": 0, "a": 1, "b": 2, "c": 3, "p": 0, "q": 0, "r": 0}


@pytest.mark.parametrize("salts", [1, 3, 32])
def test_hot_groups_give_their_own_steps(spark, salts):
    """One large group says a, b, c, a, b, c; others say the reverse, more often than a split by hash would outweigh."""
    rows = [("hot", k, "abc"[k % 3], k // 7) for k in range(1500)] + [("same", k, "de"[k // 300], 5) for k in range(600)]
    rows += [(f"g{g}", 10_000 + 3 * g + k, "cba"[k], k) for g in range(150) for k in range(3)] + [("one", 9_000, "f", 1), ("one", 9_001, "g", None)] + [("repeated", 77, "h", 3)] * 700
    values = spark.createDataFrame(rows, "key string, row_id bigint, kind string, at bigint")
    whole, split = ({(r.before, r.after) for r in survivor.transitions(values, hot=hot, salts=salts).collect()} for hot in (10_000, 500))
    assert whole == split == {("a", "b"), ("b", "c"), ("c", "a"), ("d", "e")}


def test_levels_follow_every_path():
    rng = np.random.default_rng(6)
    for _ in range(200):
        n = int(rng.integers(2, 9))
        edges = {(a, b) for a, b in rng.integers(0, n, (int(rng.integers(1, 2 * n)), 2)).tolist() if a != b}
        edges = {(a, b) for a, b in edges if a < b or (b, a) not in edges}
        reach = {(a, b): (a, b) in edges for a in range(n) for b in range(n)}
        for k in range(n):
            for a in range(n):
                for b in range(n):
                    reach[a, b] |= reach[a, k] and reach[k, b]
        group = sorted(set(rng.integers(0, n + 1, 5).tolist()))
        levels = survivor.Precedence((str(a), str(b)) for a, b in edges).levels([str(k) for k in group])
        assert all(levels[str(a)] < levels[str(b)] for a in group for b in group if reach.get((a, b)) and not reach[b, a])
        assert all(v == 0 for k, v in levels.items() if not any(reach.get((a, int(k))) for a in group if a != int(k)))


TEXTS = {
    1: ("<h2>Proof 4</h2>\n<p>It holds.</p><ul><li>One.</li><li>Two.</li></ul>", {"html"}), 2: ("It&nbsp;is $a&lt;b$ here", {"html"}), 3: ("## Proof 3\n\nIt **holds**.\n\n- One\n- Two", {"markdown"}),
    4: ("See [this](https://x.example/t/1) and `gcd(4, k)`.", {"markdown"}), 5: ("a\n\n| case | value |\n|------|-------|\n| 1 | 8 |", {"markdown"}), 6: ("== Proof 5 ==\nIt '''holds''' by [[Parity 3|parity]].", {"wiki"}),
    7: ('x\n{| class="wikitable"\n! case !! value\n|-\n| 1 || 9\n|}\ny', {"wiki"}), 8: ("{{problem box|year=1997}}\nIt holds.", {"wiki"}), 9: ("\\section*{Proof 2}\n\\begin{enumerate}\n\\item One\n\\end{enumerate}", {"latex"}),
    10: ("It is \\textbf{odd}.\\label{st:1} \\footnote{See 2.}", {"latex"}), 11: ("<b>x</b> and **y**", {"html", "markdown"}), 20: ("We get 3 * 615 < $\\binom{b}{3}$ and $z$ > 2 * 8623.", set()), 21: ("the matrix [[66,1],[0,23]] has x_1, x_2 and y_1 * y_2 in #4036", set()),
    22: ("The sets {{1},{2,3}} and {{4}} come from rule #601.", set()), 23: ("\\begin{align*}\na &= 611 \\\\\nb &= 45\n\\end{align*}", set()), 24: ("$k<690<m+3$ and \\frac{1}{2 are cut: $\\text{", set()), 25: ("", set()), 26: (None, set()), 27: ("As they say, \"count twice\"; it's 5 - 3 - 1 and a < b > c & d", set()),
    30: ("x\n[(a) b](https://x.example/t)\n| a |\n|---|\n| b (c) |", {"markdown"}), 31: ("{| (x)\n|- (y)\n|}", {"wiki"}), 28: ("1. only one numbered line", set()), 29: ("for k<5 we have <k> and <m+1>", set()),
}


def test_markup_kinds(spark):
    df = spark.createDataFrame([(i, "h" if i % 2 else None, t, "x", "y") for i, (t, _) in TEXTS.items()], "id int, host string, text string, kinds string, stream string")
    kinds, wrappers = markup.markup_kinds(df, keys=("id",))
    assert {r.id: set(r.kinds) for r in kinds.collect()} == {i: k for i, (_, k) in TEXTS.items() if k}
    assert {r.host for r in wrappers.collect()} == {"h", ""}
    assert markup.markup_kinds(df.limit(0), keys=("id",))[0].count() == 0


def test_wrapper_is_the_least_expression_of_its_streams():
    streams = ["html:<p T html:</p", "html:<p T html:</p html:<p T html:</p html:<ul T html:</ul", "html:<p T html:</p html:<ul T html:</ul"]
    wrapper = []
    for s in streams:
        wrapper = wrappers.align(wrapper, wrappers.load(wrappers.dump(wrappers.fold(s.split()))))
    assert wrappers.expression(wrapper, 3).endswith("(html:<ul)? (T)? (html:</ul)?") and "(html:<p T html:</p)*" in wrappers.expression(wrapper, 3)
    assert wrappers.fold(["?markdown:1.", "T", "markdown:**", "T", "?markdown:1.", "T"])[0] == (("?markdown:1.",), True)
    long = [(("t%d" % k,), False, 1) for k in range(2000)]
    assert len(wrappers.align(long[:1000], long[1000:])) == wrappers.LONGEST


PAGES = [(i, "shop" if i < 40 else "forum", t) for i, t in enumerate(
    [f'<answer id="{k}">The number {k} is odd.</answer>\n3. Then it holds for {k}.' for k in range(38)]
    + ["The number is even.", "We count <answer> only once."]
    + [f"We have a plain text about {k}." for k in range(36)]
    + ["For <k> in the set it holds.", "3. That is all.", "1. First we see it.\nSo it goes.\n2. Then we **see** it.", None]
)]


@pytest.mark.parametrize("fan_in", [64, 2])
def test_wrapper_decides_what_is_markup(spark, fan_in, monkeypatch):
    """The same tokens: at a fixed place of the host's texts they are markup, elsewhere they are text."""
    infer = wrappers.infer
    monkeypatch.setattr(wrappers, "infer", lambda s: infer(s, fan_in=fan_in))
    df = spark.createDataFrame(PAGES, "id int, host string, text string")
    kinds, found = markup.markup_kinds(df, keys=("id",))
    got = {r.id: set(r.kinds) for r in kinds.collect()}
    assert all(got[i] == {"html", "markdown"} for i in range(38))
    assert 38 not in got and 76 not in got and 77 not in got and got[78] == {"markdown"}
    texts = {r.id: r.text for r in markup.clean_texts(df, keys=("id",)).collect()}
    assert texts[5] == "The number 5 is odd.\n- Then it holds for 5." and texts[76] == "For <k> in the set it holds." and texts[77] == "3. That is all."
    assert texts[78] == "- First we see it.\nSo it goes.\n- Then we see it." and texts[79] is None and len(texts) == len(PAGES)
    # without the wrapper's word these tokens are text
    assert markup.clean(PAGES[5][2]) == PAGES[5][2]
    shop = next(r.wrapper for r in markup.wrapper_expressions(found).collect() if r.host == "shop" and r.cluster == "")
    assert "?html:<answer" in shop and "?markdown:1." in shop


def test_long_streams_are_aligned_as_short_ones():
    """A longest common subsequence at any length, with the pairs that the whole table of lengths gives."""

    def by_table(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a) - 1, -1, -1):
            for j in range(len(b) - 1, -1, -1):
                best[i][j] = 1 + best[i + 1][j + 1] if a[i][0] == b[j][0] else max(best[i + 1][j], best[i][j + 1])
        out, i, j = [], 0, 0
        while i < len(a) and j < len(b):
            if a[i][0] == b[j][0]:
                out.append((i, j))
            here = a[i][0] == b[j][0]
            i, j = i + (here or best[i + 1][j] >= best[i][j + 1]), j + (here or best[i + 1][j] < best[i][j + 1])
        return out

    rng = np.random.default_rng(5)
    for most, kinds in [(9, 2)] * 300 + [(40, 6)] * 100 + [(700, 30)] * 2:
        a, b = ([((f"t{k}",), False, 1) for k in rng.integers(kinds, size=rng.integers(most // 2, most))] for _ in "ab")
        assert wrappers.aligned(a, b) == by_table(a, b)
    tags = [((f"?html:<t{k}",), False, 1) for k in range(600)]
    late = [(("?html:<z",), False, 1)]
    assert wrappers.aligned(tags + late, late + tags) == [(k, k + 1) for k in range(600)]
    assert [x[2] for x in wrappers.align(tags + late, late + tags, longest=None)] == [1, *[2] * 600, 1]
    assert wrappers.aligned(tags, []) == wrappers.aligned([], tags) == wrappers.aligned(tags, late) == []


def test_long_texts_have_whole_wrappers(spark):
    """600 unknown tags that all texts of a host have are markup, though one more stands before or behind them; that one is so where most have it."""
    body = " ".join(f"<t{k}>{k}" for k in range(600))
    df = spark.createDataFrame([(1, "h", f"<zz>0 {body}"), (2, "h", f"{body} <zz>0"), (3, "h", f"{body} 1 <zz>0")], "id int, host string, text string")
    plain = " ".join(map(str, range(600)))
    assert {r.id: r.text for r in markup.clean_texts(df, keys=("id",)).collect()} == {1: f"<zz>0 {plain}", 2: f"{plain} 0", 3: f"{plain} 1 0"}
    kinds, found = markup.markup_kinds(df, keys=("id",))
    assert {r.id: r.kinds for r in kinds.collect()} == {1: ["html"], 2: ["html"], 3: ["html"]}
    fixed = {tuple(tokens) for r in found.collect() for tokens, _, n in wrappers.load(r.blocks) if n == r.n_texts == 3}
    assert {(f"?html:<t{k}",) for k in range(600)} <= fixed


def test_clean_keeps_structure(spark):
    assert markup.clean("<h2>Proof</h2><p>It is $a<b$ &amp; so.</p><ul><li>One</li><li>Two</li></ul>") == "## Proof\nIt is $a<b$ & so.\n\n- One\n- Two"
    assert markup.clean("== Proof ==\n'''It''' uses [[Parity 1|parity]].") == "# Proof\n\nIt uses parity."
    assert markup.clean("\\section*{Proof}\n\\begin{enumerate}\n\\item $x$\n\\end{enumerate}") == "# Proof\n\n- $x$"
    assert "n //= 2" in markup.clean("a\n\n```\nn //= 2\n```\n") and markup.clean("```\n**x**\n```") == "```\n**x**\n```"
    assert markup.clean(None) is None and markup.clean("3 * 6 < 5 and [[1,2],[3,4]]") == "3 * 6 < 5 and [[1,2],[3,4]]"
    df = spark.createDataFrame([(1, "<b>x</b>"), (2, None)], "id int, text string")
    assert {r.id: r.text for r in markup.clean_texts(df, keys=("id",)).collect()} == {1: "x", 2: None}


def test_mixture_meets_targets(spark, small):
    docs, targets = spark.read.parquet(f"{small}/../sf0.01/documents.parquet"), spark.read.parquet(f"{small}/mix_targets.parquet")
    caps = {r.source: r.max_repeats for r in targets.collect()}
    for run in (100_000, 40):
        mixture = mixing.mix_sources(docs, targets, run=run)
        rows = mixture.collect()
        assert rows and all(0 < r.repeats <= caps[r.domain] and (r.source or r.domain) == r.domain for r in rows)
        shares = {r.source: r for r in mixing.reached_shares(mixture, targets).collect()}
        assert set(shares) == set(caps) and shares["brackwater_lists"].reached_share == 0.0
        there = sum(s.target_share for s in shares.values() if s.n_documents)  # a source without documents gives its share to the others
        assert all(abs(s.reached_share - s.target_share / there) < (0.001 if run > 1000 else 0.003) for s in shares.values() if s.n_documents)
    assert mixing.mix_sources(docs.limit(0), targets).count() == 0 and mixing.mix_sources(docs, targets.limit(0)).count() == 0


def test_small_sources_are_repeated_up_to_their_cap(spark):
    docs = spark.createDataFrame([(i, f"alpha beta word{i}", "big" if i % 10 else "rare") for i in range(400)] + [(999, None, "big"), (1000, "no target", "other")], "doc_id bigint, text string, source string")
    targets = spark.createDataFrame([("big", 0.7, 1), ("rare", 0.3, 3)], "source string, target_share double, max_repeats int")
    rows = mixing.mix_sources(docs, targets).collect()
    assert {r.repeats for r in rows if r.domain == "rare"} == {3} and {r.repeats for r in rows if r.domain == "big"} == {1}
    tokens = {d: sum(r.tokens * r.repeats for r in rows if r.domain == d) for d in ("big", "rare")}
    assert abs(tokens["rare"] / sum(tokens.values()) - 0.3) < 0.01 and not {999, 1000} & {r.doc_id for r in rows}


def test_domain_rates_are_projected():
    # half of the soft document's tokens go each way; the second domain is at its cap
    p, tokens, cap = np.array([[1.0, 0.0], [0.0, 1.0], [0.5, 0.5]]), np.array([800.0, 100.0, 200.0]), np.array([4.0, 2.0])
    gram = p.T @ (p * tokens[:, None])
    rates, miss = mixing.fitted_domains(gram, np.array([0.5, 0.5]), cap)
    assert miss < 1e-5 and abs(rates.max() - rates[1]) < 1e-9 and abs(rates[1] - 2) < 1e-5
    supply = gram @ rates
    assert abs(supply[0] / supply.sum() - 0.5) < 1e-5
    assert mixing.fitted_domains(np.zeros((2, 2)), np.array([0.5, 0.5]), cap)[0].tolist() == [0, 0]
    # a document that is half of each cannot give one domain a tenth
    rates, miss = mixing.fitted_domains(np.array([[50.0, 50.0], [50.0, 50.0]]), np.array([0.9, 0.1]), cap)
    assert miss > 0.1
