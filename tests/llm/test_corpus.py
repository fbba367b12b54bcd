"""Leaks and shared spans against brute force."""

import random
import re
from itertools import combinations

import pytest

from grainloom.llm import spans
from grainloom.llm.contamination import find_leaks

WORD = re.compile(r"[^\W_]+")


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id bigint, text string, cls string, item_id int")


def items(spark, rows):
    return spark.createDataFrame([(i, "s", q, s, 3) for i, q, s in rows], "item_id bigint, suite string, question string, solution string, doc_id int")


@pytest.mark.parametrize("block", [8_000_000, 2_000])
def test_leaks_against_brute_force(spark, block):
    rng = random.Random(5)
    word = lambda: rng.choice(["Größe", "élan", "x1", "the", "of", "27", "Доска", "a", "b"])
    tests = [(i, " ".join(word() for _ in range(rng.randint(5, 40))), " ".join(word() for _ in range(rng.randint(0, 60)))) for i in range(40)] + [(90, None, "short"), (91, "", None)]
    corpus = []
    for i in range(200):
        text = [word() for _ in range(rng.randint(0, 120))]
        if i % 3 == 0:
            source = rng.choice(tests[:40])[rng.choice([1, 2])].split()
            at = rng.randrange(len(source) + 1)
            text[rng.randrange(len(text) + 1) :][:0] = []
            text = text[:7] + source[at : at + rng.choice([11, 12, 30])] + text[7:]
        joined = "".join(w.upper() + rng.choice([" ", ", ", "_", "\n- "]) if i % 5 == 0 else w + " " for w in text)
        corpus.append((i, joined))
    corpus += [(900, None), (901, ""), (902, " ".join(["filler"] * 3000) + " " + tests[0][1] + " tail" * 3000), (3, corpus[3][1])]
    grams = {}
    for i, q, s in tests:
        for t in (q, s):
            w = WORD.findall((t or "").casefold())
            for k in range(len(w) - 11):
                grams.setdefault(tuple(w[k : k + 12]), set()).add(i)
    expected = set()
    for d, t in corpus:
        w = WORD.findall((t or "").casefold())
        for k in range(len(w) - 11):
            expected |= {(i, d) for i in grams.get(tuple(w[k : k + 12]), ())}
    got = [(r.item_id, r.doc_id) for r in find_leaks(docs(spark, corpus), items(spark, tests), max_block_chars=block).collect()]
    assert len(got) == len(set(got)) and set(got) == expected and expected
    assert find_leaks(docs(spark, []), items(spark, tests)).count() == 0 and find_leaks(docs(spark, corpus), items(spark, [])).count() == 0


def shares(a, b, n):
    seen = {a[i : i + n] for i in range(len(a) - n + 1)}
    return any(b[i : i + n] in seen for i in range(len(b) - n + 1))


def corpus_with_spans(seed=1):
    rng = random.Random(seed)

    def text(n):
        kind = rng.random()
        if kind < 0.6:
            return " ".join("".join(rng.choice("abcdeé😀") for _ in range(rng.randint(1, 9))) + rng.choice(["", ".", ", $x_1$"]) for _ in range(n // 6))[:n]
        if kind < 0.8:
            return "".join(rng.choice("abcdefgh") for _ in range(n))  # one endless word
        return (rng.choice(["ab", "-", "= ", "xyz. "]) * n)[:n]

    texts = [text(rng.randint(0, 900)) for _ in range(60)]
    for _ in range(110):
        a = rng.choice(texts)
        at = rng.randrange(len(a) + 1)
        part = a[at : at + rng.choice([150, 199, 200, 201, 260, 400])]
        texts.append(text(rng.randint(0, 150)) + part + text(rng.randint(0, 150)))
    return [(i, t) for i, t in enumerate(texts)] + [(500, texts[3]), (501, None), (502, "")]


@pytest.mark.parametrize("hot", [64, 2])
def test_shared_spans_against_brute_force(spark, hot, monkeypatch):
    rows = corpus_with_spans()
    expected = {(i, j) for (i, a), (j, b) in combinations([(i, t) for i, t in rows if t is not None], 2) if len(a) >= 200 and len(b) >= 200 and shares(a, b, 200)}
    original = spans.shared_spans
    monkeypatch.setattr(spans, "shared_spans", lambda *a, **k: original(*a, **k, hot=hot))
    got = {(r.doc_a, r.doc_b) for r in spans.sharing_pairs(docs(spark, rows), min_chars=200).collect()}
    assert got == expected and len(expected) > 20


def test_portions(spark):
    rng = random.Random(2)
    make = lambda n: "".join(rng.choice("abcdefghij klmnop") for _ in range(n))
    shared, other = make(300), make(500)
    rows = [(1, make(100) + shared + make(50)), (2, shared + make(70)), (3, other), (4, other), (5, ""), (6, None), (7, make(600)), (7, make(5))]
    got = {(r.doc_id, r.n_chars): r for r in spans.shared_portions(docs(spark, rows[:7]), min_chars=200).collect()}
    assert got[(1, 450)].n_shared in range(300, 304)
    assert got[(3, 500)].share == 1.0 and got[(3, 500)].class_id == 3 and got[(4, 500)].class_id == 3 and got[(4, 500)].n_copies == 2
    assert got[(5, 0)].share == 0.0 and got[(7, 600)].n_shared == 0 and len(got) == 6
    assert spans.shared_portions(docs(spark, [])).count() == 0 and spans.sharing_pairs(docs(spark, [])).count() == 0


def test_anchors_do_not_depend_on_the_block():
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(60, 130)))[: rng.randint(400, 460)] for _ in range(200)]
    where, names, places = spans.anchors(texts, 400)
    for k, text in enumerate(texts):
        _, own_names, own_places = spans.anchors([text], 400)
        assert sorted(zip(own_names.tolist(), own_places.tolist())) == sorted(zip(names[where == k].tolist(), places[where == k].tolist()))
