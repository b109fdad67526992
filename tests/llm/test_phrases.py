"""Collocations against counting all phrases of all texts."""

import random
import re
from collections import Counter

import pytest

from panelmill.llm import phrase_trees
from panelmill.llm.phrase_trees import collocations, count_phrases

SCHEMA = "doc_id bigint, text string, lang string, rank int, f string, phrase string, c int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, 1, "f", "p", 2) for i, (t, g) in enumerate(rows)], SCHEMA)


def counted(rows):
    f, n = Counter(), Counter()
    for text, lang in rows:
        g = lang if lang is not None else "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            a = re.findall(r"[^\x20\x09]+", piece)
            n[g] += len(a)
            f.update((g, tuple(a[i: i + k])) for k in range(1, 5) for i in range(len(a) - k + 1))
    return f, n


def expected(rows, least, top):
    f, n = counted(rows)
    found = {x: c for x, c in f.items() if len(x[1]) > 1 and c >= least}
    out = {}
    for (g, p), a in found.items():
        inside = any(
            p == q[i: i + len(p)] and 100 * b >= 80 * a
            for (g2, q), b in found.items() if g2 == g and len(q) > len(p) for i in range(len(q) - len(p) + 1))
        if not inside:
            s, k = min((2_000_000 * a // (f[g, p[:k]] + f[g, p[k:]]), k) for k in range(1, len(p)))
            out.setdefault(g, []).append((-s, -a, " ".join(p).encode(), f[g, p[:k]], f[g, p[k:]]))
    return sorted(
        (g, r + 1, p.decode(), -a, left, right, n[g], -s) for g, all_ in out.items() for r, (s, a, p, left, right) in enumerate(sorted(all_)[:top]))


def corpus():
    rnd = random.Random(5)
    common = [f"w{i}" for i in range(12)] + ["The", "the", "Été", "naïve", "a\x00b", "x\x1fy", " "]
    rows = [(None, None), ("", "en"), (" \t\n", "de"), ("solo", None), (". , ;", "en"), ("the the the the the the", "en"), ("the cat " * 9000, "fr"), ("x", "only")]
    for _ in range(120):
        words = [rnd.choice(common) for _ in range(rnd.randint(1, 60))]
        rows.append((rnd.choice((" ", "  ", "\t")).join(w + rnd.choice(("", "", "", ".", ",", "\r", ":")) for w in words), rnd.choice(("en", "en", None, "de", "und"))))
    return rows + [("a stated passage that many texts share as it is", "en")] * 40


@pytest.mark.parametrize(("budget", "limit", "flush"), [(1_500_000, 1_000_000, 1 << 21), (40, 20, 300), (8, 2, 100)])
def test_collocations(spark, monkeypatch, budget, limit, flush):
    for name, value in (("BUDGET", budget), ("LIMIT", limit), ("_FLUSH", flush)):
        monkeypatch.setattr(phrase_trees, name, value)
    monkeypatch.setattr(phrase_trees, "WORDS", 64 if budget == 40 else 1 << 20)
    rows = corpus()
    got = collocations(frame(spark, rows).repartition(5), least=5, top=25)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == expected(rows, 5, 25)


def test_nodes_are_all_frequent_phrases(spark, monkeypatch):
    monkeypatch.setattr(phrase_trees, "LIMIT", 10)
    rows = corpus()
    nodes, totals = count_phrases(frame(spark, rows), least=4)
    f, n = counted(rows)
    assert {(r.lang, r.phrase): r.f for r in nodes.df.collect()} == {(g, " ".join(p)): c for (g, p), c in f.items() if c >= 4}
    assert {r.lang: r.n for r in totals.collect()} == {g: c for g, c in n.items() if c}


def test_no_rows(spark):
    assert collocations(frame(spark, [])).count() == 0
