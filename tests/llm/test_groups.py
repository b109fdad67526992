"""Exact and near duplicates, and the components both rest on, against brute force."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from panelmill.llm import minhash_join
from panelmill.llm.components import components
from panelmill.llm.exact_dedup import drop_exact, exact_groups
from panelmill.llm.minhash_join import COORDINATES, drop_near, near_groups, shingle_set, signature

SCHEMA = "doc_id bigint, text string, hash string, group_size int, near_id string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 7, "y") for i, t in rows], SCHEMA)


def strip(t):
    return "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")


def exact_expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(strip(t), []).append((-len(t or ""), i is None, i or 0, i))
    best = {k: min(v)[3] for k, v in groups.items()}
    return sorted(((i, best[strip(t)], len(groups[strip(t)]), i == best[strip(t)], hashlib.sha256(strip(t).encode()).hexdigest()) for i, t in rows), key=str)


ROWS = [
    (5, "a b c"), (3, "abc"), (4, " a b c"), (1, None), (2, ""), (6, "\t\n"), (7, "été 😀"), (8, "été😀"), (9, "x" * 200_000),
    (10, "x" * 200_000), (11, "a\xa0bc"), (None, "solo"), (None, "abc"), (12, "twice"), (12, "twice"),
]


@pytest.mark.parametrize("collide", [False, True])
def test_exact_groups(spark, collide):
    hash_of = (lambda c: F.lit("same").cast("binary")) if collide else None
    got = exact_groups(frame(spark, ROWS), **({"hash_of": hash_of} if collide else {})).drop("hash")
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == exact_expected(ROWS)


def test_drop_exact_keeps_one_row_and_all_columns(spark):
    docs = frame(spark, ROWS)
    out = drop_exact(docs)
    assert out.columns == docs.columns
    kept = sorted(r.doc_id if r.doc_id is not None else -1 for r in out.collect())
    assert kept == [-1, 4, 6, 7, 9, 11, 12]


def test_no_rows(spark):
    none = frame(spark, [])
    assert exact_groups(none).count() == near_groups(none).count() == drop_exact(none).count() == drop_near(none).count() == 0


def test_components_of_a_path_a_ring_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 102), (102, 100)] + [(200, 200 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r.u: r.v for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).df.collect()}
    assert got == {i: 1 for i in range(2, 41)} | {101: 100, 102: 100} | {200 + i: 200 for i in range(1, 30)}


def near_expected(rows):
    sets = [set(shingle_set(t or "").tolist()) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return sorted(((d, len(sets[i]), low.get(find(i)) if sets[i] else d, d == (low.get(find(i)) if sets[i] else d)) for i, (d, _) in enumerate(rows)), key=str)


def near_rows():
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    base = [rnd.choice(words) for _ in range(150)]
    rows = [(1, " ".join(base)), (2, " ".join(base).upper()), (3, "\n".join(base)), (4, None), (5, ""), (6, " \t"), (7, "one two"), (8, "One\ttwo"),
            (9, "one two three"), (None, "one two"), (11, " ".join(base)), (11, " ".join(base)), (12, "É t"), (13, "é t")]
    for k in range(90):  # a family around the threshold: chains that only some members link
        copy = list(base)
        for _ in range(rnd.randint(1, 9)):
            copy[rnd.randrange(len(copy))] = rnd.choice(words)
        rows.append((100 + k, " ".join(copy)))
    rows += [(300 + k, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 40)))) for k in range(30)]
    return rows


@pytest.mark.parametrize("tile", [500_000, 700])
def test_near_groups(spark, monkeypatch, tile):
    monkeypatch.setattr(minhash_join, "TILE", tile)
    rows = near_rows()
    got = near_groups(frame(spark, rows)).select("doc_id", "n_shingles", "component_id", "kept")
    assert sorted((tuple(r) for r in got.collect()), key=str) == near_expected(rows)


def test_drop_near_keeps_one_of_each_group(spark):
    rows = near_rows()
    out = drop_near(frame(spark, rows))
    assert len(out.columns) == 5
    ids = [r.doc_id for r in out.collect()]
    want = [d for d, _, _, kept in near_expected(rows) if kept]
    assert sorted(i for i in ids if i is not None) == sorted(set(i for i in want if i is not None))


def test_shingles_are_ascii_words():
    assert len(shingle_set("a b c d e")) == 1 and len(shingle_set("a b c d e f")) == 2 and len(shingle_set("a b")) == 1
    assert (shingle_set("A B") == shingle_set("a\x0bb")).all() and not (shingle_set("É x") == shingle_set("é x")).all()
    assert len(shingle_set("a\xa0b c d e f")) == 1  # a no-break blank is part of a word
    assert len(shingle_set("x " * 5000)) == 1


def test_signatures_agree_as_the_sets_do():
    rnd = random.Random(1)
    a = [f"w{rnd.randrange(10**6)}" for _ in range(3000)]
    b = a[:2571] + [f"v{i}" for i in range(429)]
    x, y = shingle_set(" ".join(a)), shingle_set(" ".join(b))
    true = len(set(x.tolist()) & set(y.tolist())) / len(set(x.tolist()) | set(y.tolist()))
    agree = (signature(x) == signature(y)).mean()
    assert abs(agree - true) < 4 * (true * (1 - true) / COORDINATES) ** 0.5
    assert minhash_join.MATCHES < 0.75 * COORDINATES - 5 * (COORDINATES * 0.75 * 0.25) ** 0.5
