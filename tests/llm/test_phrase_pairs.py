"""Pairs too rare for any phrase end a suffix."""

import numpy as np
import pyarrow as pa
import pytest

from panelmill.llm import phrase_trees
from panelmill.llm.phrase_trees import Known, Suffixes, collocations, count_phrases
from tests.llm.test_phrases import corpus, expected, frame


def tokens(text):
    return [pa.array(phrase_trees.words(text.encode()), pa.binary())]


def test_a_suffix_ends_before_a_rare_pair(spark):
    rows = [("a b c d", "en")] * 5 + [("a b x", "en"), ("c d a", "en"), ("a b", "de")]
    words = np.full(1 << 10, 255, np.uint8)
    pairs = phrase_trees._pairs(phrase_trees._texts(frame(spark, rows), "text", "lang"), 100, 5, words)
    s = Suffixes.of("en", tokens("a b c d a. c d b a b x"), Known(words, pairs))
    found = [" ".join(s.book[c[i] - 1].as_py().decode() for c in s.columns if c[i]) for i in range(len(s.count))]
    assert found == ["a b c d", "b c d", "c d", "d", "a", "c d", "d", "b", "a b", "b", "x"]
    assert all(c == 0 for c in Suffixes.of("de", tokens("a b"), Known(words, pairs)).columns[1])


@pytest.mark.parametrize(("pairs", "most"), [(4_000_000, 1 << 29), (10, 1 << 15)])
def test_few_rows_travel_and_all_phrases_are_found(spark, monkeypatch, pairs, most):
    for name, value in (("PAIRS", pairs), ("MOST", most), ("_FLUSH", 200), ("WORDS", 1 << 20)):
        monkeypatch.setattr(phrase_trees, name, value)
    sent = []
    real = phrase_trees._blocks
    monkeypatch.setattr(phrase_trees, "_blocks", lambda rows, hot, group_of, known: sent.append(known) or real(rows, hot, group_of, known))
    rows = corpus()
    got = [tuple(r) for r in collocations(frame(spark, rows), least=8, top=50).collect()]
    assert sorted(got) == expected(rows, 8, 50)
    assert 0 < np.unpackbits(sent[0].pairs).sum() < 500


def test_no_pair_is_frequent(spark):
    nodes, _ = count_phrases(frame(spark, [(f"a b{i} c{i}", "en") for i in range(9)]), least=4)
    assert [tuple(r) for r in nodes.df.collect()] == [("en", "a", 1, 9)]
