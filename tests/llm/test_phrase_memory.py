"""Pairs that many tasks send meet in little memory."""

import tracemalloc

import numpy as np

from panelmill.llm import phrase_trees


def test_pairs_of_many_tasks_meet_in_little_memory():
    rnd = np.random.default_rng(5)
    sent = [np.unique(np.concatenate(([0, 2**32 - 1], rnd.integers(0, 2**20, 100_000) << 12))).astype(np.uint64) for _ in range(10)]
    counts = [rnd.integers(1, 31, len(x)).astype(np.uint64) for x in sent]
    total = {}
    for b, n in zip(np.concatenate(sent).tolist(), np.concatenate(counts).tolist()):
        total[b] = total.get(b, 0) + n
    waiting = [b << np.uint64(32) | n for b, n in zip(sent, counts)]
    size = sum(x.nbytes for x in waiting)
    tracemalloc.start()
    got = phrase_trees._often(waiting, 30)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.dtype == np.int64 and got.tolist() == sorted(b for b, n in total.items() if n >= 30)
    assert not waiting and peak < 4 * size
