"""The query on repeated passages gives what is left of a text."""

import random

from panelmill.llm.queries import op8_suffix_dedup
from panelmill.llm.suffix_dedup import SPAN


def test_the_query_gives_the_text_that_is_left(spark, tmp_path):
    rnd = random.Random(8)
    fresh = lambda n: "".join(rnd.choice("abcdefg hi") for _ in range(n))
    shared = fresh(SPAN - 2) + "é"
    rows = [(1, "x" + shared + "y"), (2, shared), (3, fresh(500)), (4, None), (5, "中" + "q" * (SPAN + 1)), (6, fresh(20) + shared[:-1])]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op8_suffix_dedup(spark, str(tmp_path)).collect()}
    assert {i: r.text for i, r in got.items()} == {1: "xy", 2: "", 3: rows[2][1], 4: "", 5: "中", 6: rows[5][1]}
    assert all(len(r.text.encode()) == r.n_bytes - r.n_removed for r in got.values())
