"""The registered queries over whole tables, against SQL where there is some, and the pipeline stage by stage."""

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from panelmill.llm.decontaminate import plain
from panelmill.llm.minhash_join import shingle_set
from panelmill.llm.prefix_bpe import PrefixBPE
from panelmill.llm.quality_trees import score_quality
from panelmill.llm.queries import ORACLES, QUERIES
from tools.check_oracle import rows

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"create view {t} as select * from read_parquet('{FOLDER}/{t}.parquet')")
    df = QUERIES[name](spark, FOLDER)
    cur = con.execute(ORACLES[name])
    assert rows(df.columns, df.collect()) == rows([d[0] for d in cur.description], cur.fetchall())


def test_all_are_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14)) and {*QUERIES, "pipeline"} <= set(queries())
    assert set(ORACLES) <= set(oracle_sql()) and len(corpus_pipeline.STAGES) == 5


def strip(t):
    return "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    now = {r.doc_id: r.text for r in docs.collect()}
    good = {r.doc_id for r in score_quality(docs, spark.read.parquet(f"{FOLDER}/labels.parquet")).where("predicted = 1").collect()}
    now = {i: t for i, t in now.items() if i in good}
    best = {}
    for i, t in now.items():
        best[strip(t)] = min(best.get(strip(t), (1, 0)), (-len(t), i))
    now = {i: now[i] for _, i in best.values()}
    sets = {i: set(shingle_set(t).tolist()) for i, t in now.items()}
    root = {i: i for i in now}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sorted(now):
        for b in sorted(now):
            if b < a and sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    now = {i: t for i, t in now.items() if find(i) == i}
    items = [plain(r.text).strip() for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    now = {i: t for i, t in now.items() if not any(x in plain(t) for x in items)}
    own = PrefixBPE.from_file(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id for r in got} == set(now) and len(got) == len(now) < docs.count()
    assert all(np.array_equal(r.ids, library.encode_ordinary(now[r.doc_id])) for r in got)


def test_all_but_the_last_stage_return_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(0), FOLDER)
        assert out.columns == docs.columns and out.count() == 0
