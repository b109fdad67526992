"""Near duplicates: an inverted join over the coordinates of MinHash signatures.

A signature has COORDINATES values; a document is posted under each (coordinate, value). Two documents whose sets
have a similarity of 0.75 agree in 36 of 48 coordinates on average, and in fewer than MATCHES = 18 less than once in
ten million times. So the task is to find all pairs with that many common postings:

* skip: a document with fewer than MATCHES postings that anyone shares cannot be in a pair;
* prefix: of m shared postings only the m - MATCHES + 1 rarest are merged, since pairs with enough collisions meet
  in one of those; long lists stay out of it and are counted by comparing signatures;
* lists are first merged with their smallest member, their leader, only. Pairs that are confirmed on the full sets
  become components. Documents that share a list share its leader, so what is then in different components under one
  leader is counted set against set inside tasks that hold a bounded part of the group each. Only links leave a task:
  a large group of copies costs as many rows as it has members, and no pair of different texts is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmill.llm.common import free_name, slices, store, texts
from panelmill.llm.components import components
from panelmill.session import Stored

WORDS, COORDINATES, MATCHES = 5, 48, 18
#: Shingles of the sets in one tile of a group.
TILE = 500_000
#: A pair is linked if 100 * common >= PERCENT * union.
PERCENT = 75
_random = np.random.default_rng(20240229)
_MIX = _random.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = _random.integers(0, 2**63, COORDINATES, dtype=np.uint64)[:, None]
_SCALE = (_random.integers(0, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[:, None]
_CHUNK = 1024


def shingle_set(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct runs of ``words`` words; fewer words make one run; none, an empty set."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z only, and only ASCII white space
    if not parts:
        return np.zeros(0, np.uint64)
    w = pd.util.hash_array(np.array(parts, dtype=object), categorize=False)
    size = min(words, len(w))
    s = np.full(len(w) - size + 1, size, np.uint64)
    for j in range(size):
        s += w[j: len(w) - size + 1 + j] * _MIX[j]
    s ^= s >> np.uint64(32)
    s *= _MIX[63]
    s ^= s >> np.uint64(29)
    return np.unique(s)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The smallest of 32-bit hashes of the set, for each of the hash functions."""
    low = np.full(COORDINATES, 2**32 - 1, np.uint64)
    for i in range(0, len(shingles), _CHUNK):
        low = np.minimum(low, (((shingles[None, i: i + _CHUNK] ^ _FLIP) * _SCALE) >> np.uint64(32)).min(1))
    return low.astype(np.uint32).view(np.int32)


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_key, n_shingles, node (a 128-bit hash of the set; null for an empty one), sig."""
    rows = texts(docs, id_col, text_col).withColumn("text_key", F.unhex(F.md5("text")))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            sizes, nodes, sigs = [], [], []
            for text in b.column(1).to_pylist():
                s = shingle_set(text)
                sizes.append(len(s))
                nodes.append(hashlib.md5(s.tobytes()).digest() if len(s) else None)
                sigs.append(signature(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), pa.array(sigs, pa.list_(pa.int32()))],
                ["doc_id", "text_key", "n_shingles", "node", "sig"])

    return rows.mapInArrow(sketch, f"doc_id {kind}, text_key binary, n_shingles bigint, node binary, sig array<int>")


def _agree(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda s, x: s + x)


def _shape(a: str, b: str) -> Column:
    """What set sizes allow: the smaller set has to be PERCENT of the larger one at least."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT


def _alike(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Those of (u, v) that agree in MATCHES coordinates and whose set sizes allow a link."""
    side = nodes.select("node", "n_shingles", "sig")
    return (pairs.join(side.toDF("u", "n_u", "sig_u"), "u").join(side.toDF("v", "n_v", "sig_v"), "v")
            .where(_shape("n_u", "n_v")).where(_agree(F.col("sig_u"), F.col("sig_v")) >= MATCHES).select("u", "v"))


def _full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, shingles) of the wanted nodes, counted again from one text of each."""
    rows = texts(docs, id_col, text_col).withColumn("text_key", F.unhex(F.md5("text")))
    chosen = wanted.select("node", F.col("text_key").alias("key"), F.col("doc_id").alias("id"))
    found = rows.join(chosen, (F.col("text_key") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("id"))).select("node", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            sets = [shingle_set(t).view(np.int64) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])

    return found.mapInArrow(count, "node binary, shingles array<bigint>").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of (u, v) that the full sets link."""
    both = pairs.join(sets.toDF("u", "set_u"), "u").join(sets.toDF("v", "set_v"), "v")
    common = F.size(F.array_intersect("set_u", "set_v")).alias("common")
    return (both.select("u", "v", common, (F.size("set_u") + F.size("set_v")).alias("total"))
            .where(100 * F.col("common") >= PERCENT * (F.col("total") - F.col("common"))).select("u", "v"))


def _linked(index: list[tuple], probes: list[tuple], joined: dict) -> Iterator[tuple]:
    """(u, v) of links between probes and indexed sets of other components.

    Rows are (node, root, shingles). The index is an inverted list; a probe counts what it has in common with all.
    ``joined`` leads from root to root through the links yielded so far, and a link inside one such tree adds nothing:
    a tile yields fewer links than it has components.
    """

    def top(x: bytes) -> bytes:
        while (up := joined.get(x, x)) != x:
            joined[x] = joined.get(up, up)
            x = up
        return x

    sizes = np.array([len(x[2]) for x in index])
    flat = np.concatenate([np.asarray(x[2], np.int64) for x in index])
    order = np.argsort(flat, kind="stable")
    keys, owner = flat[order], np.repeat(np.arange(len(index)), sizes)[order]
    for node, root, shingles in probes:
        own = np.asarray(shingles, np.int64)
        low, high = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
        n = high - low
        post = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        common = np.bincount(owner[post], minlength=len(index))
        for k in np.flatnonzero(100 * common >= PERCENT * (sizes + len(own) - common)).tolist():
            a, b = top(root), top(index[k][1])
            if a != b:
                joined[max(a, b)] = min(a, b)
                yield node, index[k][0]


def _across(stars: DataFrame, roots: DataFrame, nodes: DataFrame, sets: DataFrame, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Links between different components under one leader.

    Each member is indexed in one tile of its group, of TILE shingles, and what is outside the group's most frequent
    component is compared with all tiles.
    """
    under = stars.select(F.col("v").alias("leader"), F.col("u").alias("node"))
    under = under.union(under.select("leader", F.col("leader").alias("node")).distinct())
    members = keep(
        under.join(roots, "node", "left").select("leader", "node", F.coalesce("root", "node").alias("root"))
        .join(nodes.select("node", "n_shingles"), "node"), "minhash-under")
    parts = members.groupBy("leader", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("size"))
    groups = keep(
        parts.groupBy("leader").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count(F.lit(1)).alias("roots"), F.ceil(F.sum("size") / TILE).alias("tiles"))
        .where("roots > 1").drop("roots"), "minhash-mixed")
    mixed = members.join(groups, "leader").select(
        "leader", "node", "root", (F.col("root") != F.col("main")).alias("odd"), F.col("tiles").cast("int").alias("tiles"))
    mixed = keep(mixed, "minhash-split")
    rows = mixed.select("leader", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int").alias("tile"), F.lit(0).alias("role"), "node", "root").union(
        mixed.where("odd").select("leader", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"), F.lit(1), "node", "root"))
    dealt = rows.join(sets, "node").select("leader", "tile", "role", "node", "root", "shingles").repartition("leader", "tile").sortWithinPartitions("leader", "tile", "role")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(group: tuple[list, list]) -> pa.RecordBatch:
            links = list(_linked(*group, joined)) if group[0] and group[1] else []
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.binary()) for k in (0, 1)], ["u", "v"])

        at, group, joined = None, ([], []), {}
        for b in batches:
            heads, sets = list(zip(*(c.to_pylist() for c in b.columns[:5]))), b.column(5)
            for j, (leader, tile, role, node, root) in enumerate(heads):
                if (leader, tile) != at or role == 1 and len(group[1]) >= 1000:
                    yield found(group)
                    if (leader, tile) == at:
                        group = (group[0], [])
                    else:
                        at, group, joined = (leader, tile), ([], []), {}
                group[role].append((node, root, sets[j].values.to_numpy(zero_copy_only=False)))
        yield found(group)

    return dealt.mapInArrow(compare, "u binary, v binary")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, and node, root, text_key for further use.

    Words are separated by ASCII white space and lower-cased A-Z; the set of a text holds its distinct runs of five
    words, or all its words as one run if it has fewer. Null and blank texts have an empty set and are linked with
    nothing. ``component_id`` is the smallest id that links lead to, the document's own included; an id that is null
    only counts if there is no other. Equal sets are one node; repeated rows are members of it, each on its own row.
    An empty table gives an empty result. Runs jobs when called; every table that is read twice is stored.
    """
    used: list[Stored] = []

    def keep(df: DataFrame, label: str) -> DataFrame:
        used.append(store(df, label))
        return used[-1].df

    every = store(sketches(docs, id_col, text_col), "minhash-sketches").df
    nodes = keep(
        every.where("node is not null").groupBy("node").agg(
            F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"),
            F.min(F.struct("doc_id", "text_key")).alias("one"))
        .select("node", "first_id", "n_shingles", "sig", F.col("one.text_key").alias("text_key"), F.col("one.doc_id").alias("doc_id")),
        "minhash-nodes")

    postings = nodes.select("node", F.posexplode("sig").alias("at", "value")).select(
        "node", (F.shiftleft(F.col("at").cast("bigint"), 32) + F.col("value")).alias("post"))
    shared = keep(postings.groupBy("post").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("leader")).where("n > 1"), "minhash-shared")
    merged = (postings.join(shared, "post").groupBy("node")
              .agg(F.sort_array(F.collect_list(F.struct("n", "post", "leader"))).alias("posts")).where(F.size("posts") >= MATCHES))
    prefixes = keep(merged.select("node", F.slice("posts", 1, F.size("posts") - MATCHES + 1).alias("posts")), "minhash-prefixes")

    stars = prefixes.select(F.col("node").alias("u"), F.explode(F.array_distinct(F.col("posts.leader"))).alias("v")).where("u <> v")
    first = _alike(stars, nodes)
    ends = stars.select(F.col("u").alias("node")).union(stars.select(F.col("v").alias("node"))).distinct()
    sets = keep(_full_sets(docs, nodes.join(ends, "node", "left_semi"), id_col, text_col), "minhash-sets")
    links = keep(_confirmed(first, sets), "minhash-links")
    used.append(components(links))
    roots = used[-1].df.toDF("node", "root")
    more = keep(_across(stars, roots, nodes, sets, keep), "minhash-more")
    if not more.isEmpty():
        used.append(components(roots.toDF("u", "v").union(more)))
        roots = used[-1].df.toDF("node", "root")

    member = nodes.select("node", "first_id").join(roots, "node", "left").select(
        "node", "first_id", F.coalesce("root", "node").alias("root"))
    member = keep(member, "minhash-members")
    least = keep(member.groupBy("root").agg(F.min("first_id").alias("component_id")), "minhash-least")
    ids = store(member.join(least, "root").select("node", "root", "component_id"), "minhash-ids").df
    for table in used:  # all but the sketches and the ids, which the result reads
        table.delete()
    return (every.select("doc_id", "n_shingles", "node", "text_key").join(ids, "node", "left")
            .withColumn("component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
            .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
                    "node", "root", "text_key"))


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group, all its columns as they were; empty texts all stay."""
    id_name, key_name, own = (free_name(docs, x) for x in ("near_id", "near_key", "near_text_key"))
    keep = (near_groups(docs, id_col, text_col).where("kept").groupBy("doc_id", F.coalesce("root", "text_key").alias("root"))
            .agg(F.min("text_key").alias(key_name)).select(F.col("doc_id").alias(id_name), key_name).distinct())
    left = docs.withColumn(own, F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")))))
    found = left.join(keep, F.col(id_col).eqNullSafe(F.col(id_name)) & (F.col(own) == F.col(key_name)), "left_semi")
    return found.dropDuplicates([id_col, own]).select(*docs.columns)
