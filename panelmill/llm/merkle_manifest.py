"""Merkle manifest of a dataset: a content-addressed DAG of digests, and proofs by descent from its root.

The leaves of a group lie in the order of the ids; every ``FAN`` consecutive nodes become the hash of their digests until
one is left, and the groups' own roots likewise give the root. Records map a digest to its children. One record holds the
subtree of PAGE levels below a node by its lowest digests: what is between follows from them, and a request goes down PAGE
levels for one look-up. Leaf requests start at the root with an empty path; at each level the next digit of the leaf's rank
chooses a child, the other children of the run are added to the path, and at the leaf the path is reversed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmill.llm.common import ranked, store
from panelmill.session import Stored

FAN = 2  # nodes of a run; `_depth` holds for two
PAGE = 8  # levels of a record: 256 digests
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<digit: int, others: array<string>>>"


def digest(parts: Sequence[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def field(value: Column) -> Column:
    """A value as it enters the hash: ``-`` for null, else its UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def depth(total: int) -> int:
    """Levels above ``total`` leaves."""
    levels = 0
    while total > 1:
        total = -(-total // FAN)
        levels += 1
    return levels


def _depth(total: Column) -> Column:
    """The same for a column: for runs of two, the binary digits of the last rank."""
    return F.when(total <= 1, 0).otherwise(F.length(F.bin(total - 1)))


def tower(row: Sequence[str], levels: int) -> list[Sequence[str]]:
    """The levels of a record from the lowest upwards; a run at the end may be short, down to one node."""
    out = [row]
    for _ in range(levels):
        row = [digest(row[i: i + FAN]) for i in range(0, len(row), FAN)]
        out.append(row)
    return out


def descend(levels: Sequence[Sequence[str]], place: int) -> list[tuple[int, list[str]]]:
    """(digit, unselected children) of every level on the way down to ``place`` in the lowest one."""
    path = []
    for k in range(len(levels) - 2, -1, -1):
        at = place // FAN**k
        run = at - at % FAN
        path.append((at - run, [*levels[k][run:at], *levels[k][at + 1: run + FAN]]))
    return path


def fold(leaf: str, path: Sequence[tuple[int, Sequence[str]]]) -> str:
    """The root that ``leaf`` leads to; ``path`` from the leaf upwards."""
    for digit, others in path:
        leaf = digest([*others[:digit], leaf, *others[digit:]])
    return leaf


@dataclass
class Manifest:
    """``root`` (None without rows), ``records`` (digest, children), and the tables that requests need."""

    root: str | None
    records: DataFrame  # digest string, children array<string>: one row per different record
    groups: DataFrame  # key, total, subroot, place: one row per group
    depth: int  # levels over the subroots
    requests: DataFrame  # key, page, total, first rank, ids, claims: the leaves below one record


def _pages(nodes: DataFrame, label: str) -> Stored:
    """key, page, total, digest, children, ids, claims of nodes (key, rank, total, height, digest, id, claim).

    ``height`` is the level of the nodes over the leaves. Groups have FAN ** PAGE rows at most.
    """
    wide = FAN**PAGE
    grouped = nodes.groupBy("key", F.floor(F.col("rank") / wide).cast("bigint").alias("page"), "total", "height").agg(
        F.sort_array(F.collect_list(F.struct("rank", "digest", "id", "claim"))).alias("x")
    ).select("key", "page", "total", "height", "x.digest", "x.id", "x.claim")
    kind = nodes.schema["id"].dataType.simpleString()

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tops = [tower(row, min(PAGE, max(0, depth(total) - height)))[-1][0]
                    for row, total, height in zip(b.column(4).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(tops, pa.string()), *b.columns[4:]], ["key", "page", "total", "digest", "children", "ids", "claims"])

    return store(grouped.mapInArrow(
        close, f"key string, page bigint, total bigint, digest string, children array<string>, ids array<{kind}>, claims array<string>"), label)


def _climb(leaves: DataFrame, label: str) -> tuple[list[Stored], DataFrame]:
    """The records of all steps, the leaves' first, and (key, total, digest) of the groups' roots."""
    steps, roots, height = [_pages(leaves.withColumn("height", F.lit(0)), label)], [], 0
    while True:
        height += PAGE
        top = steps[-1].df.select("key", "page", "total", "digest")
        ended = _depth(F.col("total")) <= height
        roots.append(top.where(ended).select("key", "total", "digest"))
        rest = top.where(~ended)
        if rest.isEmpty():
            break
        steps.append(_pages(rest.select(
            "key", F.col("page").alias("rank"), "total", F.lit(height).alias("height"), "digest", F.lit(None).cast("bigint").alias("id"),
            F.lit(None).cast("string").alias("claim")), label))
    out = roots[0]
    for more in roots[1:]:
        out = out.union(more)
    return steps, out


def build_manifest(
    docs: DataFrame, claim: Column | None = None, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", by: str = "lang",
) -> Manifest:
    """The manifest of ``docs``: one leaf per row, groups by ``by`` in byte order with null first, ids ascending.

    ``claim`` is the digest that a later proof starts from, by default the leaf itself. Null fields count as such; rows
    of one id are ordered by their leaves, so that equal rows may take either place. A null id comes first. An empty table
    has no root. Runs jobs when called: one pass over the values, the rest on digests.
    """
    leaf = leaf_digest([F.col(f) for f in fields])
    slim = store(docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(by).cast("string")), F.lit("")).alias("key"), F.col(id_col).alias("id"), leaf.alias("digest"),
        (leaf if claim is None else claim).alias("claim"), F.monotonically_increasing_id().alias("salt")), "merkle-leaves")
    line = ranked(slim.df, ["key", "id", "digest", "salt"], "merkle-line")
    slim.delete()
    groups = store(line.df.groupBy("key").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("total")), "merkle-groups")
    placed = line.df.join(groups.df, "key").select("key", (F.col("rank") - F.col("first")).alias("rank"), "total", "digest", "id", "claim")
    steps, roots = _climb(placed, "merkle-pages")
    line.delete()
    tops = ranked(store(roots, "merkle-roots").df, ["key"], "merkle-tops")  # one row per group
    n = tops.df.count()
    over, summit = _climb(tops.df.select(
        F.lit("").alias("key"), "rank", F.lit(n).cast("bigint").alias("total"), "digest", F.lit(None).cast("bigint").alias("id"),
        F.lit(None).cast("string").alias("claim")), "merkle-over")
    root = summit.head()
    both = [s.df.select("digest", "children") for s in [*steps, *over]]
    records = both[0]
    for more in both[1:]:
        records = records.union(more)
    # a digest stands for its content: equal subtrees share a record
    records = store(records.groupBy("digest").agg(F.first("children").alias("children")), "merkle-records").df
    groups.delete()
    requests = store(steps[0].df.select("key", "page", "total", "ids", "claims"), "merkle-requests").df
    for s in [*steps, *over]:
        s.delete()
    return Manifest(
        root.digest if root else None, records, tops.df.select("key", "total", F.col("digest").alias("subroot"), F.col("rank").alias("place")), depth(n), requests)


def _step(wanted: DataFrame, records: DataFrame, levels_left: Column) -> DataFrame:
    """Requests (key, page, subroot, total, path, digest) moved from their record down to the records or leaves below it."""
    joined = wanted.withColumn("levels", levels_left).join(records, "digest").select("key", "page", "subroot", "total", "path", "levels", "children")
    wide = FAN**PAGE

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.to_pylist():
                levels = tower(x["children"], x["levels"])
                path = [(p["digit"], p["others"]) for p in x["path"]]
                n = len(x["children"])
                yield pa.RecordBatch.from_pylist([
                    {"key": x["key"], "page": x["page"] * wide + i, "subroot": x["subroot"], "total": x["total"], "digest": child,
                     "path": [{"digit": d, "others": o} for d, o in [*path, *descend(levels, i)]]}
                    for i, child in zip(range(n), x["children"])], schema=arrow)

    arrow = pa.schema([
        ("key", pa.string()), ("page", pa.int64()), ("subroot", pa.string()), ("total", pa.int64()), ("digest", pa.string()),
        ("path", pa.list_(pa.struct([("digit", pa.int32()), ("others", pa.list_(pa.string()))])))])
    return joined.mapInArrow(down, f"key string, page bigint, subroot string, total bigint, digest string, path {_PATH}")


def _levels(steps_below: int, total: Column) -> Column:
    """Levels of the records that have ``steps_below`` steps of records under them."""
    return F.least(F.lit(PAGE), F.greatest(F.lit(0), _depth(total) - F.lit(PAGE * steps_below)))


def prove(manifest: Manifest, spark, with_proofs: bool = False) -> DataFrame:
    """One row per leaf: id, leaf, subroot, root, proof_sha256, folded_root, verified; with ``with_proofs`` also proof.

    ``proof`` has the unselected digests of every run from the leaf to the root, left to right; ``folded_root`` is what the
    leaf's claim and they lead to. Runs jobs when called, one join on digests for PAGE levels.
    """
    kind = manifest.requests.schema["ids"].dataType.elementType.simpleString()
    extra = ", proof array<string>" if with_proofs else ""
    schema = f"id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean{extra}"
    if manifest.root is None:
        return spark.createDataFrame([], schema)
    root, n = manifest.root, manifest.groups.count()
    # from the root to the groups
    now = spark.createDataFrame([("", 0, root, n, root, [])], f"key string, page bigint, subroot string, total bigint, digest string, path {_PATH}")
    for below in range(max(1, -(-manifest.depth // PAGE)) - 1, -1, -1):
        now = _step(now, manifest.records, _levels(below, F.col("total")))
    groups = manifest.groups
    now = now.select(F.col("page").alias("place"), "path").join(groups, "place").select(
        "key", F.lit(0).cast("bigint").alias("page"), "subroot", "total", F.col("subroot").alias("digest"), "path")
    # down the groups, the deepest first; the others wait for the step that they begin with
    steps = F.greatest(F.lit(1), F.ceil(_depth(F.col("total")) / F.lit(PAGE)))
    waiting, now = store(now.withColumn("steps", steps), "merkle-waiting").df, None
    most = waiting.agg(F.max("steps")).head()[0]
    for below in range(most - 1, 0, -1):
        here = waiting.where(F.col("steps") == below + 1).drop("steps")
        now = here if now is None else now.unionByName(here)
        now = store(_step(now, manifest.records, _levels(below, F.col("total"))), "merkle-paths").df
    here = waiting.where("steps = 1").drop("steps")
    now = here if now is None else now.unionByName(here)
    # the leaves of one record, with what their requests collect on its levels
    last = now.withColumn("levels", _levels(0, F.col("total"))).drop("total").join(manifest.records, "digest").join(
        manifest.requests.drop("total"), ["key", "page"]).select("subroot", "path", "levels", "children", "ids", "claims")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for j in range(b.num_rows):
                subroot, path, levels, children, claims = (b.column(k)[j].as_py() for k in (0, 1, 2, 3, 5))
                above = [(p["digit"], p["others"]) for p in path]
                rows = tower(children, levels)
                out: list[list] = [[] for _ in range(4)]
                for i, claim in enumerate(claims):
                    way = [*above, *descend(rows, i)][::-1]
                    proof = [x for _, others in way for x in others]
                    folded = fold(claim, way)
                    for column, x in zip(out, (digest(proof), folded, folded == root, proof)):
                        column.append(x)
                n = len(claims)
                yield pa.RecordBatch.from_arrays([
                    b.column(4)[j].values, pa.array(children, pa.string()), pa.array([subroot] * n, pa.string()), pa.array([root] * n, pa.string()),
                    pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.bool_()),
                    *([pa.array(out[3], pa.list_(pa.string()))] if with_proofs else [])],
                    ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", *(["proof"] if with_proofs else [])])

    return last.mapInArrow(answer, schema)


def tampered(doc_id: Column) -> Column:
    """Where 7 divides the unsigned crc32 of the decimal id; a null id is never one."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 0, F.lit(False))


def verify_documents(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    The proof of every document is folded from its leaf as it is now, with 1 added to ``n_chars`` in the tampered rows:
    those do not verify, unless their ``n_chars`` is null. Null values are hashed as such, empty and long texts whole;
    no rows give none.
    """
    more = leaf_digest([F.col(f) if f != "n_chars" else F.col(f).cast("decimal(38,0)") + 1 for f in FIELDS])
    own = leaf_digest([F.col(f) for f in FIELDS])
    manifest = build_manifest(docs, F.when(tampered(F.col("doc_id")) & F.col("n_chars").isNotNull(), more).otherwise(own))
    return prove(manifest, docs.sparkSession).withColumnRenamed("id", "doc_id")
