"""Exact duplicates: group by a 128-bit content hash, keep one stable id, compare bytes inside the groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmill.llm.common import SPACE, free_name, store, texts


def content_hash(norm: Column) -> Column:
    return F.unhex(F.md5(norm))


def normal_text(text: Column) -> Column:
    return F.translate(text, SPACE, "")


def _best() -> Column:
    """Most code points of the original text first, then the smallest id; a null id comes last."""
    return F.min(F.struct((-F.col("n")).alias("neg"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id")))


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_of: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, hash.

    Texts are equal when they are the same after white space is deleted; a null text is an empty one. Equal texts
    form one group, empty texts too. ``keep_id`` is the id of the row with the longest original text, then the
    smallest id. Rows that repeat the kept id are all ``kept`` (they cannot be told apart); a null id is kept only
    if its group has no other, or a longer text. An empty table gives an empty result.

    The hash groups combine on the map side, so a text that makes up a third of all rows sends one row per task.
    Bytes are compared there as well: the smallest and the largest text of a group are equal exactly if all are.
    A group in which they differ is a collision; its rows are grouped again by the text itself. Rows go back to
    their groups by a join of two plain exchanges, which Spark splits where a hash is frequent. Runs one pass when
    called, to store the groups.
    """
    rows = texts(docs, id_col, text_col).select(
        "doc_id", normal_text(F.col("text")).alias("norm"), F.char_length("text").cast("long").alias("n"))
    hashed = rows.withColumn("hash", hash_of(F.col("norm")))
    groups = store(
        hashed.groupBy("hash").agg(
            F.count(F.lit(1)).alias("group_size"), _best().alias("best"), F.min("norm").alias("low"), F.max("norm").alias("high"))
        .select("hash", "group_size", F.col("best.id").alias("keep_id"), (F.col("low") == F.col("high")).alias("pure")),
        "exact-groups").df
    slim = hashed.select("doc_id", "hash", F.sha2("norm", 256).alias("text_sha256"))
    out = slim.join(groups.where("pure").drop("pure"), "hash")
    mixed = groups.where(~F.col("pure")).select("hash")
    if not mixed.isEmpty():
        torn = hashed.join(mixed, "hash", "left_semi")
        parts = torn.groupBy("hash", "norm").agg(F.count(F.lit(1)).alias("group_size"), _best().alias("best"))
        out = out.unionByName(
            torn.join(parts, ["hash", "norm"])
            .select("doc_id", "hash", F.sha2("norm", 256).alias("text_sha256"), "group_size", F.col("best.id").alias("keep_id")))
    return out.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", "hash")


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all its columns as they were.

    Of rows that share the kept id and the text, one stays.
    """
    key, sha = free_name(docs, "exact_keep_id"), free_name(docs, "exact_sha")
    keep = (exact_groups(docs, id_col, text_col).where("kept")
            .select(F.col("keep_id").alias(key), F.col("text_sha256").alias(sha)).distinct())
    norm = normal_text(F.coalesce(F.col(text_col), F.lit("")))
    left = docs.withColumn(sha, F.sha2(norm, 256))
    found = left.join(keep.withColumnRenamed(sha, sha + "_k"), (F.col(sha) == F.col(sha + "_k")) & F.col(id_col).eqNullSafe(F.col(key)), "left_semi")
    return found.dropDuplicates([id_col, sha]).select(*docs.columns)
