"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard stands at many places of a ring of 64-bit hashes. A key belongs to the first place clockwise from its own
hash; where that shard is full it goes on to the next place whose shard is not. Which keys that are follows from the
totals of the arcs between the places alone: they are settled on the driver (as many numbers as places, whatever the
number of rows), and each row finds its shard from its place in the order of the ring.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.llm.common import ranked, store

PLACES = 128  # of each shard on the ring


def ring(shards: int, places: int = PLACES) -> tuple[np.ndarray, list[int]]:
    """(positions, shards) in clockwise order; the positions of a shard do not depend on the number of shards."""
    found = sorted(
        (int.from_bytes(hashlib.blake2b(f"{s}/{k}".encode(), digest_size=8).digest(), "big", signed=True), s)
        for s in range(shards) for k in range(places))
    return np.array([p for p, _ in found], np.int64), [s for _, s in found]


def room(total: int, shards: int, slack: float = 0.0) -> list[int]:
    """Bound of each shard's load. Without slack the bounds add up to the total and differ by 1 at most."""
    if slack:
        return [int(np.ceil(total * (1 + slack) / shards))] * shards
    return [total // shards + (s < total % shards) for s in range(shards)]


def settle(arcs: Sequence[int], owners: Sequence[int], bounds: Sequence[int]) -> list[tuple[int, int, int]]:
    """Pieces (first, end, shard) of the line on which all keys lie in the order of the ring.

    ``arcs`` has the load up to each place, and last the load beyond the last place, which is the first one's. All keys
    try the first shard clockwise, those beyond its bound the next place, and so on until none is left.
    """
    if sum(bounds) < sum(arcs):
        raise ValueError("the bounds are smaller than the load")
    left, waiting, pieces, at = list(bounds), [], [], 0
    for i, load in enumerate(arcs):
        if load:
            waiting.append((i % len(owners), at, at + load))
        at += load
    while waiting:
        over = []
        for place, first, end in waiting:
            s = owners[place]
            here = min(left[s], end - first)
            if here:
                pieces.append((first, first + here, s))
                left[s] -= here
            if first + here < end:
                over.append(((place + 1) % len(owners), first + here, end))
        waiting = over
    return sorted(pieces)


def assign_shards(
    docs: DataFrame, shards: int = 8, law: str = "rows", slack: float = 0.0, places: int = PLACES, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``law`` names what is bounded: ``rows`` (counts differ by one at most) or ``bytes`` (each shard has its equal part of
    all sizes, give or take a document for each piece of the ring). With ``slack`` a shard may hold that share more than
    its part; fewer keys overflow then, and fewer move when a shard is added. ``size`` is the number of UTF-8 bytes plus 1
    (a null text: 1), ``slot`` counts the rows of a shard from 0 in the order of the ring. ``grown_shard`` is null: with
    bounded loads the other keys decide too, so no key alone says where it goes.

    The key is the id; rows of one id, null too, lie side by side on the ring and overflow like others, however many they
    are. Equal rows can't be told apart and take neighbouring slots. No rows give none. Runs jobs when called: one pass
    over the texts, the rest on rows of a few numbers.
    """
    if law not in ("rows", "bytes"):
        raise ValueError("law is rows or bytes")
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = store(docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(data) + F.lit(1)).cast("long").alias("size"), F.crc32(data).alias("text_crc32"),
        F.xxhash64(F.col(id_col).cast("string")).alias("position"), F.monotonically_increasing_id().alias("salt")), "ring-rows")
    positions, owners = ring(shards, places)
    weight = "size" if law == "bytes" else None
    line = ranked(rows.df, ["position", "doc_id", "text_crc32", "size", "salt"], "ring-line", weight)
    rows.delete()

    def loads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            arc = np.searchsorted(positions, b.column(0).to_numpy())
            n = np.bincount(arc, b.column(1).to_numpy() if weight else None, len(positions) + 1).astype(np.int64)
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], ["arc", "load"])

    arcs = [0] * (len(positions) + 1)
    for r in line.df.select("position", "size").mapInArrow(loads, "arc bigint, load bigint").groupBy("arc").agg(F.sum("load").alias("load")).collect():
        arcs[r.arc] = r.load  # one row a place
    pieces = settle(arcs, owners, room(sum(arcs), shards, slack))
    begin = np.array([p[0] for p in pieces], np.int64)
    owner = np.array([p[2] for p in pieces], np.int32)
    if weight:  # the number of rows of a piece does not follow from its bytes
        def which(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                at = np.searchsorted(begin, b.column(0).to_numpy(), side="right") - 1
                yield pa.RecordBatch.from_arrays([pa.array(at), b.column(1)], ["piece", "rank"])

        seen = {r.piece: r for r in line.df.select("before", "rank").mapInArrow(which, "piece bigint, rank bigint")
                .groupBy("piece").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n")).collect()}
        counts = [(seen[k].first, seen[k].n) if k in seen else (0, 0) for k in range(len(pieces))]
    else:
        counts = [(first, end - first) for first, end, _ in pieces]
    filled, base = [0] * shards, []
    for (_, n), s in zip(counts, owner.tolist()):
        base.append(filled[s])
        filled[s] += n
    shift = np.array(base, np.int64) - np.array([c[0] for c in counts], np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.searchsorted(begin, b.column(4).to_numpy(), side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array([law] * b.num_rows, pa.string()), pa.array(owner[at]), pa.array(b.column(3).to_numpy() + shift[at]),
                 pa.nulls(b.num_rows, pa.int32())],
                ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"])

    kind = docs.schema[id_col].dataType.simpleString()
    return line.df.select("doc_id", "size", "text_crc32", "rank", "before").mapInArrow(
        deal, f"doc_id {kind}, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int")
