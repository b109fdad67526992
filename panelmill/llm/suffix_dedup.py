"""Repeated passages: bytes covered by a SPAN-byte string that starts anywhere else too.

One task cannot sort the suffixes of a corpus, so the corpus is first cut where equal strings must meet. Each run of
SPAN bytes has an anchor: of its GRAM-byte strings the one with the smallest hash, which is the same in every copy of
the run. The runs with one anchor are a stretch of text. Equal stretches are repeated as a whole: they are told by a
128-bit digest of their bytes and need no sorting. Different stretches around equal anchors are compared by suffix arrays
over their bytes, made in two stages: only suffixes smaller than their successors are sorted, the others are induced from
them by a scan over the buckets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.llm.common import slices, store, texts
from panelmill.session import Stored

SPAN, GRAM = 400, 160
_WINDOW = SPAN - GRAM + 1
#: Suffixes in one array, about. A larger group is split by the place of the anchor in the run, down to one place each, and
#: then by a hash of the run: equal runs have both in common.
BLOCK = 500_000
_PART = 1 << 18  # bytes of a text that are looked at together; parts overlap by a run
_HIGH = np.uint64(0xFFFFFFFF00000000)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = np.random.default_rng(400).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(x: np.uint64) -> np.ndarray:
    out = np.full(_PART + 1, x, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWER, _INVERSE = _powers(_BASE), _powers(_UNBASE)


def _mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(31)
    h *= _BASE
    h ^= h >> np.uint64(29)
    return h


def stretches(data: np.ndarray) -> np.ndarray:
    """Rows of (hash of the anchor, two halves of a digest, anchor, first run, last run), places being bytes of the text.

    The digest is of the bytes of the stretch and the anchor's place in it.
    Of equal smallest hashes in a run the first is the anchor. Long texts are looked at in parts; a stretch that is cut
    there has another hash than its copies and is then compared with them by the suffix array.
    """
    out = []
    for a in range(0, max(1, len(data) - SPAN + 1), _PART - SPAN + 1):
        part = data[a: a + _PART]
        if len(part) < SPAN:
            continue
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * _POWER[: len(part)], out=total[1:])
        m, w = len(part) - GRAM + 1, _WINDOW
        h = _mixed((total[GRAM:] - total[:m]) * _INVERSE[:m])
        runs = m - w + 1
        rows = -(-m // w)
        ranked = np.full(rows * w, np.uint64(2**64 - 1))
        ranked[:m] = (h & _HIGH) | np.arange(m, dtype=np.uint64)
        grid = ranked.reshape(rows, w)
        ahead = np.minimum.accumulate(grid, 1).ravel()
        back = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
        least = np.minimum(back[:runs], ahead[w - 1: w - 1 + runs])
        first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        last = np.concatenate((first[1:], [runs])) - 1
        at = (least[first] & ~_HIGH).astype(np.int64)
        raw = part.tobytes()
        whole = np.frombuffer(b"".join(
            hashlib.blake2b(raw[f: z], digest_size=16, salt=p.to_bytes(4, "little")).digest()
            for f, z, p in zip(first.tolist(), (last + SPAN).tolist(), (at - first).tolist())), np.int64).reshape(-1, 2)
        out.append(np.stack([h[at].view(np.int64), whole[:, 0], whole[:, 1], at + a, first + a, last + a]))
    return np.concatenate(out, 1) if out else np.zeros((6, 0), np.int64)


def suffix_order(raw: bytes, wanted: np.ndarray) -> np.ndarray:
    """The positions marked in ``wanted``, ordered by the SPAN bytes from there on (fewer at the end of ``raw``)."""
    t = np.frombuffer(raw, np.uint8)
    n = len(t)
    if n == 0:
        return np.zeros(0, np.int64)
    # A suffix is smaller than its successor if the first byte that differs from the next one is smaller than that.
    place = np.arange(n)
    differs = np.concatenate((t[:-1] != t[1:], [True]))
    change = np.minimum.accumulate(np.where(differs, place, n)[::-1])[::-1]
    rising = np.concatenate((t[:-1] < t[1:], [False]))[change]  # nothing is smaller than the end of the text
    # Induction needs the successors up to the next sorted suffix, or to the end.
    goal = np.minimum.accumulate(np.where(rising, place, n - 1)[::-1])[::-1]
    chosen = np.flatnonzero(wanted)
    reach = np.zeros(n + 1, np.int64)
    np.add.at(reach, chosen, 1)
    np.add.at(reach, goal[chosen] + 1, -1)
    used = np.cumsum(reach)[:n] > 0
    # First stage: sort the suffixes that are smaller than their successors.
    direct = np.flatnonzero(used & rising)
    keys = [raw[i: i + SPAN] for i in direct.tolist()]
    direct = direct[np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)] if keys else direct
    del keys
    heads = t[direct]
    starts = np.searchsorted(heads, np.arange(257))
    # Second stage: scan the buckets upwards; what precedes a placed suffix goes to the bucket of its own byte.
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    if used[n - 1]:
        waiting[t[n - 1]].append(np.array([n - 1]))
    done = []
    for c in range(256):
        placed = []
        now = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        while len(now):
            placed.append(now)
            before = now[now > 0] - 1
            now = before[used[before] & (t[before] == c)]
        placed.append(direct[starts[c]: starts[c + 1]])
        waiting[c] = []
        bucket = np.concatenate(placed)
        if not len(bucket):
            continue
        done.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[used[before] & (t[before] > c)]
        if len(before):
            by = np.argsort(t[before], kind="stable")
            before = before[by]
            where = np.searchsorted(t[before], np.arange(c + 1, 257))
            for k in np.flatnonzero(where[1:] > where[:-1]).tolist():
                waiting[c + 1 + k].append(before[where[k]: where[k + 1]])
    order = np.concatenate([np.zeros(0, np.int64), *done])
    return order[wanted[order]]


def equal_runs(raw: bytes, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the common prefix of the suffixes at ``a`` and ``b`` has SPAN bytes, eight at a time."""
    words = np.ndarray((max(0, len(raw) - 7),), "<u8", raw, strides=(1,))
    same = np.zeros(len(a), bool)
    left = np.flatnonzero(np.maximum(a, b) + SPAN <= len(raw))
    for k in range(0, SPAN, 8):
        at = min(k, SPAN - 8)
        left = left[words[a[left] + at] == words[b[left] + at]]
    same[left] = True
    return same


def repeated_starts(raw: bytes, wanted: np.ndarray) -> np.ndarray:
    """Marks those of the wanted positions whose SPAN bytes also start at another wanted position."""
    order = suffix_order(raw, wanted)
    same = equal_runs(raw, order[:-1], order[1:])
    marks = np.zeros(len(raw), bool)
    marks[order[:-1][same]] = True
    marks[order[1:][same]] = True
    return marks


def _runs(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate(([0], marks.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, tag, data: rows are told apart by id and a hash of the text, so that repeated ids do no harm."""
    return texts(docs, id_col, text_col).select("doc_id", F.hash("text").alias("tag"), F.col("text").cast("binary").alias("data"))


def _same_row(a: DataFrame, b: DataFrame) -> list:
    return [a["doc_id"].eqNullSafe(b["id"]), a["tag"] == b["of"]]


def _anchor_table(rows: DataFrame) -> DataFrame:
    kind = rows.schema["doc_id"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [stretches(np.frombuffer(x, np.uint8)) for x in b.column(2).to_pylist()]
            owner = pa.array(np.repeat(np.arange(len(found)), [f.shape[1] for f in found]), pa.int64())
            h = np.concatenate([np.zeros((6, 0), np.int64), *found], 1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(owner), b.column(1).take(owner), *map(pa.array, h[:3]), *(pa.array(h[k], pa.int64()).cast(pa.int32()) for k in (3, 4, 5))],
                ["doc_id", "tag", "anchor", "stretch", "proof", "at", "low", "high"])

    return rows.mapInArrow(find, f"doc_id {kind}, tag int, anchor bigint, stretch bigint, proof bigint, at int, low int, high int")


def _pieces(rows: DataFrame, members: DataFrame) -> DataFrame:
    """The texts of the members: anchor, part, doc_id, tag, low (first run), data (the bytes of all its runs)."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    wanted = members.groupBy(F.col("doc_id").alias("id"), F.col("tag").alias("of")).agg(
        F.collect_list(F.struct("anchor", "at", "low", "high", "kinds")).alias("wanted"))
    joined = rows.join(wanted, _same_row(rows, wanted)).select("doc_id", "tag", "data", "wanted.anchor", "wanted.at", "wanted.low", "wanted.high", "wanted.kinds")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, size = [], 0
            lists = [c.to_pylist() for c in b.columns[2:]]
            for j in range(b.num_rows):
                data = lists[0][j]
                for anchor, at, low, high, kinds in zip(*(x[j] for x in lists[1:])):
                    wide, tiles = max(1, BLOCK // kinds), -(-kinds // BLOCK)
                    for part in range((at - high) // wide, (at - low) // wide + 1):
                        first, last = max(low, at - (part + 1) * wide + 1), min(high, at - part * wide)
                        run = data[first: last + SPAN]
                        out.append((j, anchor, part * tiles + (crc32(run) % tiles if tiles > 1 else 0), first, run))
                        size += last + SPAN - first
                if size > 16 << 20 or j == b.num_rows - 1:
                    own = pa.array([x[0] for x in out], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(own), b.column(1).take(own), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.int64()),
                         pa.array([x[3] for x in out], pa.int32()), pa.array([x[4] for x in out], pa.binary())],
                        ["doc_id", "tag", "anchor", "part", "low", "data"])
                    out, size = [], 0

    return joined.mapInArrow(cut, f"doc_id {kind}, tag int, anchor bigint, part bigint, low int, data binary")


SPANS = "doc_id {}, tag int, start int, stop int"


def _compared(pieces: DataFrame) -> DataFrame:
    """Repeated bytes (start to stop) of the pieces, by suffix arrays over whole groups of equal anchor and part."""
    kind = pieces.schema["doc_id"].dataType.simpleString()
    dealt = pieces.repartition("anchor", "part").sortWithinPartitions("anchor", "part")

    def solve(block: list[tuple], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        raw = b"".join(x[5] for x in block)
        wanted = np.zeros(len(raw), bool)
        begins = np.cumsum([0] + [len(x[5]) for x in block])
        for begin, x in zip(begins, block):
            wanted[begin: begin + len(x[5]) - SPAN + 1] = True
        first, last = _runs(repeated_starts(raw, wanted))
        of = np.searchsorted(begins, first, side="right") - 1  # a run cannot go over the end of a piece: its tail is not wanted
        low = np.array([x[4] for x in block], np.int64)
        start = first - begins[of] + low[of]
        yield pa.RecordBatch.from_arrays(
            [pa.array([block[k][0] for k in of.tolist()], id_type), pa.array([block[k][1] for k in of.tolist()], pa.int32()),
             pa.array(start, pa.int64()).cast(pa.int32()), pa.array(start + last - first + SPAN, pa.int64()).cast(pa.int32())],
            ["doc_id", "tag", "start", "stop"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[tuple] = []
        size, group, id_type = 0, None, None
        for b in batches:
            id_type = b.schema.field(0).type
            for x in zip(*(c.to_pylist() for c in b.columns)):
                if x[2:4] != group and size >= BLOCK:
                    yield from solve(block, id_type)
                    block, size = [], 0
                group = x[2:4]
                block.append(x)
                size += len(x[5]) - SPAN + 1
        if block:
            yield from solve(block, id_type)

    return dealt.mapInArrow(compare, SPANS.format(kind))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, list[Stored]]:
    """(doc_id, tag, start, stop) of bytes that are repeated, and the stored tables it reads.

    Spans of a document may overlap and repeat.
    """
    used: list[Stored] = []

    def keep(df: DataFrame, label: str) -> DataFrame:
        used.append(store(df, label))
        return used[-1].df

    rows = _keyed(docs, id_col, text_col)
    every = store(_anchor_table(rows), "suffix-anchors")
    again = store(
        every.df.groupBy("anchor").agg(
            F.count(F.lit(1)).alias("n"), F.min("stretch").alias("s"), F.max("stretch").alias("z"), F.min("proof").alias("p"), F.max("proof").alias("q"))
        .where("n > 1").select("anchor", ((F.col("s") != F.col("z")) | (F.col("p") != F.col("q"))).alias("mixed")), "suffix-again")
    hits = store(every.df.join(again.df, "anchor"), "suffix-hits")
    every.delete(), again.delete()
    used.append(hits)
    hits = hits.df

    kinds = keep(
        hits.groupBy("anchor", "stretch", "proof", "mixed").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "tag", "at", "low", "high")).alias("one")),
        "suffix-kinds")
    whole = keep(kinds.where("n > 1").select("anchor", "stretch", "proof"), "suffix-whole")
    covered = hits.join(whole, ["anchor", "stretch", "proof"]).select("doc_id", "tag", F.col("low").alias("start"), (F.col("high") + SPAN).alias("stop"))

    # Only groups with a stretch that occurs once are left; of the others in them one stretch each stands for all.
    mixed = kinds.where("mixed")
    open_groups = keep(
        mixed.groupBy("anchor").agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("kinds")).where("least = 1").select("anchor", "kinds"),
        "suffix-open")
    members = keep(mixed.join(open_groups, "anchor").select("anchor", "one.*", "kinds"), "suffix-members")
    pieces = keep(_pieces(rows, members), "suffix-pieces")
    spans = covered.unionByName(_compared(pieces))
    return spans, used


def strip_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_bytes: bool = False, keep_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, with ``keep_bytes`` also spans and kept, with
    ``keep_text`` also text: what is left, U+FFFD standing for a character of which only some bytes are.

    A byte of the UTF-8 text goes if a SPAN-byte string that covers it starts anywhere else too, in the same or another
    document, overlaps included; this is judged on the input, not on what is left. ``n_spans`` counts maximal removed
    runs. Null and short texts lose nothing. Repeated rows are copies of each other and lose all they have in common;
    a null id is an id like others, and ids may be of any type that can be grouped. Runs jobs when called; tables that are read twice are stored.
    """
    rows = _keyed(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    found, used = repeated_spans(docs, id_col, text_col)
    spans = store(
        found.groupBy(F.col("doc_id").alias("id"), F.col("tag").alias("of"))
        .agg(F.collect_set(F.struct("start", "stop")).alias("spans")), "suffix-spans").df
    for table in used:
        table.delete()
    joined = rows.join(spans, _same_row(rows, spans), "left").select("doc_id", "data", "spans.start", "spans.stop")

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            ids, datas, starts, stops = (b.column(0), *(c.to_pylist() for c in b.columns[1:]))
            out = []
            for data, s, e in zip(datas, starts, stops):
                if not s:
                    out.append((len(data), 0, 0, hashlib.sha256(data).hexdigest(), [], data))
                    continue
                level = np.zeros(len(data) + 1, np.int64)
                np.add.at(level, s, 1)
                np.add.at(level, e, -1)
                gone = np.cumsum(level)[:-1] > 0
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                first, last = _runs(gone)
                out.append((len(data), len(data) - len(kept), len(first), hashlib.sha256(kept).hexdigest(), list(zip(first.tolist(), (last + 1).tolist())), kept))
            cols = list(zip(*out)) or [[]] * 6
            arrays = [ids, *(pa.array(cols[k], pa.int64()) for k in range(3)), pa.array(cols[3], pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if keep_bytes:
                arrays += [pa.array([[list(x) for x in y] for y in cols[4]], pa.list_(pa.list_(pa.int64()))), pa.array(cols[5], pa.binary())]
                names += ["spans", "kept"]
            if keep_text:
                arrays.append(pa.array([x.decode("utf-8", "replace") for x in cols[5]], pa.string()))
                names.append("text")
            yield pa.RecordBatch.from_arrays(arrays, names)

    extra = (", spans array<array<bigint>>, kept binary" if keep_bytes else "") + (", text string" if keep_text else "")
    return joined.mapInArrow(strip, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string{extra}")
