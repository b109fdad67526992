"""Benchmark decontamination by the q-gram lemma.

An item of m characters that occurs in a text with at most e edits shares m - q + 1 - q e of its q-grams with it, on
diagonals (text position minus item position) that span at most e. Shared q-grams are counted in bands of two widths
e + 1 that overlap by one, so some band holds the whole span; bands that reach the bound are aligned.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from panelmill.llm.common import forget, ranked, remembered, slices, store, texts
from panelmill.llm.warc_index import open_folder
from panelmill.session import scratch_path

Q = 8
#: Edits allowed per character of an item.
EDITS = 0.08
#: Items with fewer characters have no edits: with one, the lemma would leave them no q-gram that has to be shared.
EXACT = 2 * Q
#: Characters of benchmark text that one index holds; a task goes over its documents once for each block of them.
BLOCK = 1_000_000
_BITS = 20
_STEP, _SPREAD = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)


def plain(text: str) -> str:
    """Lower case, with a blank for each white space character; no character changes its place."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    for c in "\n\t\r\x0b\x0c\xa0":
        low = low.replace(c, " ")
    return low


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def grams(c: np.ndarray) -> np.ndarray:
    n = len(c) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint32)
    h = c[:n].copy()
    for j in range(1, Q):
        h *= _STEP
        h += c[j: n + j]
    return h * _SPREAD


def align(item: np.ndarray, text: np.ndarray, low: int, high: int, edits: int) -> tuple[int, int] | None:
    """(distance, end) of the best occurrence of ``item`` in ``text`` on the diagonals from ``low`` to ``high``.

    Rows are the item's characters, columns the diagonals; an occurrence may begin and end anywhere. None if it takes
    more than ``edits``.
    """
    width = high - low + 1
    far = np.int32(len(item) + len(text) + 1)
    ramp = np.arange(width, dtype=np.int32)
    padded = np.full(len(item) + width, np.uint32(0xFFFFFFFF))
    a, b = max(0, low), min(len(text), low + len(padded))
    if b > a:
        padded[a - low: b - low] = text[a:b]
    cost = np.where((ramp + low >= 0) & (ramp + low <= len(text)), 0, far).astype(np.int32)
    for i, c in enumerate(item):
        now = cost + (padded[i: i + width] != c)
        now[:-1] = np.minimum(now[:-1], cost[1:] + 1)  # a character of the item is missing in the text
        ends = i + 1 + low + ramp
        now[(ends < 0) | (ends > len(text))] = far
        cost = (np.minimum.accumulate(now - ramp) + ramp).astype(np.int32)  # characters of the text that the item lacks
    ends = len(item) + low + ramp
    cost[(ends < 0) | (ends > len(text))] = far
    best = int(cost.argmin())
    return (int(cost[best]), int(ends[best])) if cost[best] <= edits else None


class ItemIndex:
    """The q-grams of a block of items, by hash."""

    def __init__(self, items: tuple[tuple[int | None, str], ...], rate: float) -> None:
        self.ids = [i for i, _ in items]
        self.codes = [codes(plain(t).strip()) for _, t in items]
        self.sizes = np.array([len(c) for c in self.codes], np.int64)
        self.edits = np.where(self.sizes < EXACT, 0, np.floor(self.sizes * rate)).astype(np.int64)
        self.tiny = [(i, plain(t).strip()) for i, (_, t) in enumerate(items) if 0 < self.sizes[i] < Q]
        self.need = np.maximum(1, self.sizes - Q + 1 - Q * self.edits)
        all_grams = [grams(c) for c in self.codes]
        flat = np.concatenate([np.zeros(0, np.uint32), *all_grams])
        item = np.repeat(np.arange(len(items)), [len(g) for g in all_grams])
        at = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(g)) for g in all_grams)])
        order = np.argsort(flat, kind="stable")
        self.item, self.at = item[order], at[order]
        self.hash, self.first, self.count = np.unique(flat[order], return_index=True, return_counts=True)
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[self.hash >> np.uint32(32 - _BITS)] = True
        wide = self.sizes >= Q
        self.least = int(self.need[wide].min()) if wide.any() else 0
        self.shift = int(self.sizes.max(initial=0)) + 1

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item number, start, end, distance) of all occurrences, overlapping ones of an item counted once."""
        return [*self.exact(text), *self.near(text)]

    def exact(self, text: str) -> list[tuple[int, int, int, int]]:
        """The items without a q-gram."""
        out, low = [], plain(text) if self.tiny else ""
        for i, item in self.tiny:
            at = low.find(item)
            while at >= 0:
                out.append((i, at, at + len(item), 0))
                at = low.find(item, at + len(item))
        return out

    def near(self, text: str) -> list[tuple[int, int, int, int]]:
        c = codes(plain(text))
        g = grams(c)
        p = np.flatnonzero(self.seen[g >> np.uint32(32 - _BITS)])
        if len(p) < self.least or not len(self.hash):
            return []
        k = np.minimum(np.searchsorted(self.hash, g[p]), len(self.hash) - 1)
        real = self.hash[k] == g[p]
        p, k = p[real], k[real]
        if len(p) < self.least:
            return []
        n = self.count[k]
        post = np.repeat(self.first[k] - np.cumsum(n) + n, n) + np.arange(n.sum())
        item, diagonal = self.item[post], np.repeat(p, n) - self.at[post] + self.shift
        band = diagonal // (self.edits[item] + 1)
        span = int(band.max()) + 2
        keys, total = np.unique(np.concatenate([item * span + band, item * span + band - 1 + (band == 0)]), return_counts=True)
        enough = np.flatnonzero(total >= self.need[keys // span])
        found: dict[int, list[tuple[int, int]]] = {}
        done: set[int] = set()
        for key in keys[enough[np.argsort(-total[enough], kind="stable")]].tolist():
            if key - 1 in done or key + 1 in done:
                continue  # the bands overlap, and so would the occurrences
            i, b = divmod(key, span)
            e = int(self.edits[i])
            low = b * (e + 1) - self.shift
            hit = align(self.codes[i], c, low - e, low + 2 * (e + 1) + e, e)
            if hit is not None:
                found.setdefault(i, []).append(hit)
                done.add(key)
        out = []
        for i, hits in found.items():
            taken: list[tuple[int, int]] = []
            for distance, end in sorted(hits):
                m, e = int(self.sizes[i]), int(self.edits[i])
                start = end - m
                if distance:  # the same from the end backwards gives the start
                    start = end - align(self.codes[i][::-1], c[max(0, end - m - e): end][::-1], -e, e, e)[1]
                if all(end <= a or start >= z for a, z in taken):
                    taken.append((start, end))
                    out.append((i, start, end, distance))
        return out


@remembered(2)
def _index(folder: str, name: str, rate: float) -> ItemIndex:
    """One index for each block in each worker process."""
    where, root = open_folder(folder)
    with where.open_input_file(f"{root}/{name}") as source:
        items = pa.ipc.open_file(source).read_all()
    return ItemIndex(tuple(zip(items.column(0).to_pylist(), items.column(1).to_pylist())), rate)


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", least: int = 1) -> tuple[str, list[str]]:
    """(folder, files): the items in the shared folder, in blocks of BLOCK characters, or one longer item."""
    items = store(
        benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).dropna(subset=["text"]).distinct()
        .select("id", "text", F.char_length("text").alias("size"), F.monotonically_increasing_id().alias("salt")), "benchmark-items")
    line = ranked(items.df, ["salt"], "benchmark-line", "size")
    items.delete()
    folder = scratch_path(benchmark.sparkSession, "benchmark-blocks")
    dealt = line.df.select("id", "text", F.floor(F.col("before") / BLOCK).alias("block")).repartition("block").sortWithinPartitions("block")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = open_folder(folder)
        where.create_dir(root)
        now, block = None, []

        def close() -> pa.RecordBatch:
            name = f"{now}-{uuid.uuid4().hex}.arrow"  # a task that is run again writes a file of its own
            part = pa.Table.from_batches(block)
            with where.open_output_stream(f"{root}/{name}") as out, pa.ipc.new_file(out, part.schema) as rows:
                rows.write_table(part)
            return pa.RecordBatch.from_arrays([pa.array([name], pa.string())], ["name"])

        for b in batches:
            long = np.array([len(plain(t).strip()) >= max(1, least) for t in b.column(1).to_pylist()], bool)
            b = b.filter(pa.array(long))
            number = b.column(2).to_numpy()
            for k in np.unique(number).tolist():
                if k != now and block:
                    yield close()
                    block = []
                now = k
                block.append(b.filter(pa.array(number == k)).select(["id", "text"]))
        if block:
            yield close()

    names = sorted(r.name for r in dealt.mapInArrow(write, "name string").collect())  # one for BLOCK characters
    line.delete()
    return folder, names


def _buffered(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    """Batches joined up to BLOCK bytes of text, so that few of them meet many blocks of items."""
    forget(_index)
    waiting, size = [], 0
    for b in batches:
        waiting.append(b)
        size += b.column(at).nbytes
        if size >= 16 * BLOCK:
            yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0] if len(waiting) > 1 else b
            waiting, size = [], 0
    if waiting:
        for b in pa.Table.from_batches(waiting).combine_chunks().to_batches():
            yield b


def find_items(
    docs: DataFrame, benchmark: DataFrame, rate: float = EDITS, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text: str = "text", least: int = 1,
) -> DataFrame:
    """One row per occurrence of a benchmark item in a document: doc_id, item_id, start, end, distance.

    Case is ignored and any white space is a blank; ``start`` and ``end`` are code points of the original text and
    ``distance`` is the number of edits, at most ``rate`` for each character of the item. Null and empty texts have no
    occurrences, null items and those under ``least`` characters are no evidence, items under EXACT characters are found
    only as they are, repeated rows are reported each, repeated items once. Ids of documents and items may be of any type.
    The benchmark is the query set: stored as blocks of bounded size, which each task reads one after another.
    """
    rows = texts(docs, id_col, text_col)
    kinds = rows.schema["doc_id"].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, start bigint, end bigint, distance bigint"
    folder, names = item_blocks(benchmark, item_col, item_text, least)
    item_type = to_arrow_type(benchmark.schema[item_col].dataType)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _buffered(batches, 1) if len(names) > 1 else slices(batches, using=_index):
            found = b.column(1).to_pylist()
            for name in names:
                index = _index(folder, name, rate)
                hits = [(j, *m) for j, t in enumerate(found) for m in index.matches(t)]
                at = [x[0] for x in hits]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(at, pa.int64())), pa.array([index.ids[x[1]] for x in hits], item_type),
                     *(pa.array([x[k] for x in hits], pa.int64()) for k in (2, 3, 4))],
                    ["doc_id", "item_id", "start", "end", "distance"])

    return rows.mapInArrow(search, schema)


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, rate: float = EDITS, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", least: int = 1,
) -> DataFrame:
    """``docs`` without the rows in which an item occurs, all columns as they were; rows are filtered where they are."""
    at = docs.columns.index(text_col)
    folder, names = item_blocks(benchmark, item_col, item_text, least)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _buffered(batches, at) if len(names) > 1 else slices(batches, using=_index):
            found = [t or "" for t in b.column(at).to_pylist()]
            clean = np.ones(len(found), bool)
            for name in names:
                index = _index(folder, name, rate)
                for j in np.flatnonzero(clean).tolist():
                    clean[j] = not index.matches(found[j])
            yield b.filter(pa.array(clean))

    return docs.mapInArrow(keep, docs.schema)
