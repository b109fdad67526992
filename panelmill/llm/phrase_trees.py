"""Collocations from depth-truncated suffix trees over words, partitioned by word prefixes.

Every word begins a suffix, cut after DEPTH words or at the end of its piece. The suffixes below one prefix form a subtree
of their own. Prefixes of one word are counted in hash buckets; those of a bucket beyond LIMIT are extended by one word and
counted again, up to DEPTH words. Buckets are packed into groups up to a budget of rows, and a task builds the subtrees of
a group without looking at any other: the count of a node is the total of its leaves. An extended prefix itself is a leaf
of its own group. Suffixes are combined where they are read and travel in compressed blocks of one group each.

A suffix ends before a word, or a pair of neighbours, that is too rare for any phrase. Words are counted in hash buckets that
go through the driver; pairs in 2^32 buckets, which travel as sorted numbers and meet in tasks, and only a bit for each
frequent one goes to the tasks that read the texts again.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelmill.llm.common import store
from panelmill.session import Stored

DEPTH = 4
#: Rows of one group of prefixes, and suffixes of one bucket from which on its prefixes are extended.
BUDGET, LIMIT = 1_500_000, 1_000_000
FINE = 16  # hash buckets for each group
PARTS = 10_000  # tasks at most for the groups
#: Hash buckets of words. A word whose bucket has too few occurrences is too rare for any phrase and ends a suffix as a stop
#: does. Words that share a bucket with a frequent one are kept: the more words there are, the less is saved, nothing is lost.
WORDS = 1 << 25
PAIRS = 4_000_000  # pairs of neighbours whose buckets one task adds up
SPARE = 16  # bits for each frequent pair, fewer beyond MOST bits: more suffixes are kept then, nothing is lost
MOST = 1 << 29
_FLUSH = 1 << 21  # words that are combined at a time
_WORDS = [f"w{k + 1}" for k in range(DEPTH)]
_STOP = b"."
_FOLD = bytes(
    _STOP[0] if c in b".,;:!?\n\x0b\x0c\r" else 0x20 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words(data: bytes) -> list[bytes]:
    """The words of a text with A-Z in lower case and a stop after every piece; no word is or holds a stop."""
    return [*data.translate(_FOLD).replace(_STOP, b" . ").split(), _STOP]


def _mix(h: np.ndarray | np.uint64, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase with one more word, whose crc32 is given."""
    h = (h ^ word) * _MIX
    return h ^ (h >> np.uint64(29))


def _bit(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


@dataclass
class Known:
    """What may be in a phrase: a bit for each bucket of words and, once counted, of pairs of words."""

    words: np.ndarray
    pairs: np.ndarray | None = None


def _combined(keys: list[np.ndarray], count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of one row each, totals) of equal rows; the first key counts most."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    first = np.flatnonzero(new)
    return order[first], np.add.reduceat(count[order], first) if len(first) else np.zeros(0, np.int64)


def _word_buckets(lang: str, book: pa.Array, number: int) -> np.ndarray:
    seed = crc32(lang.encode())
    return np.array([crc32(w, seed) for w in book.to_pylist()], np.int64) % number


def _crcs(book: pa.Array) -> np.ndarray:
    """By the number of a word plus 1."""
    return np.array([0, *map(crc32, book.to_pylist())], np.uint64)


@dataclass
class Suffixes:
    """Different suffixes of some texts of one language: numbers of ``book`` plus 1 for each word, 0 beyond the end."""

    lang: str
    book: pa.Array
    columns: list[np.ndarray]
    count: np.ndarray

    @classmethod
    def of(cls, lang: str, tokens: list[pa.Array], known: Known | None = None) -> Suffixes:
        """One row for each word."""
        coded = pa.concat_arrays(tokens).dictionary_encode()
        ids = np.concatenate((coded.indices.to_numpy().astype(np.int32) + np.int32(1), np.zeros(DEPTH, np.int32)))
        ids[ids == coded.dictionary.index(_STOP).as_py() + 1] = 0
        if known is not None:
            rare = np.concatenate(([False], ~_bit(known.words, _word_buckets(lang, coded.dictionary, 8 * len(known.words)))))
            ids[rare[ids]] = 0
        joined = ids > 0  # with the word before
        if known is not None and known.pairs is not None:
            each = _crcs(coded.dictionary)[ids]
            bucket = _mix(_mix(np.uint64(crc32(lang.encode())), each[:-1]), each[1:]) >> np.uint64(32)
            joined[1:] &= _bit(known.pairs, (bucket * np.uint64(8 * len(known.pairs)) >> np.uint64(32)).astype(np.int64))
        n = len(ids) - DEPTH
        columns = [ids[:n]]
        for k in range(1, DEPTH):
            columns.append(np.where((columns[-1] > 0) & joined[k: k + n], ids[k: k + n], np.int32(0)))
        real = columns[0] > 0
        return cls(lang, coded.dictionary, [c[real] for c in columns], np.ones(int(real.sum()), np.int64))

    def combined(self) -> Suffixes:
        c = self.columns
        at, count = _combined([c[k].astype(np.int64) << 32 | c[k + 1] for k in range(0, DEPTH, 2)], self.count)
        return Suffixes(self.lang, self.book, [x[at] for x in self.columns], count)

    def hashes(self) -> Iterator[np.ndarray]:
        """Of the first 1, 2, ... words of every row, the same in all tasks."""
        each, h = _crcs(self.book), np.uint64(crc32(self.lang.encode()))
        for c in self.columns:
            h = _mix(h, each[c])
            yield h

    def buckets(self, number: int) -> Iterator[np.ndarray]:
        for h in self.hashes():
            yield (h % np.uint64(number)).astype(np.int64)

    def words(self, column: np.ndarray) -> pa.Array:
        return self.book.take(pa.array(column - 1, mask=column == 0)).cast(pa.string())


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("data"))


def _each(rows: DataFrame, use: Callable[[Suffixes], Iterator[pa.RecordBatch]], schema: str, known: Known | None) -> DataFrame:
    """``use`` of the suffixes of all texts, _FLUSH words at a time."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[str, list[bytes]] = {}
        packed: dict[str, list[pa.Array]] = {}
        n = 0

        def pack(lang: str) -> list[pa.Array]:
            packed.setdefault(lang, []).append(pa.array(open_.pop(lang), pa.binary()))
            return packed[lang]

        for b in batches:
            for j, lang in enumerate(b.column(0).to_pylist()):
                found = words(b.column(1)[j].as_py())
                here = open_.setdefault(lang, [])
                here += found
                n += len(found)
                if len(here) >= _FLUSH >> 4:  # a word takes far less memory in Arrow than as an object
                    pack(lang)
                if n >= _FLUSH:
                    for key in [*{**open_, **packed}]:
                        arrays = pack(key) if key in open_ else packed[key]
                        del packed[key]
                        yield from use(Suffixes.of(key, arrays, known))
                        del arrays
                    n = 0
        for key in [*{**open_, **packed}]:
            yield from use(Suffixes.of(key, pack(key) if key in open_ else packed[key], known))
            del packed[key]

    return rows.mapInArrow(cut, schema)


def _loads(rows: DataFrame, number: int, hot: Sequence[np.ndarray], known: Known | None) -> DataFrame:
    """kind, lang, bucket, n. ``load``: suffixes by their first len(hot) + 1 words, of those that begin with a chain of
    extended prefixes; without any also ``word``, by the buckets of words, and ``total``, all words of a language."""

    def count(s: Suffixes) -> Iterator[pa.RecordBatch]:
        def rows_of(kind: str, bucket: np.ndarray | None, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([kind] * len(n), pa.string()), pa.array([s.lang if kind == "total" else None] * len(n), pa.string()),
                 pa.nulls(len(n), pa.int64()) if bucket is None else pa.array(bucket), pa.array(n)], ["kind", "lang", "bucket", "n"])

        level = len(hot)
        mine = s.columns[level] > 0
        for k, b in enumerate(s.buckets(number)):
            if k == level:
                break
            mine &= hot[k][b]
        yield rows_of("load", *np.unique(b[mine], return_counts=True))
        if not level:
            f = np.bincount(s.columns[0], minlength=len(s.book) + 1)[1:]
            at = _word_buckets(s.lang, s.book, WORDS)
            order = np.argsort(at)
            bucket, first = np.unique(at[order], return_index=True)
            yield rows_of("word", bucket, np.add.reduceat(f[order], first))
            yield rows_of("total", None, np.array([len(s.count)]))

    return _each(rows, count, "kind string, lang string, bucket bigint, n bigint", known).groupBy("kind", "lang", "bucket").agg(F.sum("n").alias("n"))


def _often(waiting: list[np.ndarray], least: int) -> np.ndarray:
    """The buckets with ``least`` pairs or more; a number of ``waiting``, which is emptied, holds a bucket and below it a count."""
    both = np.concatenate(waiting)
    waiting.clear()
    both.sort()
    new = np.ones(len(both), bool)
    new[1:] = (both[1:] ^ both[:-1]) >> np.uint64(32) > 0
    first = np.flatnonzero(new)
    bucket = (both[first] >> np.uint64(32)).view(np.int64)
    both &= np.uint64(0xFFFFFFFF)
    return bucket[np.add.reduceat(both, first) >= least]


def _pairs(rows: DataFrame, size: int, least: int, words: np.ndarray) -> np.ndarray:
    """Bits, a power of two, by the bucket of a pair of neighbours (its share of 2^32): whether the pair may occur ``least`` times."""
    parts = 1 + size // 4 // PAIRS
    edges = np.arange(parts + 1, dtype=np.int64) * (1 << 32) // parts

    def pack(s: Suffixes) -> Iterator[pa.RecordBatch]:
        _, h = itertools.islice(s.hashes(), 2)
        bucket, n = np.unique((h[s.columns[1] > 0] >> np.uint64(32)).astype(np.uint32), return_counts=True)
        n = np.minimum(n, least).astype(np.uint32)  # more need not be told apart
        cut = np.searchsorted(bucket, edges)
        part = np.flatnonzero(np.diff(cut))
        blocks = []
        for a, z in zip(cut[part].tolist(), cut[part + 1].tolist()):
            # steps between sorted numbers and their counts, the bytes of one weight side by side
            both = np.concatenate((np.diff(bucket[a:z], prepend=np.uint32(0)), n[a:z]))
            blocks.append(pa.compress(both.view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True))
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(np.diff(cut)[part], pa.int64()), pa.array(blocks, pa.binary())], ["part", "n", "block"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        last = None

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(_often(waiting, least))], ["bucket"])

        for b in batches:
            for j, (part, n) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                if part != last and waiting:
                    yield close()
                last = part
                data = pa.decompress(b.column(2)[j].as_buffer(), decompressed_size=8 * n, codec="zstd")
                both = np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel()
                waiting.append(np.cumsum(both[:n], dtype=np.uint64) << np.uint64(32) | both[n:])
        if waiting:
            yield close()

    sent = _each(rows, pack, "part int, n bigint, block binary", Known(words))
    found = store(sent.repartition(min(parts, PARTS), "part").sortWithinPartitions("part").mapInArrow(meet, "bucket bigint"), "phrase-pairs")
    bits = 1 << max(15, min(SPARE * found.df.count(), MOST).bit_length())  # a bitmap in SQL has 2^15
    spot = F.shiftright("bucket", 33 - bits.bit_length()) + 1
    maps = found.df.groupBy(F.bitmap_bucket_number(spot).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("m"))
    out = np.zeros(bits >> 3, np.uint8)
    for k, m in zip(*(c.to_pylist() for c in maps.toArrow().columns)):  # SPARE bits a frequent pair
        out[(k - 1) << 12: k << 12] = np.frombuffer(m, np.uint8)
    found.delete()
    return out


def _blocks(rows: DataFrame, hot: Sequence[np.ndarray], group_of: np.ndarray, known: Known) -> DataFrame:
    """grp, lang, block: the suffixes of one group as compressed Arrow data."""
    number = len(group_of)

    def pack(every: Suffixes) -> Iterator[pa.RecordBatch]:
        s = every.combined()
        where, parts = np.ones(len(s.count), bool), []  # where: all shorter prefixes of the row are extended
        for k, bucket in enumerate(s.buckets(number)):
            where &= s.columns[k] > 0
            ends = where & ~hot[k][bucket] if k < len(hot) else where.copy()
            parts.append((np.flatnonzero(ends), k + 1, bucket[ends], DEPTH))
            where &= ~ends
            if k < len(hot):  # the extended prefix itself, cut after its words
                longer = np.flatnonzero(where)
                first, total = _combined([c[longer].astype(np.int64) for c in s.columns[: k + 1]], s.count[longer])
                parts.append((longer[first], k + 1, bucket[longer[first]], total))
            if not where.any():
                break
        rows_, deep, group, count, cut = [], [], [], [], []
        for at, k, bucket, total in parts:
            whole = isinstance(total, int)
            rows_.append(at), deep.append(np.full(len(at), k, np.int8)), group.append(group_of[bucket])
            count.append(s.count[at] if whole else total), cut.append(np.full(len(at), DEPTH if whole else k, np.int8))
        at, deep_, group_, count_, cut_ = (np.concatenate(x) for x in (rows_, deep, group, count, cut))
        order = np.argsort(group_, kind="stable")
        edges = np.flatnonzero(np.diff(group_[order], prepend=-1))
        seen = np.zeros(len(s.book) + 1, bool)
        for a, z in zip(edges.tolist(), [*edges[1:].tolist(), len(order)]):
            here = order[a:z]
            columns = [np.where(cut_[here] > k, c[at[here]], 0) for k, c in enumerate(s.columns)]
            seen[:] = False
            for c in columns:
                seen[c] = True
            seen[0] = True
            used = np.flatnonzero(seen)
            place = np.cumsum(seen) - 1
            book = s.words(used)
            kind = np.uint16 if len(used) < 1 << 16 else np.int32
            batch = pa.RecordBatch.from_arrays(
                [*(pa.DictionaryArray.from_arrays(pa.array(place[c].astype(kind)), book) for c in columns),
                 pa.array(count_[here]), pa.array(deep_[here])], [*_WORDS, "c", "deep"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(batch)
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(group_[here[0]])], pa.int32()), pa.array([s.lang], pa.string()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                ["grp", "lang", "block"])

    return _each(rows, pack, "grp int, lang string, block binary", known)


@dataclass
class Group:
    """Leaves of one group: (lang, words) as numbers of ``langs`` and ``book``, their counts and the words of their prefixes."""

    langs: list[str]
    book: pa.Array
    lang: np.ndarray
    columns: list[np.ndarray]
    count: np.ndarray
    deep: np.ndarray

    @classmethod
    def of(cls, blocks: list[tuple[str, pa.Buffer]]) -> Group:
        langs = sorted({lang for lang, _ in blocks})
        tables = [pa.ipc.open_stream(data).read_all() for _, data in blocks]
        sizes = [t.num_rows for t in tables]
        books = [t.column(0).chunk(0).dictionary for t in tables]
        coded = pa.concat_arrays(books).dictionary_encode()
        # numbers of the blocks' own books to those of the joint one; 0 stands for no word
        number = coded.indices.fill_null(-1).to_numpy() + np.int32(1)
        begin = np.cumsum([0, *(len(b) for b in books)])
        columns = [np.concatenate([number[a:][t.column(k).chunk(0).indices.to_numpy()] for a, t in zip(begin.tolist(), tables)]) for k in range(DEPTH)]
        lang = np.repeat(np.array([langs.index(x) for x, _ in blocks], np.int32), sizes)
        count, deep = (np.concatenate([t.column(c).to_numpy() for t in tables]) for c in ("c", "deep"))
        return cls(langs, coded.dictionary, lang, columns, count, deep).combined()

    def combined(self) -> Group:
        """Equal rows of many blocks as one, in the order of the tree: leaves below one node are side by side."""
        # a prefix that was extended and the rows below it may meet in one group: they differ in ``deep``
        c = self.columns
        pairs = [(self.lang, c[0]), (c[1], c[2]), (c[3], self.deep)]
        at, total = _combined([a.astype(np.int64) << 32 | b for a, b in pairs], self.count)
        return Group(self.langs, self.book, self.lang[at], [c[at] for c in self.columns], total, self.deep[at])

    def subtree(self, least: int) -> Iterator[pa.RecordBatch]:
        """lang, phrase, k, f of the nodes with ``least`` occurrences or more, level by level."""
        new = np.zeros(len(self.count), bool)
        new[:1] = True
        new[1:] = self.lang[1:] != self.lang[:-1]
        for k in range(DEPTH):
            new[1:] |= self.columns[k][1:] != self.columns[k][:-1]
            first = np.flatnonzero(new)
            total = np.add.reduceat(np.where(self.deep <= k + 1, self.count, 0), first) if len(first) else first
            kept = (self.columns[k][first] > 0) & (total >= least)
            first, total = first[kept], total[kept]
            if len(first):
                parts = [self.book.take(pa.array(c[first] - 1)) for c in self.columns[: k + 1]]
                names = pa.array(self.langs).take(pa.array(self.lang[first]))
                yield pa.RecordBatch.from_arrays(
                    [names, pc.binary_join_element_wise(*parts, " "), pa.array(np.full(len(first), k + 1, np.int32)), pa.array(total)], ["lang", "phrase", "k", "f"])


def _trees(blocks: DataFrame, groups: int, least: int) -> DataFrame:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[str, pa.Buffer]] = []
        last = None
        for b in batches:
            for j, (group, lang) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                if group != last and waiting:
                    yield from Group.of(waiting).subtree(least)
                    waiting = []
                last = group
                waiting.append((lang, b.column(2)[j].as_buffer()))
        if waiting:
            yield from Group.of(waiting).subtree(least)

    # about a group a task: a task's blocks reach Python in one piece
    return blocks.repartition(min(groups, PARTS), "grp").sortWithinPartitions("grp").mapInArrow(build, "lang string, phrase string, k int, f bigint")


def count_phrases(docs: DataFrame, least: int = 30, text_col: str = "text", lang_col: str = "lang") -> tuple[Stored, DataFrame]:
    """(nodes, totals): stored (lang, phrase, k, f) of all phrases of 1 to DEPTH words with ``least`` occurrences or more,
    and (lang, n) of all words.

    What goes through the driver is bounded: FINE numbers for BUDGET words of the texts, a number for each bucket of words and
    MOST bits for pairs.
    """
    rows = _texts(docs, text_col, lang_col)
    size = rows.agg(F.sum(F.octet_length("data"))).head()[0] or 0
    number = FINE * (1 + size // 4 // BUDGET)  # four bytes a word or more, else buckets are larger and more are extended
    hot: list[np.ndarray] = []
    load, totals, known = np.zeros(number, np.int64), None, None
    for k in range(DEPTH):
        found = store(_loads(rows, number, hot, known), "phrase-loads").df
        if not k:
            totals = found.where("kind = 'total'").select("lang", "n")
            often = found.where((F.col("kind") == "word") & (F.col("n") >= least)).select("bucket").toArrow().column(0).to_numpy()
            frequent = np.zeros(WORDS >> 3, np.uint8)
            np.bitwise_or.at(frequent, often >> 3, np.left_shift(1, often & 7).astype(np.uint8))
            known = Known(frequent, _pairs(rows, size, least, frequent))
        here = np.zeros(number, np.int64)
        for r in found.where("kind = 'load'").select("bucket", "n").collect():  # one row a bucket
            here[r.bucket] = r.n
        beyond = here > LIMIT if k + 1 < DEPTH else np.zeros(number, bool)
        load += np.where(beyond, 0, here)
        if not beyond.any():
            break
        hot.append(beyond)
    group_of, group, held = np.zeros(number, np.int32), 0, 0
    for b, weight in enumerate(load.tolist()):  # buckets side by side until a group has its budget
        if held and held + weight > BUDGET:
            group, held = group + 1, 0
        group_of[b] = group
        held += weight
    return store(_trees(_blocks(rows, hot, group_of, known), group + 1, least), "phrase-nodes"), totals


def _exact(c: Column) -> Column:
    return c.cast("decimal(20,0)")


def _part(phrase: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), start, length), " ")


def collocations(
    docs: DataFrame, least: int = 30, top: int = 2000, cover: int = 80, text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """The best ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A-Z count as lower case, pieces end at ``.,;:!?`` and line ends, words at blanks and tabs. A phrase of 2 to 4 words
    with ``least`` occurrences is scored by its weakest cut: floor(2000000 a / (l + r)), ties to the earliest. It is left
    out if a longer one holds it and has ``cover`` per cent of its occurrences. Ranks go by score and a, largest first,
    then by the bytes of the phrase. A null language is ``und``; null and empty texts have no words; repeated rows count
    each; no rows give none. Other columns are not read. Runs jobs when called.
    """
    nodes, totals = count_phrases(docs, least, text_col, lang_col)
    found = nodes.df
    longer = found.where("k > 1").withColumnRenamed("f", "a")
    cuts = longer.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.withColumns({
        "left": _part(F.col("phrase"), F.lit(1), F.col("cut")), "right": _part(F.col("phrase"), F.col("cut") + 1, F.col("k") - F.col("cut"))})
    cuts = cuts.join(found.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(found.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    cuts = cuts.withColumns({"x": _exact(F.col("a")), "y": _exact(F.col("l")) + _exact(F.col("r"))})
    scored = cuts.withColumn("score", F.expr("cast(cast(2000000 as decimal(7,0)) * x div y as bigint)"))
    best = scored.groupBy("lang", "phrase", "k", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    inside = longer.where("k > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("k") - 1)))
    inside = inside.withColumn("start", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)))
    held = inside.groupBy("lang", _part(F.col("phrase"), F.col("start"), F.col("size")).alias("phrase")).agg(F.max("a").alias("in_longer"))
    covered = (F.lit(100).cast("decimal(3,0)") * _exact(F.col("in_longer"))) >= (F.lit(cover).cast("decimal(3,0)") * _exact(F.col("a")))
    kept = best.join(held, ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False)))
    kept = store(kept.select("lang", "phrase", "a", "best.l", "best.r", "best.score"), "phrase-scores").df
    nodes.delete()
    # a language may hold most phrases: its best are picked among the best of many parts
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    few = part.withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("place") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
