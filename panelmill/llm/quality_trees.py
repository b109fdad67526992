"""Quality scores: histogram gradient-boosted trees over document statistics.

The trees are fitted on the statistics of a bounded sample of labelled documents and kept as flat arrays. Scoring is one
pass over all texts without a shuffle: statistics are counted and all documents of a batch walk down one tree level at
a time.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmill.llm.common import slices, store, texts

#: Labelled rows used for the fit, about: the ones whose hash of the id is in the share of all hashes that gives so many.
SAMPLE = 20_000
SYMBOLS = "#$%&*|!?.,:;@=<>{}[]()/\\_~^+\"'-"
FEATURES = [
    "log_chars", "log_words", "word_mean", "word_deviation", "word_longest", "distinct_words", "distinct_triples", "top_word",
    "lines_log", "repeated_lines", "line_mean", "upper", "digits", "symbols", "ends_in_symbol", "not_ascii", "blanks",
    "words_per_stop", "capitals_first", "top_triple",
    *(f"share_{ord(c)}" for c in SYMBOLS[:12]),
]
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_SHARES = [ord(c) for c in SYMBOLS[:12]]
_ENDS = frozenset(c for c in SYMBOLS if c not in ".,?:;")


def statistics(text: str) -> list[float]:
    """The values of FEATURES for one whole text; an empty text gives zeros."""
    if not text:
        return [0.0] * len(FEATURES)
    raw = text.encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = len(raw)
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    w = len(words)
    lengths = np.fromiter(map(len, words), np.int64, w) if w else np.zeros(1)
    triples = Counter(zip(words, words[1:], words[2:]))
    t = max(1, w - 2)
    stops = int(counts[ord(".")] + counts[ord("!")] + counts[ord("?")])
    return [
        np.log1p(len(text)), np.log1p(w), float(lengths.mean()), float(lengths.std()), float(lengths.max()),
        len(set(words)) / max(1, w), len(triples) / t if w > 2 else 1.0, max(Counter(words).values(), default=0) / max(1, w),
        np.log1p(len(lines)), 1 - len(set(lines)) / max(1, len(lines)), np.log1p(len(text) / max(1, len(lines))),
        counts[_UPPER].sum() / n, counts[_DIGIT].sum() / n, counts[_SYMBOL].sum() / n,
        sum(x[-1] in _ENDS for x in words) / max(1, w), counts[128:].sum() / n, counts[_BLANK].sum() / n,
        w / max(1, stops), sum(x[0].isupper() for x in words) / max(1, w),
        max(triples.values(), default=0) / t, *(counts[_SHARES] / n),
    ]


def add_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and one float column per statistic, a row for each row."""
    rows = texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            m = np.array([statistics(t) for t in b.column(1).to_pylist()], np.float32).reshape(b.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(m[:, j]) for j in range(m.shape[1]))], ["doc_id", *FEATURES])

    return rows.mapInArrow(count, f"doc_id {kind}, " + ", ".join(f"{f} float" for f in FEATURES))


@dataclass
class Forest:
    """Trees of one depth as arrays: node i of a tree has the children 2 i + 1 and 2 i + 2."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    split: np.ndarray  # trees x inner nodes: to the right if the value is larger
    leaf: np.ndarray  # trees x leaves

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, split, leaf in zip(self.feature, self.split, self.leaf):
            at = np.zeros(len(x), np.int64)
            while inner and at.size and at[0] < inner:  # all rows stand on the same level
                at = 2 * at + 1 + (x[rows, feature[at]] > split[at])
            total += leaf[at - inner]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(x)))


def fit_forest(
    x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, penalty: float = 1.0, least: float = 2.0,
) -> Forest:
    """Boosted trees for the logistic loss on binned features. Without both labels: a constant (no rows: 1)."""
    share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 1 - 1e-9
    base = float(np.log(share / (1 - share)))
    inner, leaves = 2**depth - 1, 2**depth
    if len(y) == 0 or y.min() == y.max():
        return Forest(base, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, leaves)))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)
    raw = np.full(len(y), base)
    features, splits, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        feature, split = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            gains = np.zeros((width, x.shape[1], bins))
            for j in range(x.shape[1]):
                key = (node - first) * bins + binned[:, j]
                g = np.bincount(key, grad, width * bins).reshape(width, bins).cumsum(1)
                h = np.bincount(key, hess, width * bins).reshape(width, bins).cumsum(1)
                gr, hr = g[:, -1:] - g, h[:, -1:] - h
                gain = g**2 / (h + penalty) + gr**2 / (hr + penalty) - g[:, -1:] ** 2 / (h[:, -1:] + penalty)
                gain[(h < least) | (hr < least)] = 0
                gain[:, len(cuts[j]):] = 0
                gains[:, j] = gain
            best = gains.reshape(width, -1).argmax(1)
            for k in range(width):
                j, b = divmod(int(best[k]), bins)
                if gains[k, j, b] > 1e-6:
                    feature[first + k], split[first + k] = j, cuts[j][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > split[node])
        node -= inner
        g, h = np.bincount(node, grad, leaves), np.bincount(node, hess, leaves)
        leaf = -rate * g / (h + penalty)
        raw += leaf[node]
        features.append(feature), splits.append(split), values.append(leaf)
    return Forest(base, np.array(features), np.array(splits), np.array(values))


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE,
) -> Forest:
    """Fit on the statistics of about ``sample`` labelled documents that are not held out.

    A null label or id is no label; of repeated labels of one id the smallest counts, of repeated documents the one with
    the smallest statistics. The ids of the sample are broadcast and a row of statistics for each comes to the driver: both
    are bounded by ``sample``, whatever the size of the tables.
    """
    known = store(
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).dropna()
        .where(~is_held_out(F.col("id"))).groupBy("id").agg(F.min("y").alias("y")), "quality-labels").df
    share = min(1.0, sample / max(1, known.count()))
    known = known.where(F.xxhash64("id") <= F.lit(min(2**63 - 1, int(-(2**63) + share * 2**64))))
    rows = texts(docs, id_col, text_col).join(F.broadcast(known.select(F.col("id").alias("doc_id"))), "doc_id", "left_semi")
    one = add_statistics(rows).groupBy("doc_id").agg(F.min(F.struct(*FEATURES)).alias("x")).select("doc_id", "x.*")
    seen = one.toPandas()
    both = seen.merge(known.toPandas(), left_on="doc_id", right_on="id").sort_values("doc_id")
    return fit_forest(both[FEATURES].to_numpy(np.float32), (both["y"].to_numpy() > 0).astype(float))


def _scores(forest: Forest, found: list[str | None]) -> np.ndarray:
    x = np.array([statistics(t or "") for t in found], np.float32).reshape(len(found), len(FEATURES))
    return forest.score(x)


def score_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    threshold: float = 0.7, sample: int = SAMPLE,
) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (1 if the score reaches ``threshold``).

    The trees see statistics of the text only, whole texts of any length. Null and empty texts are scored as texts
    without words; with no label at all every document scores nearly 1, with one kind of label all score the same.
    Repeated rows are scored each. The fit runs when this is called.
    """
    forest = fit_quality(docs, labels, id_col, text_col, label_col, sample)
    rows = texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_scores(forest, b.column(1).to_pylist()))], ["doc_id", "score"])

    return rows.mapInArrow(score, f"doc_id {kind}, score double").select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def drop_low_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    threshold: float = 0.7, sample: int = SAMPLE,
) -> DataFrame:
    """``docs`` without the rows that score below ``threshold``, all columns as they were; rows are filtered where they are."""
    forest = fit_quality(docs, labels, id_col, text_col, label_col, sample)
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield b.filter(pa.array(_scores(forest, b.column(at).to_pylist()) >= threshold))

    return docs.mapInArrow(keep, docs.schema)
