"""URL rules as one bit-parallel wildcard automaton.

Every glob becomes a run of states in a row of 64-bit words. One step over a character moves all states of all
globs at once: ``D = ((D << 1) & step[c]) | (D & stay[c])``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.llm.common import lower_ascii


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)

IN_HOST, ANY = "host", "any"


def rule_globs(rule: Rule) -> list[list]:
    """The rule's host itself and its subdomains, with any end of the path. A glob is a list of bytes and gaps."""
    tails = [[*rule.text.encode(), ANY]] if rule.path else [[*rule.host.encode()], [*rule.host.encode(), ord("/"), ANY]]
    return [head + tail for tail in tails for head in ([], [IN_HOST, ord(".")])]


class Automaton:
    """Globs packed into multiword masks. ``globs``: (owner, items), an item being a byte or a gap.

    A gap ``IN_HOST`` takes any bytes but "/", a gap ``ANY`` takes any bytes.
    """

    def __init__(self, globs: list[tuple[int, list]]) -> None:
        states = sum(1 + sum(isinstance(x, int) for x in items) for _, items in globs)
        self.words = max(1, -(-states // 64))
        self.step = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        self.ends: list[tuple[int, int, np.uint64]] = []
        at = 0
        for owner, items in globs:
            self._on(self.start, at)
            for item in items:
                if isinstance(item, int):
                    at += 1
                    self._on(self.step[item], at)
                else:
                    for c in range(256):
                        if item == ANY or c != ord("/"):
                            self._on(self.stay[c], at)
            self.ends.append((owner, at >> 6, np.uint64(1) << np.uint64(at & 63)))
            at += 1

    @staticmethod
    def _on(row: np.ndarray, bit: int) -> None:
        row[bit >> 6] |= np.uint64(1) << np.uint64(bit & 63)

    def run(self, strings: list[bytes]) -> np.ndarray:
        """The states after the last byte of each string. All strings advance together; ended ones drop out."""
        lengths = np.array([len(s) for s in strings], np.int64)
        order = np.argsort(-lengths, kind="stable")
        flat = np.frombuffer(b"".join(strings), np.uint8)
        first = np.concatenate(([0], np.cumsum(lengths)))[:-1][order]
        sizes = lengths[order]
        live = np.tile(self.start, (len(strings), 1))
        one, top = np.uint64(1), np.uint64(63)
        for i in range(int(sizes[0]) if len(strings) else 0):
            k = int(np.searchsorted(-sizes, -i, side="left"))  # strings longer than i
            c = flat[first[:k] + i]
            now = live[:k]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            live[:k] = (moved & self.step[c]) | (now & self.stay[c])
        out = np.empty_like(live)
        out[order] = live
        return out


class UrlFilter:
    """Rules in one automaton; the longest rule wins, at equal length a block."""

    def __init__(self, rules: tuple[Rule, ...] = RULES, otherwise: str = "allow") -> None:
        self.rules = sorted(rules, key=lambda r: (-len(r.text), r.verdict != "block", r.text))
        self.otherwise = otherwise
        self.automaton = Automaton([(i, g) for i, r in enumerate(self.rules) for g in rule_globs(r)])

    def judge(self, canonical: list[str]) -> np.ndarray:
        """The position of the winning rule in ``self.rules`` for each host + path, or their number if none fits."""
        states = self.automaton.run([s.encode() for s in canonical])
        best = np.full(len(canonical), len(self.rules))
        for owner, word, bit in self.automaton.ends:
            hit = (states[:, word] & bit) != 0
            best[hit] = np.minimum(best[hit], owner)
        return best


SPLIT = r"^(?s:.*?)://([^/?#]*)([^?#]*)"


def filter_urls(
    pages: DataFrame, rules: tuple[Rule, ...] = RULES, otherwise: str = "allow", id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    ``host`` is what follows the first "://", lower-cased, and ``path`` what follows it up to "?" or "#"; a null url
    or one without "://" has both empty. ``rule`` is null and ``verdict`` is ``otherwise`` where no rule fits, for
    empty urls too. Rows with equal ids or urls are judged each. Urls of any length are read whole.
    """
    parts = pages.select(
        F.col(id_col).alias("page_id"),
        lower_ascii(F.coalesce(F.regexp_extract(url_col, SPLIT, 1), F.lit(""))).alias("host"),
        F.coalesce(F.regexp_extract(url_col, SPLIT, 2), F.lit("")).alias("path"))
    kind = parts.schema["page_id"].dataType.simpleString()

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = UrlFilter(rules, otherwise)
        names = [r.text for r in judge.rules] + [None]
        verdicts = [r.verdict for r in judge.rules] + [otherwise]
        for b in batches:
            ids, hosts, paths = b.columns
            best = judge.judge([h + p for h, p in zip(hosts.to_pylist(), paths.to_pylist())]).tolist()
            yield pa.RecordBatch.from_arrays(
                [ids, hosts, paths, pa.array([names[i] for i in best], pa.string()), pa.array([verdicts[i] for i in best], pa.string())],
                ["page_id", "host", "path", "rule", "verdict"])

    return parts.mapInArrow(judged, f"page_id {kind}, host string, path string, rule string, verdict string")
