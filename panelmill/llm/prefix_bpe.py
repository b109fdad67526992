"""Byte-level BPE by dynamic programming over prefixes.

The encoding of every prefix of a piece ends in one certain token, and two tokens may stand side by side exactly if
merging their joined bytes gives them back. So one last token per prefix describes the encoding of all prefixes:
text can be appended without touching what is there, and after an edit only the bytes from the edit on are redone.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from panelmill.llm.common import remembered, slices, texts

#: Words and pieces that a Python worker remembers, each, and half the pairs; what was not used for as long is forgotten.
REMEMBER = 200_000
#: The end of patterns in which a blank can only stand first in a match, unless white space is beside it.
BLANK_FIRST = r"| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Memory:
    """The last REMEMBER to 2 x REMEMBER entries that were used, in two generations."""

    def __init__(self, size: int = REMEMBER) -> None:
        self.new: dict = {}
        self.old: dict = {}
        self.size = size

    def get(self, key):
        value = self.new.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self.new) >= self.size:
            self.old, self.new = self.new, {}
        self.new[key] = value


class PrefixBPE:
    """``ranks``: token bytes to id, a lower id being merged first, as in a .tiktoken file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks the single bytes {missing[:5]}")
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        #: True for patterns in which a blank between two other characters always starts a match.
        self.split_at_blanks = pattern.endswith(BLANK_FIRST)
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks))
        #: The two parts that the last merge of a token joins; tokens that no merge gives are not there.
        self.halves: dict[int, tuple[int, int] | None] = {}
        for t, i in ranks.items():
            parts = self._merge(t, 2)
            if len(parts) == 1:
                self.halves[i] = None
            elif len(parts) == 2 and parts[0] + parts[1] == t:
                self.halves[i] = (ranks[parts[0]], ranks[parts[1]])
        self.joins = {h: i for i, h in self.halves.items() if h}
        self.endings = self._suffix_automaton([self.bytes_of[i] for i in self.halves])
        self.pairs, self.pieces, self.words = {}, Memory(), Memory()
        order = sorted(self.bytes_of)
        self.size_of = np.zeros(order[-1] + 1, np.int64)
        self.size_of[order] = [len(self.bytes_of[i]) for i in order]
        self.start_of = np.cumsum(self.size_of) - self.size_of
        self.all_bytes = np.frombuffer(b"".join(self.bytes_of[i] for i in order), np.uint8)

    @classmethod
    def from_file(cls, path: str, pattern: str) -> PrefixBPE:
        lines = Path(path).read_bytes().splitlines()
        return cls({base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x)}, pattern)

    def _merge(self, data: bytes, stop: int = 1) -> list[bytes]:
        """Merges by rank, the definition, until ``stop`` parts are left; used on the tokens themselves only."""
        parts = [data[i: i + 1] for i in range(len(data))]
        ranks = self.ranks
        while len(parts) > stop:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at: at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _suffix_automaton(self, tokens: list[bytes]) -> list[list[tuple[int, int]]]:
        """States for the longest token prefix that ends at a byte; each lists the tokens that end there, longest first.

        Only tokens that merging gives back are listed: no other can be the last token of a prefix.
        """
        steps: list[dict[int, int]] = [{}]
        whole = {0: None}
        for t in tokens:
            at = 0
            for c in t:
                if c not in steps[at]:
                    steps.append({})
                    steps[at][c] = len(steps) - 1
                at = steps[at][c]
            whole[at] = (self.ranks[t], len(t))
        back = [0] * len(steps)
        ends: list[list[tuple[int, int]]] = [[] for _ in steps]
        todo = [0]
        for at in todo:
            if whole.get(at):
                ends[at] = [whole[at], *ends[back[at]]]
            else:
                ends[at] = ends[back[at]]
            for c, to in steps[at].items():
                if at:
                    k = back[at]
                    while k and c not in steps[k]:
                        k = back[k]
                    back[to] = steps[k].get(c, 0)
                todo.append(to)
        self.steps, self.back = steps, back
        return ends

    def fits(self, left: int, right: int) -> bool:
        """Whether merging the joined bytes of two tokens gives the two back.

        Merges are undone from the latest on. What then stands at the border may not join to a token that would have
        been made before the merge just undone; at equal rank the one further left is made first.
        """
        joins, halves = self.joins, self.halves
        limit = len(self.size_of) + 1
        a, b = left, right
        while True:
            joined = self.ranks.get(self.bytes_of[a] + self.bytes_of[b]) if (a, b) not in joins else joins[a, b]
            if joined is not None and joined < limit:
                return False
            cut_a, cut_b = halves[a], halves[b]
            if cut_a and (not cut_b or a > b):
                limit, a = a, cut_a[1]
            elif cut_b:
                limit, b = b + 1, cut_b[0]
            else:
                return True

    def extend(self, data: bytes, last: list[int], start: int) -> list[int]:
        """``last[i]`` becomes the last token of ``data[:i + 1]`` for every i from ``start`` on."""
        del last[start:]
        steps, back, endings, fits, known = self.steps, self.back, self.endings, self.fits, self.pairs
        state = 0
        for end in range(max(0, start - self.longest), len(data)):  # the state before ``start`` depends on so many bytes
            c = data[end]
            while state and c not in steps[state]:
                state = back[state]
            state = steps[state].get(c, 0)
            if end < start:
                continue
            for token, size in endings[state]:
                begin = end - size
                if begin < 0:
                    break
                pair = last[begin] << 32 | token
                fit = known.get(pair)
                if fit is None:
                    if len(known) >= 2 * REMEMBER:
                        known.clear()
                    fit = known[pair] = fits(last[begin], token)
                if fit:
                    break
            last.append(token)
        return last

    def walk(self, last: list[int]) -> list[int]:
        out, end, size = [], len(last), self.bytes_of
        while end:
            token = last[end - 1]
            out.append(token)
            end -= len(size[token])
        return out[::-1]

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        return [whole] if whole is not None else self.walk(self.extend(piece, [], 0))

    def _pieces(self, text: str, word: bool = False) -> bytes:
        """``word``: the caller remembers the ids of ``text``, so a piece that is all of it need not be kept twice."""
        out = []
        for piece in self.pattern.findall(text):
            ids = self.pieces.get(piece)
            if ids is None:
                ids = np.array(self.encode_piece(piece.encode("utf-8", "replace")), "<u4").tobytes()
                if len(piece) <= 64 and not (word and len(piece) == len(text)):  # long ones are rare, and keeping them would make the memory unbounded
                    self.pieces.put(piece, ids)
            out.append(ids)
        return b"".join(out)

    def encode_packed(self, text: str) -> bytes:
        """The ids of ``text`` as little-endian unsigned 32-bit integers.

        Where ``split_at_blanks`` holds and every blank stands between two characters that are not white space, each
        blank starts a piece, and what is remembered of a word with the blank before it is used again.
        """
        if not self.split_at_blanks:
            return self._pieces(text)
        first, *rest = text.split(" ")
        if rest and (not first or first[-1].isspace()):
            return self._pieces(text)
        out, words = [self._pieces(first)], self.words
        for word in rest:
            ids = words.new.get(word)
            if ids is None and (ids := words.get(word)) is None:
                if not word or word[0].isspace() or word[-1].isspace():
                    return self._pieces(text)
                ids = self._pieces(" " + word, len(word) <= 64)
                if len(word) <= 64:
                    words.put(word, ids)
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed(text), "<u4").tolist()

    def decode(self, ids: np.ndarray | list[int]) -> bytes:
        ids = np.asarray(ids, np.int64)
        sizes = self.size_of[ids]
        shift = np.repeat(self.start_of[ids] - np.cumsum(sizes) + sizes, sizes)
        return self.all_bytes[shift + np.arange(len(shift))].tobytes()


class EditableEncoding:
    """A text with its encoding, for appends and edits that redo only what may change.

    Per piece the last token of each byte prefix is stored. A piece that starts before an edit and reaches the longest
    look-ahead is cut again from there; within the first changed piece the unchanged byte prefix keeps its tokens.
    """

    def __init__(self, bpe: PrefixBPE, text: str = "") -> None:
        self.bpe, self.text = bpe, ""
        self.cuts: list[tuple[int, bytes, list[int]]] = []  # start in the text, bytes, last token of each prefix
        self.replace(0, 0, text)

    def append(self, text: str) -> None:
        self.replace(len(self.text), len(self.text), text)

    def replace(self, start: int, end: int, text: str) -> None:
        old, keep = self.cuts, 0
        new = self.text[:start] + text + self.text[end:]
        while keep < len(old) and (old[keep + 1][0] if keep + 1 < len(old) else len(self.text)) < start:
            keep += 1
        keep = max(0, keep - 1)  # a piece also depends on the character after it
        at = old[keep][0] if keep < len(old) else 0
        shift = len(new) - len(self.text)
        later = {x[0] + shift: i for i, x in enumerate(old) if x[0] >= end}
        cuts = old[:keep]
        for m in self.bpe.pattern.finditer(new, at):
            if m.start() in later and m.start() >= start + len(text):
                cuts += [(s + shift, data, last) for s, data, last in old[later[m.start()]:]]
                break
            data = m.group().encode("utf-8", "replace")
            was = old[len(cuts)] if len(cuts) < len(old) and old[len(cuts)][0] == m.start() else (0, b"", [])
            same = next((i for i, (a, b) in enumerate(zip(data, was[1])) if a != b), min(len(data), len(was[1])))
            cuts.append((m.start(), data, self.bpe.extend(data, was[2][:same], same)))
        self.text, self.cuts = new, cuts

    def ids(self) -> list[int]:
        out = []
        for _, data, last in self.cuts:
            whole = self.bpe.ranks.get(data)
            out += [whole] if whole is not None else self.bpe.walk(last)
        return out


@remembered(4)
def load(path: str, pattern: str) -> PrefixBPE:
    """One encoder for each worker process that encodes."""
    return PrefixBPE.from_file(path, pattern)


def encode_documents(
    docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False,
) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256, and with ``keep_ids`` also ids.

    ``vocabulary`` is the path of a .tiktoken file that every executor has. Each match of ``pattern`` is encoded by
    itself, without special tokens. A null or empty text has no tokens. The ids are decoded again, and bytes that
    differ from the text's raise. Texts of any length are encoded whole.
    """
    rows = texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, using=load):
            bpe = load(vocabulary, pattern)
            counts, shas, backs, lists = [], [], [], []
            for text in b.column(1).to_pylist():
                packed = bpe.encode_packed(text)
                ids = np.frombuffer(packed, "<u4")
                back = bpe.decode(ids)
                if back != text.encode("utf-8", "replace"):
                    raise ValueError("the pattern does not cover a text")
                counts.append(len(ids))
                shas.append(hashlib.sha256(packed).hexdigest())
                backs.append(hashlib.sha256(back).hexdigest())
                if keep_ids:
                    lists.append(ids.view(np.int32))
            cols = [b.column(0), pa.array(counts, pa.int64()), pa.array(shas, pa.string()), pa.array(backs, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                cols.append(pa.array(lists, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if keep_ids else "")
    return rows.mapInArrow(encode, schema)
