"""What Python workers hold stays small."""

import random

import public_tokenizers
import pyarrow as pa

from panelmill.llm import prefix_bpe
from panelmill.llm.common import slices
from panelmill.llm.queries import VOCABULARY


def test_few_texts_at_a_time():
    batches = [pa.RecordBatch.from_arrays([pa.array(range(n))], ["x"]) for n in (0, 1300, 1, 512)]
    parts = list(slices(batches))
    assert [p.num_rows for p in parts] == [512, 512, 276, 1, 512]
    assert [x for p in parts for x in p.column(0).to_pylist()] == [x for b in batches for x in b.column(0).to_pylist()]


def test_a_word_is_remembered_once_and_pairs_are_bounded(monkeypatch):
    monkeypatch.setattr(prefix_bpe, "REMEMBER", 50)
    bpe = prefix_bpe.PrefixBPE.from_file(public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(9)) for _ in range(300)]
    for word in words:
        text = f"start {word} {word}, end"
        assert bpe.decode(bpe.encode(text)) == text.encode()
        assert bpe.encode(text) == [i for p in bpe.pattern.findall(text) for i in bpe.encode_piece(p.encode())]
        assert len(bpe.pairs) <= 2 * prefix_bpe.REMEMBER
    once = "".join(rnd.choice("klmnop") for _ in range(9))
    bpe.encode(f"start {once} end")
    assert once in bpe.words.new and " " + once not in bpe.pieces.new
