"""A Python worker gives up what one stage remembered when it begins with another."""

import public_tokenizers
import pyarrow as pa

from panelmill.llm import decontaminate, prefix_bpe
from panelmill.llm.common import slices
from panelmill.llm.queries import VOCABULARY

FILE = public_tokenizers.path(VOCABULARY)


def test_another_stage_gives_up_the_encoder():
    batch = pa.RecordBatch.from_arrays([pa.array(range(3))], ["x"])
    bpe = prefix_bpe.load(FILE, public_tokenizers.PATTERN)
    assert len(list(slices([batch], using=prefix_bpe.load))) == 1
    assert prefix_bpe.load(FILE, public_tokenizers.PATTERN) is bpe  # the next task of the stage finds it
    assert len(list(slices([batch]))) == 1
    assert prefix_bpe.load.cache_info().currsize == 0


def test_blocks_of_items_give_up_the_encoder():
    prefix_bpe.load(FILE, public_tokenizers.PATTERN)
    batch = pa.RecordBatch.from_arrays([pa.array(["a b"])], ["x"])
    assert sum(b.num_rows for b in decontaminate._buffered([batch, batch], 0)) == 2
    assert prefix_bpe.load.cache_info().currsize == 0
