"""Ids by units against the public library, on words that its pattern and its normal form make hard."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from ratewell.llm.packing import text_blocks, word_ids

PIECES = (
    "'s 'S ' a É ß İ ſ µ ª × é 1 ² ٣ & <|endoftext|> </w> < / w > 漢 ﬁ Ǆ Σ ς 😀 'Ll don't I'VE ÿ Ÿ ẞ".split(" ")
    + [" ", "\t", "\xa0", " ", "\x1c", "\x85", "́", "‍", "\xad", "\x00", "\x7f"]
)


def test_units_give_the_tokenizers_ids():
    path = public_tokenizers.path("word_bpe_49k.json")
    rng = random.Random(3)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 40))) for _ in range(3_000)]
    tokenizer = Tokenizer.from_file(path)
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    ids, stops = word_ids(path)(pa.array(texts))
    assert [part.tolist() for part in np.split(ids, stops)[:-1]] == want


def test_tokens_that_the_tokenizer_finds_in_raw_text():
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["hello <|endoftext|> world", "a<|endoftext|>b", "<|ENDOFTEXT|> no", "", "plain text", "x <|startoftext|>", " \t"]
    tokenizer = Tokenizer.from_file(path)
    want = [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    assert want[0] == [3306, 49407, 1002]
    array = pa.array(["skipped", *texts]).slice(1)
    ids, stops = word_ids(path)(array)
    assert [part.tolist() for part in np.split(ids, stops)[:-1]] == want


def test_blocks_hold_every_text_once():
    texts = pa.array(["x" * n for n in (0, 3, 50, 1, 1, 0, 9, 0)])
    for size in (1, 5, 10, 1000):
        blocks = list(text_blocks(texts, size))
        assert [first for first, _ in blocks] == np.cumsum([0, *(len(part) for _, part in blocks[:-1])]).tolist()
        assert pa.concat_arrays([part for _, part in blocks]) == texts
