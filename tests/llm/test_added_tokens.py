import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from statloom.llm import common


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_equal_the_plain_library(name, odd):
    path = public_tokenizers.path(name)
    t, plain = common.PieceTokenizer(path), Tokenizer.from_file(path)
    more = ["ab <|endoftext|> cd", "x<|startoftext|>y", "ab <|EndOfText|> cd", "<|endoftext|><|endoftext|>", "a <|endof text|>", "\u023ax \u023e", "plain"]
    for text in [r.text or "" for r in odd.select("text").collect()] + more:
        assert t.encode(text) == np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
