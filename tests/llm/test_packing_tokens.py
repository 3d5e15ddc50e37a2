"""Texts that hold the string of an added token."""

import numpy as np
import pytest
from tokenizers import Tokenizer

from kpiweave.llm import packing


@pytest.mark.parametrize("text", ["<|endoftext|>", "one<|endoftext|> two", "東京 <|endoftext|>", "<|endoftext|", "plain"])
def test_added_tokens_have_their_id(text):
    plain = Tokenizer.from_file(packing.default_tokenizer())
    found = np.frombuffer(packing.encoder(packing.default_tokenizer()).encode(text), "<u4").tolist()
    assert found == plain.encode(text, add_special_tokens=False).ids
    assert (plain.token_to_id("<|endoftext|>") in found) == ("<|endoftext|>" in text)
