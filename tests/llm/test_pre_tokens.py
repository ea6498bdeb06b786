"""A slice's pre-tokens are looked up once, and ids are the tokenizer's whether they are kept or forgotten."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tokenizers

from drillspark.llm import packing

BPE = public_tokenizers.path("word_bpe_49k.json")
SLICES = [["The well's 12 bits", None, "", "naïve café"], ["the well <|x|> 日本 bits", "don't 3 a"], ["The well's 12 bits", "日本 ſ new"]]


@pytest.mark.parametrize("kept", [200_000, 6])
def test_one_look_up_a_slice(monkeypatch, kept):
    calls, index_in = [], packing.pc.index_in
    monkeypatch.setattr(packing.pc, "index_in", lambda *a, **b: calls.append(1) or index_in(*a, **b))
    monkeypatch.setattr(packing, "_CACHE_WORDS", kept)
    encode, tk = packing.WordTokenizer(BPE), tokenizers.Tokenizer.from_file(BPE)
    for texts in SLICES:
        ids, offsets = encode(pa.array(texts, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == [tk.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert len(encode.known) == len(set(encode.known.to_pylist())) == len(encode.starts) - 1 and isinstance(ids, np.ndarray)
    assert len(calls) == len(SLICES)
