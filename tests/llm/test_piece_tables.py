"""Words are kept in one table for both ways, their ids in flat arrays; keys of pieces that share a bit are all found."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece

from drillspark.llm import pieces

PIECE = public_tokenizers.path("piece_bpe_32k.model")


def test_words_of_both_ways_share_one_table():
    codec, sp = pieces.Codec(pieces.Pieces(PIECE)), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    texts = ["the well was drilled", "", "well \U0001F600 café the", "x" * 64 + " " + "ab" * 40]
    distinct, codes, offsets = codec.split(pa.array(texts))
    by_score, by_merge = codec.coded(distinct, False, True)
    assert set(codec.places) == set(distinct) and len(codec._held) == 2
    assert all(isinstance(flat, np.ndarray) and len(starts) == len(distinct) + 1 for flat, starts in codec._held)
    ids, ends = codec.laid_out(*by_merge, codes, offsets)
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == sp.encode(texts)
    assert codec.decode(*codec.laid_out(*by_score, codes, offsets)) == texts
    # asked again, with a new word among known ones, and in one way only
    assert np.array_equal(codec.coded([*distinct[:2], "▁bit"], False, True)[1][0], np.concatenate([by_merge[0][: by_merge[1][2]], codec.coded(["▁bit"], True)[0][0]]))


def test_every_piece_is_found_by_its_hash():
    p = pieces.Pieces(PIECE)
    assert p.crowd > 1
    assert p.find(p.keys).tolist() == p.ids.tolist()
    # other hashes of the same bit are no piece
    other = p.keys ^ np.uint64(1 << 63)
    assert (p.find(other[~np.isin(other, p.keys)]) < 0).all()
