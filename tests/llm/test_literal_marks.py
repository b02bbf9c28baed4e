"""Texts that hold the character written for a space."""

import zlib

import pyarrow as pa


def test_texts_with_the_space_mark_come_back(spark):
    from roomledger.llm.pieces import decode_pieces, sample_pieces
    texts = ["▁", "▁▁ ▁", " ▁a", "a▁b c", "bars ▁▂▃▄▅▆▇█ end", "a ▁ b\n▁", "plain words", "▁" * 200, "x" * 70 + "▁y▁" + "z" * 70, "two  ▁"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    coded = sample_pieces(df)
    assert dict(map(tuple, decode_pieces(coded).collect())) == dict(enumerate(texts))
    assert all(r.logprob < 1e-9 for r in coded.collect())


def test_a_literal_mark_is_its_three_bytes():
    import numpy as np
    import public_tokenizers

    from roomledger.llm.pieces import Lattice, spread_bytes, unit_table
    lattice = Lattice(public_tokenizers.path("piece_bpe_32k.model"))
    units, which, counts = unit_table(pa.array(["▁", "a ▁▁b"]))
    numbers = lattice.numbers(units)[which]
    doc = np.repeat(np.arange(2), counts)
    who, codes, _ = lattice.sample(numbers, doc.astype(np.uint64), np.arange(len(doc)))
    who, codes = spread_bytes(who, codes, lattice.first_byte)
    coded = bytes(int(c) - lattice.first_byte for c in codes if lattice.first_byte <= c < lattice.first_byte + 256)
    assert coded == "▁▁▁".encode() and zlib.crc32(coded) == zlib.crc32("▁▁▁".encode())
