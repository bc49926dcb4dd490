import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm import packing
from tests.llm.helpers import TEXTS, docs

VOCAB = public_tokenizers.path("word_bpe_49k.json")


def expected(text):
    ids = Tokenizer.from_file(VOCAB).encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, 1], "<u4")


def test_pieces_hold_every_id_once(spark):
    texts = [*TEXTS, "<|endoftext|> a<|startoftext|>b", "é ́x\x0by\x85z 　q"]
    rows = packing.pack_documents(docs(spark, texts), VOCAB).collect()
    for i, t in enumerate(texts):
        ids, mine = expected(t), sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        assert b"".join(r.ids for r in mine) == ids.tobytes()
        assert [r.start for r in mine] == list(np.cumsum([0] + [r.length for r in mine])[:-1])
        assert all(r.doc_tokens == len(ids) and zlib.crc32(r.ids) == zlib.crc32(ids[r.start:r.start + r.length].tobytes()) for r in mine)


def test_sequences_are_gapless_and_bounded(spark):
    rows = packing.pack_documents(docs(spark).repartition(3), VOCAB).collect()
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.WINDOW


def test_empty_table(spark):
    assert packing.pack_documents(docs(spark, []), VOCAB).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), min_size=1, max_size=60))
def test_pool_never_exceeds_capacity(sizes):
    window = packing.pack_pool(sizes, 64)
    sums = np.bincount(window, weights=sizes)
    assert len(window) == len(sizes) and sums.max() <= 64


def test_differencing_balances():
    rng = np.random.default_rng(5)
    sizes = [int(x) for x in rng.integers(1, 512, 1200)]
    window, sums = packing.differencing(sizes, 100)
    assert (np.bincount(window, weights=sizes, minlength=100) == sums).all()
    assert sums.max() - sums.min() <= 8
    window = packing.pack_pool(sizes, 2048)
    assert sum(sizes) / 2048 / (window.max() + 1) > 0.985
