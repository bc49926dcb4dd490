import random

import public_tokenizers as P
import pytest
import tiktoken

from tessera.llm import bpe
from tests.llm.helpers import TEXTS, docs

PATH = P.path("byte_bpe_50k.tiktoken")
RANKS = bpe.load_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_transducer_equals_library_on_random_pieces():
    machine = bpe.Transducer(RANKS)
    rng = random.Random(11)
    for _ in range(6000):
        letters = rng.choice([b"abcdehint ", bytes(range(256)), "éàñßü漢字🙂".encode(), b"  \n\t", b"aaaa0000"])
        piece = bytes(rng.choice(letters) for _ in range(rng.randrange(1, 40)))
        assert machine.encode(piece) == LIBRARY._encode_single_piece(piece), piece


def test_transducer_survives_state_resets(monkeypatch):
    monkeypatch.setattr(bpe, "MAX_STATES", 20)
    machine = bpe.Transducer(RANKS)
    for w in ("transducer", "lookahead", "determinised", "straße", "transducers") * 3:
        assert machine.encode(w.encode()) == LIBRARY._encode_single_piece(w.encode())
    assert len(machine.states) < 60


def test_every_token_encodes_to_itself():
    machine = bpe.Transducer(RANKS)
    for token, rank in list(RANKS.items())[::7]:
        assert machine.encode(token) == [rank]


def test_round_trip(spark):
    texts = [*TEXTS, "<|endoftext|>", "it's  we'll don't x", "é" * 5000]
    tokens = bpe.encode_documents(docs(spark, texts), PATH, P.PATTERN)
    rows = {r.doc_id: r for r in bpe.decode_documents(tokens, PATH).collect()}
    assert rows == {r.doc_id: r for r in bpe.round_trip_documents(docs(spark, texts), PATH, P.PATTERN).collect()}
    for i, t in enumerate(texts):
        ids = LIBRARY.encode_ordinary(t or "")
        assert rows[i].ids == " ".join(map(str, ids)) and rows[i].n_tokens == len(ids)
        assert bytes(rows[i].decoded) == (t or "").encode() and rows[i].n_chars == len(t or "")
    assert bpe.encode_documents(docs(spark, []), PATH, P.PATTERN).count() == 0


def test_streaming_decode_carries_characters_over_chunks(monkeypatch):
    table = {str(v): k for k, v in RANKS.items()}
    ids = " ".join(map(str, LIBRARY.encode_ordinary("漢字🙂é" * 30)))
    monkeypatch.setattr(bpe, "STREAM_TOKENS", 1)
    assert bpe.decode_ids(ids, table) == (("漢字🙂é" * 30).encode(), 120)
    with pytest.raises(UnicodeDecodeError):
        bpe.decode_ids(ids.split()[0], table) if len(table[ids.split()[0]]) < 3 else bpe.decode_ids(str(RANKS[b"\xe6"]), table)
    with pytest.raises(KeyError):
        bpe.decode_ids("999999", table)


def test_memo_is_bounded():
    from tessera.llm.common import Memo
    memo = Memo(lambda keys: [k * 2 for k in keys], 10)
    for a in range(0, 100, 3):
        known = memo.ready({a, a + 1, a + 2})
        assert known[a] == 2 * a and known[a + 2] == 2 * a + 4
        assert len(memo.new) + len(memo.old) <= 12
