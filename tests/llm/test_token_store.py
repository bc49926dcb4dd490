"""Token ids in ORC: equal to the library, in order, prunable by metadata."""

import glob
import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyarrow import orc
from tokenizers import Tokenizer

from tessera.llm import token_pieces, token_store
from tessera.session import scratch_path
from tests.llm.helpers import TEXTS, docs

VOCAB = public_tokenizers.path("byte_bpe_50k.json")
AWKWARD = ["<|endoftext|> a", "don't 'S ''s \"'re x'ses", "é ́x\x0by\x85z 　q", "a  b\n\n c \t d", "\x1c \x1d", "  ", "\n", "x  y", "12a3.4,,'", "İ≯ Σ"]


def library(text, path=VOCAB, as_text=True):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = as_text
    return t.encode(text or "", add_special_tokens=False).ids


def local(folder):
    return folder.removeprefix("file:")


def test_files_hold_every_document_in_order(spark):
    texts = [*TEXTS, *AWKWARD]
    folder = token_store.write_tokens(docs(spark, texts).repartition(5), scratch_path(spark, "tokens"), VOCAB, slices=4)
    rows = sorted(token_store.read_tokens(spark, folder).collect())
    start = 0
    for r, t in zip(rows, texts, strict=True):
        want = [*library(t), 2]
        assert (r.ids, r.n_tokens, r.start) == (want, len(want), start)
        start += len(want)
    crc = {r.doc_id: r.ids_crc32 for r in token_store.with_crc32(token_store.read_tokens(spark, folder)).collect()}
    assert all(crc[r.doc_id] == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in rows)


def test_stripes_and_pruning(spark):
    n = 6000
    texts = [f"w{i} " + " ".join(str(hash((i, k)) % 10**9) for k in range(30)) for i in range(n)]
    folder = token_store.write_tokens(docs(spark, texts, extra=False), scratch_path(spark, "tokens"), VOCAB,
                                      slices=3, stripe_bytes=64 << 10, stride=1000)
    files = sorted(glob.glob(os.path.join(local(folder), "*.orc")))
    bounds = []
    for f in files:
        o = orc.ORCFile(f)
        assert o.row_index_stride == 1000 and o.nstripes >= 1
        ids = o.read(columns=["doc_id"])["doc_id"].to_pylist()
        assert ids == sorted(ids)
        bounds.append((ids[0], ids[-1]))
    assert max(orc.ORCFile(f).nstripes for f in files) > 1
    assert all(a[1] < b[0] for a, b in zip(sorted(bounds), sorted(bounds)[1:]))
    some = token_store.read_tokens(spark, folder, [17, 4321, n + 5])
    assert "PushedFilters: [In(doc_id" in some._jdf.queryExecution().toString()
    got = {r.doc_id: r.ids for r in some.collect()}
    assert set(got) == {17, 4321} and got[4321] == [*library(texts[4321]), 2]
    whole = {r.doc_id: r.start for r in token_store.read_tokens(spark, folder).collect()}
    assert {r.doc_id: r.start for r in some.collect()} == {k: whole[k] for k in got}


def test_bloom_filters_are_written(spark):
    folder = token_store.write_tokens(docs(spark, ["a"] * 50, extra=False), scratch_path(spark, "tokens"), VOCAB, slices=1)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    file = sorted(glob.glob(os.path.join(local(folder), "*.orc")))[0]
    reader = jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(file), jvm.org.apache.orc.OrcFile.readerOptions(conf))
    footer = reader.rows().readStripeFooter(reader.getStripes().get(0))
    kinds = {footer.getStreams(i).getKind().toString() for i in range(footer.getStreamsCount())}
    assert {"ROW_INDEX", "BLOOM_FILTER_UTF8"} <= kinds
    assert "DIRECT_V2" in {footer.getColumns(i).getKind().toString() for i in range(footer.getColumnsCount())}


def test_repeated_null_ids_and_empty_tables(spark):
    df = spark.createDataFrame([(7, "b b"), (7, "a"), (None, "zz"), (7, "a"), (3, None)], "doc_id bigint, text string")
    rows = token_store.read_tokens(spark, token_store.write_tokens(df, scratch_path(spark, "tokens"), VOCAB, slices=2)).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 3, 7, 7, 7]
    assert [r.start for r in rows] == list(np.cumsum([0] + [r.n_tokens for r in rows])[:-1])
    assert sorted(r.ids for r in rows) == sorted([*library(t), 2] for t in ("b b", "a", "zz", "a", None))
    empty = token_store.write_tokens(docs(spark, []), scratch_path(spark, "tokens"), VOCAB)
    assert token_store.with_crc32(token_store.read_tokens(spark, empty)).collect() == []


_text = st.text(st.sampled_from(list("ab Zé's'tre  \n\t\r12.,!<|>_ 　中\u0085\x1c\x00≠Σİ​🎉́")), max_size=50)


@pytest.mark.parametrize("name, spaced, lower", [("byte_bpe_50k.json", True, False), ("word_bpe_49k.json", False, True)])
@pytest.mark.parametrize("as_text", [True, False])
def test_pieces_give_the_library_ids(name, spaced, lower, as_text):
    path = public_tokenizers.path(name)
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = as_text

    @settings(max_examples=80, deadline=None)
    @given(st.lists(_text, max_size=8))
    def check(texts):
        texts = [*texts, *AWKWARD]
        for end in (None, 9):
            ids, at = token_pieces.token_ids([t.encode() for t in texts], path, end, spaced, lower, as_text, memo_pieces=64)
            for i, t in enumerate(texts):
                assert ids[at[i]:at[i + 1]].tolist() == tokenizer.encode(t, add_special_tokens=False).ids + ([9] if end else [])

    check()
    ids, at = token_pieces.token_ids([], path, 2, spaced)
    assert len(ids) == 0 and at.tolist() == [0]
