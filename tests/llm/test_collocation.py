"""Phrase mining against counting by dictionary."""

import collections
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import collocation
from tests.llm.helpers import docs


def brute(rows, longest=3, least=10, top=2000, inside=50):
    count, n = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                count[lang].update(tuple(words[i:i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, c in count.items():
        cand = {k: v for k, v in c.items() if len(k) > 1 and v >= least}
        gone = {k[i:i + m] for k, v in cand.items() for m in range(2, len(k)) for i in range(len(k) - m + 1)
                if 100 * v >= inside * cand[k[i:i + m]]}
        best = []
        for k, a in cand.items():
            if k not in gone:
                score, cut = min((1000000 * a * a // (c[k[:j]] * c[k[j:]]), j) for j in range(1, len(k)))
                best.append((-score, -a, " ".join(k).encode(), c[k[:cut]], c[k[cut:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def mined(df, **kw):
    return sorted(tuple(r) for r in collocation.mine_phrases(df, **kw).collect())


ROWS = [("New York city, new york CITY. new york\tcity", "en"), ("the the the the", "en"), (None, "en"), ("", None), ("a b", None),
        ("x\x01 y x y\nx\x00 y", "e n\t%"), ("Ünï cödé Ünï cödé 漢字 漢字", "de"), ("the new york times " * 30, "en"), ("solo", "")]


@pytest.mark.parametrize("slices", [1, 3, 16])
@pytest.mark.parametrize("longest, least", [(2, 2), (3, 1), (4, 2)])
def test_equals_brute_force_over_range_borders(spark, slices, longest, least):
    df = spark.createDataFrame([(t, lang, "x", 1) for t, lang in ROWS * 3], "text string, lang string, key string, f int").repartition(4)
    assert mined(df, longest=longest, least=least, slices=slices) == brute(ROWS * 3, longest, least)


def test_hot_phrases_over_many_ranges(spark, monkeypatch):
    """One word begins and ends most phrases; ranges and chunks are tiny, so that its runs
    cross many of them."""
    monkeypatch.setattr(collocation, "CHUNK", 200)
    rows = [(f"hot w{i % 37} hot w{i % 11}; w{i % 5} hot", "en") for i in range(400)]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(6)
    for top in (2000, 7):
        assert mined(df, least=3, slices=23, top=top) == brute(rows, 3, 3, top)


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert mined(df) == brute([(r.text, r.lang) for r in df.select("text", "lang").collect()])


def test_empty_tables(spark):
    assert mined(docs(spark, []).withColumnRenamed("key", "lang")) == []
    assert mined(docs(spark, [None, "", " "]).withColumnRenamed("key", "lang")) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text(st.sampled_from(list("ab \t.\n\x01é")), max_size=30), st.sampled_from(["x", "x-y", "a b"])), max_size=6),
       st.integers(1, 4))
def test_records_are_sorted_runs(rows, longest):
    keys, counts = collocation.records([t.encode() for t, _ in rows], [lang for _, lang in rows], longest)
    keys = keys.to_pylist()
    assert keys == sorted(set(keys))
    want = collections.Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            for i in range(len(words)):
                want[collocation.escaped(lang).encode() + b"\t" + b"".join(w.encode() + b" " for w in words[i:i + longest])] += 1
    assert dict(zip(keys, counts.tolist())) == want


def test_long_texts_are_cut_at_breaks(monkeypatch):
    monkeypatch.setattr(collocation, "CHUNK", 10)
    assert collocation._cut(b"aaaa bbbbbbbbb ccc. dd") == (b"aaaa bbbbbbbbb ccc.", b" dd")
    assert collocation._cut(b"a" * 50) == (b"a" * 50, b"")
