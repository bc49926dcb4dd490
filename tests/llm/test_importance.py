"""Span digests against zlib, and the whole resampling against plain Python."""

import hashlib
import math
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import crc_spans, importance
from tests.llm.helpers import TEXTS, docs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=900), st.lists(st.tuples(st.integers(0, 900), st.integers(0, 900)), max_size=12))
def test_digests_equal_zlib(data, spans):
    spans = [(min(a, b, len(data)), min(max(a, b), len(data))) for a, b in spans]
    got = crc_spans.crc32_spans(np.frombuffer(data, np.uint8), np.array([a for a, _ in spans], np.int64), np.array([b for _, b in spans], np.int64))
    assert got.tolist() == [zlib.crc32(data[a:b]) for a, b in spans]


def test_very_long_spans():
    data = np.random.default_rng(3).integers(0, 256, 3_000_000, dtype=np.uint8)
    starts, ends = np.array([0, 5, 64, 1]), np.array([3_000_000, 2_999_999, 128, 1_000_001])
    assert crc_spans.crc32_spans(data, starts, ends).tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends)]


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def runs(text, n):
    w = words_of(text)
    return [zlib.crc32(" ".join(w[i:i + k]).encode()) % 100 for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def brute(rows, target, n, percent, least):
    s, t = [0] * 100, [0] * 100
    for _, text in rows:
        for b in runs(text, n):
            s[b] += 1
    for text in target:
        for b in runs(text, n):
            t[b] += 1
    gain = [math.floor(1000 * math.log((b + 1.0) * (sum(s) + 100.0) / ((a + 1.0) * (sum(t) + 100.0)))) for a, b in zip(s, t)]
    out = []
    for i, text in rows:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        f = runs(text, n)
        weight = sum(gain[b] for b in f)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words_of(text))])
    fit = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {}
    for place, r in enumerate(fit[:percent * len(fit) // 100], 1):
        rank.setdefault(id(r), place)
    return sorted(((r[0], r[1], r[2], r[3], rank.get(id(r))) for r in out), key=repr)


def drawn(spark, rows, target, n, percent, least, slices=None):
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id bigint, text string, score int, slice int").repartition(3)
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(df, bench, n, 100, percent, least, slices=slices)
    return sorted(map(tuple, got.collect()), key=repr)


def test_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    texts = [*TEXTS, *(" ".join(f"W{x}" for x in rng.zipf(1.5, rng.integers(0, 60)) % 50) for _ in range(80))]
    rows = list(enumerate(texts)) + [(None, "w1 w2 w3"), (None, None)]
    target = ["w1 w2 w3 w4", None, "", "w7 w7 one two"]
    for n, percent, least, slices in ((1, 10, 20, None), (1, 100, 0, 5), (3, 50, 1, 2)):
        assert drawn(spark, rows, target, n, percent, least, slices) == brute(rows, target, n, percent, least)


def test_repeated_rows_take_ranks_one_after_the_other(spark):
    rows = [(7, "a b c")] * 10 + [(8, "d e f")]
    got = drawn(spark, rows, ["a"], 1, 100, 1, 3)
    assert sorted(r[4] for r in got) == list(range(1, 12))
    assert {r[:4] for r in got} == {r[:4] for r in brute(rows, ["a"], 1, 100, 1)}


def test_empty_tables(spark):
    assert drawn(spark, [], ["a"], 1, 10, 1) == []
    assert drawn(spark, [(1, "a b")], [], 1, 100, 1) == brute([(1, "a b")], [], 1, 100, 1)
    assert importance.resample(docs(spark, []), docs(spark, [])).collect() == []
