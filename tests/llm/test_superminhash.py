import random
import re

import numpy as np
import pytest

from tessera.llm import superminhash as M
from tessera.llm.components import connected_components
from tests.llm.helpers import TEXTS, docs


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def brute(texts):
    sets = [shingles(t) for t in texts]
    comp = list(range(len(texts)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                x, y = root(i), root(j)
                comp[max(x, y)] = min(x, y)
    return [(len(s), root(i), root(i) == i) for i, s in enumerate(sets)]


def corpus(seed=4):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    texts = list(TEXTS)
    for size in (6, 9, 30, 200, 700):
        base = [word() for _ in range(size)]
        for changes in (0, 0, 1, 1, 2, 3, size // 30, size // 20, size // 12):
            copy = list(base)
            for _ in range(changes):
                copy[rng.randrange(size)] = word()
            texts.append(" ".join(copy))
    passage = [word() for _ in range(60)]
    texts += [" ".join([word() for _ in range(n)] + passage + [word() for _ in range(n)]) for n in (3, 5, 8, 10, 20, 40) for _ in range(4)]
    return texts


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in M.near_duplicates(df).collect()}


def test_components_equal_brute_force(spark):
    texts = corpus()
    assert result(docs(spark, texts).repartition(5)) == dict(enumerate(brute(texts)))


def test_large_group_without_common_leader(spark, monkeypatch):
    """Copies that differ from one text in distinct places are often not similar to each
    other; small blocks make many block pairs."""
    monkeypatch.setattr(M, "BLOCK", 16)
    monkeypatch.setattr(M, "SET_BLOCK", 5)
    rng = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(60):
        copy = list(base)
        for _ in range(3):
            copy[rng.randrange(120)] = f"x{rng.randrange(10 ** 6)}"
        texts.append(" ".join(copy))
    texts.append(" ".join(base))
    assert result(docs(spark, texts)) == dict(enumerate(brute(texts)))


def test_link_that_only_the_residual_round_finds(spark):
    """Leaders are neither of two similar texts in any of their buckets: the links come
    from members meeting another component."""
    rng = random.Random(1)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for step in range(40):  # a chain of texts, each similar to its neighbours only
        copy = list(base)
        for i in range(step * 8, step * 8 + 60):
            copy[i % 200] = f"y{i}"
        texts.append(" ".join(copy))
    rng.shuffle(texts)
    assert result(docs(spark, texts)) == dict(enumerate(brute(texts)))


def test_similar_is_exact():
    rng = np.random.default_rng(4)
    for _ in range(300):
        n, m = rng.integers(1, 60, 2)
        a, b = (np.unique(rng.integers(0, 50, k).astype(np.uint64)) for k in (n, m))
        both = len(np.intersect1d(a, b))
        assert M.similar(a, b) == (100 * both >= 75 * (len(a) + len(b) - both))


def test_empty_and_null(spark):
    assert M.near_duplicates(docs(spark, [])).count() == 0
    df = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (5, None), (4, "A b C d e f")], "doc_id bigint, text string")
    rows = sorted((str(r.doc_id), r.component_id, r.kept) for r in M.near_duplicates(df).collect())
    assert rows[:4] == [("3", 3, True), ("3", 3, True), ("4", 3, False), ("5", 5, True)]
    kept = sorted(str(r.doc_id) for r in M.keep_one(df).collect())
    assert kept == ["3", "3", "5", "None"]


def test_early_stop_equals_full_run():
    """Signatures equal those of the definition, element by element without stopping."""
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 60, 900):
        grams = np.sort(rng.integers(1, 2 ** 63, n, dtype=np.uint64))
        got = M.signatures(grams, np.array([n]), 16)[0]
        want = np.full(16, 16.0)
        state = M.mix(grams + M._STEP)
        for s in state:
            perm = list(range(16))
            for j in range(16):
                bits = M.mix(np.array([s]) + np.uint64((j + 1) * int(M._STEP) & (1 << 64) - 1))
                r = j + float(bits[0] >> np.uint64(11)) * 2.0 ** -53
                k = j + int(M.mix(bits + M._STEP)[0] % np.uint64(16 - j))
                perm[j], perm[k] = perm[k], perm[j]
                want[perm[j]] = min(want[perm[j]], r)
        assert np.array_equal(got, want)


def test_estimates_are_close():
    rng = np.random.default_rng(0)
    errors = []
    for _ in range(80):
        a = rng.integers(1, 2 ** 63, 150, dtype=np.uint64)
        b = np.concatenate([a[:129], rng.integers(1, 2 ** 63, 21, dtype=np.uint64)])
        v = M.signatures(np.concatenate([np.sort(a), np.sort(b)]), np.array([150, 150]))
        errors.append((v[0] == v[1]).mean() - 129 / 171)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.045


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(300)], [(0, i) for i in range(1, 200)] + [(500, 501)],
                                   [(i, 2 * i) for i in range(1, 150)], [(None, 3), (4, None), (7, 6), (6, 7)]])
def test_connected_components(spark, edges):
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    comp = {x: x for e in edges if None not in e and e[0] != e[1] for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a in comp and b in comp and comp[a] != comp[b]:
                comp[a] = comp[b] = min(comp[a], comp[b])
                changed = True
    assert got == comp


def test_pair_with_few_equal_slots_is_compared(spark):
    from math import comb
    miss = sum(comb(M.SLOTS, i) * 0.75 ** i * 0.25 ** (M.SLOTS - i) for i in range(M.LEAST_SLOTS))
    assert miss < (1 - 0.75 ** M.ROWS) ** M.BANDS / 10   # the sieve adds little to the loss of the bands
    host, guest = np.zeros(M.SLOTS, np.uint8), np.arange(M.SLOTS, dtype=np.uint8) // 71 * 9  # 71 of 128 equal
    assert (host == guest).sum() == 71
    a = np.arange(100, dtype=np.uint64)
    b = np.concatenate([a[:88], a[88:] + np.uint64(1000)])
    assert M.similar(a, b)
    sets = spark.createDataFrame([(1, host.tobytes(), a.tobytes()), (2, guest.tobytes(), b.tobytes())], "id bigint, sig binary, grams binary")
    cand = spark.createDataFrame([(2, 1)], "u bigint, c bigint")
    comps = spark.createDataFrame([(1, 1)], "id bigint, comp bigint")
    assert [tuple(r) for r in M.visits(cand, comps, sets).collect()] == [(2, 1)]
    rows = [("k", 0, 0, 0, 1, 1, 2, 100, host.tobytes()), ("k", 0, 0, 0, 2, 2, 1, 100, guest.tobytes())]
    members = spark.createDataFrame(rows, "key string, x bigint, y bigint, blk bigint, id bigint, comp bigint, members bigint, n_shingles bigint, sig binary")
    assert [tuple(r) for r in M.visitors(members).collect()] == [(2, 1)]
