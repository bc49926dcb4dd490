import base64
import collections
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import quality
from tests.llm.helpers import TEXTS, docs


def brute(s):
    w = re.findall(r"[^\x20\x09-\x0D]+", s or "")
    grams = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = set()
    for i in range(len(w) - 4):
        if grams[tuple(w[i:i + 5])] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in (s or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", s or "")), len(lines) - len(set(lines)), len(covered))


def test_base_counts_on_fixture(spark):
    rows = {r.doc_id: r for r in quality.quality_rules(docs(spark)).collect()}
    for i, t in enumerate(TEXTS):
        r, e = rows[i], brute(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == e
        assert r.base_failed == (e[0] < 10 or 100 * e[4] > 20 * e[0])
        assert not (r.base_failed and r.kept)
    assert quality.quality_rules(docs(spark, [])).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t\x0b#é|", max_size=60), min_size=1, max_size=8))
def test_base_counts_equal_brute_force(texts):
    out = quality.base_counts([t.encode() for t in texts])
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert [tuple(int(out[n][i]) for n in names) for i in range(len(texts))] == [brute(t) for t in texts]


def test_bands_reject_repetitive_and_incompressible_text():
    import zstandard
    zstd = zstandard.ZstdCompressor(level=quality.LEVEL, write_content_size=False)
    rng = random.Random(2)
    prose = " ".join("".join(rng.choice("aeiourtnsl") for _ in range(rng.randrange(2, 9))) for _ in range(2000))
    noise = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(9000))
    judge = lambda t: quality.compression_verdict(t.encode(), zstd)[3]
    assert judge(prose) == "kept"
    assert judge("all work and no play. " * 500) == "repetitive"
    assert judge(noise) == "incompressible"
    half = prose[:9000] + "".join(f"same line again and again {i % 3}\n" for i in range(900))
    assert judge(half).startswith("repetitive")
    assert judge("") == "empty" and judge("short text") == "short"


def encoded(rng, size):
    raw = base64.b64encode(rng.randbytes(size)).decode()
    return "\n".join(raw[i:i + 76] for i in range(0, len(raw), 76))[:size]


def test_encoded_text_is_rejected_alone_and_mixed_with_prose(spark):
    import zstandard
    zstd = zstandard.ZstdCompressor(level=quality.LEVEL, write_content_size=False)
    rng = random.Random(5)
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("length(text) > 400").collect()
    good = [r.text for r, k in zip(rows, quality.verdicts([r.text.encode() for r in rows])["kept"]) if k]
    by_lang = collections.defaultdict(list)
    for r in rows:
        if r.text in set(good):
            by_lang[r.lang].append(r.text)
    assert len(by_lang) == 4 and len(good) > 0.8 * len(rows)
    for size in (800, 1500, 3000, 5000, 20_000):
        for texts in by_lang.values():
            whole = encoded(rng, size)
            most = encoded(rng, size * 8 // 10)
            prose = " ".join(texts)[:size]
            cases = [whole, prose[:size - len(most)] + "\n" + most, most + "\n" + prose[:size - len(most)], prose]
            out = [quality.compression_verdict(t.encode(), zstd)[3] for t in cases]  # copies in the joined prose fail base rules
            assert all(v.startswith("incompressible") for v in out[:3]) and out[3] == "kept", (size, out)
            assert not any(quality.verdicts([t.encode() for t in cases[:3]])["kept"])


def test_chunks_are_judged_by_the_band_of_their_length():
    import zstandard
    zstd = zstandard.ZstdCompressor(level=quality.LEVEL, write_content_size=False)
    rng = random.Random(7)
    prose = " ".join("".join(rng.choice("aeiourtnsl") for _ in range(rng.randrange(2, 9))) for _ in range(9000))
    for size, share, n in ((4096, 0.55, 2), (6200, 0.6, 3), (8191, 0.6, 3), (20_000, 0.65, 4)):
        text = prose[:size - int(share * size)] + encoded(rng, int(share * size))
        ratio, bad, chunks, verdict = quality.compression_verdict(text.encode(), zstd)
        assert chunks in (n, 0) and verdict.startswith("incompressible"), (size, ratio, bad, chunks, verdict)
        assert quality.compression_verdict(prose[:size].encode(), zstd)[1:] == (0, n, "kept")
