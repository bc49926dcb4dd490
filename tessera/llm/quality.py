"""Quality rules: compression bands.

A document is kept when its zstandard ratio (compressed size / raw size) lies inside
a band that depends on its length, for the whole document and for fixed chunks of
it. Text that repeats itself compresses far too well; encoded or random text hardly
compresses at all. Short texts carry zstandard's frame overhead and no history, so
their limits are wider; the limits are a table by raw length.

Base rules (word count, repeated 5-word windows) come first and always reject.

Defined results: a null or empty text has no words, ``n_words`` 0, ``base_failed``
true, ratio null and ``kept`` false. A text shorter than the first band's length is
judged by the base rules alone. Rows are judged one by one, so ties, repeated rows
and extra columns change nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import SPACES, Words, byte_class, map_arrow, spans_of

#: (raw bytes from, lowest ratio, highest ratio) of whole documents. Upper limits lie
#: between the highest ratio of prose (rows of the 10,000 document table that pass the
#: base rules, all languages) and the lowest of base64 in lines, over the whole range:
#: 0.742 | 0.842 from 256 bytes, 0.696 | 0.810 from 512, 0.635 | 0.796 from 768,
#: 0.591 | 0.773 from 1024, 0.521 | 0.763 from 2048, 0.478 | 0.754 from 4096.
DOCUMENT_BANDS = ((256, 0.30, 0.82), (512, 0.30, 0.76), (768, 0.30, 0.73), (1024, 0.22, 0.70), (2048, 0.22, 0.67),
                  (4096, 0.17, 0.65), (65536, 0.12, 0.62))
#: Chunks are as long as CHUNK, in documents shorter than two of them half as long; the
#: last one joins its predecessor. Documents from CHUNK up have chunks. A document is
#: rejected when more than MAX_BAD_SHARE of its chunks leave the band of their length.
CHUNK = 4096
CHUNK_BANDS = ((2048, 0.19, 0.67), (4096, 0.15, 0.65))
MAX_BAD_SHARE = 0.5
LEVEL = 3
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5

_SYMBOLS = byte_class(b"#*$%&|<>")
_CONTINUATION = byte_class(range(0x80, 0xC0))

SCHEMA = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
          "n_repeat_words bigint, base_failed boolean, ratio double, bad_chunks bigint, n_chunks bigint, "
          "verdict string, kept boolean")


def base_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words per text."""
    w = Words(texts, lower=False)
    n = len(texts)

    def per_text(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[w.first_byte[1:] - 1] - sums[w.first_byte[:-1]]

    dup_lines = np.zeros(n, np.int64)
    for i, t in enumerate(texts):
        lines = [x for x in t.split(b"\n") if x.strip()]
        dup_lines[i] = len(lines) - len(set(lines))

    repeated = np.zeros(n, np.int64)
    at, grams = w.grams(w.hashes(), WINDOW)
    if len(at):
        owner = w.owner[at]
        order = np.lexsort((grams, owner))
        g, o = grams[order], owner[order]
        same = (g[1:] == g[:-1]) & (o[1:] == o[:-1])
        twice = np.zeros(len(g), bool)
        twice[1:] |= same
        twice[:-1] |= same
        hit = at[order[twice]]
        covered = np.zeros(len(w.starts), bool)
        for k in range(WINDOW):
            covered[hit + k] = True
        repeated = np.bincount(w.owner[covered], minlength=n)
    return {"n_words": w.counts, "word_chars": per_text(~SPACES[w.buf] & ~_CONTINUATION[w.buf]),
            "n_symbols": per_text(_SYMBOLS[w.buf]), "n_dup_lines": dup_lines, "n_repeat_words": repeated}


def band_of(length: int, bands=DOCUMENT_BANDS) -> tuple[float, float] | None:
    """Limits for that many bytes; None where they are too few to tell."""
    found = None
    for least, low, high in bands:
        if length >= least:
            found = (low, high)
    return found


def compression_verdict(text: bytes, compressor) -> tuple[float | None, int, int, str]:
    """(whole ratio, chunks out of band, chunks, verdict) of one text."""
    band = band_of(len(text))
    if not text:
        return None, 0, 0, "empty"
    ratio = len(compressor.compress(text)) / len(text)
    if band is None:
        return ratio, 0, 0, "short"
    if not band[0] <= ratio <= band[1]:
        return ratio, 0, 0, "repetitive" if ratio < band[0] else "incompressible"
    if len(text) < CHUNK:
        return ratio, 0, 1, "kept"
    size = CHUNK if len(text) >= 2 * CHUNK else CHUNK // 2
    cuts = list(range(0, len(text) - size + 1, size))
    bad = low = 0
    for k, a in enumerate(cuts):
        part = text[a:] if k == len(cuts) - 1 else text[a:a + size]
        least, most = band_of(len(part), CHUNK_BANDS)
        r = len(compressor.compress(part)) / len(part)
        low += r < least
        bad += not least <= r <= most
    verdict = "kept" if bad <= MAX_BAD_SHARE * len(cuts) else "repetitive chunks" if 2 * low >= bad else "incompressible chunks"
    return ratio, bad, len(cuts), verdict


def verdicts(texts: list[bytes]) -> dict[str, list]:
    """All result columns but the id."""
    import zstandard
    zstd = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
    out = base_counts(texts)
    failed = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * out["n_words"])
    figures = [compression_verdict(t, zstd) for t in texts]
    return out | {"base_failed": failed, "ratio": [f[0] for f in figures], "bad_chunks": [f[1] for f in figures],
                  "n_chunks": [f[2] for f in figures],
                  "verdict": ["base rules" if b else f[3] for b, f in zip(failed, figures)],
                  "kept": [bool(not b and f[3] in ("kept", "short")) for b, f in zip(failed, figures)]}


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: base counts, compression figures, verdict and ``kept``."""

    def judge(cols, texts):
        return verdicts(texts) | {"doc_id": cols["doc_id"]}

    source = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].alias("text"))
    return map_arrow(source, judge, SCHEMA, ["doc_id", "text"], "text")


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that all rules keep, all columns as they are."""

    @F.pandas_udf("boolean")
    def kept(texts: pd.Series) -> pd.Series:
        values = ["" if t is None else t for t in texts]
        out: list[bool] = []
        for a, b in spans_of([len(t) for t in values]):
            out += verdicts([t.encode("utf-8", "replace") for t in values[a:b]])["kept"]
        return pd.Series(out, dtype=bool)

    return docs.filter(kept(F.col(text_col)))
