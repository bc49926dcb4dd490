"""Importance resampling of a corpus towards a target distribution.

Features are runs of 1 to ``n`` words, hashed into buckets by CRC-32 (``crc_spans``: position
tables and ``bitwise_xor.reduceat``). Three passes:

1. every task counts the buckets of its documents with numpy and emits at most ``buckets``
   numbers; their sums, for corpus and target, come to the driver (``buckets`` numbers, a
   parameter, whatever the size of the corpus) and give one gain per bucket;
2. every document's weight is the sum of its features' gains; with Gumbel noise from a
   digest of its id this gives a score whose highest values are a sample without
   replacement proportional to exp(weight / 1000);
3. the eligible documents, a few numbers each, are dealt out in ranges of the score; the
   rows of earlier ranges plus the place in the own range are the rank.

Defined results: null and empty texts have no features, weight 0 and are never drawn
(``min_words`` above 0). A null id draws noise like the empty string and loses ties. Rows
that share id and score (repeated rows) take ranks one after the other. A corpus or a
target without rows counts as zeros. An empty corpus gives no rows; columns other than id
and text are not looked at. A very long text or word is folded block by block.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import LOWER, Words, arrow_schema, byte_class, pieces
from tessera.llm.crc_spans import crc32_spans
from tessera.llm.token_pieces import ragged
from tessera.llm.token_store import slices_for
from tessera.session import materialize

BUCKETS = 10_000
SEED = 2024
PERCENT = 10
MIN_WORDS = 20
WORD_BYTES = byte_class(bytes([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]))


def features(texts: list[bytes], n: int = 1, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every feature, text of every feature, words per text)."""
    words = Words(texts, WORD_BYTES)
    count = len(words.starts)
    size = words.ends - words.starts
    # the words of a text joined by one space each, so that every run of words is one span
    joined = np.full(int(size.sum()) + count, 0x20, np.uint8)
    first = np.cumsum(size + 1) - (size + 1)
    joined[ragged(first, size, np.arange(count))] = LOWER[words.buf[ragged(words.starts, size, np.arange(count))]]
    starts, ends, owner = [], [], []
    for k in range(1, n + 1):
        run = np.flatnonzero(words.owner[:count - k + 1] == words.owner[k - 1:]) if count >= k else np.empty(0, np.int64)
        starts.append(first[run])
        ends.append((first + size)[run + k - 1])
        owner.append(words.owner[run])
    digest = crc32_spans(joined, np.concatenate(starts), np.concatenate(ends))
    return (digest % np.uint32(buckets)).astype(np.int64), np.concatenate(owner), words.counts


def bucket_counts(docs: DataFrame, n: int = 1, buckets: int = BUCKETS, text_col: str = "text") -> np.ndarray:
    """Number of features of all ``docs`` in each bucket."""
    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, texts in pieces(batch, "text"):
                total += np.bincount(features(texts, n, buckets)[0], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    parts = docs.select(docs[text_col].alias("text")).mapInArrow(count, "bucket bigint, n bigint")
    out = np.zeros(buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log ratio) of the smoothed shares, bucket by bucket, in doubles."""
    b, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + b) / ((s + 1.0) * (t_all + b))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, n: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_features, n_words, weight of every document."""
    kind = dict(docs.dtypes)[id_col]
    schema = f"doc_id {kind}, n_features bigint, n_words bigint, weight bigint"
    arrow = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for cols, texts in pieces(batch, "text"):
                bucket, owner, n_words = features(texts, n, len(gain))
                order = np.argsort(owner, kind="stable") if n > 1 else slice(None)
                sums = np.concatenate([[0], np.cumsum(gain[bucket[order]])])
                at = np.searchsorted(owner[order], np.arange(len(texts) + 1))
                yield pa.RecordBatch.from_arrays([cols["doc_id"], pa.array(np.diff(at)), pa.array(n_words.astype(np.int64)),
                                                  pa.array(np.diff(sums[at]))], schema=arrow)

    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, schema)


def noise(doc_id, seed: int = SEED):
    """floor(-1000 ln(-ln u)) with u from the first 32 bits of the digest of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


def resample(docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = BUCKETS, percent: int = PERCENT,
             min_words: int = MIN_WORDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
             target_text: str = "text", slices: int | None = None) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null: not drawn) of every document."""
    gain = gains(bucket_counts(docs, n, buckets, text_col), bucket_counts(target, n, buckets, target_text))
    scored = weigh(docs, gain, n, id_col, text_col).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = materialize(scored.withColumn("row", F.monotonically_increasing_id()), "importance-scores")
    fits = scored.where(F.col("n_words") >= min_words)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()]
    dealt = fits.repartitionByRange(slices or slices_for(docs), *order).withColumn("slice", F.spark_partition_id())
    dealt = materialize(dealt, "importance-ranges")
    before, offsets = 0, []
    for r in sorted(dealt.groupBy("slice").count().collect()):
        offsets.append((r["slice"], before))
        before += r["count"]
    drawn = percent * before // 100
    place = docs.sparkSession.createDataFrame(offsets, "slice int, before bigint")
    rank = F.col("before") + F.row_number().over(Window.partitionBy("slice").orderBy(*order))
    ranked = dealt.join(F.broadcast(place), "slice").withColumn("rank", rank.cast("bigint"))
    keep = ["doc_id", "n_features", "weight", "score"]
    return (ranked.select(*keep, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
            .unionByName(scored.where(F.col("n_words") < min_words).select(*keep, F.lit(None).cast("bigint").alias("rank"))))
