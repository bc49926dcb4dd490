"""Token ids in ORC: one row per document in ascending id order, integer run-length
encoding, row indexes and Bloom filters on the document id.

``write_tokens`` deals the documents out by (id, hash of the text) in ranges, so that a
file holds neighbouring ids in order and an id that very many rows share is spread over
several files; each task then encodes its range text by text and writes one ORC file:

* ``doc_id``, ``slice`` (number of the range), ``slice_start`` (ids before it in the
  range), ``n_tokens`` and ``ids`` as an array of integers, which ORC stores run-length
  encoded and bit-packed, in stripes with one index entry per ``STRIDE`` rows;
* min/max statistics and a Bloom filter of ``doc_id`` in every stripe and index entry, so
  that a reader asking for some ids skips files, stripes and row groups by metadata.

``read_tokens`` reads the stripes in parallel (a file is split at stripes) and turns the
place inside the range into the place in the whole stream: the totals of the ranges
(one number per range, at most ``MAX_SLICES``) are summed on the driver. With ``doc_ids``
the condition is pushed into the ORC reader.

Defined results: null and empty texts hold the end id alone; null ids come first; rows
that share an id stand together in the order of a hash of their texts, then of the
texts, repeated rows one after the other. An empty table gives an empty stream; columns
other than id and text are not looked at. The strings of special tokens in a text are
ordinary text. A very long text is one row. Rows are dealt by the data alone, so a task
repeated after a lost executor writes the same file.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import arrow_schema, pieces
from tessera.llm.token_pieces import CHUNK, token_ids

END_ID = 2
STRIDE = 1000
STRIPE_BYTES = 16 << 20
BLOOM_FPP = 0.01
ROWS_BETWEEN_CHECKS = 200  # how often the writer compares the open stripe with its size
MAX_SLICES = 20_000


def slices_for(df: DataFrame) -> int:
    """Number of ranges: as many as the scan has splits, at least the session's shuffle
    partitions, at most ``MAX_SLICES`` (each range's total and bounds visit the driver)."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(least, min(df.rdd.getNumPartitions(), MAX_SLICES))


def _list_array(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.view(np.int32)))


def encode_slices(docs: DataFrame, vocabulary: str, end_id: int = END_ID, slices: int | None = None,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents in ascending id order over ranges, encoded: doc_id, slice, slice_start,
    n_tokens, ids."""
    source = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = dict(source.dtypes)["doc_id"]
    schema = f"doc_id {kind}, slice int, slice_start bigint, n_tokens bigint, ids array<int>"
    arrow = arrow_schema(schema)
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = source.repartitionByRange(slices or slices_for(source), *order).sortWithinPartitions(*order, "text")

    def encode(batches):
        number, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            for cols, texts in pieces(batch, "text", CHUNK):
                flat, offsets = token_ids(texts, vocabulary, end_id, spaced=True)
                yield pa.RecordBatch.from_arrays([
                    cols["doc_id"], pa.array(np.full(len(texts), number, np.int32)), pa.array(start + offsets[:-1]),
                    pa.array(np.diff(offsets)), _list_array(flat, offsets)], schema=arrow)
                start += int(offsets[-1])

    return dealt.mapInArrow(encode, schema)


def write_tokens(docs: DataFrame, folder: str, vocabulary: str, end_id: int = END_ID, slices: int | None = None,
                 id_col: str = "doc_id", text_col: str = "text", stripe_bytes: int = STRIPE_BYTES, stride: int = STRIDE) -> str:
    """Write the ORC files of ``docs`` and return the folder."""
    (encode_slices(docs, vocabulary, end_id, slices, id_col, text_col).write.mode("overwrite")
     .option("compression", "zstd")
     .option("orc.create.index", "true").option("orc.row.index.stride", str(stride))
     .option("orc.stripe.size", str(stripe_bytes)).option("orc.rows.between.memory.checks", str(ROWS_BETWEEN_CHECKS))
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", str(BLOOM_FPP))
     .orc(folder))
    return folder


def read_tokens(spark: SparkSession, folder: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids of all documents, or of some: their condition prunes
    files, stripes and row groups. Starts count the ids of all documents either way."""
    stored = spark.read.orc(folder)
    before, starts = 0, []
    for r in sorted(stored.groupBy("slice").agg(F.sum("n_tokens").alias("n")).collect()):
        starts.append((r["slice"], before))
        before += r["n"]
    rows = stored if doc_ids is None else stored.where(F.col("doc_id").isin(doc_ids))
    place = spark.createDataFrame(starts, "slice int, before bigint")
    return (rows.join(F.broadcast(place), "slice")
                .select("doc_id", (F.col("before") + F.col("slice_start")).alias("start"), "n_tokens", "ids"))


def with_crc32(tokens: DataFrame) -> DataFrame:
    """``tokens`` with ``ids_crc32`` (unsigned, over the ids as little-endian unsigned
    32-bit integers) in place of ``ids``."""
    kind = dict(tokens.dtypes)["doc_id"]
    schema = f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint"
    arrow = arrow_schema(schema)

    def digest(batches):
        for batch in batches:
            ids = batch.column(3)
            offsets = ids.offsets.to_numpy().tolist()
            data = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<i4")).cast("B")
            crc = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(crc, pa.int64())], schema=arrow)

    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(digest, schema)
