"""Helpers shared by the operators of this subpackage: table scans, Arrow batch
handling and vectorised word hashing over whole texts.

All helpers work on one Arrow batch at a time; a batch is cut into pieces of about
``CHUNK_BYTES`` of text so that the numpy buffers of a task stay small whatever the
batch size (a single longer text forms a piece of its own).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

CHUNK_BYTES = 1 << 20
SEED = 0x5EED_7E55


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def map_arrow(df: DataFrame, fn: Callable[[list[dict]], Iterator[dict] | dict], schema: str,
              fields: list[str], text: str) -> DataFrame:
    """``mapInArrow`` over ``fields`` of ``df``; ``fn`` gets (columns, texts) pieces.

    ``columns`` maps every field but ``text`` to an Arrow array; ``texts`` is a list of
    ``bytes`` (null text: ``b""``). ``fn`` returns a dict of column values."""
    arrow = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for cols, texts in pieces(batch, text):
                out = fn(cols, texts)
                if out is not None:
                    yield pa.RecordBatch.from_arrays(
                        [_array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.select(*fields).mapInArrow(run, schema)


_KINDS = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(),
          "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary(),
          "array<bigint>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()), "array<int>": pa.list_(pa.int32()),
          "array<float>": pa.list_(pa.float32()), "array<double>": pa.list_(pa.float64())}


def arrow_schema(schema: str) -> pa.Schema:
    """Arrow schema of a list of ``name type`` with the simple types used here."""
    fields = [f.strip().rsplit(" ", 1) for f in schema.split(",")]
    return pa.schema([pa.field(name.strip("`"), _KINDS[kind]) for name, kind in fields])


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def pieces(batch: pa.RecordBatch, text: str, chunk: int = CHUNK_BYTES) -> Iterator[tuple[dict, list[bytes]]]:
    """Cut a batch into pieces of about ``chunk`` bytes of text."""
    arr = batch.column(batch.schema.get_field_index(text))
    values = [v or b"" for v in arr.cast(pa.binary() if pa.types.is_string(arr.type) else pa.large_binary()).to_pylist()]
    others = {f.name: batch.column(i) for i, f in enumerate(batch.schema) if f.name != text}
    for start, end in spans_of([len(v) for v in values], chunk):
        yield {k: a.slice(start, end - start) for k, a in others.items()}, values[start:end]


def spans_of(sizes: list[int], chunk: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``chunk`` bytes."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > chunk:
            yield start, i
            start, total = i, 0
        total += n
    if len(sizes) > start:
        yield start, len(sizes)


# ------------------------------------------------------------------ words

def byte_class(members: bytes | range) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


SPACES = byte_class(b"\x20\x09\x0a\x0b\x0c\x0d")
NOT_SPACE = ~SPACES
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.default_rng(SEED)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(2**62, 2**63, dtype=np.uint64)) | 5
_GRAM = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_pow = np.ones(1, np.uint64)
_inv = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _pow, _inv
    if len(_pow) < n:
        size = max(n, 2 * CHUNK_BYTES)
        steps = np.full(size, np.uint64(_BASE))
        steps[0] = 1
        _pow = np.multiply.accumulate(steps)
        steps[1:] = np.uint64(pow(_BASE, -1, 1 << 64))
        _inv = np.multiply.accumulate(steps)
    return _pow[:n], _inv


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Words of a list of texts: byte spans, owning text, counts per text."""

    def __init__(self, texts: list[bytes], word_bytes: np.ndarray = NOT_SPACE, lower: bool = True):
        self.buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        lens = np.fromiter(map(len, texts), np.int64, len(texts))
        self.first_byte = np.concatenate([[0], np.cumsum(lens + 1)])
        inside = word_bytes[self.buf]
        turns = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
        self.starts, self.ends = turns[::2], turns[1::2]
        bounds = np.searchsorted(self.starts, self.first_byte)
        self.counts = np.diff(bounds)
        self.first = bounds[:-1]
        self.owner = np.repeat(np.arange(len(texts)), self.counts)
        self._lower = lower

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word's bytes (A-Z lowered when ``lower``)."""
        n = len(self.starts)
        out = np.empty(n, np.uint64)
        table = _BYTE[LOWER] if self._lower else _BYTE
        i = 0
        while i < n:
            base = int(self.starts[i])
            j = max(i + 1, int(np.searchsorted(self.ends, base + CHUNK_BYTES, "right")))
            span = int(self.ends[j - 1]) - base
            power, inverse = _powers(span)
            sums = np.zeros(span + 1, np.uint64)
            np.cumsum(table[self.buf[base:base + span]] * power, out=sums[1:])
            lo, hi = self.starts[i:j] - base, self.ends[i:j] - base
            out[i:j] = (sums[hi] - sums[lo]) * inverse[lo] + (hi - lo).astype(np.uint64)
            i = j
        return mix(out)

    def grams(self, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(start word index, hash) of every run of ``n`` words inside one text."""
        if len(hashes) < n:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        at = np.flatnonzero(self.owner[: len(hashes) - n + 1] == self.owner[n - 1:])
        total = np.zeros(len(at), np.uint64)
        for k in range(n):
            total += hashes[at + k] * _GRAM[k]
        return at, mix(total)


def run_hash(hashes: np.ndarray) -> int:
    """Hash of one whole word sequence (used where it is shorter than a shingle)."""
    k = np.arange(len(hashes))
    terms = hashes * _GRAM[33 + k % 30] + k.astype(np.uint64)
    return int(mix(terms.sum(keepdims=True) + np.full(1, len(hashes), np.uint64) * _GRAM[32])[0])


class Memo:
    """Two generations of a mapping, at most ``cap`` entries in all; the older one is
    dropped when the younger has filled up. ``fill(keys)`` gives the missing values."""

    def __init__(self, fill, cap: int):
        self.fill, self.half = fill, cap // 2
        self.new: dict = {}
        self.old: dict = {}

    def ready(self, keys: set) -> dict:
        """A dict that holds (at least) all of ``keys``."""
        need = keys.difference(self.new)
        if len(self.new) + len(need) > self.half and self.new:
            self.old, self.new = self.new, {}
            need = keys
        if need:
            known = need.intersection(self.old)
            for k in known:
                self.new[k] = self.old[k]
            missing = list(need.difference(known))
            self.new.update(zip(missing, self.fill(missing)))
        return self.new
