"""URL rules by a Bloom filter cascade.

A rule is ``host/path``: it fits its host, every subdomain of it, and every path that
starts with its path; the longest rule wins. A URL therefore has a small, finite set
of candidate keys: each host suffix of as many labels as some rule's host, joined with the path's first
L characters for each path length L that some rule has.

The candidate keys of the whole corpus are the key universe. Level 1 of the cascade
is a Bloom filter of the listed keys, level 2 of the universe's unlisted keys that
level 1 accepts, level 3 of the listed keys that level 2 accepts, and so on until a
level has no false positive. Over the universe the cascade's answer is exact, so
judging the URLs is one pass without a join. A second cascade over the listed keys
tells block from allow.

With r listed and s unlisted keys, level 1 gets the false-positive rate r / (s * sqrt 2)
and every further level 1/2, so the whole cascade takes about r * (1.44 * log2(s / r) + 4)
bits: it grows with the list, not with the corpus. Levels are built by the tasks and
merged with ``bit_or``; only the merged words come to the driver, and only while a
level stays under ``MAX_LEVEL_BITS``. Beyond that size ``judge_urls`` joins the
candidate keys with the list instead.

Defined results: a null URL, or one without ``://``, has an empty host and path, no
rule and the default verdict; so has a URL that no rule fits. Repeated rows are
judged alike, a repeated rule counts once, and of contradictory verdicts for one rule
block holds. Rules with a null host or verdict are ignored, a null path means ``/``.
Empty tables give empty results. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize

MAX_LEVEL_BITS = 1 << 27
MAX_LEVELS = 64
DEFAULT_VERDICT = "allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url):
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lowered."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url):
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def candidate_keys(host, path, lengths: list[int], label_counts: list[int]):
    """Every rule key that could fit (longest first): host suffixes of as many labels as
    some rule's host has, so a host of very many labels costs no more than a short one."""
    labels = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1
    suffixes = F.array_compact(F.array(*[F.when(labels >= n, F.substring_index(host, ".", -n)) for n in label_counts]))
    long_enough = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: F.length(path) >= n)
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(
        long_enough, lambda n: F.concat(s, F.substring(path, F.lit(1), n)))))
    by_length = F.array_sort(F.transform(F.array_distinct(keys), lambda k: F.struct((-F.length(k)).alias("n"), k.alias("k"))))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.transform(by_length, lambda x: x["k"]))


def _h1(key):
    return F.xxhash64(key)


def _h2(key):
    return F.xxhash64(key, F.lit(1))


# ---------------------------------------------------------------- the cascade

def positions(h1: np.ndarray, h2: np.ndarray, level: int, hashes: int, bits: int):
    """Bit positions of each key: double hashing, different in every level."""
    a = h1.astype(np.uint64) + np.uint64(level) * np.uint64(0x9E3779B97F4A7C15)
    b = (h2.astype(np.uint64) ^ (a >> np.uint64(29))) | np.uint64(1)
    for i in range(hashes):
        x = a + np.uint64(i) * b
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        yield ((x ^ (x >> np.uint64(32))) % np.uint64(bits)).astype(np.int64)


class Level:
    """One Bloom filter: its number, hash count, bits and 64-bit words."""

    def __init__(self, number: int, hashes: int, bits: int, words: np.ndarray):
        self.number, self.hashes, self.bits, self.words = number, hashes, bits, words

    def holds(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        out = np.ones(len(h1), bool)
        for p in positions(h1, h2, self.number, self.hashes, self.bits):
            out &= (self.words[p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1) == 1
        return out


class Cascade:
    """Levels of filters; exact for every key of the universe it was built over."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    def holds(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        result = np.zeros(len(h1), bool)
        open_ = np.arange(len(h1))
        for k, level in enumerate(self.levels):
            inside = level.holds(h1[open_], h2[open_])
            result[open_[~inside]] = k % 2 == 1
            open_ = open_[inside]
        result[open_] = len(self.levels) % 2 == 1
        return result

    @property
    def bits(self) -> int:
        return sum(x.bits for x in self.levels)


def shape(n: int, rate: float) -> tuple[int, int]:
    """(hash functions, bits) of a Bloom filter for ``n`` keys at a false-positive rate."""
    hashes = max(1, round(-math.log2(rate)))
    return hashes, max(64, math.ceil(n * hashes / math.log(2) / 64) * 64)


def _build_level(keys: DataFrame, number: int, hashes: int, bits: int) -> Level:
    """Each task sets the bits of its keys; equal words merge by ``bit_or``."""
    def partial(batches):
        for b in batches:
            h1, h2 = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            at = np.unique(np.concatenate(list(positions(h1, h2, number, hashes, bits))))
            if len(at):
                word, first = np.unique(at >> 6, return_index=True)
                value = np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), first)
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(value.view(np.int64))], names=["word", "value"])

    rows = (keys.select("h1", "h2").mapInArrow(partial, "word bigint, value bigint")
            .groupBy("word").agg(F.bit_or("value").alias("value")).toArrow())
    words = np.zeros(bits // 64, np.uint64)
    words[rows["word"].to_numpy()] = rows["value"].to_numpy().view(np.uint64)
    return Level(number, hashes, bits, words)


def _passing(keys: DataFrame, level: Level) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def run(batches):
        for b in batches:
            h1, h2 = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            yield b.filter(pa.array(shared.value.holds(h1, h2)))

    return keys.select("h1", "h2").mapInArrow(run, "h1 bigint, h2 bigint")


def build_cascade(listed: DataFrame, unlisted: DataFrame) -> Cascade | None:
    """Cascade for disjoint key sets, both with columns h1, h2; None when a level would
    pass ``MAX_LEVEL_BITS``. ``listed`` and ``unlisted`` are read once per level, the
    sets that remain shrink by the filters' rates."""
    levels: list[Level] = []
    inside, outside = listed, unlisted
    n_in, n_out = inside.count(), outside.count()
    rate = min(0.5, n_in / (max(1, n_out) * math.sqrt(2))) if n_in else 0.5
    while n_in:
        if len(levels) >= MAX_LEVELS:
            raise RuntimeError("the key sets are not disjoint")
        hashes, bits = shape(n_in, rate)
        if bits > MAX_LEVEL_BITS:
            return None
        level = _build_level(inside, len(levels), hashes, bits)
        levels.append(level)
        passed = materialize(_passing(outside, level), "bloom-pass")
        inside, outside = passed, inside
        n_in, n_out = inside.count(), n_in
        rate = 0.5
    return Cascade(levels)


# ---------------------------------------------------------------- judging

def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url",
               default: str = DEFAULT_VERDICT) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages``.

    ``rules``: (verdict, host, path). The list may also be large: it is held as a
    DataFrame of keys from here on."""
    spark = pages.sparkSession
    lowered = str.maketrans(_UPPER, _LOWER)
    kept = {(h.translate(lowered), p or "/", v) for v, h, p in rules if h and v in ("block", "allow")}
    clean = sorted({(h + p, v) for h, p, v in kept})
    label_counts = sorted({h.count(".") + 1 for h, _, _ in kept}) or [1]
    lengths = sorted({len(k) - k.index("/") for k, _ in clean if "/" in k}, reverse=True) or [1]
    urls = pages.select(pages[id_col].alias("page_id"), host_of(pages[url_col]).alias("host"),
                        path_of(pages[url_col]).alias("path"))
    urls = urls.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), lengths, label_counts))
    hashed = lambda k: [_h1(k).alias("h1"), _h2(k).alias("h2")]
    rule_rows = spark.createDataFrame(clean, "key string, verdict string").groupBy("key").agg(
        F.max(F.col("verdict") == "block").alias("block"))
    universe = urls.select(F.explode("keys").alias("key")).select(*hashed(F.col("key")), F.lit(False).alias("listed"))
    marked = (universe.unionByName(rule_rows.select(*hashed(F.col("key")), F.lit(True).alias("listed")))
              .groupBy("h1", "h2").agg(F.max("listed").alias("listed")))
    marked = materialize(marked, "url-keys")
    which = build_cascade(marked.filter("listed"), marked.filter("not listed"))
    verdicts = build_cascade(rule_rows.filter("block").select(*hashed(F.col("key"))),
                             rule_rows.filter("not block").select(*hashed(F.col("key"))))
    if which is None or verdicts is None:
        return _judge_by_join(urls, rule_rows, default)
    shared = spark.sparkContext.broadcast((which, verdicts))

    def judge(batches):
        listed, blocked = shared.value
        for b in batches:
            h1, h2 = (b.column(b.schema.get_field_index(c)) for c in ("h1", "h2"))
            sizes = np.diff(h1.offsets.to_numpy())
            a, c = h1.flatten().to_numpy(zero_copy_only=False), h2.flatten().to_numpy(zero_copy_only=False)
            member = listed.holds(a, c)
            owner = np.repeat(np.arange(b.num_rows), sizes)
            place = np.arange(len(a)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            at = np.flatnonzero(member)
            rows, first = np.unique(owner[at], return_index=True)  # longest key first
            at = at[first]
            index = np.zeros(b.num_rows, np.int32)
            index[rows] = place[at] + 1
            block = np.zeros(b.num_rows, bool)
            block[rows] = blocked.holds(a[at], c[at])
            keep = ["page_id", "host", "path", "keys"]
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(k)) for k in keep] + [pa.array(index), pa.array(block)], names=[*keep, "at", "block"])

    kind = dict(urls.dtypes)["page_id"]
    judged = urls.select("*", F.transform("keys", _h1).alias("h1"), F.transform("keys", _h2).alias("h2")).mapInArrow(
        judge, f"page_id {kind}, host string, path string, keys array<string>, at int, block boolean")
    rule = F.when(F.col("at") > 0, F.col("keys")[F.col("at") - 1])
    return judged.select("page_id", "host", "path", rule.alias("rule"),
                         F.when(F.col("at") == 0, default).when(F.col("block"), "block").otherwise("allow").alias("verdict"))


def _judge_by_join(urls: DataFrame, rule_rows: DataFrame, default: str) -> DataFrame:
    """For lists whose filters pass the size bound: candidate keys are joined with the
    list and the longest of each row is kept (``max`` over a row number, no window)."""
    numbered = urls.withColumn("row", F.monotonically_increasing_id())
    numbered = materialize(numbered, "url-rows")
    hits = (numbered.select("row", F.explode("keys").alias("key")).join(rule_rows, "key")
            .groupBy("row").agg(F.max(F.struct(F.length("key").alias("n"), "key", "block")).alias("hit")))
    return numbered.join(hits, "row", "left").select(
        "page_id", "host", "path", F.col("hit.key").alias("rule"),
        F.when(F.col("hit.block").isNull(), default).when(F.col("hit.block"), "block").otherwise("allow").alias("verdict"))
