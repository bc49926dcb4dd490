"""Phrase collocations by sorted count streams.

The layout is that of external language-model estimation: only the longest runs of words
are counted, and everything else falls out of streams in sorted order.

1. Every word occurrence gives one record, the run of up to ``longest`` words that starts
   there inside its piece. Tasks add equal records up in numpy chunk by chunk and deal
   the sums out in ranges of the *prefix order* (language, then word by word).
2. One pass over each sorted range adds equal keys; a shorter phrase is a prefix of its
   records, so its count is a run of neighbouring sums, and the count of all words of a
   language is the run of its language. Runs that touch an end of their range may go on
   in the next: those few partial sums (at most two per length and range) are added
   afterwards. Phrases below ``least`` end here: every part of a frequent phrase is at
   least as frequent, so nothing below is ever needed again.
3. The frequent phrases are kept as two streams, in prefix order and in suffix order (last
   word first). In either order a phrase stands right behind its parts and right before
   its extensions, so one lockstep pass per stream, holding one open phrase per length,
   gives the counts of all first (last) parts and the highest count of an extension to
   the right (left). A range that begins inside an open phrase is seeded with that
   phrase's parts, looked up for the first key of every range.
4. Both streams, unique per phrase, are merge-joined; cuts, scores and ranks follow.

Range bounds come from a sample of at most ``SAMPLE_DOCS`` documents and only balance the
ranges; no result depends on them. A hot word's records are different keys and spread
over ranges; a hot phrase is one sum per chunk of text.

Defined results: null and empty texts have no words; a null language is ``und``. Repeated
rows count again. Empty tables give no rows. Columns other than text and language are
not looked at. A text of any length is worked off in chunks that end where a piece ends.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import LOWER, Words, byte_class
from tessera.llm.token_pieces import ragged
from tessera.llm.token_store import slices_for
from tessera.session import materialize

LONGEST = 3
LEAST = 10
TOP = 2000
INSIDE_PERCENT = 50
PARTS = 16
CHUNK = 4 << 20
SAMPLE_DOCS = 2000
SAMPLE_KEYS = 50
UNKNOWN = "und"

BREAKS = byte_class(b".,;:!?\n\x0b\x0c\r")
WORD_BYTES = ~(BREAKS | byte_class(b" \t"))


# ------------------------------------------------------------- records of one chunk

def _chunks(batches) -> Iterator[tuple[list[bytes], list[str]]]:
    """(texts, languages) of about ``CHUNK`` bytes; longer texts are cut at breaks."""
    texts, langs, size = [], [], 0
    rows = (r for batch in batches for at in range(0, batch.num_rows, 256)
            for part in [batch.slice(at, 256)] for r in zip(part.column(0).to_pylist(), part.column(1).to_pylist()))
    for text, lang in rows:
        lang = UNKNOWN if lang is None else lang
        data = (text or "").encode()
        while data:
            part, data = (data, b"") if len(data) <= CHUNK else _cut(data)
            texts.append(part)
            langs.append(lang)
            size += len(part)
            if size >= CHUNK:
                yield texts, langs
                texts, langs, size = [], [], 0
    if texts:
        yield texts, langs


def _cut(data: bytes) -> tuple[bytes, bytes]:
    """Cut behind the first break from ``CHUNK`` bytes on."""
    start = CHUNK
    while start < len(data):
        found = np.flatnonzero(BREAKS[np.frombuffer(data, np.uint8, min(CHUNK, len(data) - start), start)])
        if len(found):
            end = start + int(found[0]) + 1
            return data[:end], data[end:]
        start += CHUNK
    return data, b""


def escaped(lang: str) -> str:
    return lang.replace("%", "%25").replace("\t", "%09").replace(" ", "%20")


def _strings(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.large_binary())


def records(texts: list[bytes], langs: list[str], longest: int = LONGEST, reverse: bool = False,
            every: int = 0) -> tuple[pa.Array, np.ndarray]:
    """(keys, counts): the different runs of up to ``longest`` words starting at each word.

    A key is the language, a tab and the words, each followed by a space, in rising order
    of language and words. ``reverse``: runs that end at each word, last word first.
    ``every``: of each text only that many evenly spaced words, with their share as count."""
    words = Words(texts, WORD_BYTES)
    count = len(words.starts)
    if not count:
        return _strings([]), np.empty(0, np.int64)
    size = words.ends - words.starts
    data = LOWER[words.buf[ragged(words.starts, size, np.arange(count))]]
    coded = pa.Array.from_buffers(pa.large_binary(), count, [
        None, pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int64)), pa.py_buffer(data)]).dictionary_encode()
    spaced = pc.binary_join_element_wise(coded.dictionary, _strings([b""] * len(coded.dictionary)), pa.scalar(b" ", pa.large_binary()))
    sort = pc.sort_indices(spaced)
    spaced = pa.concat_arrays([_strings([b""]), spaced.take(sort)])
    place = np.empty(len(sort), np.int64)
    place[sort.to_numpy()] = np.arange(1, len(sort) + 1)
    ids = place[coded.indices.to_numpy()]
    piece = np.cumsum(BREAKS[words.buf])[words.starts]
    names = sorted(set(langs), key=lambda v: escaped(v).encode() + b"\t")
    number = {v: i for i, v in enumerate(names)}
    lang = np.fromiter((number[v] for v in langs), np.int64, len(langs))[words.owner]
    base = len(sort) + 1
    columns = [ids]
    for k in range(1, longest):
        column = np.zeros(count, np.int64)
        if count > k:
            same = piece[k:] == piece[:-k]
            if reverse:
                column[k:][same] = ids[:-k][same]
            else:
                column[:-k][same] = ids[k:][same]
        columns.append(column)
    weights = None
    if every:
        at, weights = _evenly(words, every)
        lang, columns = lang[at], [c[at] for c in columns]
    code, bound, parts = lang.copy(), len(names), []
    for column in columns:
        if bound * base >= 1 << 62:  # too wide for one number: go on with its rank
            table, code = np.unique(code, return_inverse=True)
            parts.append(table)
            bound = len(table)
        else:
            parts.append(None)
        code, bound = code * base + column, bound * base
    if weights is None:
        code, sums = np.unique(code, return_counts=True)
    else:
        code, back = np.unique(code, return_inverse=True)
        sums = np.bincount(back, weights=weights).astype(np.int64)
    pieces = []
    for table in reversed(parts):
        pieces.append(spaced.take(pa.array(code % base)))
        code //= base
        if table is not None:
            code = table[code]
    pieces.append(_strings([escaped(n).encode() + b"\t" for n in names]).take(pa.array(code)))
    return pc.binary_join_element_wise(*reversed(pieces), pa.scalar(b"", pa.large_binary())), sums


def _evenly(words: Words, every: int) -> tuple[np.ndarray, np.ndarray]:
    at, weights = [], []
    for first, n in zip(words.first.tolist(), words.counts.tolist()):
        take = min(n, every)
        at.append(first + (np.arange(take) * n) // max(take, 1))
        weights.append(np.full(take, max(1, n // max(take, 1))))
    return np.concatenate(at), np.concatenate(weights)


# ------------------------------------------------------------- ranges

def range_bounds(docs: DataFrame, slices: int, longest: int) -> tuple[list[bytes], list[bytes]]:
    """Bounds of ``slices`` ranges of about equal weight in prefix and in suffix order."""
    rows = docs.count()
    sample = docs.sample(min(1.0, SAMPLE_DOCS / rows), 7) if rows > SAMPLE_DOCS else docs

    def keys(batches):
        for texts, langs in _chunks(batches):
            for reverse in (False, True):
                found, weights = records(texts, langs, longest, reverse, SAMPLE_KEYS)
                yield pa.RecordBatch.from_arrays([pa.array([reverse] * len(found), pa.bool_()), found.cast(pa.binary()), pa.array(weights)],
                                                 names=["suffix", "key", "w"])

    out: tuple[list, list] = ([], [])
    for r in sample.mapInArrow(keys, "suffix boolean, key binary, w bigint").collect():
        out[r["suffix"]].append((bytes(r["key"]), r["w"]))
    return _bounds(out[0], slices), _bounds(out[1], slices)


def _bounds(weighted: list[tuple[bytes, int]], slices: int) -> list[bytes]:
    weighted.sort()
    total, run, bounds = sum(w for _, w in weighted), 0, []
    for key, w in weighted:
        if run * slices >= total * (len(bounds) + 1) and (not bounds or key > bounds[-1]):
            bounds.append(key)
        run += w
    return bounds[:slices - 1]


def _slices_of(sorted_keys: pa.Array, bounds: list[bytes]) -> np.ndarray:
    """Range of every key; within one language order the keys rise, so each bound is one
    binary search."""
    n = len(sorted_keys)
    starts = []
    for b in bounds:
        low, high = 0, n
        while low < high:
            mid = (low + high) // 2
            low, high = (low, mid) if sorted_keys[mid].as_py() >= b else (mid + 1, high)
        starts.append(low)
    return np.searchsorted(np.array(starts), np.arange(n), "right").astype(np.int32)


# ------------------------------------------------------------- counts in prefix order

class Runs:
    """Sums of equal neighbouring keys of a stream; the last run stays open."""

    def __init__(self):
        self.key, self.sum = None, 0

    def feed(self, keys: pa.Array, sums: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        if not len(keys):
            return keys, sums
        if self.key is not None:
            keys = pa.concat_arrays([pa.array([self.key], keys.type), keys])
            sums = np.concatenate([[self.sum], sums])
        first = np.concatenate([[0], 1 + np.flatnonzero(pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False))])
        keys, sums = keys.take(pa.array(first)), np.add.reduceat(sums, first)
        self.key, self.sum = keys[-1].as_py(), int(sums[-1])
        return keys[:-1], sums[:-1]

    def close(self, kind: pa.DataType) -> tuple[pa.Array, np.ndarray]:
        key, total = self.key, self.sum
        self.key = None
        return (pa.array([], kind), np.empty(0, np.int64)) if key is None else (pa.array([key], kind), np.array([total], np.int64))


def _layout(keys: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, start of each key, places of all spaces, first of them and number per key)."""
    offsets = np.frombuffer(keys.buffers()[1], np.int64)[keys.offset:keys.offset + len(keys) + 1]
    data = np.frombuffer(keys.buffers()[2] or b"", np.uint8)
    spaces = np.flatnonzero(data[:offsets[-1]] == 0x20)
    return data, offsets, spaces, np.searchsorted(spaces, offsets)


def orders(keys: pa.Array) -> np.ndarray:
    """Number of words of each key."""
    return np.diff(_layout(keys)[3])


def prefixes(keys: pa.Array, words: int) -> pa.Array:
    """The keys cut behind their first ``words`` words (shorter keys as they are)."""
    data, offsets, spaces, at = _layout(keys)
    starts = offsets[:-1]
    if words:
        end = np.where(np.diff(at) > 0, spaces[np.minimum(at[:-1] + np.minimum(np.diff(at), words) - 1, max(len(spaces) - 1, 0))] + 1, offsets[1:]) \
            if len(spaces) else offsets[1:]
    else:
        tabs = np.flatnonzero(data[:offsets[-1]] == 0x09)
        end = tabs[np.searchsorted(tabs, starts)] + 1
    size = end - starts
    cut = data[ragged(starts, size, np.arange(len(keys)))]
    return pa.Array.from_buffers(pa.large_binary(), len(keys), [
        None, pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(cut))])


def _merge(longest: int, least: int):
    """Pass over one sorted range: (key, f, open) of all phrases of at least ``least``, of
    all languages, and of every run at an end of the range (``open``), however rare."""
    kind = pa.large_binary()

    def run(batches):
        runs = [Runs() for _ in range(longest + 1)]
        begun = [False] * (longest + 1)

        def push(level, keys, sums, last):
            """Feed one level and what it completes to the next shorter one."""
            done, totals = runs[level].feed(keys, sums)
            if last:
                tail, total = runs[level].close(kind)
                done, totals = pa.concat_arrays([done, tail]), np.concatenate([totals, total])
            if len(done):
                own = orders(done) == level
                ends = np.zeros(len(done), bool)
                if level < longest:
                    ends[0] |= not begun[level]
                    ends[-1] |= last
                    begun[level] = True
                pick = own & (ends | (totals >= (least if level else 0)))
                if pick.any():
                    yield pa.RecordBatch.from_arrays([done.filter(pa.array(pick)).cast(pa.binary()), pa.array(totals[pick]), pa.array(ends[pick])],
                                                     names=["key", "f", "open"])
            if level:
                yield from push(level - 1, prefixes(done, level - 1), totals, last)

        for batch in batches:
            if batch.num_rows:
                yield from push(longest, batch.column(0).cast(kind), batch.column(1).to_numpy(), False)
        yield from push(longest, pa.array([], kind), np.empty(0, np.int64), True)

    return run


def frequent_phrases(docs: DataFrame, bounds: list[bytes], slices: int, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """(key, f): all phrases of up to ``longest`` words with f >= ``least``, and one row per
    language (a key without words) with the number of its words."""
    def extract(batches):
        for texts, langs in _chunks(batches):
            keys, sums = records(texts, langs, longest)
            if len(keys):
                yield pa.RecordBatch.from_arrays([pa.array(_slices_of(keys, bounds)), keys.cast(pa.binary()), pa.array(sums)],
                                                 names=["slice", "key", "c"])

    counted = docs.mapInArrow(extract, "slice int, key binary, c bigint")
    ranges = counted.repartitionById(slices, F.col("slice")).select("key", "c").sortWithinPartitions("key")
    sums = materialize(ranges.mapInArrow(_merge(longest, least), "key binary, f bigint, open boolean"), "phrase-sums")
    joined = sums.where("open").groupBy("key").agg(F.sum("f").alias("f"))
    words = F.length(F.regexp_replace(F.col("key").cast("string"), "[^ ]", ""))
    return sums.where("NOT open").select("key", "f").unionByName(joined.where((F.col("f") >= least) | (words == 0)))


# ------------------------------------------------------------- parts and extensions

def _walk(longest: int, seeds: dict[int, list[tuple[bytes, int]]]):
    """Lockstep pass over sorted phrases: (key, f, parts, extension, seed). ``parts[j]`` is
    the count of the first j+1 words, ``extension`` the highest count of a phrase that is one
    word longer. Phrases open at the end of a batch are carried into the next one; a range
    starts with its seeds, whose rows (``seed``) only bring extensions."""
    kind = pa.large_binary()

    def run(batches):
        number, held = None, None
        for batch in batches:
            for part, slice_of in _by_slice(batch):
                if slice_of != number:
                    if held is not None:
                        yield _rows(*held, longest)
                    given = seeds.get(slice_of, [])
                    number = slice_of
                    held = (pa.array([k for k, _ in given], kind), np.array([f for _, f in given], np.int64),
                            np.zeros(len(given), np.int64), np.ones(len(given), bool))
                keys = pa.concat_arrays([held[0], part.column(1).cast(kind)])
                f = np.concatenate([held[1], part.column(2).to_numpy()])
                best = np.concatenate([held[2], np.zeros(part.num_rows, np.int64)])
                seed = np.concatenate([held[3], np.zeros(part.num_rows, bool)])
                order = orders(keys)
                for m in range(1, longest):
                    child = np.flatnonzero(order == m + 1)
                    parent = _last(order == m)[child]
                    np.maximum.at(best, parent, f[child])
                size = len(keys)
                open_rows = [int(np.flatnonzero(order == m)[-1]) for m in range(1, longest + 1) if (order == m).any()]
                path = [i for i in open_rows if not (order[i + 1:] <= order[i]).any()]
                last = np.zeros(size, bool)
                last[path] = True
                out = _rows(keys, f, best, seed, longest, ~last)
                if out.num_rows:
                    yield out
                held = keys.take(pa.array(path)), f[path], best[path], seed[path]
        if held is not None:
            yield _rows(*held, longest)

    return run


def _by_slice(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, int]]:
    numbers = batch.column(0).to_numpy()
    cuts = [0, *(1 + np.flatnonzero(np.diff(numbers))).tolist(), len(numbers)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a), int(numbers[a])


def _last(on: np.ndarray) -> np.ndarray:
    """For every row the last marked row up to it, or -1."""
    return np.maximum.accumulate(np.where(on, np.arange(len(on)), -1))


def _rows(keys, f, best, seed, longest, pick=None) -> pa.RecordBatch:
    order = orders(keys)
    parts = np.stack([f[_last(order == m)] if len(f) else f for m in range(1, longest)], axis=1) if longest > 1 else np.empty((len(f), 0), np.int64)
    pick = np.ones(len(f), bool) if pick is None else pick
    parts = parts[pick]
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(parts) + 1) * (longest - 1), pa.int32()), pa.array(parts.ravel(), pa.int64()))
    return pa.RecordBatch.from_arrays([keys.filter(pa.array(pick)).cast(pa.binary()), pa.array(f[pick]), lists, pa.array(best[pick]),
                                       pa.array(order[pick].astype(np.int32)), pa.array(seed[pick])],
                                      names=["key", "f", "parts", "extension", "words", "seed"])


def reversed_key(key: Column) -> Column:
    """Key of the other order: the words turned around."""
    text = key.cast("string")
    words = F.filter(F.split(F.element_at(F.split(text, "\t"), 2), " "), lambda w: w != "")
    return F.concat(F.element_at(F.split(text, "\t"), 1), F.lit("\t"), F.array_join(F.reverse(words), " "), F.lit(" ")).cast("binary")


def walk_stream(phrases: DataFrame, bounds: list[bytes], slices: int, longest: int) -> DataFrame:
    """(key, f, words, parts, extension) of all phrases, keys taken in their own order."""
    def number(batches):
        for batch in batches:
            at = [bisect_right(bounds, k) for k in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), batch.column(0), batch.column(1)], names=["slice", "key", "f"])

    numbered = materialize(phrases.mapInArrow(number, "slice int, key binary, f bigint"), "phrase-stream")
    needed: dict[bytes, list[int]] = {}
    for r in numbered.groupBy("slice").agg(F.min("key").alias("key")).collect():
        lang, _, words = bytes(r["key"]).partition(b"\t")
        parts = words.split(b" ")[:-1]
        for m in range(1, len(parts)):
            needed.setdefault(lang + b"\t" + b" ".join(parts[:m]) + b" ", []).append(r["slice"])
    seeds: dict[int, list] = {}
    if needed:
        wanted = phrases.sparkSession.createDataFrame([(k,) for k in needed], "key binary")
        for r in numbered.join(F.broadcast(wanted), "key").collect():
            for s in needed[bytes(r["key"])]:
                seeds.setdefault(s, []).append((bytes(r["key"]), r["f"]))
    seeds = {s: sorted(v) for s, v in seeds.items()}
    ordered = numbered.repartitionById(slices, F.col("slice")).sortWithinPartitions("slice", "key")
    rows = materialize(ordered.mapInArrow(_walk(longest, seeds), "key binary, f bigint, parts array<bigint>, extension bigint, words int, seed boolean"),
                       "phrase-walk")
    more = rows.where("seed").groupBy("key").agg(F.max("extension").alias("more"))
    return (rows.where("NOT seed").join(F.broadcast(more), "key", "left")
                .select("key", "f", "words", "parts", F.greatest("extension", F.coalesce("more", F.lit(0))).alias("extension")))


# ------------------------------------------------------------- operator

def unescaped(lang: Column) -> Column:
    return F.replace(F.replace(F.replace(lang, F.lit("%20"), F.lit(" ")), F.lit("%09"), F.lit("\t")), F.lit("%25"), F.lit("%"))


def mine_phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP, inside_percent: int = INSIDE_PERCENT,
                 text_col: str = "text", lang_col: str = "lang", slices: int | None = None) -> DataFrame:
    """The ``top`` phrases of 2 to ``longest`` words of each language: lang, rank, phrase, a,
    l, r, n, score."""
    source = docs.select(docs[text_col].alias("text"), docs[lang_col].cast("string").alias("lang"))
    slices = slices or slices_for(docs)
    first, second = range_bounds(source, slices, longest)
    grams = materialize(frequent_phrases(source, first, slices, longest, least), "phrases")
    phrases = grams.where(F.contains(F.col("key"), F.lit(b" ")))
    left = walk_stream(phrases, first, slices, longest).where("words > 1")
    right = (walk_stream(phrases.select(reversed_key(F.col("key")).alias("key"), "f"), second, slices, longest).where("words > 1")
             .select(reversed_key(F.col("key")).alias("key"), F.col("parts").alias("ends"), F.col("extension").alias("extension_left")))
    both = left.join(right.hint("merge"), "key")
    a = F.col("f")
    cuts = F.transform(F.sequence(F.lit(1), F.col("words") - 1), lambda k: F.struct(
        k.alias("k"), F.element_at("parts", k).alias("l"), F.element_at("ends", F.col("words") - k).alias("r")))
    wide = "decimal(18,0)"
    score = F.expr("cast((1000000BD * cast(f as decimal(15,0)) * cast(f as decimal(15,0))) div "
                   f"(cast(cut.l as {wide}) * cast(cut.r as {wide})) as bigint)")
    scored = (both.where(100 * F.greatest("extension", "extension_left") < inside_percent * a)
              .select("key", "f", F.explode(cuts).alias("cut")).withColumn("score", score)
              .groupBy("key").agg(F.min(F.struct("score", "cut.k", "cut.l", "cut.r", "f")).alias("s")))
    text = F.col("key").cast("string")
    named = scored.select(F.substring_index(text, "\t", 1).alias("code"), F.rtrim(F.substring_index(text, "\t", -1)).alias("phrase"),
                          F.col("s.f").alias("a"), "s.l", "s.r", "s.score")
    # the best of each part of a language first, so that one task gets PARTS * top rows at most
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    named = named.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    some = named.withColumn("rank", F.row_number().over(Window.partitionBy("code", "part").orderBy(*order))).where(F.col("rank") <= top)
    best = Window.partitionBy("code").orderBy(*order)
    ranked = some.withColumn("rank", F.row_number().over(best).cast("bigint")).where(F.col("rank") <= top).drop("part")
    totals = grams.where(~F.contains(F.col("key"), F.lit(b" "))).select(
        F.substring_index(F.col("key").cast("string"), "\t", 1).alias("code"), F.col("f").alias("n"))
    return ranked.join(totals, "code").select(unescaped(F.col("code")).alias("lang"), "rank", "phrase", "a", "l", "r", "n", "score")
