"""Near-duplicate documents by SuperMinHash signatures.

Every shingle of a document draws a random permutation of the signature's slots, one
place after the other; at step j it offers j plus a random fraction to the slot it
drew. A slot keeps the smallest offer. The ranks of one element are a permutation, so
the slots are negatively correlated and the signature's variance is lower than that of
independent minima; and as soon as all slots hold less than j + 1, later steps cannot
change anything and the document stops. All elements of a batch take step j together.

Signatures are cut into bands; equal bands put documents into one bucket. Documents
with equal shingle sets are one *class* and only its smallest id goes on. Then:

1. star round: the member with the smallest id leads its bucket (so a group of copies
   has few leaders), all others are compared with it on full shingle sets, links are
   united;
2. residual round: buckets that still hold several components name the (member, other
   component) pairs in which some signatures agree well enough, the smaller component's
   members against the larger one. Each named member meets its component once, block
   by block, whatever the number of buckets they share: members are compared on full
   sets in falling order of agreement until one is similar or all are tested. A large
   group of copies so costs a star, and only what the star left out is searched.

Buckets, components and their visitors are cut into blocks; a pair of blocks is a task.
No bucket, class or component is collected anywhere, and no list of pairs is made.

Contract: texts are lower-cased (A-Z), words ``[^\\x20\\x09-\\x0D]+``, sets of five-word
shingles; two documents are linked when 100 * |intersection| >= 75 * |union|.

Defined results: fewer than five words are one shingle; no words (or a null text) are
an empty set, linked with nothing, their own component, kept. Repeated rows are copies:
each is returned with the same component. Rows that share an id but not their text are
one node of the graph, compared by the text that sorts first. Rows without an id are
left out of the groups but returned, without component. Extra columns are ignored,
empty tables give empty results.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Words, map_arrow, mix, run_hash
from tessera.llm.components import connected_components
from tessera.session import materialize

SHINGLE = 5
SLOTS, ROWS = 128, 4
BANDS = SLOTS // ROWS
PERCENT = 75
#: A pair whose signatures agree in fewer of the 128 slots is not compared in the residual
#: round: at similarity 0.75 that has the (binomial) chance 1.9e-7.
LEAST_SLOTS = 70
#: Rows of a bucket, and members or visitors of a component, in one block.
BLOCK, SET_BLOCK = 1024, 256


# ---------------------------------------------------------------- sets and signatures

def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all texts one after the other, sizes)."""
    w = Words(texts)
    hashes = w.hashes()
    at, grams = w.grams(hashes, SHINGLE)
    owner = w.owner[at]
    short = [(i, run_hash(hashes[w.first[i]:w.first[i] + w.counts[i]]))
             for i in np.flatnonzero((w.counts > 0) & (w.counts < SHINGLE))]
    if short:
        owner = np.concatenate([owner, [i for i, _ in short]])
        grams = np.concatenate([grams, np.array([h for _, h in short], np.uint64)])
    order = np.lexsort((grams, owner))
    owner, grams = owner[order], grams[order]
    if len(grams):
        new = np.append(True, (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1]))
        owner, grams = owner[new], grams[new]
    return grams, np.bincount(owner.astype(np.int64), minlength=len(texts)).astype(np.int64)


_STEP = np.uint64(0x9E3779B97F4A7C15)


def signatures(grams: np.ndarray, sizes: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """(texts, slots) SuperMinHash values; rows of empty sets stay at ``slots``."""
    n = len(sizes)
    out = np.full((n, slots), float(slots))
    owner = np.repeat(np.arange(n), sizes)
    state = mix(grams + _STEP)
    perm = None
    for j in range(slots):
        bits = mix(state + np.uint64((j + 1) * int(_STEP) & (1 << 64) - 1))
        offer = j + (bits >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
        draw = j + (mix(bits + _STEP) % np.uint64(slots - j)).astype(np.int64)
        if perm is None:
            slot = draw
        else:
            rows = np.arange(len(owner))
            slot = perm[rows, draw].astype(np.int64)
            perm[rows, draw] = perm[:, j]
            perm[:, j] = slot
        np.minimum.at(out.reshape(-1), owner * slots + slot, offer)
        going = out.max(1) >= j + 1
        going[sizes == 0] = False
        if not going.any():
            break
        keep = going[owner]
        if perm is None:
            perm = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16), (int(keep.sum()), 1))
            first = slot[keep]
            perm[np.arange(len(first)), first] = 0
            perm[:, 0] = first
            owner, state = owner[keep], state[keep]
        elif not keep.all():
            perm, owner, state = perm[keep], owner[keep], state[keep]
    return out


def band_keys(values: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """(texts, bands) bucket keys as signed 64-bit numbers."""
    bits = mix(np.ascontiguousarray(values).view(np.uint64))
    n, slots = bits.shape
    parts = bits.reshape(n, slots // rows, rows)
    total = np.arange(slots // rows, dtype=np.uint64)[None, :] * _STEP
    for k in range(rows):
        total = mix(total + parts[:, :, k] * np.uint64(2 * k + 3))
    return total.view(np.int64)


def _short(values: np.ndarray) -> np.ndarray:
    """8 bits of every slot, for estimates (unequal slots agree by chance once in 256)."""
    return (mix(np.ascontiguousarray(values).view(np.uint64)) >> np.uint64(56)).astype(np.uint8)


def sketch(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_shingles, set_key (null: empty set), sig (8 bits a slot), bands."""

    def run(cols, texts):
        grams, sizes = shingle_sets(texts)
        values = signatures(grams, sizes)
        ends = np.cumsum(sizes)
        keys = [hashlib.blake2b(grams[e - s:e].tobytes(), digest_size=16).digest() if s else None for s, e in zip(sizes, ends)]
        bands = band_keys(values)
        short = _short(values)
        flat = pa.ListArray.from_arrays(pa.array(np.arange(0, bands.size + 1, BANDS, dtype=np.int32)), pa.array(bands.reshape(-1)))
        return {"doc_id": cols["doc_id"], "n_shingles": sizes, "set_key": keys, "sig": [r.tobytes() for r in short], "bands": flat}

    source = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].alias("text"))
    return map_arrow(source, run, "doc_id bigint, n_shingles bigint, set_key binary, sig binary, bands array<bigint>", ["doc_id", "text"], "text")


def full_sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, sig, grams) of the documents listed in ``ids`` (column id): signature and
    sorted 64-bit hashes as bytes."""

    def run(cols, texts):
        grams, sizes = shingle_sets(texts)
        ends = np.cumsum(sizes)
        return {"id": cols["id"], "sig": [r.tobytes() for r in _short(signatures(grams, sizes))],
                "grams": [grams[e - s:e].tobytes() for s, e in zip(sizes, ends)]}

    source = (docs.select(docs[id_col].cast("bigint").alias("id"), docs[text_col].alias("text")).join(ids, "id", "left_semi")
              .groupBy("id").agg(F.min("text").alias("text")))
    return map_arrow(source, run, "id bigint, sig binary, grams binary", ["id", "text"], "text")


# ---------------------------------------------------------------- links

def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets meet the similarity, exactly."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a) or PERCENT * len(b) > 100 * len(a):
        return False
    both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def set_views(column: pa.Array) -> list[np.ndarray]:
    """The sets of a binary column without copying them."""
    if not len(column):
        return []
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return [data[a:b].view(np.uint64) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar on full sets."""

    def run(batches):
        for batch in batches:
            same = [similar(x, y) for x, y in zip(set_views(batch.column(2)), set_views(batch.column(3)))]
            yield batch.select([0, 1]).filter(pa.array(same, type=pa.bool_()))

    joined = (pairs.join(sets.select(F.col("id").alias("a"), F.col("grams").alias("ga")), "a")
              .join(sets.select(F.col("id").alias("b"), F.col("grams").alias("gb")), "b"))
    return joined.select("a", "b", "ga", "gb").mapInArrow(run, "a bigint, b bigint")


def by_group(batches, keys: list[str], work):
    """Apply ``work`` (a table of whole groups, their first rows) to batches sorted by
    ``keys``; a group may go over batch ends."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        t = t if held is None else pa.concat_tables([held, t])
        cols = np.stack([t[c].to_numpy() for c in keys], 1)
        last = int(np.argmax((cols == cols[-1]).all(1)))
        if last:
            yield from work(t.slice(0, last), _starts(cols[:last]))
        held = t.slice(last).combine_chunks()
    if held is not None:
        yield from work(held, np.zeros(1, np.int64))


def _starts(cols: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, (cols[1:] != cols[:-1]).any(1)))


def _signatures_of(t: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(t["sig"].to_pylist()), np.uint8).reshape(t.num_rows, SLOTS)


def _possible(a, b):
    """Whether two set sizes allow the similarity."""
    return 100 * np.minimum(a, b) >= PERCENT * np.maximum(a, b)


_PAIR = pa.schema([("u", pa.int64()), ("c", pa.int64())])


def visitors(members: DataFrame) -> DataFrame:
    """(u, c): a member and the larger component it may be linked with, from buckets.

    ``members``: key, x, y (pair of blocks), blk, id, comp, members (size of the
    component), n_shingles, sig."""
    keys = ["key", "x", "y"]

    def named(t: pa.Table, starts: np.ndarray):
        ids, comps, large, sizes, blk, x, y = (t[c].to_numpy() for c in ("id", "comp", "members", "n_shingles", "blk", "x", "y"))
        sigs = _signatures_of(t)
        ends = np.append(starts[1:], len(ids))
        us, cs = [np.empty(0, np.int64)], [np.empty(0, np.int64)]

        def smaller(i, j):
            return (large[i] < large[j]) | ((large[i] == large[j]) & (comps[i] < comps[j]))

        two = np.flatnonzero(ends - starts == 2)      # most buckets: all at once
        if len(two):
            i, j = starts[two], starts[two] + 1
            ok = (comps[i] != comps[j]) & _possible(sizes[i], sizes[j])
            i, j = i[ok], j[ok]
            ok = (sigs[i] == sigs[j]).sum(1) >= LEAST_SLOTS
            i, j = i[ok], j[ok]
            i, j = np.where(smaller(i, j), i, j), np.where(smaller(i, j), j, i)
            us.append(ids[i])
            cs.append(comps[j])
        for s, e in zip(starts, ends):
            if e - s > 2:
                rows = np.arange(s, e)
                left, right = rows[blk[s:e] == x[s]], rows[blk[s:e] == y[s]]
                for i in left:
                    j = right[(comps[right] != comps[i]) & _possible(sizes[right], sizes[i])]
                    j = j[(sigs[j] == sigs[i]).sum(1) >= LEAST_SLOTS]
                    if len(j):
                        goes = smaller(i, j)
                        to = np.unique(comps[j[goes]])
                        us += [np.full(len(to), ids[i]), ids[j[~goes]]]
                        cs += [to, np.full(int((~goes).sum()), comps[i])]
        pairs = np.unique(np.stack([np.concatenate(us), np.concatenate(cs)]), axis=1)
        if pairs.shape[1]:
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], schema=_PAIR)

    dealt = members.repartition(*keys).sortWithinPartitions(*keys, "id")
    return dealt.select(*keys, "blk", "id", "comp", "members", "n_shingles", "sig").mapInArrow(
        lambda batches: by_group(batches, keys, named), "u bigint, c bigint").distinct()


def visits(cand: DataFrame, comps: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b): each visitor u of component c with one similar member of it, if there
    is any. Members and visitors of a component meet in pairs of blocks."""
    keys = ["c", "ub", "vb"]
    blocks = lambda n: F.ceil(n / SET_BLOCK).cast("bigint")
    sizes = (cand.groupBy("c").agg(blocks(F.count("*")).alias("ubs"))
             .join(comps.groupBy(F.col("comp").alias("c")).agg(blocks(F.count("*")).alias("vbs")), "c"))
    zero = F.lit(0).cast("bigint")
    guests = (cand.join(sizes, "c").select("c", F.pmod(F.xxhash64("u"), "ubs").alias("ub"),
                                           F.explode(F.sequence(zero, F.col("vbs") - 1)).alias("vb"), F.lit(False).alias("home"), F.col("u").alias("id")))
    homes = (comps.withColumnRenamed("comp", "c").join(sizes, "c")
             .select("c", F.explode(F.sequence(zero, F.col("ubs") - 1)).alias("ub"), F.pmod(F.xxhash64("id"), "vbs").alias("vb"), F.lit(True).alias("home"), "id"))

    def meet(t: pa.Table, starts: np.ndarray):
        ids, home = t["id"].to_numpy(), t["home"].to_numpy(zero_copy_only=False)
        sigs = _signatures_of(t)
        grams = set_views(t.combine_chunks()["grams"].chunk(0))
        sizes_ = np.fromiter(map(len, grams), np.int64, len(grams))
        a, b = [], []
        for s, e in zip(starts, np.append(starts[1:], len(ids))):
            rows = np.arange(s, e)
            hosts = rows[home[s:e]]
            for u in rows[~home[s:e]]:
                near = hosts[_possible(sizes_[hosts], sizes_[u])]
                agree = (sigs[near] == sigs[u]).sum(1)
                for v in near[np.argsort(-agree, kind="stable")][: int((agree >= LEAST_SLOTS).sum())]:
                    if similar(grams[u], grams[v]):
                        a.append(ids[u])
                        b.append(ids[v])
                        break
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    dealt = guests.unionByName(homes).join(sets, "id").repartition(*keys).sortWithinPartitions(*keys, "home", "id")
    return dealt.select(*keys, "home", "id", "sig", "grams").mapInArrow(lambda batches: by_group(batches, keys, meet), "a bigint, b bigint")


def residual_links(members: DataFrame, classes: DataFrame, comps: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between different components of the star round."""
    named = members.select("key", "id").join(comps, "id")
    mixed = (named.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("m"))
             .filter("lo <> hi").select("key", F.ceil(F.col("m") / BLOCK).cast("bigint").alias("blocks")))
    large = comps.groupBy("comp").agg(F.count("*").alias("members"))
    facts = comps.join(large, "comp").join(classes.select("id", "n_shingles", "sig"), "id")
    rows = members.select("key", "id").join(mixed, "key").join(facts, "id").withColumn("blk", F.pmod(F.xxhash64("id"), "blocks"))
    rows = rows.withColumn("o", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    rows = rows.withColumn("x", F.least("blk", "o")).withColumn("y", F.greatest("blk", "o"))
    cand = materialize(visitors(rows), "visitors")
    return materialize(visits(cand, comps, sets), "links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document."""
    spark = docs.sparkSession
    sketched = materialize(sketch(docs, id_col, text_col), "sketch")
    classes = (sketched.filter("set_key is not null and doc_id is not null").groupBy("set_key")
               .agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"), F.first("bands").alias("bands")))
    classes = materialize(classes, "classes")

    spread = classes.select("id", F.explode("bands").alias("key"))
    leaders = (spread.groupBy("key").agg(F.min("id").alias("leader"), F.count("*").alias("n"))
               .filter("n > 1"))
    members = materialize(spread.join(leaders, "key"), "buckets")
    stars = (members.filter("id <> leader").select(F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b")).distinct())
    nodes = materialize(members.select("id").distinct(), "nodes")
    sets = materialize(full_sets(docs, nodes, id_col, text_col), "sets")
    links = materialize(verified(stars, sets), "links")
    comps = materialize(nodes.join(connected_components(links), "id", "left")
                        .select("id", F.coalesce("component", "id").alias("comp")), "components")

    more = residual_links(members, classes, comps, sets)
    if not more.isEmpty():  # unite components; the smallest id of a component is its name
        ends = lambda c: comps.select(F.col("id").alias(c), F.col("comp").alias("c" + c))
        over = connected_components(more.join(ends("a"), "a").join(ends("b"), "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")))
        comps = comps.join(over.withColumnRenamed("id", "comp"), "comp", "left").select("id", F.coalesce("component", "comp").alias("comp"))
    rep = sketched.join(classes.select("set_key", F.col("id").alias("rep")), "set_key", "left")
    out = rep.join(comps.withColumnRenamed("id", "rep"), "rep", "left")
    component = F.coalesce("comp", "rep", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose document stands for its component, all columns as they
    are; rows without id stay, rows that repeat an id share its fate."""
    dropped = near_duplicates(docs, id_col, text_col).filter("not kept").select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(dropped, id_col, "left_anti")
