"""Near-duplicate vectors by hierarchical navigable small-world graphs.

Vectors are compared only under equal labels. Equal vectors of a label are one class;
the classes of a label are dealt by hash into shards of about ``SHARD`` vectors. One stage
builds the graph of every shard, once, and writes it with its vectors as one row per
shard; a second stage reads those rows and queries every graph with every shard of its
label, one task per unordered pair of shards. A hot label becomes many tasks of bounded
size and no task holds a label.

A graph's nodes are ordered by falling level, so that each layer is a prefix; layers
are built from the top in batches (searching the part that stands, comparing a batch
with itself directly, keeping diverse neighbours). Queries run in batches too: all
beams of a batch take a step together.

The recall of a graph is audited when it is built, however few real links there are:
``AUDIT`` vectors of the shard are turned by a random angle to a cosine between the
threshold and 1, and each turned vector must find the one it came from. While less than
``RECALL`` of them do, the beam is doubled; the beam that passed is stored with the graph.
Only where a beam as large as the shard fails are links counted directly, block by block,
as are those of a query whose whole beam lies above the threshold (more links than the
beam holds).

Every link found is verified by cosine in double precision. A task emits one row per
vector with its number of links (copies counted) and the smallest id it is united with
inside the task, never the pairs; components unite those rows over all tasks.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components, and rows without label, link with nothing and are their own component.
Vectors of different lengths are not compared. Repeated rows are copies of each other.
A row without id is returned with null component; it is nobody's representative, but
its copies count it. Extra columns are ignored, empty tables give empty results.
"""

from __future__ import annotations

import io

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.components import connected_components
from tessera.session import materialize

THRESHOLD = 0.98
SHARD = 8192
NEIGHBOURS, GROUND, BUILD_BEAM, BEAM = 12, 24, 48, 64
BATCH = 512
AUDIT, RECALL = 256, 0.995
EXPAND = 4
#: float32 search keeps what is this close to the threshold; double precision decides.
SLACK = 1e-4


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision, without overflow."""
    x = vectors.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


class Graph:
    """Layers over unit vectors (float32). Node numbers are positions in ``order``."""

    def __init__(self, vectors: np.ndarray, seed: int = 1):
        n = len(vectors)
        rng = np.random.default_rng(seed)
        level = np.floor(-np.log(np.maximum(rng.random(n), 1e-12)) / np.log(NEIGHBOURS)).astype(int)
        self.order = np.lexsort((rng.random(n), -level))
        self.x = np.ascontiguousarray(vectors[self.order], np.float32)
        level = level[self.order]
        self.sizes = [int((level >= k).sum()) for k in range(int(level[0]) + 1)]
        self.links: list[np.ndarray] = [None] * len(self.sizes)
        for layer in range(len(self.sizes) - 1, -1, -1):
            self._build(layer)

    def _build(self, layer: int) -> None:
        n, width = self.sizes[layer], GROUND if layer == 0 else NEIGHBOURS
        links = self.links[layer] = np.full((n, width), -1, np.int32)
        done = 0
        while done < n:
            stop = min(n, done + max(32, min(BATCH, done)))
            rows = np.arange(done, stop)
            own = self.x[rows]
            near = own @ own.T
            np.fill_diagonal(near, -2)
            keep = min(len(rows), BUILD_BEAM)
            pick = np.argpartition(-near, keep - 1, axis=1)[:, :keep]
            cand = rows[pick]
            sims = np.take_along_axis(near, pick, 1)
            if done:
                found, value = self._search(own, layer, BUILD_BEAM, self._entries(own, layer, done), done)
                cand, sims = np.concatenate([cand, found], 1), np.concatenate([sims, value], 1)
            links[rows] = self._diverse(cand, sims, width)
            self._back_links(links, rows, done, width)
            done = stop

    def _diverse(self, cand: np.ndarray, sims: np.ndarray, width: int) -> np.ndarray:
        """Of each row's candidates the best that are closer to the row than to a kept
        one; what is free is filled with the best of the rest."""
        sims = np.where(cand < 0, -9, sims)
        order = np.argsort(-sims, axis=1, kind="stable")[:, :BUILD_BEAM]
        cand, sims = np.take_along_axis(cand, order, 1), np.take_along_axis(sims, order, 1)
        n, c = cand.shape
        points = self.x[np.maximum(cand, 0)]
        between = np.einsum("nid,njd->nij", points, points)
        kept = np.zeros((n, c), bool)
        for j in range(c):
            blocked = (np.where(kept[:, :j], between[:, j, :j], -9) > sims[:, j, None]).any(1) if j else np.zeros(n, bool)
            kept[:, j] = ~blocked & (sims[:, j] > -2) & (kept.sum(1) < width)
        rank = np.where(kept, 0, np.where(sims > -2, 1, 2)) * (c + 1) + np.arange(c)
        best = np.argsort(rank, axis=1, kind="stable")[:, :width]
        out = np.where(np.take_along_axis(sims, best, 1) > -2, np.take_along_axis(cand, best, 1), -1)
        if out.shape[1] < width:
            out = np.concatenate([out, np.full((n, width - out.shape[1]), -1, out.dtype)], 1)
        return out

    def _back_links(self, links: np.ndarray, rows: np.ndarray, done: int, width: int) -> None:
        source = np.repeat(rows, width)
        target = links[rows].ravel()
        ok = target >= 0
        source, target = source[ok], target[ok]
        value = np.einsum("nd,nd->n", self.x[source], self.x[target])
        order = np.lexsort((-value, target))
        source, target = source[order], target[order]
        first = np.searchsorted(target, target)
        rank = np.arange(len(target)) - first
        source, target, rank = source[rank < width], target[rank < width], rank[rank < width]
        nodes, place = np.unique(target, return_inverse=True)
        extra = np.full((len(nodes), width), -1, np.int64)
        extra[place, rank] = source
        for a in range(0, len(nodes), BATCH):
            part = nodes[a:a + BATCH]
            cand = np.concatenate([links[part], extra[a:a + BATCH]], 1).astype(np.int64)
            repeated = ((cand[:, :, None] == cand[:, None, :]) & np.tri(cand.shape[1], k=-1, dtype=bool)).any(2)
            cand = np.where(repeated, -1, cand)
            sims = np.einsum("nd,ncd->nc", self.x[part], self.x[np.maximum(cand, 0)])
            sims = np.where((cand < 0) | (cand == part[:, None]), -9, sims)
            links[part] = self._diverse(np.where(sims <= -9, -1, cand), sims, width)

    def _entries(self, q: np.ndarray, layer: int, limit: int) -> np.ndarray:
        """Entry nodes for a search of ``layer``: the best of the layers above that are
        already part of it."""
        entry = np.zeros((len(q), 1), np.int64)
        for k in range(len(self.sizes) - 1, layer, -1):
            found, _ = self._search(q, k, 8, entry, self.sizes[k])
            entry = found[:, :4]
        return np.where((entry < 0) | (entry >= limit), 0, entry)

    def _search(self, q: np.ndarray, layer: int, beam: int, entry: np.ndarray, limit: int):
        """(nodes, similarities) of the best ``beam`` nodes below ``limit`` per query,
        best first; -1 and -9 where there are fewer."""
        n = len(q)
        links = self.links[layer]
        seen = np.zeros((n, limit), bool)
        rows = np.arange(n)[:, None]
        entry = np.where((np.cumsum(np.ones_like(entry), 1) > 1) & (entry == entry[:, :1]), -1, entry)
        value = np.where(entry >= 0, np.einsum("nd,nkd->nk", q, self.x[np.maximum(entry, 0)]), -9)
        seen[rows, np.maximum(entry, 0)] = True
        seen[:, 0] |= (entry == 0).any(1)
        ids = np.full((n, beam), -1, np.int64)
        sims = np.full((n, beam), -9.0, np.float32)
        w = min(beam, entry.shape[1])
        ids[:, :w], sims[:, :w] = entry[:, :w], value[:, :w]
        ready = ids < 0
        live = np.arange(n)
        while len(live):
            waiting = np.where(ready[live], -9, sims[live])
            best = np.argsort(-waiting, axis=1, kind="stable")[:, :EXPAND]
            open_ = np.take_along_axis(waiting, best, 1) > -9
            going = open_.any(1)
            live, best, open_ = live[going], best[going], open_[going]
            if not len(live):
                break
            at = live[:, None]
            node = np.where(open_, ids[at, best], -1)
            ready[at, best] = True
            near = np.where(node[:, :, None] >= 0, links[np.maximum(node, 0)], -1).reshape(len(live), -1).astype(np.int64)
            near = np.where(near < limit, near, -1)
            near = np.where((near >= 0) & ~seen[at, np.maximum(near, 0)], near, -1)
            near = -np.sort(-near, axis=1)
            near[:, 1:] = np.where(near[:, 1:] == near[:, :-1], -1, near[:, 1:])
            near = near[:, : max(1, int((near >= 0).sum(1).max()))] if (near >= 0).any() else near[:, :1]
            near = -np.sort(-near, axis=1)
            r, c = np.nonzero(near >= 0)
            seen[live[r], near[r, c]] = True
            new = np.full(near.shape, -9.0, np.float32)
            new[r, c] = np.einsum("kd,kd->k", q[live[r]], self.x[near[r, c]])
            all_ids = np.concatenate([ids[live], near], 1)
            all_sims = np.concatenate([sims[live], new], 1)
            all_ready = np.concatenate([ready[live], near < 0], 1)
            top = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
            ids[live] = np.take_along_axis(all_ids, top, 1)
            sims[live] = np.take_along_axis(all_sims, top, 1)
            ready[live] = np.take_along_axis(all_ready, top, 1)
        return ids, sims

    def pack(self) -> bytes:
        """Order and links; the vectors are stored apart."""
        out = io.BytesIO()
        np.savez(out, order=self.order, sizes=np.array(self.sizes), **{f"links{k}": v for k, v in enumerate(self.links)})
        return out.getvalue()

    @classmethod
    def unpack(cls, data: bytes, vectors: np.ndarray) -> "Graph":
        self, parts = cls.__new__(cls), np.load(io.BytesIO(data))
        self.order, self.sizes = parts["order"], parts["sizes"].tolist()
        self.x = np.ascontiguousarray(vectors[self.order], np.float32)
        self.links = [parts[f"links{k}"] for k in range(len(self.sizes))]
        return self

    def query(self, q: np.ndarray, beam: int):
        """(original positions, similarities) of the best ``beam`` vectors per query."""
        q = q.astype(np.float32)
        beam = min(beam, len(self.x))
        out_ids, out_sims = [], []
        for a in range(0, len(q), BATCH):
            part = q[a:a + BATCH]
            ids, sims = self._search(part, 0, beam, self._entries(part, 0, self.sizes[0]), self.sizes[0])
            out_ids.append(np.where(ids >= 0, self.order[np.maximum(ids, 0)], -1))
            out_sims.append(sims)
        return np.concatenate(out_ids), np.concatenate(out_sims)


def planted(x: np.ndarray, threshold: float, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(positions, queries): a sample of unit vectors and, for each, a vector at a cosine
    between ``threshold`` and 1 from it, in a random direction."""
    rng = np.random.default_rng(seed)
    at = rng.permutation(len(x))[:AUDIT]
    own = x[at].astype(np.float64)
    aside = rng.normal(size=own.shape)
    aside -= (aside * own).sum(1, keepdims=True) * own
    size = np.sqrt((aside * aside).sum(1, keepdims=True))
    aside = np.where(size > 1e-9, aside / np.maximum(size, 1e-9), 0)
    cosine = threshold + (1 - threshold) * rng.random((len(at), 1))
    return at, unit(cosine * own + np.sqrt(1 - cosine * cosine) * aside)


def audited_beam(graph: Graph, x: np.ndarray, threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """The smallest beam (doubling from ``BEAM``) with which the planted neighbours are
    found; 0 where even a beam as large as the shard fails."""
    at, queries = planted(x, threshold)
    beam = BEAM
    while True:
        ids, _ = graph.query(queries, beam)
        if (ids == at[:, None]).any(1).sum() >= recall * len(at):
            return beam
        if beam >= len(x):
            return 0
        beam *= 2


def links_of(q: np.ndarray, x: np.ndarray, same: bool, graph: Graph, beam: int, threshold: float = THRESHOLD) -> np.ndarray:
    """Boolean matrix (queries, vectors) of verified links, found in ``graph`` over ``x`` with
    its audited ``beam``; ``same``: queries and vectors are one shard."""
    n, m = len(q), len(x)
    out = np.zeros((n, m), bool)

    def count(rows: np.ndarray) -> None:
        """Links of these queries against every vector."""
        for a in range(0, len(rows), AUDIT):
            out[rows[a:a + AUDIT]] = q[rows[a:a + AUDIT]] @ x.T >= threshold

    if not n or not m:
        return out
    if beam:
        ids, sims = graph.query(q, beam)
        i, k = np.nonzero((ids >= 0) & (sims >= threshold - SLACK))
        j = ids[i, k]
        ok = np.einsum("nd,nd->n", q[i], x[j]) >= threshold
        out[i[ok], j[ok]] = True
        if beam < m:  # more links than the beam holds
            count(np.flatnonzero((sims[:, -1] >= threshold - SLACK) & (ids[:, -1] >= 0)))
    else:
        count(np.arange(n))
    if same:
        np.fill_diagonal(out, False)
        out |= out.T
    return out


def united(links: np.ndarray, ids_q: np.ndarray, ids_x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id every vector of both sides is connected with through ``links``."""
    a, b = np.nonzero(links)
    name_q, name_x = ids_q.copy(), ids_x.copy()
    while True:
        before = name_q.copy(), name_x.copy()
        np.minimum.at(name_x, b, name_q[a])
        np.minimum.at(name_q, a, name_x[b])
        if (before[0] == name_q).all() and (before[1] == name_x).all():
            return name_q, name_x


def _build(pdf, threshold: float, recall: float):
    """One shard's row: its vectors, their ids and sizes, the graph and its beam."""
    import pandas as pd
    pdf = pdf.sort_values("rep")
    vectors = np.stack(pdf["embedding"].to_numpy())
    x = unit(vectors)
    graph = Graph(x)
    beam = audited_beam(graph, x, threshold, recall)
    kind = "f4" if vectors.dtype == np.float32 else "f8"
    return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "shards": [int(pdf["shards"].iloc[0])], "kind": [kind],
                         "reps": [pdf["rep"].to_numpy("<i8").tobytes()], "counts": [pdf["n"].to_numpy("<i8").tobytes()],
                         "vectors": [vectors.astype("<" + kind).tobytes()], "graph": [graph.pack()], "beam": [beam]})


def _shard(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit vectors, representatives, class sizes) of a stored shard."""
    reps = np.frombuffer(row["reps"], "<i8")
    return unit(np.frombuffer(row["vectors"], "<" + row["kind"]).reshape(len(reps), -1)), reps, np.frombuffer(row["counts"], "<i8")


def _task(pdf, threshold: float):
    """Query the graph of the shard ``y`` with the shard ``x``."""
    import pandas as pd
    stored = {int(r["shard"]): r for r in pdf.to_dict("records")}
    left, right = stored.get(int(pdf["x"].iloc[0])), stored.get(int(pdf["y"].iloc[0]))
    empty = pd.DataFrame({"rep": np.empty(0, np.int64), "links": np.empty(0, np.int64), "least": np.empty(0, np.int64)})
    if left is None or right is None:  # a shard that got no vectors
        return empty
    same = left is right
    x, ids_x, n_x = _shard(right)
    q, ids_q, n_q = (x, ids_x, n_x) if same else _shard(left)
    links = links_of(q, x, same, Graph.unpack(right["graph"], x), int(right["beam"]), threshold)
    a, b = np.nonzero(links)
    name_q, name_x = united(links, ids_q, ids_x)
    if same:
        out = pd.DataFrame({"rep": ids_q, "links": np.bincount(a, weights=n_q[b], minlength=len(q)).astype(np.int64),
                            "least": np.minimum(name_q, name_x)})
    else:
        out = pd.DataFrame({"rep": np.concatenate([ids_q, ids_x]), "least": np.concatenate([name_q, name_x]),
                            "links": np.concatenate([np.bincount(a, weights=n_x[b], minlength=len(q)),
                                                     np.bincount(b, weights=n_q[a], minlength=len(x))]).astype(np.int64)})
    return out[out["links"] > 0][["rep", "links", "least"]]


def near_duplicate_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                           threshold: float = THRESHOLD, shard: int = SHARD, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    v = df[vector_col]
    finite = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))
    sound = (df[label_col].isNotNull() & (F.size(v) > 0) & F.forall(v, finite) & F.exists(v, lambda e: e != 0))
    rows = df.select(df[id_col].cast("bigint").alias("vec_id"), df[label_col].alias("label"), v.alias("embedding"),
                     F.coalesce(sound, F.lit(False)).alias("sound"))
    key = [F.xxhash64("embedding").alias("k1"), F.xxhash64(F.lit(7), "embedding").alias("k2")]
    plain = rows.select("vec_id", "label", F.when(F.col("sound"), F.transform("embedding", lambda e: e + F.lit(0).cast("float"))).alias("embedding"))
    keyed = plain.select("*", *key)
    classes = (keyed.filter("embedding is not null and vec_id is not null").groupBy("label", "k1", "k2")
               .agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("embedding").alias("embedding")))
    classes = materialize(classes.withColumn("dim", F.size("embedding")), "vectors")
    sizes = classes.groupBy("label", "dim").agg(F.ceil(F.count("*") / shard).cast("bigint").alias("shards"))
    dealt = classes.join(sizes, ["label", "dim"]).withColumn("shard", F.pmod(F.xxhash64("rep"), "shards"))
    graphs = materialize(dealt.select("label", "dim", "shard", "shards", "rep", "n", "embedding").groupBy("label", "dim", "shard").applyInPandas(
        lambda key, pdf: _build(pdf, threshold, recall).assign(label=[key[0]], dim=[key[1]]),
        f"label {dict(dealt.dtypes)['label']}, dim int, shard bigint, shards bigint, kind string, reps binary, counts binary, vectors binary, graph binary, beam int"),
        "vector-graphs")
    paired = (graphs.withColumn("o", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shards") - 1)))
              .withColumns({"x": F.least("shard", "o"), "y": F.greatest("shard", "o")}))
    # the queried side needs its graph, the other one its vectors only
    paired = paired.withColumn("graph", F.when(F.col("shard") == F.col("y"), F.col("graph")))
    found = paired.groupBy("label", "dim", "x", "y").applyInPandas(lambda pdf: _task(pdf, threshold), "rep bigint, links bigint, least bigint")
    found = materialize(found, "links")
    comps = connected_components(found.select(F.col("rep").alias("a"), F.col("least").alias("b")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    of_rep = classes.select("label", "k1", "k2", "rep", "n").join(links, "rep", "left").join(
        comps.withColumnRenamed("id", "rep"), "rep", "left")
    named = of_rep.select("label", "k1", "k2", "n", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "rep").alias("comp"))
    # rows without a sound vector link with nothing; they are split off, not joined on nulls
    whole = keyed.where("embedding is not null").select("vec_id", "label", "k1", "k2").join(named, ["label", "k1", "k2"], "left")
    bare = keyed.where("embedding is null").select("vec_id", *[F.lit(None).cast("bigint").alias(c) for c in ("n", "links", "comp")])
    out = whole.select("vec_id", "n", "links", "comp").unionByName(bare)
    component = F.coalesce("comp", "vec_id")
    return out.select("vec_id", F.coalesce(F.col("links") + F.col("n") - 1, F.lit(0)).alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
