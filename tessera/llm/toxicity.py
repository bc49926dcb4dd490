"""Toxicity: a bidirectional gated recurrent network with attention pooling.

Each time step is a word. Its input joins a word embedding and a character embedding
(the element-wise maximum over the embeddings of its 4-byte character groups), so that
stems inside unseen words count. Two gated recurrent layers read a window of ``STEPS``
words forwards and backwards, attention pools their states, and a logistic unit scores
the window. A text's score is the largest score of its overlapping windows, which
start every ``STRIDE`` words (half a window): a passage of up to ``STEPS - STRIDE + 1``
words lies whole in one of them.

Training, in numpy on the driver, uses at most ``MAX_POSITIVE`` + ``MAX_NEGATIVE``
labelled documents of at most ``MAX_TRAIN_CHARS`` characters, chosen by a hash of the
id among rows the caller admits; nothing else of the corpus comes to the driver. The
vocabulary is what differs significantly between the sampled classes; the first
embedding coordinate starts as its log odds. Labels belong to documents, not windows:
each round scores all windows of the sample and trains on every document's highest
one. Equal input gives an equal model (fixed seed, rows sorted by id).

Scoring is one pass of ``mapInArrow`` with the broadcast model (bounded by the
vocabulary limits), without a shuffle.

Defined results: null and empty texts have one empty window and get the model's score
for it; a score depends on its text alone, but for rounding that is cut off at six
digits, so repeated rows get equal scores. Null labels or
ids are not trained on; of several labels of one id the largest holds. Without labels
of both classes the score is 0. Extra columns are ignored, empty tables give empty
results.
"""

from __future__ import annotations

import warnings

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import LOWER, Words, byte_class, map_arrow, spans_of

STEPS, STRIDE = 32, 16
HIDDEN = 8
DIM = 6
MAX_POSITIVE, MAX_NEGATIVE, MAX_TRAIN_CHARS = 1000, 2000, 20_000
MAX_WORDS, MAX_GRAMS = 4096, 8192
MIN_Z = 5.0
PART = 200
ROUNDS, EPOCHS, BATCH, RATE = 3, 5, 128, 0.01
THRESHOLD = 0.7

WORD_BYTES = byte_class([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)])


# ---------------------------------------------------------------- inputs

class Inputs:
    """Distinct words of a list of texts with their 4-byte groups, and each text's
    windows as rows of distinct-word numbers (-1 beyond its end)."""

    def __init__(self, texts: list[bytes]):
        w = Words(texts, WORD_BYTES)
        self.hashes, first, number = np.unique(w.hashes(), return_index=True, return_inverse=True)
        spaced = np.full(len(w.buf) + 4, 32, np.uint32)
        spaced[1:-3] = np.where(WORD_BYTES[w.buf], LOWER[w.buf], 32)
        groups = spaced[:-3] | spaced[1:-2] << 8 | spaced[2:-1] << 16 | spaced[3:] << 24
        length = (w.ends - w.starts)[first]
        size = np.maximum(length - 1, 1)              # groups of " word "
        self.group_first = np.cumsum(size) - size
        at = np.repeat(w.starts[first] - self.group_first, size) + np.arange(size.sum())
        self.groups = groups[at] if len(at) else np.empty(0, np.uint32)
        self.group_word = np.repeat(np.arange(len(first)), size)

        count = np.maximum(1, -(-(w.counts - (STEPS - STRIDE)) // STRIDE))
        self.owner = np.repeat(np.arange(len(texts)), count)
        step = np.arange(len(self.owner)) - np.repeat(np.cumsum(count) - count, count)
        place = step[:, None] * STRIDE + np.arange(STEPS)[None, :]
        inside = place < w.counts[self.owner][:, None]
        self.windows = np.full(place.shape, -1, np.int64)
        self.windows[inside] = number[(w.first[self.owner][:, None] + place)[inside]]
        self.word_text = (w.owner, number)


class Vocabulary:
    """Sorted keys; ``find`` gives 1 + the position of a key, 0 where it is unknown."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys

    def find(self, values: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(values), np.int64)
        at = np.minimum(np.searchsorted(self.keys, values), len(self.keys) - 1)
        return np.where(self.keys[at] == values, at + 1, 0)


def significant(keys: np.ndarray, texts: np.ndarray, toxic: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted keys, log odds) of the keys whose share of toxic texts is unusual."""
    found, number = np.unique(keys, return_inverse=True)
    pairs = np.unique(number * len(toxic) + texts)
    inverse, text = pairs // len(toxic), pairs % len(toxic)
    total = np.bincount(inverse, minlength=len(found))
    pos = np.bincount(inverse, weights=toxic[text], minlength=len(found))
    return chosen_keys(found, total, pos, toxic, most)


def chosen_keys(found: np.ndarray, total: np.ndarray, pos: np.ndarray, toxic: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted keys, log odds) of those whose share of toxic texts lies MIN_Z deviations
    off; ``total`` and ``pos``: how many texts, and toxic texts, hold each key."""
    n_pos, n_neg = toxic.sum(), len(toxic) - toxic.sum()
    share = n_pos / len(toxic)
    z = (pos - total * share) / np.sqrt(total * share * (1 - share) + 1e-9)
    odds = np.log((pos + 0.5) / (n_pos + 1)) - np.log((total - pos + 0.5) / (n_neg + 1))
    best = np.argsort(-np.abs(z), kind="stable")[:most]
    best = np.sort(best[np.abs(z[best]) >= MIN_Z])
    return found[best], odds[best]


# ---------------------------------------------------------------- network

def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Parameters are named arrays in ``p``; row 0 of both embeddings is 'unknown'."""

    def __init__(self, words: np.ndarray, word_odds: np.ndarray, groups: np.ndarray, group_odds: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        draw = lambda *s: rng.normal(0, 0.3, s).astype(np.float32)
        self.words, self.groups = Vocabulary(words), Vocabulary(groups)
        self.p = {"word": draw(len(words) + 1, DIM) * 0.1, "group": draw(len(groups) + 1, DIM) * 0.1}
        self.p["word"][0] = self.p["group"][0] = 0
        self.p["word"][1:, 0] = word_odds / 2
        self.p["group"][1:, 0] = group_odds / 2
        for d in "fb":
            self.p |= {f"x{d}": draw(2 * DIM, 3 * HIDDEN), f"h{d}": draw(HIDDEN, 3 * HIDDEN), f"b{d}": np.zeros(3 * HIDDEN, np.float32)}
        self.p |= {"a": draw(2 * HIDDEN, HIDDEN), "v": draw(HIDDEN), "o": draw(2 * HIDDEN), "c": np.full(1, -1, np.float32)}

    def embed(self, x: Inputs) -> tuple:
        """Vectors of the distinct words, and where each coordinate came from."""
        word, group = self.words.find(x.hashes), self.groups.find(x.groups)
        own = self.p["word"][word]
        if not len(x.hashes):
            return np.zeros((0, 2 * DIM), np.float32), word, np.zeros((0, DIM), np.int64)
        values = self.p["group"][group]
        top = np.maximum.reduceat(values, x.group_first, axis=0)
        return np.concatenate([own, top], 1), word, (group, values, top)

    def _direction(self, d: str, given: np.ndarray, live: np.ndarray, keep: bool):
        """States (windows, steps, HIDDEN) of one direction; ``given`` holds the inputs'
        share of the gates for every step. A dead step keeps the state."""
        n, steps, _ = given.shape
        h = np.zeros((n, HIDDEN), np.float32)
        out = np.empty((n, steps, HIDDEN), np.float32)
        trace = []
        weights, k = self.p[f"h{d}"], HIDDEN
        for t in (range(steps) if d == "f" else range(steps - 1, -1, -1)):
            g = h @ weights
            zr = sigmoid(given[:, t, :2 * k] + g[:, :2 * k])
            z, r = zr[:, :k], zr[:, k:]
            c = np.tanh(given[:, t, 2 * k:] + r * g[:, 2 * k:])
            m = live[:, t, None]
            new = np.where(m, c + z * (h - c), h)
            if keep:
                trace.append((t, h, z, r, c, g[:, 2 * k:], m))
            h = new
            out[:, t] = h
        return out, trace

    def forward(self, vectors: np.ndarray, windows: np.ndarray, keep: bool = False):
        """Logits of the windows; with ``keep``, what the backward pass needs."""
        live = windows >= 0
        table = np.concatenate([vectors, np.zeros((1, 2 * DIM), np.float32)])
        states, traces = [], []
        for d in "fb":
            gates = table @ self.p[f"x{d}"] + self.p[f"b{d}"]
            h, trace = self._direction(d, gates[windows], live, keep)
            states.append(h)
            traces.append(trace)
        h = np.concatenate(states, 2)
        u = np.tanh(h @ self.p["a"])
        e = np.where(live, u @ self.p["v"], -1e9)
        a = np.exp(e - e.max(1, keepdims=True)) * live
        a /= np.maximum(a.sum(1, keepdims=True), 1e-9)
        pooled = np.einsum("nt,nth->nh", a, h)
        logit = pooled @ self.p["o"] + self.p["c"]
        return (logit, (live, table, traces, h, u, a, pooled)) if keep else logit

    def backward(self, x: Inputs, embedded: tuple, windows: np.ndarray, d_logit: np.ndarray, kept: tuple) -> dict:
        """Gradients of all parameters given those of the logits."""
        live, table, traces, h, u, a, pooled = kept
        p, g, k = self.p, {}, HIDDEN
        g["c"] = d_logit.sum(keepdims=True)
        g["o"] = pooled.T @ d_logit
        d_pooled = d_logit[:, None] * p["o"]
        d_a = np.einsum("nh,nth->nt", d_pooled, h)
        d_h = a[:, :, None] * d_pooled[:, None, :]
        d_e = a * (d_a - (a * d_a).sum(1, keepdims=True))
        d_u = d_e[:, :, None] * p["v"] * (1 - u * u)
        g["v"] = np.einsum("nt,ntk->k", d_e, u)
        g["a"] = np.einsum("nth,ntk->hk", h, d_u)
        d_h += d_u @ p["a"].T
        flat = np.where(live, windows, len(table) - 1)
        d_table = np.zeros_like(table)
        for d, trace, part in zip("fb", traces, (d_h[:, :, :k], d_h[:, :, k:])):
            weights = p[f"h{d}"]
            d_w, d_given = np.zeros_like(weights), np.zeros((*windows.shape, 3 * k), np.float32)
            carry = np.zeros((len(windows), k), np.float32)
            for t, before, z, r, c, gc, m in reversed(trace):
                total = carry + part[:, t]
                alive = np.where(m, total, 0)
                d_c = alive * (1 - z) * (1 - c * c)
                d_z = alive * (before - c) * z * (1 - z)
                d_r = d_c * gc * r * (1 - r)
                d_g = np.concatenate([d_z, d_r, d_c * r], 1)
                d_given[:, t] = np.concatenate([d_z, d_r, d_c], 1)
                d_w += before.T @ d_g
                carry = np.where(m, alive * z, total) + d_g @ weights.T
            g[f"h{d}"], g[f"b{d}"] = d_w, d_given.sum((0, 1))
            d_gates = np.zeros((len(table), 3 * k), np.float32)
            np.add.at(d_gates, flat.ravel(), d_given.reshape(-1, 3 * k))
            g[f"x{d}"] = table.T @ d_gates
            d_table += d_gates @ p[f"x{d}"].T
        _, word, (group, values, top) = embedded
        g["word"], g["group"] = np.zeros_like(p["word"]), np.zeros_like(p["group"])
        np.add.at(g["word"], word, d_table[:-1, :DIM])
        winner = values == top[x.group_word]
        share = np.add.reduceat(winner.astype(np.float32), x.group_first, axis=0)[x.group_word]
        np.add.at(g["group"], group, winner / share * d_table[:-1, DIM:][x.group_word])
        g["word"][0] = g["group"][0] = 0
        return g

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Largest window score of each text."""
        x = Inputs(texts)
        vectors = self.embed(x)[0]
        logit = np.concatenate([self.forward(vectors, x.windows[a:a + 4096]) for a in range(0, len(x.windows), 4096)])
        first = np.flatnonzero(np.diff(x.owner, prepend=-1))
        return np.round(sigmoid(np.maximum.reduceat(logit, first)).astype(np.float64), 6)


class Constant:
    """Stands in where the sample lacks one of the classes."""

    def score(self, texts: list[bytes]) -> np.ndarray:
        return np.zeros(len(texts))


def train(texts: list[bytes], toxic: np.ndarray):
    """A fitted network; ``toxic`` holds 0 or 1 per text."""
    if not 0 < toxic.sum() < len(toxic):
        return Constant()
    x = Inputs(texts)
    owner, number = x.word_text
    words, word_odds = significant(x.hashes[number], owner, toxic, MAX_WORDS)
    sizes = np.diff(np.append(x.group_first, len(x.groups)))
    groups, group_of = np.unique(x.groups, return_inverse=True)
    total, pos = np.zeros(len(groups), np.int64), np.zeros(len(groups))
    bounds = np.searchsorted(owner, np.arange(0, len(texts) + PART, PART))
    for a, b in zip(bounds, bounds[1:]):  # some texts at a time: their distinct words, then groups
        pairs = np.unique(owner[a:b] * len(x.hashes) + number[a:b])
        pair_text, pair_word = pairs // max(1, len(x.hashes)), pairs % max(1, len(x.hashes))
        repeat = sizes[pair_word]
        at = np.repeat(x.group_first[pair_word] - (np.cumsum(repeat) - repeat), repeat) + np.arange(repeat.sum())
        pairs = np.unique(np.repeat(pair_text, repeat) * len(groups) + group_of[at])
        total += np.bincount(pairs % len(groups), minlength=len(groups))
        pos += np.bincount(pairs % len(groups), weights=toxic[pairs // len(groups)], minlength=len(groups))
    groups, group_odds = chosen_keys(groups, total, pos, toxic, MAX_GRAMS)
    net = Network(words, word_odds, groups, group_odds)
    rng = np.random.default_rng(3)
    first = np.flatnonzero(np.diff(x.owner, prepend=-1))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    weight = np.where(toxic == 1, len(toxic) / (2 * toxic.sum()), len(toxic) / (2 * (len(toxic) - toxic.sum())))
    steps = 0
    for turn in range(ROUNDS):
        vectors = net.embed(x)[0]
        if turn:
            value = np.concatenate([net.forward(vectors, x.windows[a:a + 4096]) for a in range(0, len(x.windows), 4096)])
        else:  # the untrained network can't tell yet: take the largest log odds
            odds = np.append(np.maximum(vectors[:, 0], vectors[:, DIM]), -9)
            value = odds[x.windows].max(1)
        chosen = np.array([a + int(np.argmax(value[a:b])) for a, b in zip(first, [*first[1:], len(value)])])
        for _ in range(EPOCHS):
            mixed = rng.permutation(len(texts))
            for a in range(0, len(mixed), BATCH):
                part = mixed[a:a + BATCH]
                windows = x.windows[chosen[part]]
                small, sub, windows = _only(x, windows)
                embedded = net.embed(sub)
                logit, kept = net.forward(embedded[0], windows, keep=True)
                d = ((sigmoid(logit) - toxic[part]) * weight[part] / len(part)).astype(np.float32)
                grads = net.backward(sub, embedded, windows, d, kept)
                steps += 1
                for k, g in grads.items():
                    m, v = moments[k]
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    net.p[k] -= RATE * (m / (1 - 0.9 ** steps)) / (np.sqrt(v / (1 - 0.999 ** steps)) + 1e-7)
    return net


class _Part:
    """The distinct words of some windows, as ``Inputs`` has them."""


def _only(x: Inputs, windows: np.ndarray) -> tuple:
    live = windows >= 0
    used, inverse = np.unique(windows[live], return_inverse=True)
    out = np.full_like(windows, -1)
    out[live] = inverse
    sizes = np.diff(np.append(x.group_first, len(x.groups)))[used]
    part = _Part()
    part.hashes = x.hashes[used]
    part.group_first = np.cumsum(sizes) - sizes
    part.groups = x.groups[np.repeat(x.group_first[used] - part.group_first, sizes) + np.arange(sizes.sum())]
    part.group_word = np.repeat(np.arange(len(used)), sizes)
    return used, part, out


# ---------------------------------------------------------------- Spark

def training_sample(docs: DataFrame, labels: DataFrame, admitted, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic") -> tuple[list[bytes], np.ndarray]:
    """Texts and labels to train on: a bounded number of admitted ids per class, picked
    by hash among those that have a short enough document (a semi-join of narrow ids);
    only those (a broadcast of that many ids) meet the texts. Warns when the labels hold
    both classes and the sample does not."""
    known = (labels.select(labels[id_col].alias("id"), labels[label_col].cast("int").alias("toxic"))
             .filter(F.col("id").isNotNull() & F.col("toxic").isin(0, 1)).filter(admitted(F.col("id")))
             .groupBy("id").agg(F.max("toxic").alias("toxic")))
    short = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).filter(F.length("text") <= MAX_TRAIN_CHARS)
    labelled, known = known, known.join(short.select("id"), "id", "left_semi")
    order = [F.xxhash64("id"), F.col("id")]
    ids = (known.filter("toxic = 1").orderBy(*order).limit(MAX_POSITIVE)
           .unionByName(known.filter("toxic = 0").orderBy(*order).limit(MAX_NEGATIVE)))
    rows = (short.join(F.broadcast(ids), "id")
            .groupBy("id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text")).orderBy("id").collect())
    if len({r.toxic for r in rows}) < 2 and labelled.select("toxic").distinct().count() == 2:
        warnings.warn(f"labels of both classes, but not both have documents of at most {MAX_TRAIN_CHARS} characters: every score is 0", RuntimeWarning)
    return [r.text.encode() for r in rows], np.array([r.toxic for r in rows], np.float64)


def score_documents(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))

    def run(cols, texts):
        return {"doc_id": cols["doc_id"], "score": shared.value.score(texts)}

    return map_arrow(source, run, "doc_id bigint, score double", ["doc_id", "text"], "text")


def held_out(doc_id):
    """Rows kept for testing: crc32 of the id as text leaves 1 on division by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    model = train(*training_sample(docs, labels, lambda i: ~held_out(i)))
    scored = score_documents(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns as they are."""
    model = train(*training_sample(docs, labels, lambda i: ~held_out(i)))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        values = ["" if t is None else t for t in texts]
        out = []
        for a, b in spans_of([len(t) for t in values]):
            out.append(shared.value.score([t.encode("utf-8", "replace") for t in values[a:b]]))
        return pd.Series(np.concatenate(out) if out else np.empty(0))

    return docs.filter(score(F.col(text_col)) < THRESHOLD)
