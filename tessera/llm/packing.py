"""Packing documents into fixed token windows by Karmarkar-Karp differencing.

Every document is tokenised as a whole, an end id is appended, and the ids are cut at
multiples of the window length. Whole windows are sequences of their own. What is left
of each document (less than a window) is cut into pieces of at most ``CUT`` ids, for
differencing balances small items best, and goes to a pool of ``POOL`` pieces per task,
which is packed by multiway differencing: every piece starts as a partition of k
windows with one used, the two partitions with the largest imbalance are merged over
and over, fullest window with emptiest, until one partition with nearly equal windows
is left. k starts at the fewest windows that could hold the pool; whenever a window
exceeds its capacity, k rises by one and the pool is packed again.

A pool lives in one task and is bounded, so packing needs no shuffle at all, however
the documents are distributed; a lost task is repeated over the same input split with
the same result. Sequence ids are the partition number and a counter. A window that is
not full is padded to the window length unless its length is a power of two.

Defined results: null and empty texts are documents of the end id alone. Repeated rows
are packed each; a null id stays null. Empty tables give empty results; extra columns
are ignored. A very long document is cut into many windows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tessera.llm.common import arrow_schema, pieces
from tessera.llm.token_pieces import token_ids

WINDOW = 2048
POOL = 1280
CUT = 512
END_ID = 1
CHUNK = 3 << 19  # bytes of text worked on at once
MEMO_PIECES = 400_000


# ---------------------------------------------------------------- differencing

def differencing(sizes: list[int], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(window of each item, sum of each window) of ``k`` windows.

    A partial partition is its sums in falling order, the smallest subtracted; a merge
    adds the rising order of one to the falling order of the other. ``slots`` keeps for
    every merge where the windows of both parts went, so that items are placed by
    walking the merges backwards."""
    heap, parts, joins = [], {}, []
    for i, s in enumerate(sizes):
        first = np.zeros(k, np.int64)
        first[0] = s
        parts[i] = first
        heap.append((-(int(s) if k > 1 else 0), i))
    heapq.heapify(heap)
    node = len(sizes)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        sums = parts.pop(a) + parts.pop(b)[::-1]
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        parts[node] = sums - sums[-1]
        joins.append((node, a, b, order))
        heapq.heappush(heap, (-int(parts[node][0]), node))
        node += 1
    place = {heap[0][1]: np.arange(k)}
    window = np.zeros(len(sizes), np.int64)
    for merged, a, b, order in reversed(joins):
        at = place.pop(merged)
        mine = np.empty(k, np.int64)
        mine[order] = at
        place[a], place[b] = mine, mine[::-1]
    for i in range(len(sizes)):
        window[i] = place[i][0]
    return window, np.bincount(window, weights=sizes, minlength=k).astype(np.int64)


def pack_pool(sizes: list[int], capacity: int) -> np.ndarray:
    """Window of each item; no window above ``capacity`` (no item is)."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        window, sums = differencing(sizes, k)
        if sums.max() <= capacity:
            return window
        k += 1


# ---------------------------------------------------------------- tokens

def token_bytes(texts: list[bytes], path: str, end_id: int = END_ID) -> list[bytes]:
    """Little-endian unsigned 32-bit ids of each text, the end id appended. The vocabulary
    lower-cases, drops white space and cuts letters, single digits and marks from each
    other, so the ids are gathered from those pieces; the strings of special tokens become
    their ids, as the library does by itself."""
    ids, offsets = token_ids(texts, path, end_id, spaced=False, lower=True, special_as_text=False,
                             memo_pieces=MEMO_PIECES)
    data, at = ids.tobytes(), (4 * offsets).tolist()
    return [data[a:b] for a, b in zip(at, at[1:])]


# ---------------------------------------------------------------- operator

def pack_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, pool: int = POOL, cut: int = CUT) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset and the
    piece's ids (``ids``, little-endian unsigned 32-bit)."""
    source = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = dict(source.dtypes)["doc_id"]
    schema = (f"doc_id {kind}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, "
              "`offset` bigint, ids binary")
    arrow = arrow_schema(schema)

    def pack(batches):
        next_id = TaskContext.get().partitionId() << 33
        waiting: list[tuple] = []

        def placed():
            nonlocal next_id, waiting
            where = pack_pool([len(w[3]) // 4 for w in waiting], window)
            fill = np.zeros(int(where.max()) + 1, np.int64)
            number = {int(w): next_id + i for i, w in enumerate(np.unique(where))}
            rows = []
            for (doc, start, total, ids), w in zip(waiting, where):
                rows.append((doc, start, len(ids) // 4, total, number[int(w)], int(fill[w]), ids))
                fill[w] += len(ids) // 4
            next_id += len(number)
            waiting = []
            return rows

        def rows_of(batch):
            nonlocal next_id
            for cols, texts in pieces(batch, "text", CHUNK):
                rows = []
                for doc, ids in zip(cols["doc_id"].to_pylist(), token_bytes(texts, vocabulary)):
                    total = len(ids) // 4
                    whole = total - total % window
                    for start in range(0, whole, window):
                        rows.append((doc, start, window, total, next_id, 0, ids[4 * start:4 * (start + window)]))
                        next_id += 1
                    waiting.extend((doc, start, total, ids[4 * start:4 * (start + cut)]) for start in range(whole, total, cut))
                    if len(waiting) >= pool:
                        rows += placed()
                yield rows

        def table(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

        for batch in batches:
            for rows in rows_of(batch):
                if rows:
                    yield table(rows)
        if waiting:
            yield table(placed())

    return source.mapInArrow(pack, schema)
