"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

Differencing keeps a heap of partial partitions, each a vector of ``k`` subset
sums. It takes the two with the largest spread (largest minus smallest sum) and
combines them oppositely ordered, the fullest subset of one with the emptiest of
the other, until one partition is left.

At scale it runs on two levels:

* Every shuffle partition differences its own groups into ``k`` bundles. A group
  heavier than an even bundle is not mixed in; it stays an item of its own, so
  that a giant group can be balanced against everything else.
* One task differences all bundles and giant groups into the shards. It sees at
  most ``2 * max(BUNDLES, 8 * partitions)`` sums, no texts and no groups.

A group is all rows with equal text (hash, CRC and length must agree). A group of
copies may own any share of the rows: it is counted map-side in ``SALTS`` parts by
a hash of the id, and rows are numbered within a part, so no task gets all its rows.

Edge cases: null text counts as no bytes and forms one group with the empty text;
rows with equal or null ids are numbered side by side; an empty table gives an
empty result; only the id and the text are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import shuffle_width, utf8_bytes, whole_text

BUNDLES = 16384
SALTS = 64
ROW_BYTES = 8


def differencing(weights: np.ndarray, k: int) -> np.ndarray:
    """Subset (0 to ``k - 1``) of each weight by ``k``-way Karmarkar-Karp differencing.

    Ties go to the partition made first; the result depends on the order of
    ``weights`` only through such ties.
    """
    n = len(weights)
    slots = np.zeros(n, np.int64)
    if n == 0 or k < 2:
        return slots
    sums: dict[int, np.ndarray] = {}
    heap = []
    for i in np.argsort(-np.asarray(weights, np.int64), kind="stable").tolist():
        heap.append((-int(weights[i]), i))
    heapq.heapify(heap)
    merged: list[tuple[int, int, np.ndarray]] = []  # (a, b, order): node n + its index

    def vector(node: int) -> np.ndarray:
        if node >= n:
            return sums.pop(node)
        v = np.zeros(k, np.int64)
        v[0] = weights[node]
        return v

    kind = np.min_scalar_type(k)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        both = vector(a) + vector(b)[::-1]
        order = np.argsort(-both, kind="stable")
        both = both[order]
        node = n + len(merged)
        merged.append((a, b, order.astype(kind)))
        sums[node] = both
        heapq.heappush(heap, (int(both[-1] - both[0]), node))
    # top down: places[node][position in the node's own order] = subset at the root
    places = {n + len(merged) - 1: np.arange(k)} if merged else {0: np.arange(k)}
    for i in range(len(merged) - 1, -1, -1):
        a, b, order = merged[i]
        mine = places.pop(n + i)
        for child, at in ((a, order), (b, k - 1 - order.astype(np.int64))):
            if child < n:
                slots[child] = mine[np.flatnonzero(at == 0)[0]]
            else:
                down = np.empty(k, np.int64)
                down[at] = mine
                places[child] = down
    return slots


def _bundle(frames: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    """One partition's group parts (h, crc, size, salt, n) with ``item`` and ``before``.

    ``before`` counts the item's rows that come earlier in this partition. An item
    number joins the partition's number with the bundle's (giant groups: from k on).
    """
    from pyspark import TaskContext

    got = [f for f in frames if len(f)]
    if not got:
        return
    parts = pd.concat(got, ignore_index=True).sort_values(["size", "h", "crc", "salt"], ascending=[False, True, True, True],
                                                          kind="stable", ignore_index=True)
    key = parts[["size", "h", "crc"]].to_numpy()
    new = np.r_[True, (key[1:] != key[:-1]).any(axis=1)]
    group = np.cumsum(new) - 1
    rows = parts["n"].to_numpy()
    weight = np.bincount(group, weights=rows * parts["size"].to_numpy()).astype(np.int64)
    giant = weight * k > weight.sum()
    item = np.empty(len(weight), np.int64)
    item[giant] = k + np.arange(giant.sum())
    item[~giant] = differencing(weight[~giant], k)
    parts["item"] = item[group]
    parts["before"] = parts.groupby("item")["n"].cumsum() - parts["n"]
    parts["item"] += TaskContext.get().partitionId() << 32
    yield parts


def _shards(frames: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    """All items (item, bytes, n) with their ``shard`` and ``base``, the shard's rows in earlier items."""
    got = [f for f in frames if len(f)]
    if not got:
        return
    items = pd.concat(got, ignore_index=True).sort_values(["bytes", "item"], ascending=[False, True], ignore_index=True)
    items["shard"] = differencing(items["bytes"].to_numpy(), k).astype(np.int32)
    items["base"] = items.groupby("shard")["n"].cumsum() - items["n"]
    yield items[["item", "shard", "base"]]


def shard_by_bytes(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, size, crc, shard, slot`` for every row; equal texts share a shard, sizes are near equal.

    ``size`` is the text's UTF-8 bytes plus ``ROW_BYTES``; ``slot`` numbers a
    shard's rows without gaps from 0.
    """
    width = shuffle_width(docs.sparkSession)
    k = max(8, BUNDLES // width)
    text = whole_text(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), F.crc32(text).alias("crc"),
                       (utf8_bytes(text) + ROW_BYTES).alias("size"),
                       F.pmod(F.xxhash64(F.col(id_col)), F.lit(SALTS)).alias("salt"))
    keys = ["h", "crc", "size"]
    parts = rows.groupBy(*keys, "salt").agg(F.count(F.lit(1)).alias("n"))
    placed = parts.repartition(width, *keys).mapInPandas(
        lambda frames: _bundle(frames, k), "h long, crc long, size long, salt long, n long, item long, before long")
    items = placed.groupBy("item").agg(F.sum(F.col("size") * F.col("n")).alias("bytes"), F.sum("n").alias("n"))
    shards = items.repartition(1).mapInPandas(lambda frames: _shards(frames, n_shards), "item long, shard int, base long")
    slots = placed.join(F.broadcast(shards), "item").select(*keys, "salt", "shard", (F.col("base") + F.col("before")).alias("first"))
    nth = F.row_number().over(Window.partitionBy(*keys, "salt").orderBy(F.col("id").asc_nulls_first()))
    return (rows.join(slots, [*keys, "salt"])
            .select("id", "size", "crc", "shard", (F.col("first") + nth - 1).cast("long").alias("slot")))
