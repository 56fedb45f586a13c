"""Hard negatives by threshold joins over a pruned inverted index (after L2AP).

Vectors are whole numbers, scores integer inner products. Every row of the table is
held against a stated set of anchors, in blocks: a block of at most ``ANCHORS``
anchors is broadcast (its size is bounded; more anchors mean more blocks), a chunk of
``ROWS`` rows meets it inside a task. No row is shuffled; a task hands on at most
``positives`` or ``negatives`` rows per anchor or window.

A chunk against a block (``Chunk.matches``), for a threshold per anchor:

1. Dimensions go by falling weight in the block. Of a row's vector the tail whose norm
   times the largest anchor norm stays under the lowest threshold is omitted from the
   index: what is left out cannot reach a threshold by itself. Rows are ordered by
   how many dimensions they keep, so that each dimension's postings are the first
   rows of the chunk.
2. Partial scores accumulate over groups of dimensions; after each, a pair whose
   partial score and remaining norms cannot reach its anchor's threshold is pruned.
3. What survives is verified: the whole integer product.

Thresholds start high and are lowered, for the anchors whose windows are not full,
until they are or no row is left. Over the chunks of a task a full window's last score
is the threshold, so pruning sharpens. The tasks' windows are merged by key.

Two passes: the positives (the best other rows of the anchor's label), then for each
anchor and positive the window of scores between ``low`` and ``high`` hundredths of
the positive's score among rows of other labels.

Edge cases: rows with a null label or vector, or a null or non-finite component,
take no part; vectors of different lengths are compared as if filled up with zeros;
components beyond ``WIDEST`` after scaling count as that; rows of one id and
one score with an anchor count once, and none is "other" to an anchor of its id; anchors
of one id with different labels or vectors each have windows of their own; an empty table gives an empty result; columns beside
id, vector and label are not read. Equal scores go by smaller id.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.llm.common import record, release
from ledgerlens.sources.tables import shared_path

ANCHORS, ROWS, SUB, GROUP = 8192, 2048, 256, 8
WIDEST = 1 << 24
LEVELS = (0.85, 0.7, 0.55, 0.4, 0.2, 0.0)


def whole_vectors(rows: DataFrame, label: Column, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id, label, vector`` of the rows that take part, components as whole numbers (256ths, rounded down)."""
    x = F.col(vector_col)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    scaled = F.transform(x, lambda v: F.greatest(F.lit(-float(WIDEST)), F.least(
        F.lit(float(WIDEST)), F.floor(v.cast("double") * 256).cast("double"))).cast("int"))
    return rows.filter(label.isNotNull() & x.isNotNull() & ~F.coalesce(bad, F.lit(False))).select(
        F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), scaled.alias("vector"))


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of numbers as a matrix, shorter ones filled up with zeros."""
    sizes = np.asarray(lists.value_lengths().fill_null(0), np.int64)
    flat = np.asarray(lists.flatten(), np.int64)
    out = np.zeros((len(sizes), max(width, int(sizes.max(initial=0)))), np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


class Anchors:
    """A block of anchors: ids, labels, vectors with dimensions by falling weight, norms of what remains."""

    def __init__(self, rows: list[tuple[int, int, list[int]]]):
        width = max((len(v) for _, _, v in rows), default=0)
        self.ids = np.array([i for i, _, _ in rows], np.int64)
        self.labels = np.array([k for _, k, _ in rows], np.int64)
        vectors = np.zeros((len(rows), width), np.int64)
        for i, (_, _, v) in enumerate(rows):
            vectors[i, :len(v)] = v
        self.order = np.argsort(-(vectors.astype(float) ** 2).sum(axis=0), kind="stable")
        self.vectors = vectors[:, self.order]
        self.left = _remaining(self.vectors)
        self.width = width


def _remaining(vectors: np.ndarray) -> np.ndarray:
    """Norm of the components from each place on, a little rounded up; the last column is 0."""
    squares = vectors.astype(float) ** 2
    tails = np.sqrt(np.cumsum(squares[:, ::-1], axis=1)[:, ::-1]) * (1 + 1e-12)
    return np.concatenate((tails, np.zeros((len(vectors), 1))), axis=1)


def _most(left: np.ndarray, rest: np.ndarray, start: np.ndarray) -> np.ndarray:
    """What the dimensions from ``start`` on (per row) can add to a pair's score at most."""
    return left[np.arange(len(start)), start][:, None] * rest.T[start]


class Chunk:
    """Some rows, ready to be held against anchors of one block."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, lists: pa.Array, anchors: Anchors):
        whole = _matrix(lists, anchors.width)
        own = np.zeros((len(ids), anchors.width), np.int64)
        own[:] = whole[:, anchors.order]
        self.ids, self.labels, self.vectors, self.left = ids, labels, own, _remaining(own)
        self.anchors = anchors

    def index(self, least: float, largest: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows by falling number of indexed dimensions, and that number. ``least``: the lowest threshold."""
        kept = (self.left[:, :-1] * largest >= least).sum(axis=1)
        rows = np.argsort(-kept, kind="stable")
        return rows, kept[rows]

    def matches(self, which: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (row, anchor, score) with score >= the anchor's threshold, for the anchors ``which`` of the block."""
        a = self.anchors
        q, rest = a.vectors[which], a.left[which]
        rows, kept = self.index(float(thresholds.min(initial=0)), float(rest[:, 0].max(initial=0)))
        x, left = self.vectors[rows], self.left[rows]
        wide = q.astype(float)
        partial = np.zeros((len(rows), len(which)))
        alive = np.ones(partial.shape, bool)
        for lo in range(0, a.width, GROUP):
            n = int(np.searchsorted(-kept, -lo))  # rows with a posting in this group: kept > lo
            if not n:
                break
            hi = min(lo + GROUP, a.width)
            # a row that keeps fewer dimensions than the group's last has no posting there
            own = np.where(np.arange(lo, hi) < kept[:n, None], x[:n, lo:hi], 0)
            partial[:n] += own.astype(float) @ wide[:, lo:hi].T
            if hi < a.width and hi % (2 * GROUP) == 0:
                alive[:n] &= partial[:n] + _most(left[:n], rest, np.minimum(kept[:n], hi)) >= thresholds - 0.5
                if not alive.any():
                    break
        alive &= partial + _most(left, rest, kept) >= thresholds - 0.5
        r, c = np.nonzero(alive)
        score = np.einsum("ij,ij->i", x[r], q[c]) if len(r) else np.zeros(0, np.int64)
        good = score >= thresholds[c]
        return rows[r[good]], which[c[good]], score[good]


class Windows:
    """The best rows of each window so far. A window belongs to an anchor and takes scores of ``lo`` to ``hi``."""

    def __init__(self, owner: np.ndarray, lo: np.ndarray, hi: np.ndarray, size: int):
        self.owner, self.lo, self.hi, self.size = owner, lo, hi, size
        self.rows: list[list[tuple[int, int, int]]] = [[] for _ in owner]  # (-score, id, label)

    def add(self, window: np.ndarray, score: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        order = np.lexsort((ids, -score, window))
        starts = np.flatnonzero(np.concatenate(([True], np.diff(window[order]) != 0))) if len(order) else []
        for lo, hi in zip(starts, [*starts[1:], len(order)]):
            # one row may be met again at a lower threshold: equal entries are one
            best = order[lo:hi][:4 * self.size]
            if len(best) < hi - lo and len({(score[i], ids[i]) for i in best}) < self.size:
                best = order[lo:hi]
            w = int(window[order[lo]])
            new = {(-int(score[i]), int(ids[i]), int(labels[i])) for i in best}
            self.rows[w] = sorted(new.union(self.rows[w]))[:self.size]

    def full(self) -> np.ndarray:
        return np.fromiter((len(r) >= self.size for r in self.rows), bool, len(self.rows))

    def floors(self) -> np.ndarray:
        """The score below which a window needs no row."""
        return np.fromiter((max(lo, -r[-1][0]) if len(r) >= self.size else lo
                            for lo, r in zip(self.lo.tolist(), self.rows)), np.int64, len(self.rows))


def fill(windows: Windows, chunk: Chunk, same_label: bool) -> None:
    """Put the chunk's rows into the windows, thresholds falling until these are full or nothing is left."""
    a = chunk.anchors
    bound = chunk.left[:, 0].max(initial=0) * a.left[:, 0]  # no score of an anchor is larger
    top = np.minimum(windows.hi.astype(float), bound[windows.owner])
    floor = np.maximum(windows.lo, np.floor(-bound[windows.owner] - 1).astype(np.int64))
    done = np.zeros(len(windows.owner), bool)
    for level in LEVELS:
        full = windows.full()
        need = windows.floors()
        # a full window asks once more, from its last score on; the others from the next lower level
        ask = np.where(full, need, np.maximum(floor, np.ceil(floor + (top - floor) * level)).astype(np.int64))
        todo = np.flatnonzero(~done)
        if not len(todo):
            return
        for lo in range(0, len(todo), SUB):
            own = todo[lo:lo + SUB]
            which, at = np.unique(windows.owner[own], return_inverse=True)
            least = np.full(len(which), np.iinfo(np.int64).max)
            np.minimum.at(least, at, ask[own])
            row, anchor, score = chunk.matches(which, least)
            _offer(windows, own, chunk, row, anchor, score, same_label)
        done |= full | (ask <= floor) | windows.full() & (windows.floors() >= ask)


def _offer(windows: Windows, own: np.ndarray, chunk: Chunk, row, anchor, score, same_label: bool) -> None:
    """Pairs to the windows ``own`` that take them."""
    a = chunk.anchors
    fits = ((chunk.labels[row] == a.labels[anchor]) == same_label) & (chunk.ids[row] != a.ids[anchor])
    row, anchor, score = row[fits], anchor[fits], score[fits]
    by_anchor = np.argsort(windows.owner[own], kind="stable")
    mine = own[by_anchor]
    first = np.searchsorted(windows.owner[mine], anchor, "left")
    last = np.searchsorted(windows.owner[mine], anchor, "right")
    pair = np.repeat(np.arange(len(row)), last - first)
    window = mine[np.arange(len(pair)) - np.repeat(np.cumsum(last - first) - (last - first), last - first) + first[pair]]
    score = score[pair]
    ok = (score >= windows.floors()[window]) & (score <= windows.hi[window])
    pair, window, score = pair[ok], window[ok], score[ok]
    windows.add(window, score, chunk.ids[row[pair]], chunk.labels[row[pair]])


def join(rows: DataFrame, anchors: Anchors, owner: list[int], lo: list[int], hi: list[int], size: int, same_label: bool) -> DataFrame:
    """``window, id, score``: each task's best rows of every window. A narrow step."""
    spark = rows.sparkSession
    block = spark.sparkContext.broadcast((anchors, np.array(owner, np.int64), np.array(lo, np.int64), np.array(hi, np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, owner, lo, hi = block.value
        windows = Windows(owner, lo, hi, size)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                fill(windows, Chunk(np.asarray(part.column(0), np.int64), np.asarray(part.column(1), np.int64), part.column(2), anchors), same_label)
        found = [(w, i, -s) for w, own in enumerate(windows.rows) for s, i, _ in own]
        cols = list(zip(*found)) or [()] * 3
        yield record({n: pa.array(c, pa.int64()) for n, c in zip(("window", "id", "score"), cols)})
        release()

    return rows.mapInArrow(run, "window long, id long, score long")


def first_of_windows(found: DataFrame, size: int) -> DataFrame:
    """``window, rank, id, score`` of each window's best rows over all tasks."""
    order = Window.partitionBy("window").orderBy(F.desc("score"), F.asc("id"))
    return found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)


MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """``MINED`` over ``rows`` (``id, label, vector``): anchors are the rows where ``is_anchor`` holds.

    Of the anchors' blocks one at a time is on the driver, with its positives: at
    most ``ANCHORS`` anchors and ``positives`` windows each.
    """
    spark = rows.sparkSession
    folder = shared_path(spark, f"negatives-{uuid.uuid4().hex}")
    chosen = rows.filter(is_anchor).distinct()
    blocks = -(-chosen.count() // (ANCHORS // 2))
    done: list[str] = []
    for k in range(blocks):
        for anchors in _bounded(chosen.filter(F.pmod(F.xxhash64("id", "label", "vector"), F.lit(blocks)) == k)):
            done.append(f"{folder}/{len(done)}")
            _mine_block(rows, anchors, positives, negatives, low, high).write.parquet(done[-1])
    return spark.read.schema(MINED).parquet(*done) if done else spark.createDataFrame([], MINED)


def _bounded(chosen: DataFrame) -> Iterator[Anchors]:
    """The anchors of a block; a block that came out larger than ``ANCHORS`` in several."""
    held = []
    for r in chosen.toLocalIterator():
        held.append((r["id"], r["label"], r["vector"]))
        if len(held) == ANCHORS:
            yield Anchors(held)
            held = []
    if held:
        yield Anchors(held)


def _mine_block(rows: DataFrame, anchors: Anchors, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    spark, n = rows.sparkSession, len(anchors.ids)
    wide = np.iinfo(np.int64).max // 4
    best = first_of_windows(join(rows, anchors, list(range(n)), [-wide] * n, [wide] * n, positives, True), positives).collect()
    # low * p <= 100 * s <= high * p
    windows = [(r["window"], r["id"], r["score"], -(-low * r["score"] // 100), high * r["score"] // 100) for r in best]
    windows = [w for w in windows if w[3] <= w[4]]
    found = join(rows, anchors, [w[0] for w in windows], [w[3] for w in windows], [w[4] for w in windows], negatives, False)
    names = spark.createDataFrame([(k, int(anchors.ids[w[0]]), w[1], w[2]) for k, w in enumerate(windows)],
                                  "window long, anchor_id long, positive_id long, positive_score long")
    return first_of_windows(found, negatives).join(names, "window").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
