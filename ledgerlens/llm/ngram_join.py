"""N-gram Jaccard self-join of documents with rare-first prefix filtering, down to components.

A document's set: its distinct n-word shingles (A-Z lower-cased), as 64-bit hashes.
Two documents link when ``den * intersection >= num * union``.

1. *Classes.* Documents with equal sets are one class (128-bit digest of the set);
   from here on classes are joined, never their copies.
2. *Rare-first order.* Shingles of all documents are counted in ``SKETCH`` hashed
   buckets; each set is ordered by bucket count, then hash: one global order, in
   which frequent shingles come last. The counts (one byte each, on a logarithmic
   scale) are broadcast; their size is fixed.
3. *Prefixes.* Of two sets that link, the first ``n - ceil(num * n / den) + 1``
   shingles of each have one in common. A first pass counts these shingles alone
   (map-side first); a second keeps the rows of shared ones, with each row's place
   in its set and its rank among the set's shared prefix rows. A bit filter of
   fixed size leaves most unshared rows out before the shuffle.
4. *Candidates.* Classes meet on a prefix shingle. The length filter and the
   positional filter (shared rows before the place, plus what the shorter rest can
   still give) are conditions of that join; pairs are then counted, and a pair
   stays if the shingles its prefixes share plus the longer rest can reach the
   overlap needed. So each pair is verified once.
5. *Hubs first.* Many near copies of one text share their prefix rows, and all
   their pairs would be as many as the square of the group. Of a shingle with more
   than ``SMALL`` classes, each class first meets only the shingle's hub, the class
   closest to the text they share. Classes that link to a hub carry its label;
   after that a shingle's rows meet only across labels: those without the hub's
   label against all. Pairs left out lie within one component already, so no
   component is lost.
6. *Verification.* The texts of the classes in question are fetched by their hash,
   the suffix filter splits both sets at common values and bounds the overlap by
   the smaller parts, and what passes is intersected in full.
7. *Components* of the links (``components``), named by the smallest id.

Joins on a shingle or class that may be hot are built so that AQE can split them.

Edge cases: null text and text without words have the empty set and link with
nothing, not even each other; a text with fewer than ``n`` words is one shingle;
repeated rows are one class; a null id is ignored when the smallest id is sought,
unless the component has no other; texts of any length are read whole; an empty
table gives an empty result; only the id and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import equi_split, record, slices, small_batches, split_by_ids, text_bytes, whole_text
from ledgerlens.llm.components import components
from ledgerlens.llm.pieces import forget
from ledgerlens.llm.shingles import mixed, shingle_sets
from ledgerlens.session import checkpoint_dir

SKETCH = 1 << 22
SLICE_BYTES = 1_000_000
FILTER_BITS = 1 << 25
# Arrays are summed in rows of CHUNK bytes: a reducer gets as many rows as there are tasks, batch by batch.
CHUNK, ROWS, REDUCERS = 1 << 12, 64, 64
SMALL = 8
FETCH_BUCKETS = 1 << 18
PROBES = 16


def digests(grams: np.ndarray, ends: np.ndarray) -> tuple[list[bytes | None], np.ndarray]:
    """128-bit digest of each set (None: empty) and the sizes."""
    sizes = np.diff(np.concatenate([[0], ends]))
    halves = []
    for salt in (1, 2):
        running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(grams + np.uint64(salt)), dtype=np.uint64)])
        halves.append(mixed((running[ends] - running[ends - sizes]) ^ sizes.astype(np.uint64)))
    data = np.stack(halves, axis=1).tobytes()
    return [data[16 * i:16 * i + 16] if n else None for i, n in enumerate(sizes.tolist())], sizes


def _classes(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    forget()
    for batch in batches:
        texts = text_bytes(batch.column(2))
        for a, b in slices(map(len, texts), SLICE_BYTES):
            cls, sizes = digests(*shingle_sets(texts[a:b], n))
            yield record({"id": batch.column(0).slice(a, b - a), "hash": batch.column(1).slice(a, b - a),
                          "cls": pa.array(cls, pa.binary()), "n": pa.array(sizes, pa.int64())})


def classes(docs: DataFrame, n: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, hash, cls, n`` per row: the text's 64-bit hash, its set's digest and size. A narrow step."""
    small_batches(docs)
    text = whole_text(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    return rows.mapInArrow(lambda b: _classes(b, n), f"id {id_type}, hash long, cls binary, n long")


def _chunks(data: np.ndarray, name: str) -> Iterator[pa.RecordBatch]:
    """Rows of ``CHUNK`` bytes of an array of bytes, with their number; those that are all zero are left out."""
    rows = data.reshape(-1, CHUNK)
    told = np.flatnonzero(rows.any(axis=1))
    for lo in range(0, len(told), ROWS):
        own = told[lo:lo + ROWS]
        yield record({"chunk": pa.array(own, pa.int32()), name: pa.array([rows[i].tobytes() for i in own], pa.binary())})


# --- rare-first order

def _sketch(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    forget()
    counts = np.zeros(SKETCH, np.uint32)
    for batch in batches:
        texts = text_bytes(batch.column(0))
        for a, b in slices(map(len, texts), SLICE_BYTES):
            grams, _ = shingle_sets(texts[a:b], n)
            np.add.at(counts, (grams & np.uint64(SKETCH - 1)).astype(np.int64), 1)
    yield from _chunks(np.minimum(counts, 255).astype(np.uint8), "counts")


def _levels(counts: np.ndarray) -> np.ndarray:
    """Counts as one byte: exact below 32, then sixteen steps per doubling."""
    high = 32 + 16 * np.log2(np.maximum(counts, 32) / 32)
    return np.minimum(np.where(counts < 32, counts, high), 254).astype(np.uint8)


def _sum_chunks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[int, np.ndarray] = {}
    for frame in frames:
        for chunk, counts in frame.itertuples(index=False):
            sums[chunk] = sums.get(chunk, 0) + np.frombuffer(counts, np.uint8).astype(np.int64)
    if sums:
        yield pd.DataFrame({"chunk": list(sums), "levels": [_levels(c).tobytes() for c in sums.values()]})


def rarity(docs: DataFrame, n: int, text_col: str = "text") -> np.ndarray:
    """Level of every sketch bucket over all documents; ``SKETCH`` bytes reach the driver."""
    small_batches(docs)
    parts = docs.select(whole_text(F.col(text_col)).alias("text")).mapInArrow(lambda b: _sketch(b, n), "chunk int, counts binary")
    sums = parts.repartition(REDUCERS, "chunk").mapInPandas(_sum_chunks, "chunk int, levels binary")
    out = np.zeros(SKETCH, np.uint8)
    for r in sums.collect():
        out[r["chunk"] * CHUNK:(r["chunk"] + 1) * CHUNK] = np.frombuffer(r["levels"], np.uint8)
    return out


# --- prefixes

def prefix_size(n, num: int, den: int):
    return n - (num * n + den - 1) // den + 1


def _prefixes(batches: Iterator[pa.RecordBatch], n: int, num: int, den: int, levels: np.ndarray,
              several: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """``key, cls, n, place`` of the first shingles of each set; a set that the task has met is left out.

    With ``several``, a bit per hashed key, rows whose bit is off are left out too;
    without it only the keys are given.
    """
    met: set[bytes] = set()
    for batch in batches:
        texts = text_bytes(batch.column(0))
        for a, b in slices(map(len, texts), SLICE_BYTES):
            grams, ends = shingle_sets(texts[a:b], n)
            cls, sizes = digests(grams, ends)
            fresh = np.zeros(len(cls), bool)
            for i, c in enumerate(cls):
                if c is not None and c not in met:
                    met.add(c)
                    fresh[i] = True
            key = (levels[grams & np.uint64(SKETCH - 1)].astype(np.uint64) << np.uint64(56)) | (grams >> np.uint64(8))
            owner = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((key, owner))
            key = key[order]
            place = np.arange(len(key)) - np.repeat(ends - sizes, sizes)
            take = (place < prefix_size(sizes, num, den)[owner]) & fresh[owner]
            if several is None:
                yield record({"key": pa.array(key[take].view(np.int64))})
                continue
            take[take] = _bits(several, key[take])
            own = owner[take]
            data = b"".join(c or bytes(16) for c in cls)
            names = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(cls), [None, pa.py_buffer(data)]).cast(pa.binary())
            yield record({"key": pa.array(key[take].view(np.int64)), "cls": names.take(pa.array(own)),
                          "n": pa.array(sizes[own], pa.int64()), "place": pa.array(place[take], pa.int64())})


def _bit_of(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys) & np.uint64(FILTER_BITS - 1)).astype(np.int64)


def _bits(several: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = _bit_of(keys)
    return (several[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _filter_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(FILTER_BITS, bool)
    for batch in batches:
        bits[_bit_of(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))] = True
    yield from _chunks(np.packbits(bits, bitorder="little"), "bits")


def _or_chunks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[int, np.ndarray] = {}
    for frame in frames:
        for chunk, bits in frame.itertuples(index=False):
            sums[chunk] = sums.get(chunk, 0) | np.frombuffer(bits, np.uint8)
    if sums:
        yield pd.DataFrame({"chunk": list(sums), "bits": [b.tobytes() for b in sums.values()]})


def key_filter(keys: DataFrame) -> np.ndarray:
    """A bit per hashed key, set for those of ``keys``; ``FILTER_BITS / 8`` bytes reach the driver."""
    small_batches(keys)
    parts = keys.mapInArrow(_filter_chunks, "chunk int, bits binary")
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in parts.repartition(REDUCERS, "chunk").mapInPandas(_or_chunks, "chunk int, bits binary").collect():
        out[r["chunk"] * CHUNK:(r["chunk"] + 1) * CHUNK] = np.frombuffer(r["bits"], np.uint8)
    return out


def shared_prefixes(docs: DataFrame, n: int, num: int, den: int, levels, text_col: str = "text") -> DataFrame:
    """``key, cls, n, place, rank``: prefix rows of shingles that two rows or more have; rank counts them per class.

    A first pass counts the keys alone; the keys that several rows have are kept.
    The second pass leaves most other rows out by a bit filter of fixed size
    before anything is shuffled; the join with the kept keys is exact.
    """
    small_batches(docs)
    texts = docs.select(whole_text(F.col(text_col)).alias("text"))
    counted = texts.mapInArrow(lambda b: _prefixes(b, n, num, den, levels.value, None), "key long")
    several = (counted.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
               .select(F.col("key").alias("several")).checkpoint())
    bits = docs.sparkSession.sparkContext.broadcast(key_filter(several))
    rows = texts.mapInArrow(lambda b: _prefixes(b, n, num, den, levels.value, bits.value),
                            "key long, cls binary, n long, place long")
    shared = rows.join(several, rows["key"] == several["several"], "left_semi")
    nth = F.dense_rank().over(Window.partitionBy("cls").orderBy("place"))  # copies of a class in other tasks tie
    return shared.withColumn("rank", nth.cast("long") - 1).dropDuplicates(["cls", "key"])


# --- candidates

def _can_link(na: Column, nb: Column, overlap: Column, num: int, den: int) -> Column:
    return overlap * (num + den) >= (na + nb) * num


def _length_ok(na: Column, nb: Column, num: int, den: int) -> Column:
    return F.least(na, nb) * den >= F.greatest(na, nb) * num


def _row_ok(a: DataFrame, b: DataFrame, num: int, den: int) -> Column:
    """Length and positional filter of two prefix rows of one shingle."""
    reach = F.least(a["rank"], b["b_rank"]) + 1 + F.least(a["n"] - a["place"] - 1, b["b_n"] - b["b_place"] - 1)
    return _length_ok(a["n"], b["b_n"], num, den) & _can_link(a["n"], b["b_n"], reach, num, den)


def _counted(pairs: DataFrame, num: int, den: int) -> DataFrame:
    """Distinct pairs ``a < b`` that their shared prefix rows still allow to link."""
    ordered = pairs.select(F.least("cls", "b_cls").alias("a"), F.greatest("cls", "b_cls").alias("b"),
                           F.col("n").alias("x"), F.col("b_n").alias("y"), "key")
    counted = ordered.groupBy("a", "b").agg(F.count(F.lit(1)).alias("common"), F.least(F.min("x"), F.min("y")).alias("lo"),
                                            F.greatest(F.max("x"), F.max("y")).alias("hi"))
    rest = F.floor((F.col("hi") * num + den - 1) / den) - 1  # the longer set without its prefix
    return counted.filter(_can_link(F.col("lo"), F.col("hi"), F.col("common") + rest, num, den)).select("a", "b")


def _as_b(rows: DataFrame, *extra: str) -> DataFrame:
    return rows.select(F.col("key").alias("b_key"), *[F.col(c).alias(f"b_{c}") for c in ("cls", "n", "place", "rank", *extra)])


def hub_pairs(rows: DataFrame, hubs: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of every class with the hub of each crowded shingle."""
    crowded = hubs.filter(F.col("b_size") > SMALL)
    met = equi_split(rows, crowded, "key", "b_key", "inner").filter(F.col("cls") != F.col("b_cls"))
    reach = F.least("rank", "b_rank") + 1 + F.least(F.col("n") - F.col("place") - 1, F.col("b_n") - F.col("b_place") - 1)
    return _counted(met.filter(_length_ok(F.col("n"), F.col("b_n"), num, den)
                               & _can_link(F.col("n"), F.col("b_n"), reach, num, den)), num, den)


def hubs_of(rows: DataFrame) -> DataFrame:
    """Per shingle the class with the fewest unshared rows before it, and the shingle's number of classes."""
    first = F.struct((F.col("place") - F.col("rank")).alias("own"), "cls", "n", "place", "rank")
    return (rows.groupBy(F.col("key").alias("b_key")).agg(F.min(first).alias("h"), F.count(F.lit(1)).alias("b_size"))
            .filter("b_size > 1")
            .select("b_key", "b_size", *[F.col(f"h.{c}").alias(f"b_{c}") for c in ("cls", "n", "place", "rank")]))


def star_labels(found: DataFrame) -> DataFrame:
    """``node, root``: the smallest class within two links of each class. Equal roots mean one component."""
    both = found.select(F.col("a").alias("u"), F.col("b").alias("v"))
    both = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m")).select("c", F.least("c", "m").alias("m"))
    return (equi_split(both, near, "v", "c", "inner").groupBy(F.col("u").alias("node")).agg(F.min("m").alias("m"))
            .select("node", F.least("node", "m").alias("root")))


def cross_pairs(rows: DataFrame, hubs: DataFrame, labels: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs across labels of every shingle: rows without the hub's label against all its rows."""
    named = equi_split(rows, labels, "cls", "node", "left").withColumn("label", F.coalesce("root", "cls")).drop("node", "root")
    hub = equi_split(hubs.select("b_key", "b_cls"), labels, "b_cls", "node", "left").select(
        F.col("b_key").alias("h_key"), F.coalesce("root", "b_cls").alias("hub_label"))
    marked = equi_split(named, hub, "key", "h_key", "inner").withColumn("is_hub", F.col("label") == F.col("hub_label")).drop("h_key")
    away = marked.filter(~F.col("is_hub"))
    other = _as_b(marked, "label", "is_hub")
    match = ((away["key"] == other["b_key"]) & (away["label"] != other["b_label"])
             & (other["b_is_hub"] | (away["cls"] < other["b_cls"])) & _row_ok(away, other, num, den))
    return _counted(away.join(other, match), num, den)


# --- verification

def overlap_bound(x: np.ndarray, y: np.ndarray) -> int:
    """Suffix filter: split both sorted sets at values of ``x``; no more is common than the smaller parts hold."""
    cut = np.linspace(0, len(x), min(PROBES, len(x)) + 1).astype(np.int64)
    there = np.concatenate([[0], np.searchsorted(y, x[cut[1:-1]]), [len(y)]])
    return int(np.minimum(np.diff(cut), np.diff(there)).sum())


def _verify(batches: Iterator[pa.RecordBatch], n: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        text = [text_bytes(batch.column(i)) for i in (2, 3)]
        keep = np.zeros(len(a), bool)
        for lo, hi in slices([len(x) + len(y) for x, y in zip(*text)], SLICE_BYTES):
            sets = [shingle_sets(t[lo:hi], n) for t in text]
            names = [digests(*s)[0] for s in sets]
            for i in range(lo, hi):
                j = i - lo
                x, y = (g[(e[j - 1] if j else 0):e[j]] for g, e in sets)
                if names[0][j] != a[i] or names[1][j] != b[i]:
                    continue  # another text with the same hash
                least = -(-num * (len(x) + len(y)) // (num + den))
                if overlap_bound(x, y) >= least:
                    keep[i] = len(x) + len(y) - len(np.union1d(x, y)) >= least
        yield record({"a": batch.column(0), "b": batch.column(1)}).filter(pa.array(keep))


def verified(pairs: DataFrame, table: DataFrame, docs: DataFrame, n: int, num: int, den: int, text_col: str) -> DataFrame:
    """The pairs that link. Texts are fetched by hash; only rows whose hash bucket is asked for are shuffled."""
    small_batches(docs)
    asked = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).distinct()
    one = table.filter("cls is not null").groupBy("cls").agg(F.min("hash").alias("hash"))
    asked = asked.join(one, "cls")
    bucket = F.pmod(F.col("hash"), F.lit(FETCH_BUCKETS))
    buckets = asked.select(bucket.alias("bucket")).distinct()  # at most FETCH_BUCKETS rows
    text = whole_text(F.col(text_col))
    texts = (docs.select(F.xxhash64(text).alias("hash"), text.alias("text")).withColumn("bucket", bucket)
             .join(F.broadcast(buckets), "bucket", "left_semi").drop("bucket"))
    found = asked.join(texts, "hash").dropDuplicates(["cls", "hash", "text"]).select("cls", "text")
    left = pairs.join(found.select(F.col("cls").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(found.select(F.col("cls").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(lambda x: _verify(x, n, num, den), "a binary, b binary")


# --- the join

def links(docs: DataFrame, table: DataFrame, n: int, num: int, den: int, text_col: str = "text") -> DataFrame:
    """Verified links ``a, b`` between classes; every two classes that link are joined by a path of them."""
    spark = docs.sparkSession
    checkpoint_dir(spark)
    levels = spark.sparkContext.broadcast(rarity(docs, n, text_col))
    rows = shared_prefixes(docs, n, num, den, levels, text_col).checkpoint()
    hubs = hubs_of(rows)
    star = hub_pairs(rows, hubs, num, den).checkpoint()
    first = verified(star, table, docs, n, num, den, text_col).checkpoint()
    labels = star_labels(first).checkpoint()
    cross = cross_pairs(rows, hubs, labels, num, den).join(star, ["a", "b"], "left_anti").checkpoint()
    second = verified(cross, table, docs, n, num, den, text_col)
    return first.unionByName(second).checkpoint()


def _labelled(docs: DataFrame, n: int, num: int, den: int, id_col: str, text_col: str) -> DataFrame:
    """``id, hash, n, label`` per row: rows of one component share a label."""
    checkpoint_dir(docs.sparkSession)
    table = classes(docs, n, id_col, text_col).checkpoint()
    roots = components(links(docs, table, n, num, den, text_col))
    named = equi_split(table, roots, "cls", "node", "left").select(
        "id", "hash", "n", F.coalesce("root", "cls").alias("label"))
    return named.withColumn("label", F.coalesce("label", F.encode(F.concat(F.lit("alone "), F.coalesce(F.col("id").cast("string"), F.lit(""))), "utf-8")))


def near_duplicates(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``id, n_shingles, component_id`` per row."""
    named = _labelled(docs, n, num, den, id_col, text_col).drop("hash")
    least = named.filter("n > 0").groupBy(F.col("label").alias("component")).agg(F.min("id").alias("least_id"))
    return equi_split(named, least, "label", "component", "left").select(
        "id", F.col("n").alias("n_shingles"), F.coalesce("least_id", "id").alias("component_id"))


def keep_representatives(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """One row of each component, with all its columns: the one with the smallest id (null last), then the smallest text hash.

    Rows are told apart by id and text: rows that share an id, or have none, stay or go
    each by its own text. Of rows repeated with one id and text, one stays. Rows without
    words are linked with nothing and stay.
    """
    named = _labelled(docs, n, num, den, id_col, text_col).filter("n > 0")
    rows = named.groupBy("label", "id", "hash").agg(F.count(F.lit(1)).alias("copies"))
    rank = F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("best_id"), F.col("hash").alias("best_hash"))
    best = rows.groupBy(F.col("label").alias("component")).agg(F.min(rank).alias("best")).select(
        "component", "best.best_id", "best.best_hash")
    stays = F.col("id").eqNullSafe(F.col("best_id")) & (F.col("hash") == F.col("best_hash"))
    marks = equi_split(rows, best, "label", "component", "inner").withColumn("__stays", stays).filter(
        ~stays | (F.col("copies") > 1)).select("id", *_key(F.col("id"), F.col("hash")), "__stays").checkpoint()
    asked, rest = split_by_ids(docs, id_col, marks.select("id"))
    keys = ["__id", "__has_id", "__hash"]
    tagged = asked.select("*", *_key(F.col(id_col), F.xxhash64(whole_text(F.col(text_col)))))
    told = tagged.join(marks.select(*keys, "__stays"), keys, "left")
    kept = told.filter(F.col("__stays").isNull()).unionByName(told.filter("__stays").dropDuplicates(keys))
    return kept.select(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]).unionByName(rest)


def _key(id_: Column, hash_: Column) -> list[Column]:
    """An id and a text hash as columns without nulls, for joining and grouping alike."""
    return [F.coalesce(id_.cast("string"), F.lit("")).alias("__id"), id_.isNotNull().alias("__has_id"), hash_.alias("__hash")]
