"""Packing token sequences by best-fit decreasing.

A document's ids (its text's, then a separator) are cut into pieces of at most
``limit`` tokens; pieces are packed into sequences of ``limit`` tokens. Pieces go by
falling length to the open sequence with the least room that still holds them,
found in a segment tree over the remaining capacities: logarithmic in ``limit``.

Only lengths matter to the packing, and they are whole numbers up to ``limit``: the
histogram of all lengths (at most ``limit`` numbers) is packed on the driver, equal
pieces and equal bins at once (``plan``). The corpus is packed as one, not group by
group. Each piece then finds its place by its rank among the pieces of its length:
ranks are counted per length and deal, so a length that a third of the pieces share is
spread over as many tasks as the session shuffles into. Only ``(id, piece, start,
length, crc)`` of a piece is shuffled; ids stay where the text was read.

Ids are the tokenizers library's. White-space separated chunks are encoded
independently there (white space is dropped, no token crosses it), so they are kept
in a bounded worker cache. Chunks of plain Latin text that the worker has not met
are merged together with the vocabulary's own rules; any other chunk goes through
the library itself. The rules are read once, on the driver; workers get them as
arrays of a fixed size.

Edge cases: null text is empty: one piece, the separator alone; repeated or null
ids have their own pieces; a document of any length is encoded whole; an empty
table gives an empty result; only the id and the text are read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.llm.bpe import byte_alphabet
from ledgerlens.llm.common import LOWER_AZ, WHITE_BYTES, record, shuffle_width, slices, small_batches, text_bytes
from ledgerlens.llm.pairindex import PairIndex
from ledgerlens.llm.pieces import worker_cache
from ledgerlens.session import checkpoint_dir

FILE = "word_bpe_49k.json"
SLICE_BYTES, CACHE_ENTRIES = 8_000_000, 600_000
# Chunks of these characters alone have a known normal form; their pre-tokens.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
_GAP = np.isin(np.arange(256), list(WHITE_BYTES))
_TOKENS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


class WordVocabulary:
    """Ids of white-space chunks under a lower-casing word-end BPE file.

    Made once, where the file is; what it keeps is arrays of the file's size, so it
    travels to the workers whole. The library itself is loaded where it is needed.
    """

    def __init__(self, path: str):
        self.path, self.library = path, None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        alphabet = sorted(byte_alphabet().items(), key=lambda x: x[1])
        self.inner = np.array([ids[c] for c, _ in alphabet], np.int64)
        self.last = np.array([ids[c + end] for c, _ in alphabet], np.int64)
        rules: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            rules.setdefault((ids[a], ids[b]), (rank, ids[a + b]))
        self.size = max([*ids.values(), *self.special.values()]) + 1
        self.kind = "<u2" if self.size <= 1 << 16 else "<u4"
        self.index = PairIndex(rules, self.size)
        self.marks = {m: np.array([ids[m.decode() + end]], self.kind).tobytes() for m in (b".", b",")}
        self.split_special = re.compile(b"(" + b"|".join(map(re.escape, self.special)) + b")") if self.special else None

    def __getstate__(self):
        return self.__dict__ | {"library": None}

    def _library(self):
        """The library's tokenizer, loaded when the first odd chunk comes."""
        if self.library is None:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        return self.library

    def encode_chunks(self, chunks: list[bytes], known: Callable[[bytes], bytes | None] | None = None) -> list[bytes]:
        """Ids of each chunk (A-Z already lower-cased) as bytes of ``kind``.

        A chunk that is a ``known`` one with a full stop or comma after a letter
        has that one's ids and the mark's: the mark is a pre-token of its own.
        """
        out: list[bytes | None] = [None] * len(chunks)
        letters: list[int] = []  # chunks of ASCII letters alone: one pre-token
        tokens: list[tuple[int, list[bytes]]] = []
        odd = []
        for i, chunk in enumerate(chunks):
            if chunk.isalpha():
                letters.append(i)
                continue
            mark = chunk[-1:]
            if mark in self.marks and chunk[-2:-1].isalpha():
                core = known(chunk[:-1]) if known else None
                if core is not None:
                    out[i] = core + self.marks[mark]
                    continue
                if chunk[:-1].isalpha():
                    tokens.append((i, [chunk[:-1], mark]))
                    continue
            text = chunk.decode("utf-8", "replace")
            if _PLAIN.fullmatch(text):
                tokens.append((i, [t.encode() for t in _TOKENS.findall(text.lower())]))
            else:
                odd.append((i, text))
        words = list(dict.fromkeys([*(chunks[i] for i in letters), *(t for _, own in tokens for t in own)]))
        if words:
            data = np.frombuffer(b"".join(words), np.uint8)
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            symbols = self.inner[data]
            ends = np.cumsum(sizes) - 1
            symbols[ends] = self.last[data[ends]]
            of = dict(zip(words, self.index.encode(symbols, sizes, self.kind)))
            for i in letters:
                out[i] = of[chunks[i]]
            for i, own in tokens:
                out[i] = b"".join([of[t] for t in own])
        if odd:
            got = self._library().encode_batch([t for _, t in odd], add_special_tokens=False)
            for (i, _), e in zip(odd, got):
                out[i] = np.array(e.ids, self.kind).tobytes()
        return out

    def encode(self, texts: list[bytes], cache) -> list[bytes]:
        """Ids of whole UTF-8 texts as bytes of ``kind``; special strings are special tokens."""
        odd = [bool(self.special) and any(s in t for s in self.special) for t in texts]
        plain = iter(self._encode_plain([t for t, x in zip(texts, odd) if not x], cache))
        rare = iter(self._encode_split([t for t, x in zip(texts, odd) if x], cache))
        return [next(rare) if x else next(plain) for x in odd]

    def _encode_plain(self, texts: list[bytes], cache) -> list[bytes]:
        """Texts without special strings: each distinct chunk is looked up once, ids are gathered by chunk number."""
        if not texts:
            return []
        chars = np.frombuffer(b" ".join(t.translate(LOWER_AZ) for t in texts), np.uint8)
        gap = _GAP[chars]
        edges = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True]))))
        starts, stops = edges[::2], edges[1::2]
        offsets = np.concatenate(([0], np.cumsum(stops - starts))).astype(np.int32)
        words = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(chars[~gap])]).dictionary_encode()
        values = cache.values(words.dictionary.to_pylist()) if len(starts) else []
        width = np.dtype(self.kind).itemsize
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // width
        flat = np.frombuffer(b"".join(values), self.kind)
        first = np.cumsum(sizes) - sizes
        codes = np.asarray(words.indices, np.int64) if len(starts) else np.zeros(0, np.int64)
        counts = sizes[codes]
        ends = np.cumsum(counts)
        ids = flat[np.repeat(first[codes] - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)].tobytes()
        # a text's chunks are those that start before the text ends
        last = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]) - 1)
        cuts = [0, *(np.concatenate(([0], ends))[last] * width).tolist()]
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]

    def _encode_split(self, texts: list[bytes], cache) -> list[bytes]:
        """Texts that may have special strings: cut there first."""
        keys: list[bytes] = []
        plans = []
        width = np.dtype(self.kind).itemsize
        for text in texts:
            parts = self.split_special.split(text) if self.split_special and any(s in text for s in self.special) else [text]
            plan: list = []
            for part in parts:
                if part in self.special:
                    plan.append(self.special[part].to_bytes(width, "little"))
                else:
                    own = part.translate(LOWER_AZ).split()
                    plan.append((len(keys), len(keys) + len(own)))
                    keys += own
            plans.append(plan)
        values = cache.values(keys)
        return [b"".join([p if isinstance(p, bytes) else b"".join(values[p[0]:p[1]]) for p in plan]) for plan in plans]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> WordVocabulary:
    return WordVocabulary(path)


PIECES = "piece int, start long, length long, ids_crc32 long, deal long"


def pieces_of(docs: DataFrame, limit: int, id_col: str = "doc_id", text_col: str = "text", separator: int = 0,
              path: str | None = None, with_ids: bool = False, slice_bytes: int = SLICE_BYTES,
              cache_entries: int = CACHE_ENTRIES) -> DataFrame:
    """``id`` and ``PIECES`` (and ``ids``, little-endian unsigned 32-bit, if asked for). A narrow step.

    ``deal`` numbers a task's pieces from a start of its own, for dealing them out. A
    worker holds ``slice_bytes`` of text and ``cache_entries`` chunks at a time (some 300 MB as given).
    """
    small_batches(docs)
    path = path or public_tokenizers.path(FILE)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        v = shared.value
        cache = worker_cache(("words", path), lambda: lambda chunks: v.encode_chunks(chunks, cache.get), cache_entries)
        end = np.array([separator], v.kind).tobytes()
        width = np.dtype(v.kind).itemsize
        deal = TaskContext.get().partitionId()
        for batch in batches:
            texts = text_bytes(batch.column(1))
            for a, b in slices(map(len, texts), slice_bytes):
                rows, owner = [], []
                for i, ids in enumerate(v.encode(texts[a:b], cache), a):
                    ids += end
                    for nth, lo in enumerate(range(0, len(ids), limit * width)):
                        own = np.frombuffer(ids[lo:lo + limit * width], v.kind).astype("<u4").tobytes()
                        rows.append((nth, lo // width, len(own) // 4, zlib.crc32(own), deal, own if with_ids else None))
                        owner.append(i)
                        deal += 1
                cols = list(zip(*rows))
                out = {"id": batch.column(0).take(pa.array(owner, pa.int64())), "piece": pa.array(cols[0], pa.int32())}
                out |= {n: pa.array(c, pa.int64()) for n, c in zip(("start", "length", "ids_crc32", "deal"), cols[1:5])}
                yield record(out | ({"ids": pa.array(cols[5], pa.binary())} if with_ids else {}))

    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {id_type}, {PIECES}" + (", ids binary" if with_ids else ""))


class Capacities:
    """Open bins by room left: a segment tree whose leaves count the bins of one capacity."""

    def __init__(self, limit: int):
        self.leaves = 1 << limit.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(limit + 1)]  # first bin, number of bins

    def put(self, first: int, count: int, room: int) -> None:
        """``count`` bins from ``first`` on, each with ``room``."""
        self.runs[room].append((first, count))
        self._change(room, count)

    def _change(self, room: int, by: int) -> None:
        node = self.leaves + room
        while node:
            self.tree[node] += by
            node >>= 1

    def take(self, least: int) -> tuple[int, int, int] | None:
        """A run of bins with the least room of at least ``least``, taken out: first, number, room."""
        tree, node = self.tree, self.leaves + least
        if not tree[node]:
            while node > 1 and (node & 1 or not tree[node + 1]):
                node >>= 1  # up until a right sibling has bins
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                if not tree[node]:
                    node += 1
        room = node - self.leaves
        first, count = self.runs[room].pop()
        self._change(room, -count)
        return first, count, room


def plan(histogram: dict[int, int], limit: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counted lengths: ``length, rank, each, bin, offset`` runs, by length and rank.

    Pieces of ``length`` from ``rank`` on go to bins from ``bin`` on, ``each`` to a bin, side by side from
    ``offset``. A bin that has taken a piece and still holds another of the length is the tightest for the
    next one, so pieces fill a bin before they go on: equal pieces and equal bins are placed together.
    """
    open_, made, out = Capacities(limit), 0, []
    for n in sorted(histogram, reverse=True):
        left, rank = histogram[n], 0
        while left:
            found = open_.take(n)
            if found is None:
                count = -(-left // (limit // n))
                found, made = (made, count, limit), made + count
            first, count, room = found
            each = room // n
            full = min(count, left // each)
            if full:
                out.append((n, rank, each, first, limit - room))
                if room - each * n:
                    open_.put(first, full, room - each * n)
                left, rank, first, count = left - full * each, rank + full * each, first + full, count - full
            if left and count:  # fewer than a bin takes: one bin, then none of this length is left
                out.append((n, rank, left, first, limit - room))
                if room - left * n:
                    open_.put(first, 1, room - left * n)
                left, first, count = 0, first + 1, count - 1
            if count:
                open_.put(first, count, room)
    return sorted(out)


def best_fit(lengths: list[int], limit: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each piece; ``lengths`` fall and lie between 1 and ``limit``."""
    bins, offsets, rank = [], [], {}
    runs = plan(Counter(lengths), limit)
    places = Places(runs)
    for n in lengths:
        rank[n] = rank.get(n, -1) + 1
        bin_, offset = places.of(np.array([n]), np.array([rank[n]]))
        bins.append(int(bin_[0]))
        offsets.append(int(offset[0]))
    return bins, offsets


class Places:
    """The runs of a plan as arrays, to look up many pieces at once."""

    def __init__(self, runs: list[tuple[int, int, int, int, int]]):
        self.length, self.rank, self.each, self.bin, self.offset = np.array(runs, np.int64).reshape(-1, 5).T.copy()
        self.wide = int(self.rank.max(initial=0)) + 1

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bin and offset of pieces by length and rank among the pieces of that length."""
        first = np.searchsorted(self.length, length, "left")
        last = np.searchsorted(self.length, length, "right")
        while (last - first > 1).any():  # halve the runs of the length until one is left
            mid = (first + last) // 2
            up = (last - first > 1) & (self.rank[np.minimum(mid, len(self.rank) - 1)] <= rank)
            first, last = np.where(up, mid, first), np.where(up | (last - first <= 1), last, mid)
        nth = rank - self.rank[first]
        return self.bin[first] + nth // self.each[first], self.offset[first] + nth % self.each[first] * length


COLUMNS = ["id", "piece", "start", "length", "ids_crc32"]


def ranked(pieces: DataFrame) -> DataFrame:
    """``COLUMNS`` and ``rank``: a number of each piece among those of its length, without a gap."""
    width = shuffle_width(pieces.sparkSession)
    dealt = pieces.select(*COLUMNS, F.pmod("deal", F.lit(width)).cast("int").alias("part"))
    order = ["ids_crc32", F.col("id").asc_nulls_first(), "piece", "start"]
    numbered = dealt.withColumn("nth", F.row_number().over(Window.partitionBy("length", "part").orderBy(*order)))
    counts = dealt.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("length").alias("own_length"), F.col("part").alias("own_part"),
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start_rank"))
    return numbered.join(starts, (F.col("length") == F.col("own_length")) & (F.col("part") == F.col("own_part"))).select(
        *COLUMNS, (F.col("start_rank") + F.col("nth") - 1).alias("rank"))


def pack(pieces: DataFrame, limit: int) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``. They are read several times and must not change: give a written table."""
    counted = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    shared = pieces.sparkSession.sparkContext.broadcast(Places(plan(counted, limit)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bin_, offset = shared.value.of(np.asarray(batch.column(3)), np.asarray(batch.column(5)))
            own = dict(zip(COLUMNS, batch.columns))
            yield record(own | {"sequence_id": pa.array(bin_, pa.int64()), "offset": pa.array(offset, pa.int64())})

    id_type = pieces.schema["id"].dataType.simpleString()
    return ranked(pieces).mapInArrow(place, f"id {id_type}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text", **memory: int) -> DataFrame:
    """All documents' pieces with their places. Texts are encoded once: the pieces (some 40 bytes each) are written before
    they are counted, so a lost executor cannot change them between the count and the packing."""
    checkpoint_dir(docs.sparkSession)
    return pack(pieces_of(docs, limit, id_col, text_col, **memory).checkpoint(), limit)
