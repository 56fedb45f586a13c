"""Phrase collocations by shard mining (SON) and exact global counts.

``f(phrase)`` counts all occurrences of up to three words in a row within a piece
of text, overlaps included; pieces end at punctuation and line ends.

1. Texts are dealt to ``SHARDS`` shards slice by slice. A slice counts its phrases
   completely (sorted word numbers) and hands on one packed block per bucket of
   phrases; a phrase's bucket is a hash of its words and language.
2. A bucket meets all its blocks in one place. There, per shard, the counts of a
   phrase add up: the mining of that shard, complete. A phrase with ``support``
   occurrences has at least ``ceil(support / SHARDS)`` in some shard, so the union of
   the shards' frequent phrases at this lowered support holds every frequent one.
   Candidates are then counted globally: the sum over all shards, exact, whether
   frequent there or not. As a bucket holds the counts of every shard, the corpus is
   not read a second time. More shards than ``support`` would lower the local
   support to 1 and leave nothing out, hence few, large shards; a shard is no unit of
   work, slices and buckets are.
3. Frequent phrases (a few percent) are written. Joins give the counts of the parts
   of every cut; scores are exact in decimals of 38 digits.

Memory: a slice's text is bounded (one longer text forms its own); a bucket holds
its share of all phrases, with ``BUCKETS`` times as many buckets as partitions. A word
or phrase that is everywhere adds one entry per slice to its bucket. Nothing is
broadcast, nothing collected.

Edge cases: null text is empty; null language counts as ``und``; words keep every
character but white space and piece ends; a text without two words in a piece has no
phrase; an empty table gives an empty result; repeated rows count each time; only
text and language are read, other columns may have any name.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.llm.common import record, release, shuffle_width, slices, text_bytes
from ledgerlens.sources.tables import write_read

SUPPORT, SHARDS, BUCKETS, WORDS = 10, 4, 4, 3
SLICE_BYTES = 6_000_000
_NO_LANG = "und"
# A-Z to lower case, the characters that end a piece to a line end, tab to space.
_TABLE = bytes(10 if chr(b) in ".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
BLOCK = "bucket int, shard int, size long, phrases binary, lengths binary, counts binary"


def _escaped(lang: str) -> bytes:
    """The language as the head of a packed line: free of tabs."""
    return lang.replace("\\", "\\\\").replace("\t", "\\t").encode()


def _restored(lang: str) -> str:
    return re.sub(r"\\(.)", lambda m: {"t": "\t"}.get(m[1], m[1]), lang)


def word_numbers(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words in byte order, the number of each word in reading order, and the piece it stands in."""
    chars = np.frombuffer(b"\n".join(t.translate(_TABLE) for t in texts), np.uint8)
    ends = chars == 10
    gap = ends | (chars == 32)
    edges = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True]))))
    starts, stops = edges[::2], edges[1::2]
    offsets = np.concatenate(([0], np.cumsum(stops - starts))).astype(np.int32)
    words = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(chars[~gap])])
    coded = words.dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[np.asarray(order)] = np.arange(len(order))
    numbers = rank[np.asarray(coded.indices)] if len(starts) else np.zeros(0, np.int64)
    return coded.dictionary.take(order), numbers, np.cumsum(ends)[starts]


def _runs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, rising, and how often each occurs."""
    codes = np.sort(codes)
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    return codes[first], np.diff(np.concatenate((first, [len(codes)])))


def phrase_counts(numbers: np.ndarray, pieces: np.ndarray, known: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For one word, two words and so on: the word numbers of each distinct phrase and how often it stands."""
    shorter = np.arange(known)[:, None]  # the phrases one word shorter, and for each start in the text which of them stands there
    codes = numbers
    for n in range(1, WORDS + 1):
        if n == 1:
            yield shorter, np.bincount(numbers, minlength=known)
            continue
        if len(numbers) < n:
            return
        inside = pieces[:1 - n] == pieces[n - 1:]  # no later start fits if a shorter phrase does not: pieces rise
        codes = codes[:len(inside)] * known + numbers[n - 1:]
        distinct, count = _runs(codes[inside])
        if not len(distinct):
            return
        found = np.concatenate((shorter[distinct // known], (distinct % known)[:, None]), axis=1)
        yield found, count
        # numbered anew, so that the next code fits in 64 bits; starts at which none stands get any number
        codes = np.minimum(np.searchsorted(distinct, codes), len(distinct) - 1) if n < WORDS else codes
        shorter = found


def _mixed(hashes: np.ndarray, seed: int) -> np.ndarray:
    """A hash per row of word hashes."""
    h = np.full(len(hashes), seed, np.uint64)
    for k in range(hashes.shape[1]):
        h = (h ^ hashes[:, k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(20)


def packed_blocks(texts: dict[str, list[bytes]], buckets: int) -> Iterator[tuple[int, int, bytes, bytes, bytes]]:
    """``bucket, size, phrases, lengths, counts`` of all phrases of the texts, by language.

    A phrase is written as language, tab, words; one without words counts all words of the language.
    """
    lines, parts, sums = [], [], []
    for lang, own in texts.items():
        known, numbers, pieces = word_numbers(own)
        if not len(known):
            continue
        head = _escaped(lang) + b"\t"
        seed = zlib.crc32(head)
        first = pc.binary_join_element_wise(head, known, b"")
        hashes = np.fromiter(map(zlib.crc32, known.to_pylist()), np.uint64, len(known))
        for rows, count in phrase_counts(numbers, pieces, len(known)):
            words = [(known if k else first).take(pa.array(rows[:, k])) for k in range(rows.shape[1])]
            lines.append(pc.binary_join_element_wise(*words, b" ") if len(words) > 1 else words[0])
            parts.append(_mixed(hashes[rows], seed) % np.uint64(buckets))
            sums.append(count)
        lines.append(pa.array([head], pa.binary()))
        parts.append(np.array([seed % buckets], np.uint64))
        sums.append(np.array([len(numbers)]))
    if not lines:
        return
    bucket, count = np.concatenate(parts).astype(np.int64), np.concatenate(sums)
    order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")  # 16 bits: a radix sort
    whole = pa.chunked_array(lines).combine_chunks().take(pa.array(order))
    offsets = np.frombuffer(whole.buffers()[1], np.int32)[whole.offset:whole.offset + len(whole) + 1]
    data, count = memoryview(whole.buffers()[2]), count[order].astype("<u4")
    lo = 0
    for b, hi in enumerate(np.cumsum(np.bincount(bucket, minlength=buckets)).tolist()):
        if hi > lo:
            yield (b, hi - lo, bytes(data[offsets[lo]:offsets[hi]]), np.diff(offsets[lo:hi + 1]).astype("<i4").tobytes(),
                   count[lo:hi].tobytes())
        lo = hi


def _pack(body: bytes) -> bytes:
    return len(body).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)


def _unpack(body: bytes) -> pa.Buffer:
    return pa.decompress(body[8:], decompressed_size=int.from_bytes(body[:8], "little"), codec="zstd")


def mine_slices(docs: DataFrame, buckets: int, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Packed counts of every slice. A narrow step."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        nth = TaskContext.get().partitionId()
        held: dict[str, list[bytes]] = {}
        size = 0

        def emit() -> Iterator[pa.RecordBatch]:
            rows = [(b, nth % SHARDS, n, *map(_pack, packed)) for b, n, *packed in packed_blocks(held, buckets)]
            for lo in range(0, len(rows), 1024):
                cols = list(zip(*rows[lo:lo + 1024]))
                kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
                yield record({f.split()[0]: pa.array(c, k) for f, c, k in zip(BLOCK.split(", "), cols, kinds)})
            held.clear()

        for batch in batches:
            texts = text_bytes(batch.column(0))
            langs = batch.column(1).to_pylist()
            for lo, hi in slices(map(len, texts), SLICE_BYTES):
                for text, lang in zip(texts[lo:hi], langs[lo:hi]):
                    held.setdefault(_NO_LANG if lang is None else lang, []).append(text)
                    size += len(text)
                if size >= SLICE_BYTES // 2:
                    yield from emit()
                    nth, size = nth + 1, 0
        yield from emit()
        release()

    return docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).mapInArrow(run, BLOCK)


FREQUENT = "lang string, phrase string, words int, f long"


def _merged(blocks: list[tuple[int, bytes, bytes, bytes]], support: int) -> tuple[list[bytes], list[int]]:
    """Frequent phrases of a bucket with their counts; those without words (a language's word count) always."""
    lines, counts, shards = [], [], []
    for shard, phrases, lengths, count in blocks:
        offsets = np.concatenate(([0], np.cumsum(np.frombuffer(_unpack(lengths), "<i4"), dtype=np.int64)))
        lines.append(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), _unpack(phrases)]))
        counts.append(np.frombuffer(_unpack(count), "<u4").astype(np.int64))
        shards.append(np.full(len(offsets) - 1, shard, np.int64))
    coded = pa.concat_arrays(lines).dictionary_encode()
    at = np.asarray(coded.indices).astype(np.int64)
    local = np.zeros(len(coded.dictionary) * SHARDS, np.int64)
    np.add.at(local, at * SHARDS + np.concatenate(shards), np.concatenate(counts))
    local = local.reshape(-1, SHARDS)
    candidate = (local >= -(-support // SHARDS)).any(axis=1)
    total = local.sum(axis=1)
    chosen = np.flatnonzero(candidate & (total >= support) | np.asarray(pc.ends_with(coded.dictionary, b"\t"), bool))
    return coded.dictionary.take(pa.array(chosen)).to_pylist(), total[chosen].tolist()


def frequent_phrases(docs: DataFrame, support: int = SUPPORT, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``FREQUENT`` of every phrase of one to ``WORDS`` words with f >= support; a row without phrase counts the language's words."""
    width = shuffle_width(docs.sparkSession)
    blocks = mine_slices(docs, width * BUCKETS, text_col, lang_col)
    dealt = blocks.repartition(width, "bucket").sortWithinPartitions("bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(blocks: list) -> pa.RecordBatch:
            rows = []
            for line, n in zip(*_merged(blocks, support)):
                lang, _, phrase = line.decode("utf-8", "replace").partition("\t")
                rows.append((_restored(lang), phrase or None, phrase.count(" ") + 1 if phrase else 0, n))
            cols = list(zip(*rows)) or [()] * 4
            kinds = (pa.string(), pa.string(), pa.int32(), pa.int64())
            return record({f.split()[0]: pa.array(c, k) for f, c, k in zip(FREQUENT.split(", "), cols, kinds)})

        bucket, held = None, []
        for batch in batches:
            for b, *block in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4, 5))):
                if b != bucket and held:
                    yield close(held)
                    held = []
                bucket = b
                held.append(block)
        if held:
            yield close(held)
        release()

    return dealt.mapInArrow(run, FREQUENT)


WIDE = "decimal(38,0)"


def scored(frequent: DataFrame) -> DataFrame:
    """Candidates of two and more words with ``a, l, r, score`` of their lowest cut."""
    counts = frequent.filter("phrase IS NOT NULL").select("lang", "phrase", "f")
    cands = frequent.filter("words >= 2")
    cuts = F.explode(F.filter(F.sequence(F.lit(1), F.lit(WORDS - 1)), lambda k: k < F.col("words")))
    parted = cands.select("lang", "phrase", "words", F.col("f").alias("a"), cuts.alias("cut"))
    words = F.split("phrase", " ", -1)
    parted = parted.withColumn("left", F.array_join(F.slice(words, F.lit(1), F.col("cut")), " "))
    parted = parted.withColumn("right", F.array_join(F.slice(words, F.col("cut") + 1, F.col("words")), " "))
    for side, name in (("left", "l"), ("right", "r")):
        own = counts.select(F.col("lang").alias("own_lang"), F.col("phrase").alias("own"), F.col("f").alias(name))
        parted = parted.join(own, (F.col("lang") == F.col("own_lang")) & (F.col(side) == F.col("own"))).drop("own", "own_lang", side)
    wide = {c: F.col(c).cast("decimal(16,0)") for c in "alr"}
    score = F.call_function("div", (wide["a"] * wide["a"]).cast(WIDE) * F.lit(1_000_000).cast("decimal(7,0)"),
                            (wide["l"] * wide["r"]).cast(WIDE)).cast("long")
    best = F.min(F.struct("score", "cut", "l", "r")).alias("best")
    return parted.withColumn("score", score).groupBy("lang", "phrase", "words", "a").agg(best).select(
        "lang", "phrase", "words", "a", "best.l", "best.r", "best.score")


def undominated(cands: DataFrame, num: int = 50, den: int = 100) -> DataFrame:
    """Without candidates that stand inside a longer one with ``den * f(longer) >= num * a``."""
    longer = cands.filter("words > 2")
    inner = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.col("words") - n + 1), lambda at: F.array_join(F.slice(F.split("phrase", " ", -1), at, n), " ")))))
    cover = longer.select("lang", inner.alias("phrase"), F.col("a").alias("f")).groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    kept = F.col("most").isNull() | (F.col("most") * den < F.col("a") * num)
    return cands.join(cover, ["lang", "phrase"], "left").filter(kept).drop("most")


def collocations(docs: DataFrame, support: int = SUPPORT, top: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Each language's first ``top`` phrases: ``lang, rank, phrase, a, l, r, n, score``."""
    spark = docs.sparkSession
    folder = f"collocations-{uuid.uuid4().hex}"
    frequent = write_read(spark, frequent_phrases(docs, support, text_col, lang_col), folder, "frequent")
    cands = write_read(spark, scored(frequent), folder, "scored")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    spread = undominated(cands).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(shuffle_width(spark))))
    # first per language and part, so that no task sorts a whole language
    first = spread.withColumn("nth", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("nth") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    totals = frequent.filter("phrase IS NULL").groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle_sql(support: int = SUPPORT, top: int = 2000) -> str:
    """The same result as DuckDB SQL, every phrase counted at once."""
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '{_NO_LANG}') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
phrases AS (
  SELECT lang, 1 AS k, unnest(w) AS phrase FROM words
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM words),
f AS (SELECT lang, k, phrase, count(*) AS f FROM phrases GROUP BY ALL HAVING count(*) >= {support}),
n AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
cuts AS (
  SELECT lang, k, phrase, f AS a, unnest(range(1, k)) AS cut, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
scores AS (
  SELECT c.lang, c.k, c.phrase, c.a, c.cut, c.w, x.f AS l, y.f AS r,
         (1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.cut], ' ')
              JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1:], ' ')),
best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner2 AS (
  SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM best WHERE k = 3
  UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM best WHERE k = 3),
kept AS (
  SELECT b.* FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM inner2 i WHERE i.lang = b.lang AND i.phrase = b.phrase AND 100 * i.a >= 50 * b.a))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept JOIN n USING (lang) QUALIFY rank <= {top}"""
