"""Token counts by a two-tier lookup of pre-token lengths, without shuffling pre-tokens.

1. Every task counts its own pre-tokens in a bounded table and hands on its
   ``LOCAL_TOP`` most frequent ones; the sums of these give the ``TABLE`` most
   frequent of the corpus. All documents are read, but the
   table is approximate: a word in no task's top is missing. What moves is bounded per task.
2. Their lengths are broadcast as one compact table (words joined in one string,
   one byte each for the lengths): tier one.
3. A second narrow pass looks every pre-token up; misses go to the worker's own
   cache and, once per batch and word, to the library: tier two.

Counts never depend on the table: it only decides where a length is found. The
library is run without begin, end or added tokens; texts are cut only where its
encoding is independent (see ``pieces``), so counts are the library's own.

Edge cases: null text is empty: 0 bytes, 0 tokens; a text of any length is counted
whole, in slices of documents; repeated or null ids are just rows; an empty table
gives an empty table and result; only the id and the text are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import pieces
from ledgerlens.llm.common import record, slices, small_batches

LOCAL_TOP, TABLE = 8192, 65536
LOCAL_ENTRIES = 400_000
SLICE_CHARS = 2_000_000


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's most frequent pre-tokens. A full table forgets its rarer half, so memory is bounded."""
    seen: Counter = Counter()
    for batch in batches:
        for text in pieces.texts_of(batch.column(0)):
            seen.update(pieces.segments(text))
            if len(seen) > LOCAL_ENTRIES:
                seen = Counter(dict(seen.most_common(LOCAL_ENTRIES // 2)))
    top = [(w, n) for w, n in seen.most_common(LOCAL_TOP) if w and " " not in w and len(w) <= pieces.LONG_KEY]
    yield record({"word": pa.array([w for w, _ in top], pa.string()), "n": pa.array([n for _, n in top], pa.int64())})


def frequent_pretokens(docs: DataFrame, text_col: str = "text", most: int = TABLE) -> DataFrame:
    """``word, n``: frequent pre-tokens of the corpus, by the sums of the tasks' own tops.

    Approximate: a task that keeps ``LOCAL_ENTRIES`` words forgets its rarer half and hands on ``LOCAL_TOP``, so
    ``n`` can be too small and a word in no task's top is left out. Token counts do not depend on it.
    """
    small_batches(docs)
    local = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(_frequent, "word string, n long")
    return local.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(most)


def length_table(words: list[str], path: str) -> tuple[str, bytes]:
    """The compact broadcast form: words in one string, a byte for each length (longer than 255: left out)."""
    ids = pieces.model(path).encode(words, num_threads=1) if words else []
    short = [(w, len(i)) for w, i in zip(words, ids) if len(i) < 256]
    return " ".join(w for w, _ in short), bytes(n for _, n in short)


_tables: dict[int, dict[str, int]] = {}


def _unpacked(number: int, packed: tuple[str, bytes]) -> dict[str, int]:
    """The table as this process' dictionary; unpacked once per broadcast."""
    if number not in _tables:
        _tables.clear()
        _tables[number] = dict(zip(packed[0].split(" "), packed[1])) if packed[1] else {}
    return _tables[number]


def _counts(texts: list[str], table: dict[str, int], cache: pieces.Cache) -> np.ndarray:
    keys: list[str] = []
    ends = []
    for text in texts:
        keys += pieces.segments(text)
        ends.append(len(keys))
    found = list(map(table.get, keys))
    places = [i for i, v in enumerate(found) if v is None]
    if places:
        rest = itemgetter(*places)(keys) if len(places) > 1 else (keys[places[0]],)
        for i, v in zip(places, cache.values(list(rest))):
            found[i] = v
    running = np.concatenate([[0], np.cumsum(np.array(found, np.int64))])
    ends = np.array(ends, np.int64)
    return running[ends] - running[np.concatenate([[0], ends[:-1]])]


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096,
                 path: str | None = None) -> DataFrame:
    """``id, n_bytes, n_tokens, over_limit`` per row."""
    spark = docs.sparkSession
    path = path or pieces.model_path()
    words = [r["word"] for r in frequent_pretokens(docs, text_col).collect()]  # at most TABLE short words
    shared = spark.sparkContext.broadcast(length_table(words, path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = pieces.model(path)
        cache = pieces.worker_cache(("lengths", path), lambda: lambda keys: list(map(len, m.encode(keys, num_threads=1))))
        table = _unpacked(shared.id if hasattr(shared, "id") else id(shared), shared.value)
        for batch in batches:
            texts = pieces.texts_of(batch.column(1))
            n = [_counts(texts[a:b], table, cache) for a, b in slices(map(len, texts), SLICE_CHARS)]
            yield record({"id": batch.column(0), "n_bytes": batch.column(2),
                          "n_tokens": pa.array(np.concatenate(n) if n else np.zeros(0, np.int64), pa.int64())})

    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    return rows.mapInArrow(count, f"id {id_type}, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit)
