"""Byte-level BPE encoding with a pair occurrence index, and decoding.

The distinct pre-tokens of a slice of documents that the worker has not met yet are
encoded together: the index maps every pair to all its positions, active ranks are
applied in ascending order and the affected lists updated (``pairindex``). A slice is
as many documents as a worker can hold: the ranks are gone through once per slice.

Pre-tokens are found with the public pattern; a token never crosses from a visible
character into the white space after it, so results are kept per white-space chunk
in a bounded worker cache. The special string in a text is its special token, as
the library does by default.

Edge cases: null text is empty: no tokens, decoded as the empty text; a text of any
length is encoded whole; repeated or null ids are just rows; an empty table gives
an empty result; only the id and the text are read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import record, slices, small_batches
from ledgerlens.llm.pairindex import PairIndex
from ledgerlens.llm.pieces import texts_of, worker_cache

FILE = "byte_bpe_50k.json"
SLICE_CHARS = 6_000_000
CACHE_ENTRIES = 1_000_000
FEW = 24
_CHUNK = re.compile(r"\s*\S+|\s+", re.ASCII)
_STOPS = frozenset(".,;:!?")
# White space outside ASCII: texts that have it are not cut into chunks.
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in of every byte: itself where Latin-1 shows it, else the next free code point from 256."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Token bytes, single-byte ids, special strings and merge rules of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        ids = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes: dict[int, bytes] = {i: bytes(alphabet[c] for c in token) for token, i in ids.items()}
        self.bytes |= {i: s.encode() for s, i in self.special.items()}
        self.of_byte = np.array([ids[c] for c, _ in sorted(alphabet.items(), key=lambda x: x[1])], np.int64)
        rules: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            rules.setdefault((ids[a], ids[b]), (rank, ids[a + b]))
        self.index = PairIndex(rules, max(ids.values()) + 1, FEW)
        table = [self.bytes.get(i) for i in range(max(self.bytes) + 1)]
        self.table = np.empty(len(table), object)
        self.table[:] = table
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each pre-token as little-endian unsigned 32-bit integers, all encoded together."""
        symbols = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        return self.index.encode(symbols, np.fromiter(map(len, words), np.int64, len(words)), "<u4")

    def pretokens(self, chunk: str) -> tuple[str, ...]:
        """The pattern's pre-tokens of a chunk. A space and ASCII letters, maybe with a stop, need no pattern."""
        if chunk[:1] == " " and chunk.isascii():
            if chunk[1:].isalpha():
                return (chunk,)
            if chunk[-1] in _STOPS and chunk[1:-1].isalpha():
                return chunk[:-1], chunk[-1]
        return tuple(self.pattern.findall(chunk))

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk as little-endian unsigned 32-bit integers."""
        tokens = list(map(self.pretokens, chunks))
        words = list(dict.fromkeys(chain.from_iterable(tokens)))
        of = dict(zip(words, self.encode_words([w.encode() for w in words])))
        return [of[own[0]] if len(own) == 1 else b"".join([of[t] for t in own]) for own in tokens]

    def chunks(self, text: str) -> list[str]:
        if not text:
            return []
        if _ODD_SPACE.search(text):
            return [text]
        return _CHUNK.findall(text)

    def encode(self, texts: list[str], cache) -> list[bytes]:
        """Ids of whole texts, special strings as special tokens."""
        keys: list[str] = []
        plans = []
        for text in texts:
            plan = []
            parts = self.split_special.split(text) if self.split_special and any(s in text for s in self.special) else [text]
            for part in parts:
                if part in self.special:
                    plan.append(self.special[part])
                else:
                    own = self.chunks(part)
                    plan.append((len(keys), len(keys) + len(own)))
                    keys += own
            plans.append(plan)
        values = cache.values(keys)
        return [b"".join(b"".join(values[p[0]:p[1]]) if isinstance(p, tuple) else int(p).to_bytes(4, "little") for p in plan)
                for plan in plans]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(self.table[ids].tolist()).decode("utf-8", "replace")


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary at ``path``, loaded once per process."""
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
           decoded: bool = False) -> DataFrame:
    """``id, ids``: the token ids of every text, little-endian unsigned 32-bit. A narrow step.

    With ``decoded`` also ``text``, what the ids decode to: the round trip in one
    worker, where ``decode`` after ``encode`` would hold two per task.
    """
    small_batches(docs)
    path = path or public_tokenizers.path(FILE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_cache(("bpe", path), lambda: vocabulary(path).encode_chunks, CACHE_ENTRIES)
        v = vocabulary(path)
        for batch in batches:
            texts = texts_of(batch.column(1))
            for a, b in slices(map(len, texts), SLICE_CHARS):
                ids = v.encode(texts[a:b], cache)
                out = {"id": batch.column(0).slice(a, b - a), "ids": pa.array(ids, pa.binary())}
                if decoded:
                    out["text"] = pa.array([v.decode(np.frombuffer(x, "<u4")) for x in ids], pa.string())
                yield record(out)

    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {id_type}, ids binary" + (", text string" if decoded else ""))


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``id, ids, text`` of ``id, ids``: special tokens are written out."""
    small_batches(encoded)
    path = path or public_tokenizers.path(FILE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            texts = [v.decode(np.frombuffer(b, "<u4")) for b in batch.column(1).to_pylist()]
            yield record({"id": batch.column(0), "ids": batch.column(1), "text": pa.array(texts, pa.string())})

    id_type = encoded.schema["id"].dataType.simpleString()
    return encoded.select("id", "ids").mapInArrow(run, f"id {id_type}, ids binary, text string")
