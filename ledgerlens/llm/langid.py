"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts, per language, the n-grams (orders ``ORDERS``, lower-cased code
points, hashed to ``BUCKETS``) of every labelled text. A task hands on one count
vector per language, cut in ``CHUNKS`` small pieces; these are summed as they stream
through the reducers. The driver takes ``languages x BUCKETS`` counts, whatever the
input, and broadcasts the matrix of log probabilities (add-one smoothing) and priors.

Scoring is a narrow pass: a text's n-grams pick columns of the matrix, their sums
per text plus the prior give each language's log likelihood; the best wins (ties:
first by name) and its posterior is the score.

The posterior only compares the learnt languages, so for a text in none of them it
is near 1 as well. ``keep_known`` therefore also asks how well the best language
explains the text: the mean log probability of its n-grams (those with a digit
aside, as numbers and keys belong to no language) must not lie further below the
language's own mean than ``MOST_DEPTH`` of the way down to that of n-grams never
seen. Of sf0.1's documents that pass the base quality rule all stay within 0.30 of
the way; sentences in ten other languages go down 0.45 or more, random letters 0.7.
A language learnt from fewer than ``LEAST_TEXTS`` texts has no mean to rely on: there
the share of n-grams it never saw must not exceed ``MOST_UNSEEN``. ``identify`` is not
changed by this.

Edge cases: null text or a text without a letter is ``und`` with score 0; so is
every text if nothing is labelled; rows with a null language are not learnt from;
texts of any length are scored whole, in slices of documents; repeated or null ids
are just rows; an empty table gives an empty result. The language column is only
read for training.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import record, slices, small_batches
from ledgerlens.llm.pieces import forget, texts_of

BUCKETS, ORDERS = 1 << 16, (2, 3)
# A reducer gets as many pieces of each vector as there are tasks, batch by batch: pieces are small (4 KB).
CHUNKS, REDUCERS = 128, 16
SLICE_CHARS = 1_000_000
MOST_DEPTH, LEAST_TEXTS, MOST_UNSEEN = 0.4, 20, 0.4
UNKNOWN = "und"
# Odd multipliers of a hash over up to three code points, one set per order.
FACTORS = {1: (0x27D4EB2F,), 2: (0x9E3779B1, 0x85EBCA77), 3: (0xC2B2AE3D, 0x165667B1, 0x2545F491)}
_LETTER = regex.compile(r"\p{L}")
_ASCII_LETTER = regex.compile("[A-Za-z]")


def features(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """Buckets of the n-grams of each order, and where each text's begin (with the end).

    Two line feeds follow each text, so it has one n-gram of each order per
    character whatever stands next to it.
    """
    low = [t.lower() for t in texts]
    points = np.frombuffer("".join(f"{t}\n\n" for t in low).encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.concatenate([[0], np.cumsum(np.fromiter(map(len, low), np.int64, len(low)) + 2)])
    padded = np.concatenate([points, np.full(max(ORDERS), 10, np.uint32)])
    out = []
    for order in ORDERS:
        h = np.full(len(points), order, np.uint32)
        for i, f in enumerate(FACTORS[order]):
            h += padded[i:i + len(points)] * np.uint32(f)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h ^= h >> np.uint32(13)
        out.append((h & np.uint32(BUCKETS - 1)).astype(np.int32))
    return out, at


def _digits(texts: list[str]) -> np.ndarray:
    """Marks of the digits 0-9 among the characters that ``features`` reads."""
    points = np.frombuffer("".join(f"{t.lower()}\n\n" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return (points >= 48) & (points <= 57)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's counts: per language its texts and the n-grams per bucket, in chunks."""
    forget()
    sums: dict[str, np.ndarray] = {}
    texts_seen: dict[str, int] = {}
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), texts_of(batch.column(1))
        for lang in sorted(set(langs)):
            own = [t for t, x in zip(texts, langs) if x == lang]
            total = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
            texts_seen[lang] = texts_seen.get(lang, 0) + len(own)
            for a, b in slices(map(len, own), SLICE_CHARS):
                buckets, at = features(own[a:b])
                skip = np.zeros(len(buckets[0]) + 1, bool)
                skip[at[1:] - 1] = skip[at[1:] - 2] = True  # n-grams of the line feeds between texts
                for x in buckets:
                    total += np.bincount(x[~skip[:-1]], minlength=BUCKETS)
    step = BUCKETS // CHUNKS
    for lang, total in sums.items():
        yield record({"lang": pa.array([lang] * CHUNKS), "chunk": pa.array(range(CHUNKS), pa.int32()),
                      "texts": pa.array([texts_seen[lang]] * CHUNKS, pa.int64()),
                      "counts": pa.array([total[i * step:(i + 1) * step].tobytes() for i in range(CHUNKS)], pa.binary())})


PARTIAL = "lang string, chunk int, texts long, counts binary"


def _sum(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[tuple, list] = {}
    for frame in frames:
        for lang, chunk, texts, counts in frame.itertuples(index=False):
            own = sums.setdefault((lang, chunk), [0, 0])
            own[0] += texts
            own[1] = own[1] + np.frombuffer(counts, np.int64)
    if sums:
        yield pd.DataFrame([(lang, chunk, n, c.tobytes()) for (lang, chunk), (n, c) in sums.items()],
                           columns=["lang", "chunk", "texts", "counts"])


class Model:
    """Languages, priors and the log-probability matrix (one row per language)."""

    def __init__(self, langs: list[str], texts: np.ndarray, counts: np.ndarray):
        self.langs = langs
        self.prior = np.log((texts + 1) / (texts.sum() + len(langs))) if langs else np.zeros(0)
        smooth = counts + 1.0
        self.log = np.log(smooth / smooth.sum(axis=1, keepdims=True)) if langs else np.zeros((0, BUCKETS))
        mean = (np.exp(self.log) * self.log).sum(axis=1)  # of an n-gram drawn from the language
        few = texts < LEAST_TEXTS
        self.least = np.where(few, -MOST_UNSEEN, mean + MOST_DEPTH * (-np.log(smooth.sum(axis=1)) - mean))
        self.fit = np.where(few[:, None], np.where(counts == 0, -1.0, 0.0), self.log) if few.any() else self.log

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        return self._predict(texts, features(texts))

    def _predict(self, texts: list[str], grams: tuple[list[np.ndarray], np.ndarray]) -> tuple[list[str], list[float]]:
        if not self.langs:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        buckets, at = grams
        likely = np.repeat(self.prior[:, None], len(texts), axis=1)
        for row, table in enumerate(self.log):
            for x in buckets:
                running = np.concatenate([[0.0], np.cumsum(table[x])])
                likely[row] += running[at[1:] - 2] - running[at[:-1]]
        best = likely.argmax(axis=0)
        score = 1.0 / np.exp(likely - likely.max(axis=0)).sum(axis=0)
        names, scores = [], []
        for text, b, s in zip(texts, best.tolist(), score.tolist()):
            known = bool(_ASCII_LETTER.search(text) or _LETTER.search(text))
            names.append(self.langs[b] if known else UNKNOWN)
            scores.append(s if known else 0.0)
        return names, scores

    def tell(self, texts: list[str], least_score: float) -> list[bool]:
        """Whether each text's language is told: by its posterior, and by how well that language explains the text."""
        grams = buckets, at = features(texts)
        names, scores = self._predict(texts, grams)
        told = np.array([n != UNKNOWN and s >= least_score for n, s in zip(names, scores)], bool)
        if not told.any():
            return told.tolist()
        best = np.array([self.langs.index(n) if n != UNKNOWN else 0 for n in names])
        row = np.repeat(best, np.diff(at))
        digit = np.concatenate([_digits(texts), np.zeros(max(ORDERS), bool)])
        total, number = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        for order, x in zip(ORDERS, buckets):
            plain = ~np.logical_or.reduce([digit[i:i + len(x)] for i in range(order)])
            for out, values in ((total, np.where(plain, self.fit[row, x], 0.0)), (number, plain.astype(np.int64))):
                running = np.concatenate([[0], np.cumsum(values)])
                out += running[at[1:] - 2] - running[at[:-1]]
        mean = np.where(number > 0, total / np.maximum(number, 1), -np.inf)
        return (told & (mean >= self.least[best])).tolist()


def train(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Model:
    """The model of all rows with a language and a text."""
    small_batches(labelled)
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    parts = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).mapInArrow(_count, PARTIAL)
    sums = parts.repartition(REDUCERS, "lang", "chunk").mapInPandas(_sum, PARTIAL).collect()
    langs = sorted({r["lang"] for r in sums})
    counts, texts = np.zeros((len(langs), BUCKETS)), np.zeros(len(langs))
    step = BUCKETS // CHUNKS
    for r in sums:
        i = langs.index(r["lang"])
        counts[i, r["chunk"] * step:(r["chunk"] + 1) * step] = np.frombuffer(r["counts"], np.int64)
        texts[i] = r["texts"]
    return Model(langs, texts, counts)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, lang_pred, score`` per row. A narrow step."""
    small_batches(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        m = shared.value
        for batch in batches:
            texts = texts_of(batch.column(1))
            names, scores = [], []
            for a, b in slices(map(len, texts), SLICE_CHARS):
                n, s = m.predict(texts[a:b])
                names += n
                scores += s
            yield record({"id": batch.column(0), "lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64())})

    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {id_type}, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Model, least_score: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows whose language is told with at least ``least_score`` and explains the text, all columns unchanged.

    A narrow step.
    """
    small_batches(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        m = shared.value
        for batch in batches:
            texts = texts_of(batch.column(place))
            kept = []
            for a, b in slices(map(len, texts), SLICE_CHARS):
                kept += m.tell(texts[a:b], least_score)
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
