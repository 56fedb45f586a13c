"""Quality rules by tokeniser fertility, on top of base counts.

Base counts (words, symbols, repeated lines and windows) settle ``base_failed``.
The method's own verdict reads the text with a public sentencepiece vocabulary and
measures

* characters per token (how well the vocabulary fits the text),
* byte-fallback share (tokens that spell bytes the vocabulary has no piece for,
  white space aside),
* entropy of the text's tokens in bits.

A text is rejected when one of them leaves the band of its script (the script of
most of its letters), or when what its characters are says that the measures do
not come from language:

* digits are a token each, so characters per token are judged without them, and
  Latin letters outside ASCII, which take tokens of their own, are made up for
  (``ACCENTS``); letters at random, base64 and the like stay below the band;
* symbols in runs are cheap to encode and lift characters per token into the band,
  so their share has a bound of its own (``MOST_SYMBOLS``, ``MOST_MARKS``);
* a text of which few characters are letters (``LEAST_LETTERS``) is not language;
* where most tokens spell bytes, one writing system repeats its leading bytes:
  letters of many systems at random do not (``MOST_BYTE_BITS``).

The Latin bounds lie in the gaps of the given tables (sf0.1): from 64 tokens on,
clean documents have 2.19 characters per token or more by this reckoning, 40 words
of random letters 1.94 or less; symbols are up to 14 % of a clean document (tables)
and from 17 % on in symbol junk. Entropy and the lower end of characters per token need some length to
mean anything: they are judged from ``LEAST_TOKENS`` tokens on, Latin texts loosely
(``SHORT``) from half as many.

Edge cases: null text has no words and fails the base rule; a text without letters
takes the bands of script ``none`` and has no letter share, so it is never kept; texts of any length are read whole, in slices
of documents; repeated or null ids are just rows; an empty table gives an empty
result; only the id and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import pieces
from ledgerlens.llm.common import WHITE, record, slices, small_batches, text_bytes
from ledgerlens.llm.shingles import Words, grams, mixed, words_of

SLICE_BYTES = 1_000_000
LEAST_TOKENS = 64
WINDOW = 5
# The characters counted as symbols.
SYMBOLS = b"#*$%&|<>"
# Most share of these symbols and of all ASCII marks among the characters, least share of letters
# among the characters other than white space, most entropy in bits of texts of script "other" spelt mostly in bytes.
MOST_SYMBOLS, MOST_MARKS, LEAST_LETTERS, MOST_BYTE_BITS = 0.15, 0.30, 0.25, 5.5
# Characters per token made up for a share 1 of characters outside ASCII, and the lower end for short texts (Latin).
ACCENTS, SHORT = 2.5, 1.8
# Script -> least and most characters per token, most byte-fallback share, least token entropy in bits.
BANDS = {
    "Latin": (2.05, 12.0, 0.20, 3.0),
    "Cyrillic": (1.0, 12.0, 0.20, 3.0),
    "Greek": (0.6, 12.0, 0.60, 3.0),
    "Arabic": (0.5, 12.0, 0.60, 3.0),
    "Hebrew": (0.5, 12.0, 0.60, 3.0),
    "Devanagari": (0.4, 12.0, 0.95, 2.5),
    "Han": (0.3, 4.0, 0.90, 2.5),
    "Hiragana": (0.3, 4.0, 0.90, 2.5),
    "Hangul": (0.3, 4.0, 0.90, 2.5),
    "other": (0.25, 12.0, 1.00, 2.0),
    "none": (1.5, 12.0, 0.20, 3.0),
}
_SCRIPTS = {s: regex.compile(rf"\p{{Script={s}}}") for s in BANDS if s not in ("other", "none")}
_LETTER = regex.compile(r"\p{L}")
_LATIN1 = regex.compile("[^\x00-ɏ]")
_IS_SYMBOL = np.zeros(256, np.int64)
_IS_SYMBOL[list(SYMBOLS)] = 1
_ASCII = np.array([chr(b) if b < 128 else "" for b in range(256)])
_IS_LETTER, _IS_DIGIT = np.char.isalpha(_ASCII).astype(np.int64), np.char.isdigit(_ASCII).astype(np.int64)
_IS_MARK = np.array([33 <= b < 127 and not chr(b).isalnum() for b in range(256)], np.int64)
# Bytes that begin a character outside ASCII.
_IS_WIDE = (np.arange(256) >= 0xC0).astype(np.int64)

MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
            "script string, n_tokens long, chars_per_token double, byte_share double, token_entropy double, kept boolean")


def script_of(text: str) -> str:
    """Script of most letters; ties go to the first in ``BANDS``."""
    if not _LATIN1.search(text):  # every letter below U+0250 but a few modifiers is Latin
        return "Latin" if any(map(str.isalpha, text)) else "none"
    letters = len(_LETTER.findall(text))
    if not letters:
        return "none"
    counts = {s: len(p.findall(text)) for s, p in _SCRIPTS.items()}
    best = max(counts, key=counts.get)
    return best if counts[best] * 2 >= letters - sum(counts.values()) + counts[best] else "other"


def _per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    running = np.concatenate([[0], np.cumsum(values)])
    return np.diff(running[bounds])


def repeated_words(words: Words) -> np.ndarray:
    """Words of each text that lie in a ``WINDOW``-word window found twice or more in it."""
    gram, at = grams(words, WINDOW)
    size = np.diff(words.first)
    owner = np.repeat(np.arange(len(size), dtype=np.uint64), np.maximum(size - WINDOW + 1, 0))
    key = gram ^ mixed(owner + np.uint64(1))
    order = np.argsort(key)
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    marks = np.zeros(len(words.start) + WINDOW + 1, np.int64)
    starts = at[twice]
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + WINDOW, -1)
    covered = np.cumsum(marks)[:len(words.start)] > 0
    return _per_text(covered, words.first)


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    return len(lines) - len(set(lines))


def base_counts(texts: list[bytes], words: Words | None = None) -> dict[str, np.ndarray]:
    words = words or words_of(texts)
    points = (words.data & 0xC0) != 0x80
    running = np.concatenate([[0], np.cumsum(points)])
    in_words = running[words.end] - running[words.start]
    return {"n_words": np.diff(words.first), "word_chars": _per_text(in_words, words.first),
            "n_symbols": _per_text(_IS_SYMBOL[words.data], words.text_at), "n_repeat_words": repeated_words(words)}


def _entropy(ids: np.ndarray) -> float:
    if not len(ids):
        return 0.0
    counts = np.unique(ids, return_counts=True)[1]
    share = counts / len(ids)
    return float(-(share * np.log2(share)).sum())


class Fertility:
    """Token measures of texts with one vocabulary."""

    def __init__(self, path: str, cache_entries: int = pieces.CACHE_ENTRIES):
        self.model = pieces.model(path)
        size = self.model.get_piece_size()
        self.kind = "<u2" if size <= 1 << 16 else "<u4"
        white = {f"<0x{b:02X}>" for b in WHITE.encode()}
        self.fallback = np.array([self.model.is_byte(i) and self.model.id_to_piece(i) not in white for i in range(size)])
        self.cache = pieces.worker_cache(("ids", path), lambda: self._encode, cache_entries)

    def _encode(self, keys: list[str]) -> list[bytes]:
        return [np.array(ids, self.kind).tobytes() for ids in self.model.encode(keys, num_threads=1)]

    def measures(self, texts: list[str]) -> list[tuple[int, float, float, float]]:
        """``(tokens, characters per token, byte-fallback share, entropy)`` of each text."""
        keys: list[str] = []
        ends = [0]
        for text in texts:
            keys += pieces.segments(text)
            ends.append(len(keys))
        values = self.cache.values(keys)
        out = []
        for text, lo, hi in zip(texts, ends, ends[1:]):
            ids = np.frombuffer(b"".join(values[lo:hi]), self.kind)
            n = len(ids)
            out.append((n, len(text) / n if n else 0.0, float(self.fallback[ids].mean()) if n else 0.0, _entropy(ids)))
        return out


def make_up(words: Words) -> dict[str, np.ndarray]:
    """Characters of each text by kind: ASCII letters, digits and marks, and those outside ASCII (``wide``)."""
    tables = {"letters": _IS_LETTER, "digits": _IS_DIGIT, "marks": _IS_MARK, "wide": _IS_WIDE}
    return {n: _per_text(t[words.data], words.text_at) for n, t in tables.items()}


def in_band(script: str, tokens: int, chars: float, fallback: float, entropy: float) -> bool:
    least, most, share, bits = BANDS[script]
    if tokens == 0:
        return False
    if chars > most or fallback > share or (script == "other" and fallback > 0.5 and entropy > MOST_BYTE_BITS):
        return False
    if script == "Latin":  # its lower end is judged by ``reads_as_letters``
        least = 0.0
    return tokens < LEAST_TOKENS or (chars >= least and entropy >= bits)


def reads_as_letters(text: str, script: str, tokens: int, word_chars: int, symbols: int, letters: int, digits: int,
                     marks: int, wide: int) -> bool:
    """Whether the text is made of letters, and of such that the vocabulary knows in a row."""
    size = len(text)
    if script == "none" or symbols > MOST_SYMBOLS * size or marks > MOST_MARKS * size:
        return False
    if letters < LEAST_LETTERS * word_chars:
        if len(_LETTER.findall(text)) < LEAST_LETTERS * word_chars:  # those outside ASCII count too
            return False
    if script != "Latin":
        return True
    rest = tokens - digits
    least = BANDS[script][0] if rest >= LEAST_TOKENS else SHORT if rest >= LEAST_TOKENS // 2 else 0.0
    return (size - digits) / max(rest, 1) + ACCENTS * wide / size >= least


def judge(texts: list[bytes], fertility: Fertility) -> dict[str, list | np.ndarray]:
    """All columns of ``MEASURES`` for a slice of texts."""
    words = words_of(texts)
    out: dict[str, list | np.ndarray] = dict(base_counts(texts, words))
    strings = [t.decode("utf-8", "replace") for t in texts]
    out["n_dup_lines"] = [repeated_lines(t) for t in strings]
    out["base_failed"] = (out["n_words"] < 10) | (100 * out["n_repeat_words"] > 20 * out["n_words"])
    out["script"] = [script_of(t) for t in strings]
    tokens, chars, share, bits = map(list, zip(*fertility.measures(strings)))
    out["n_tokens"], out["chars_per_token"], out["byte_share"], out["token_entropy"] = tokens, chars, share, bits
    kinds = [x.tolist() for x in (out["word_chars"], out["n_symbols"], *make_up(words).values())]
    out["kept"] = [not failed and in_band(s, n, c, b, e) and reads_as_letters(t, s, n, *own) for failed, t, s, n, c, b, e, *own in
                   zip(out["base_failed"].tolist(), strings, out["script"], tokens, chars, share, bits, *kinds)]
    return out


_ARROW = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "double": pa.float64()}


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """``id`` and ``MEASURES`` per row. A narrow step."""
    small_batches(docs)
    path = path or pieces.model_path()
    fields = [f.split() for f in MEASURES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fertility = Fertility(path)
        for batch in batches:
            texts = text_bytes(batch.column(1))
            for a, b in slices(map(len, texts), SLICE_BYTES):
                cols = judge(texts[a:b], fertility)
                yield record({"id": batch.column(0).slice(a, b - a)} | {n: pa.array(cols[n], _ARROW[k]) for n, k in fields})

    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {id_type}, {MEASURES}")


def keep_good(docs: DataFrame, text_col: str = "text", path: str | None = None,
              cache_entries: int = pieces.CACHE_ENTRIES) -> DataFrame:
    """The rows whose text is kept, all columns unchanged. A narrow step; a worker holds ``cache_entries`` segments."""
    small_batches(docs)
    path = path or pieces.model_path()
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fertility = Fertility(path, cache_entries)
        for batch in batches:
            texts = text_bytes(batch.column(place))
            kept = [k for a, b in slices(map(len, texts), SLICE_BYTES) for k in judge(texts[a:b], fertility)["kept"]]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
