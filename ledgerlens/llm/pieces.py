"""Segments of a text that a sentencepiece BPE model encodes independently, and a worker's cache of them.

The model turns spaces into ``▁`` and puts one in front. None of its pieces has a
``▁`` after another character (checked when the model is loaded), so no merge
crosses the border between a character and the space run that follows it: a space
run with the characters after it can be encoded on its own. A segment's key leaves
out its first space, which the library adds again.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Callable, Iterable
from itertools import islice

import public_tokenizers
import sentencepiece

from ledgerlens.llm.common import release

MODEL = "piece_bpe_32k.model"
CACHE_ENTRIES = 400_000
LONG_KEY = 64
_RUNS = re.compile(r" +[^ ]*(?: +\Z)?")
_models: dict[str, sentencepiece.SentencePieceProcessor] = {}


def model(path: str) -> sentencepiece.SentencePieceProcessor:
    """The model at ``path``, loaded once per process."""
    if path not in _models:
        m = sentencepiece.SentencePieceProcessor(model_file=path)
        inner = [p for p in (m.id_to_piece(i) for i in range(m.get_piece_size())) if "▁" in p.lstrip("▁")]
        if inner:
            raise ValueError(f"pieces that cross a space, such as {inner[0]!r}: texts can't be cut at spaces")
        _models[path] = m
    return _models[path]


def model_path() -> str:
    return public_tokenizers.path(MODEL)


def segments(text: str) -> list[str]:
    """Keys of the text's segments; ``segments("")`` is empty."""
    if not text:
        return []
    if "▁" in text:  # the model reads both as one character
        text = text.replace("▁", " ")
    if "  " in text or text[0] == " " or text[-1] == " ":
        return [run[1:] for run in _RUNS.findall(" " + text)]
    return text.split(" ")


class Cache:
    """Values of keys; misses are computed together, long keys are not kept.

    Two generations of at most half of ``entries`` keys each: a full young one
    becomes the old one, and keys of the old one that are asked for again move up.
    So memory is bounded and frequent keys stay.
    """

    def __init__(self, compute: Callable[[list], list], entries: int = CACHE_ENTRIES):
        self.compute, self.half, self.young, self.old = compute, max(1, entries // 2), {}, {}

    def get(self, key):
        """The kept value of a key, or None."""
        value = self.young.get(key)
        return self.old.get(key) if value is None else value

    def values(self, keys: list) -> list:
        found = list(map(self.young.get, keys))
        if None not in found:
            return found
        fresh = dict.fromkeys([k for k, v in zip(keys, found) if v is None])
        if self.old:
            fresh.update({k: self.old.get(k) for k in fresh})
        missing = [k for k, v in fresh.items() if v is None]
        if missing:
            fresh.update(zip(missing, self.compute(missing)))
        found = [fresh[k] if v is None else v for k, v in zip(keys, found)]
        if len(self.young) + len(fresh) > self.half:
            self.old, self.young = self.young, {}
        if len(fresh) > self.half or max(map(len, fresh)) > LONG_KEY:
            fresh = dict(islice(((k, v) for k, v in fresh.items() if len(k) <= LONG_KEY), self.half))
        self.young.update(fresh)
        return found


_caches: dict[tuple, Cache] = {}


def worker_cache(name: tuple, make: Callable[[], Callable[[list], list]], entries: int = CACHE_ENTRIES) -> Cache:
    """The process's cache of that name: it lives on while the worker runs task after task.

    A worker that turns to another operator drops the former one's cache before
    ``make`` loads what the new one computes with.
    """
    if name not in _caches:
        forget()
        cache = Cache(lambda keys: [], entries)
        cache.compute = make()
        _caches[name] = cache
    return _caches[name]


def forget() -> None:
    """Drop the worker's cache, for operators that have none."""
    if _caches:
        _caches.clear()
        gc.collect()
        release()


def texts_of(column) -> Iterable[str]:
    return [t or "" for t in column.to_pylist()]
