"""Merging symbols by ranked rules with a pair occurrence index.

The words of a batch lie in one array with a border after each. The index maps
every pair that has a rule to all its positions. Active ranks are taken in
ascending order from a heap; a rule is applied to all its positions at once, from
left to right where occurrences overlap, and the pairs this makes with the
neighbours enter the lists of their own ranks. A rank with few positions takes them
one after another: most ranks of a batch are rare, and an array step costs the same
for two positions as for hundreds.

A rule whose product also takes part in an earlier rule could make a pair that has
to be merged before the rule's next occurrence in the same word. Such rules are
known beforehand; they are applied to the first occurrence in each word and wait
for the earlier ranks before the next.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush

import numpy as np

BORDER, GONE = -1, -2


class PairIndex:
    def __init__(self, rules: dict[tuple[int, int], tuple[int, int]], symbols: int, few: int = 0):
        """``rules``: pair -> (rank, product); ``symbols``: more than any symbol.

        ``few``: most positions of a rank that are taken one after another; needs a table of the rules' size.
        """
        self.width = symbols + 2
        pairs = np.array([(a, b, r, c) for (a, b), (r, c) in rules.items()], np.int64).reshape(-1, 4)
        keys = (pairs[:, 0] + 2) * self.width + pairs[:, 1] + 2
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], pairs[order, 2]
        n = int(pairs[:, 2].max()) + 1 if len(pairs) else 0
        self.rule = np.zeros((n, 3), np.int64)
        self.rule[pairs[:, 2]] = pairs[:, [0, 1, 3]]
        first_use = np.full(self.width, n, np.int64)
        np.minimum.at(first_use, pairs[:, 0], pairs[:, 2])
        np.minimum.at(first_use, pairs[:, 1], pairs[:, 2])
        self.one_by_one = first_use[self.rule[:, 2]] < np.arange(n)
        self.none = n
        self.few = few
        self.rank_of = dict(zip(self.keys.tolist(), self.ranks.tolist())) if few else {}

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``none`` where it has no rule."""
        keys = (left + 2) * self.width + right + 2
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], self.none)

    def merge(self, symbols: np.ndarray) -> np.ndarray:
        """The merged symbols; dead positions hold ``GONE``. ``symbols`` ends with a border and is changed."""
        n = len(symbols)
        after = np.arange(1, n + 1)
        before = np.arange(-1, n - 1)
        lists: dict[int, list[np.ndarray]] = {}
        single: dict[int, list[int]] = {}
        heap: list[int] = []

        def add(places: np.ndarray, ranks: np.ndarray) -> None:
            hit = ranks < self.none
            places, ranks = places[hit], ranks[hit]
            if not len(places):
                return
            if len(places) > 1:
                order = np.argsort(ranks, kind="stable")
                places, ranks = places[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            bounds = [0, *cuts.tolist(), len(ranks)]
            for lo, hi, rank in zip(bounds, bounds[1:], ranks[bounds[:-1]].tolist()):
                own = lists.get(rank)
                if own is None:
                    lists[rank] = [places[lo:hi]]
                    if rank not in single:
                        heappush(heap, rank)
                else:
                    own.append(places[lo:hi])

        def merge_few(rank: int, places: list[int]) -> None:
            left, right, product = self.rule[rank].tolist()
            spots = []
            for at in places:  # ascending: of overlapping occurrences the left one is taken
                if symbols.item(at) != left:
                    continue
                follow = after.item(at)
                if symbols.item(follow) != right:
                    continue
                symbols[at], symbols[follow] = product, GONE
                beyond = after.item(follow)
                after[at], before[beyond] = beyond, at
                spots.append(at)
            for at in spots:
                prior = before.item(at)
                for spot in (prior, at) if prior >= 0 else (at,):
                    key = (symbols.item(spot) + 2) * self.width + symbols.item(after.item(spot)) + 2
                    made = self.rank_of.get(key)
                    if made is None:
                        continue
                    own = single.get(made)
                    if own is None:
                        single[made] = [spot]
                        if made not in lists:
                            heappush(heap, made)
                    else:
                        own.append(spot)

        if len(self.keys) and n > 1:
            add(np.arange(n - 1), self.ranks_of(symbols[:-1], symbols[1:]))
        heapify(heap)
        while heap:
            rank = heappop(heap)
            own, loose = lists.pop(rank, []), single.pop(rank, [])
            if len(loose) + sum(map(len, own)) <= self.few and not self.one_by_one[rank]:
                merge_few(rank, sorted({*loose, *(x for a in own for x in a.tolist())}))
                continue
            if loose:
                own.append(np.array(loose, np.int64))
            places = own[0] if len(own) == 1 and not loose else np.unique(np.concatenate(own))
            left, right, product = self.rule[rank].tolist()
            places = places[symbols[places] == left]
            follow = after[places]
            live = symbols[follow] == right
            places, follow = places[live], follow[live]
            if not len(places):
                continue
            if left == right and len(places) > 1:  # aaa: every other one of a chain
                chained = np.r_[False, follow[:-1] == places[1:]]
                nth = np.arange(len(places))
                start = np.maximum.accumulate(np.where(chained, 0, nth))
                take = (nth - start) % 2 == 0
                places, follow = places[take], follow[take]
            if self.one_by_one[rank] and len(places) > 1:
                if not hasattr(self, "_at") or self._at is not symbols:
                    self._at, self._borders = symbols, np.flatnonzero(symbols == BORDER)
                word = np.searchsorted(self._borders, places)
                first = np.r_[True, word[1:] != word[:-1]]
                if not first.all():
                    lists[rank] = [places[~first]]
                    heappush(heap, rank)
                    places, follow = places[first], follow[first]
            symbols[places] = product
            symbols[follow] = GONE
            beyond = after[follow]
            after[places] = beyond
            before[beyond] = places
            prior = before[places]
            at_left = prior >= 0
            lefts = prior[at_left]
            spots = np.concatenate([lefts, places])
            add(spots, self.ranks_of(symbols[spots], symbols[after[spots]]))
        self._at = None
        return symbols

    def encode(self, symbols: np.ndarray, sizes: np.ndarray, kind: str) -> list[bytes]:
        """Merged symbols of each word, as bytes of dtype ``kind``; ``symbols`` has the words one after another."""
        if not len(sizes):
            return []
        ends = np.cumsum(sizes + 1)
        flat = np.full(int(ends[-1]), BORDER, np.int64)
        inside = np.ones(len(flat), bool)
        inside[ends - 1] = False
        flat[inside] = symbols
        flat = self.merge(flat)
        kept = flat >= 0
        width = np.dtype(kind).itemsize
        cuts = [0, *(np.cumsum(kept)[ends - 1] * width).tolist()]
        out = flat[kept].astype(kind).tobytes()
        return [out[lo:hi] for lo, hi in zip(cuts, cuts[1:])]
