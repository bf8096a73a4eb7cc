"""Byte-pair merges replayed over many words at once.

The words of a block form one array of symbols. An inverted index leads from every mergeable pair to the
positions where it occurs; merges are applied in rank order, each to all its positions, and only the
pairs with the two neighbours of a merged place enter the index anew.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush

import numpy as np

SHIFT = 20


def rank_pairs(ranks: dict[bytes, int]) -> dict[int, int]:
    """Every pair of tokens whose bytes together are a token, with its rank: (left << 20 | right) -> rank."""
    pairs = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left = ranks.get(token[:cut])
            if left is not None and (right := ranks.get(token[cut:])) is not None:
                pairs[left << SHIFT | right] = rank
    return pairs


class Replay:
    """pairs: rank of every mergeable pair; made: the symbol that the merge of a rank leaves."""

    def __init__(self, pairs: dict[int, int], made: dict[int, int] | None = None):
        self.pairs, self.made = pairs, made
        keys = np.fromiter(pairs, np.int64, len(pairs))
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], np.fromiter(pairs.values(), np.int64, len(pairs))[order]

    def run(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols left of every word, one word after the other, and how many each has.

        symbols: those of all words, one after the other; sizes: how many each word has.
        """
        n = len(symbols)
        if not n:
            return np.empty(0, np.int64), np.zeros(len(sizes), np.int64)
        full = sizes[sizes > 0]
        last = np.cumsum(full) - 1
        where, heap = self._index(symbols, last)
        follow, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        follow[last] = n
        before[0] = n
        before[last[:-1] + 1] = n
        sym, follow, before = [*symbols.tolist(), -1], [*follow.tolist(), n], [*before.tolist(), n]
        rank_of, made, odd = self.pairs.get, self.made, []
        while heap:
            rank = heappop(heap)
            new = rank if made is None else made[rank]
            for p in sorted(where.pop(rank)):
                q = follow[p]
                if sym[p] < 0 or rank_of(sym[p] << SHIFT | sym[q]) != rank:
                    continue  # one of the two has been merged with another neighbour
                z, o = follow[q], before[p]
                sym[p], sym[q], follow[p], before[z] = new, -1, z, p
                for at, pair in ((p, new << SHIFT | sym[z]), (o, sym[o] << SHIFT | new)):
                    if (x := rank_of(pair)) is not None:
                        if x < rank:
                            odd.append(p)
                        if x in where:
                            where[x].append(at)
                        else:
                            where[x] = [at]
                            heappush(heap, x)
        left = np.array(sym[:n])
        counts = np.zeros(len(sizes), np.int64)
        counts[sizes > 0] = np.add.reduceat(left >= 0, np.concatenate([[0], last[:-1] + 1]))
        left = left[left >= 0]
        return self._mend(symbols, sizes, left, counts, odd) if odd else (left, counts)

    def _index(self, symbols: np.ndarray, last: np.ndarray) -> tuple[dict[int, list[int]], list[int]]:
        pair = symbols[:-1].astype(np.int64) << SHIFT | symbols[1:]
        place = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        found = self.keys[place] == pair if len(self.keys) else np.zeros(len(pair), bool)
        found[last[:-1]] = False
        at = np.flatnonzero(found)
        ranks = self.ranks[place[at]] if len(at) else np.empty(0, np.int64)
        order = np.argsort(ranks, kind="stable")
        distinct, starts = np.unique(ranks[order], return_index=True)
        heap = distinct.tolist()
        where = dict(zip(heap, map(np.ndarray.tolist, np.split(at[order], starts[1:])))) if heap else {}
        heapify(heap)
        return where, heap

    def _mend(self, symbols, sizes, left, counts, odd):
        """Words in which a merge made a pair of a lower rank: that pair goes before later places of the merge."""
        ends = np.cumsum(sizes)
        words = set(np.searchsorted(ends, odd, side="right").tolist())
        parts = np.split(left, np.cumsum(counts)[:-1])
        for w in words:
            parts[w] = np.array(self._one(symbols[ends[w] - sizes[w] : ends[w]].tolist()))
        return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))

    def _one(self, sym: list[int]) -> list[int]:
        while True:
            options = [(r, i) for i in range(len(sym) - 1) if (r := self.pairs.get(sym[i] << SHIFT | sym[i + 1])) is not None]
            if not options:
                return sym
            rank, i = min(options)
            sym[i : i + 2] = [rank if self.made is None else self.made[rank]]
