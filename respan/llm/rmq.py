"""Best-first search of one shard of documents, bounded by range-maximum queries.

A shard's posting lists lie one after another, each in order of documents, with the impact of every posting.  A sparse
table over them names the place of the greatest impact among any 2^k neighbours, so the greatest impact that a list has inside an
interval of documents takes two look-ups.  A query starts with the interval of all documents.  The sum of its
lists' maxima bounds every document of an interval; the most promising intervals are split at the document of their
greatest impact, which is scored exactly, and both sides are bounded anew.  Intervals whose bound cannot
enter the best k any more are dropped.
"""

from __future__ import annotations

import numpy as np

WAVE = 64  # intervals split at once; more where many are open


class Shard:
    """Posting lists: ``first[t]`` to ``first[t + 1]`` are list t's postings, of ascending ``doc`` and positive ``impact``."""

    def __init__(self, first: np.ndarray, doc: np.ndarray, impact: np.ndarray, n_docs: int):
        self.first, self.doc, self.impact, self.n_docs = first, doc.astype(np.int64), impact, n_docs
        lists = np.repeat(np.arange(len(first) - 1), np.diff(first))
        self.place = lists * n_docs + self.doc  # ascending over all lists
        longest = int(np.diff(first).max(initial=1))
        best = np.arange(len(doc), dtype=np.int32)
        self.table = [best]
        for k in range(longest.bit_length() - 1):
            half = 1 << k
            low, high = best[:-half], best[half:]
            best = np.where(impact[high] > impact[low], high, low)
            self.table.append(best)
        self.levels = np.concatenate([[0], np.cumsum([len(t) for t in self.table])])[:-1]
        self.flat = np.concatenate(self.table)
        self.log = np.zeros(longest + 2, np.int64)
        for i in range(2, longest + 2):
            self.log[i] = self.log[i >> 1] + 1

    def top_places(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greatest impact among postings a to b (0 where empty), and where it is."""
        n = b - a
        some = n > 0
        level = self.log[n]
        at = self.levels[level]
        x = self.flat[np.where(some, at + a, 0)]
        y = self.flat[np.where(some, at + b - (1 << level), 0)]
        left, right = self.impact[x], self.impact[y]
        return np.where(some, np.maximum(left, right), 0), np.where(right > left, y, x)

    def search(self, lists: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(score, document) of the ``k`` best documents of positive score, higher scores first, then lower documents."""
        if not len(lists) or not len(self.doc):
            return []
        lists = np.asarray(lists)
        base = lists * self.n_docs
        a, b = self.first[lists][None, :].astype(np.int64), self.first[lists + 1][None, :].astype(np.int64)
        low = np.zeros(1, np.int64)
        bound, split = self._bounds(a, b)
        best: list[tuple[int, int]] = []
        least, last = 1, self.n_docs  # what a document needs: a higher score, or this one and a lower place
        while len(bound):
            live = (bound > least) | ((bound == least) & (low < last))
            a, b, low, bound, split = a[live], b[live], low[live], bound[live], split[live]
            if not len(bound):
                break
            wave = min(max(WAVE, len(bound) // 8), len(bound))
            taken = np.argpartition(-bound, wave - 1)[:wave]
            left = np.ones(len(bound), bool)
            left[taken] = False
            ta, tb, tl, p = a[taken], b[taken], low[taken], split[taken]
            middle = np.searchsorted(self.place, base[None, :] + p[:, None])
            hit = (middle < tb) & (self.doc[np.minimum(middle, len(self.doc) - 1)] == p[:, None])
            score = np.where(hit, self.impact[np.minimum(middle, len(self.doc) - 1)], 0).sum(1)
            best += [(int(s), int(d)) for s, d in zip(score, p) if s > least or (s == least and d < last)]
            if len(best) >= k:
                best = sorted(best, key=lambda x: (-x[0], x[1]))[:k]
                if len(best) == k:
                    least, last = best[-1]
            na, nb = np.concatenate([ta, middle + hit]), np.concatenate([middle, tb])
            nl = np.concatenate([tl, p + 1])
            nbound, nsplit = self._bounds(na, nb)
            a, b = np.concatenate([a[left], na]), np.concatenate([b[left], nb])
            low, bound, split = np.concatenate([low[left], nl]), np.concatenate([bound[left], nbound]), np.concatenate([split[left], nsplit])
        return sorted(best, key=lambda x: (-x[0], x[1]))[:k]

    def _bounds(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum of the lists' greatest impacts in each interval, and the document that has the greatest of them."""
        top, at = self.top_places(a, b)
        return top.sum(1), self.doc[np.take_along_axis(at, top.argmax(1)[:, None], 1)[:, 0]]
