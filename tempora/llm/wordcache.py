"""A worker's bounded memory of words that it has encoded."""

from __future__ import annotations

import array
import itertools
from collections.abc import Callable, Iterable

import numpy as np

#: Words kept, and the most characters of a kept word.
ROWS, CHARS = 1 << 18, 64


class WordCache:
    """Ids of words, as one flat array, from ``encode``: an iterable of id lists for a list of sorted words.

    When it is full, words that were met once go, and if need be the less frequent ones of the others.
    """

    def __init__(self, encode: Callable[[list[str]], Iterable[list[int]]], rows: int = ROWS) -> None:
        self.encode, self.rows = encode, rows
        self.number: dict[str, int] = {}
        self.ids, self.start, self.uses = np.empty(0, np.int32), np.zeros(1, np.int64), np.empty(0, np.int64)

    def _shrink(self) -> None:
        numbers = np.fromiter(self.number.values(), np.int64, len(self.number))
        uses = self.uses[numbers]
        least = max(2, int(np.partition(uses, -self.rows // 2)[-self.rows // 2]) + 1) if len(uses) > self.rows // 2 else 2
        keep = uses >= least
        kept = [w for w, k in zip(self.number, keep.tolist()) if k]
        numbers = numbers[keep]
        self.ids, size = self._gather(numbers)
        self.start, self.uses = np.concatenate([[0], np.cumsum(size)]), self.uses[numbers]
        self.number = dict(zip(kept, range(len(kept))))

    def _gather(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, size = self.start[number], self.start[number + 1] - self.start[number]
        ends = np.cumsum(size)
        return self.ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - size), size)], size

    def lookup(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in order, number of ids of each word)."""
        number = np.fromiter(map(self.number.get, words, itertools.repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(number < 0)
        if len(missing):
            unknown = list(map(words.__getitem__, missing.tolist()))
            fresh = sorted(set(unknown))
            if self.number and len(self.number) + len(fresh) > self.rows:
                self._shrink()
                number = np.fromiter(map(self.number.get, words, itertools.repeat(-1)), np.int64, len(words))
                missing = np.flatnonzero(number < 0)
                unknown = list(map(words.__getitem__, missing.tolist()))
                fresh = sorted(set(unknown))
            flat, sizes = array.array("i"), array.array("q")
            for ids in self.encode(fresh):
                flat.extend(ids)
                sizes.append(len(ids))
            known = len(self.start) - 1
            self.number.update(zip(fresh, range(known, known + len(fresh))))
            number[missing] = np.fromiter(map(self.number.__getitem__, unknown), np.int64, len(unknown))
            if flat:
                self.ids = np.concatenate([self.ids, np.frombuffer(flat, np.int32)])
            self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(np.frombuffer(sizes, np.int64))])
            self.uses = np.concatenate([self.uses, np.zeros(len(fresh), np.int64)])
            for w in [w for w in fresh if len(w) > CHARS]:
                del self.number[w]
        self.uses += np.bincount(number, minlength=len(self.uses))
        return self._gather(number)

    def encode_lists(self, lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all lists in order, where each list's ids begin and, last, the end)."""
        ids, size = self.lookup(list(itertools.chain.from_iterable(lists)))
        return ids, np.concatenate([[0], np.cumsum(size)])[np.cumsum([0, *map(len, lists)])]
