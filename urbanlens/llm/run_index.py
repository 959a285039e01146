"""A run-compressed Burrows-Wheeler transform with sampled run ends, and the long matches that it shows.

The index of a few hundred strings (one task's share) is built in numpy:

* suffixes are sorted by prefix doubling, first by eight bytes, then only those that are still tied; every string ends in a mark of its own,
  so no match runs over an end;
* the transform is kept as runs of equal symbols, with the text positions (samples) at both ends of every run;
* where one run ends and the next begins, two suffixes are neighbours whose common prefix cannot be had from another pair. Their
  match length is measured on the text. Inside a run a suffix's match is that of the suffix one position to the left, less one. So streaming
  over the text once, ``reach = max(reach, position + length of its samples)``, gives every suffix's matching statistic: how long the
  longest match is that it has anywhere else. In repetitive texts runs, and so samples, are few.
"""

from __future__ import annotations

import numpy as np


class RunIndex:
    """Index over byte strings. ``text`` holds them one after the other, a zero byte after each."""

    def __init__(self, strings: list[bytes]):
        lengths = np.array([len(s) for s in strings], np.int64)
        self.starts = np.cumsum(lengths + 1) - lengths - 1
        self.lengths = lengths
        self.text = np.frombuffer(b"\0".join(strings) + b"\0" * 9, np.uint8)
        self.n = int((lengths + 1).sum())
        self.owner = np.repeat(np.arange(len(strings), dtype=np.int64), lengths + 1)
        #: Bytes from each position to its string's end.
        self.left = self.starts[self.owner] + lengths[self.owner] - np.arange(self.n)
        self.head = self._eight()
        self.samples_before, self.samples_after = self._runs(self._sorted())

    def _eight(self) -> np.ndarray:
        """The eight bytes from each position on as one integer; bytes after the string's end are 0."""
        head = np.zeros(self.n, np.uint64)
        for k in range(8):
            head = (head << np.uint64(8)) | self.text[k:k + self.n]
        short = np.flatnonzero(self.left < 8)
        gone = np.uint64(8) * (8 - self.left[short]).astype(np.uint64)
        head[short] = np.where(self.left[short] == 0, np.uint64(0), (head[short] >> (gone & np.uint64(63))) << (gone & np.uint64(63)))
        return head

    def _sorted(self) -> np.ndarray:
        """The suffix array."""
        order = np.argsort(self.head, kind="stable")
        rank = np.empty(self.n, np.int64)
        rank[order] = self._first_of_equal(self.head[order])
        # suffixes that end within these bytes: shorter first, then by string
        last = np.int64(9 * len(self.lengths))
        ending = np.where(self.left < 8, self.left * len(self.lengths) + self.owner, last)
        key = rank * (last + 1) + ending
        order = np.argsort(key, kind="stable")
        rank[order] = self._first_of_equal(key[order])
        step = 8
        while True:
            in_order = rank[order]
            tied = np.zeros(self.n, bool)
            same = in_order[1:] == in_order[:-1]
            tied[1:] |= same
            tied[:-1] |= same
            slots = np.flatnonzero(tied)
            if not len(slots):
                return order
            at = order[slots]
            key = (rank[at] << 32) | rank[at + step]
            by = np.argsort(key, kind="stable")
            at, key = at[by], key[by]
            order[slots] = at
            rank[at] = slots[self._first_of_equal(key)]
            step *= 2

    @staticmethod
    def _first_of_equal(values: np.ndarray) -> np.ndarray:
        """For each place of a sorted array the first place with the same value."""
        new = np.r_[True, values[1:] != values[:-1]]
        return np.maximum.accumulate(np.where(new, np.arange(len(values)), 0))

    def _runs(self, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Text positions at the end of each run of the transform and at the start of the next."""
        symbol = np.where(np.isin(order, self.starts), 256 + self.owner[order], self.text[order - 1].astype(np.int64))
        ends = np.flatnonzero(symbol[1:] != symbol[:-1])
        self.runs = len(ends) + 1
        return order[ends], order[ends + 1]

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes of the suffixes at ``a`` and ``b``, word by word."""
        most = np.minimum(self.left[a], self.left[b])
        found, live = most.copy(), np.arange(len(a))
        at = 0
        while len(live):
            differ = self.head[a[live] + at] ^ self.head[b[live] + at]
            ends = differ != 0
            stop = live[ends]
            bits = 63 - np.floor(np.log2(differ[ends].astype(np.float64))).astype(np.int64)
            bits -= (differ[ends] >> (63 - bits).astype(np.uint64)) == 0  # rounded up to the next power
            found[stop] = np.minimum(most[stop], at + bits // 8)
            at += 8
            live = live[~ends]
            live = live[most[live] > at]
        return found

    def matching_statistics(self) -> np.ndarray:
        """For every position the length of its suffix's longest match elsewhere."""
        length = self._common(self.samples_before, self.samples_after)
        reach = np.zeros(self.n, np.int64)
        for at in (self.samples_before, self.samples_after):
            np.maximum.at(reach, at, at + length)
        return np.maximum(np.maximum.accumulate(reach) - np.arange(self.n), 0)

    def long_matches(self, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of bytes that matches of ``least`` bytes or more cover: string numbers, starts and ends in the string."""
        at = np.arange(self.n)
        length = self.matching_statistics()
        covered = np.maximum.accumulate(np.where(length >= least, at + length, 0)) > at
        edge = np.diff(np.r_[0, covered.astype(np.int8), 0])
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        owner = self.owner[start]
        return owner, start - self.starts[owner], end - self.starts[owner]
