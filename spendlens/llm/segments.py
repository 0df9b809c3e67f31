"""Encoding of texts that fall into independent segments.

Where a tokenizer never merges across certain points of a text, the ids of a text
are the ids of its segments in order.  Most segments (words) occur again and
again, so each distinct one is handed to the tokenizer once while it is held; the
ids of the texts are gathered with numpy.  The store is cleared at a bound, so a
worker's memory does not grow with the corpus.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import repeat

import numpy as np

#: Distinct segments held at a time, segments gathered at a time, segments encoded as one text.
HELD, AT_ONCE, JOINED = 300_000, 500_000, 500


class SegmentEncoder:
    """``encode`` gives the ids of texts; ``weight`` the length of each id and
    ``size`` of a segment in the same unit.  Segments that ``joins`` accepts may
    stand behind one another in one text, whose ids are cut by these lengths."""

    def __init__(self, encode: Callable[[list[str]], list], weight: np.ndarray, size: Callable[[str], int],
                 joins: Callable[[str], bool], held: int = HELD, on_clear: Callable[[], None] = lambda: None):
        self.encode, self.weight, self.length, self.joins, self.held = encode, weight, size, joins, held
        self.on_clear = on_clear
        self.clear()

    def clear(self):
        """Give the store's memory back (tasks do so when they end)."""
        self.on_clear()
        self.slot: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.start = np.zeros(1 << 12, np.int64)
        self.size = np.zeros(1 << 12, np.int64)

    def _sizes(self, ids: np.ndarray, segments: list[str]) -> np.ndarray:
        """Number of ids of each of the segments that make up one text."""
        ends = np.cumsum(np.fromiter(map(self.length, segments), np.int64, len(segments)))
        cuts = np.searchsorted(np.cumsum(self.weight[ids]), ends, "left") + 1
        return np.diff(cuts, prepend=0)

    def _add(self, new: list[str]) -> None:
        joined = [x for x in new if self.joins(x)]
        groups = [joined[i:i + JOINED] for i in range(0, len(joined), JOINED)] + [[x] for x in new if not self.joins(x)]
        encoded = [np.asarray(ids, np.uint32) for ids in self.encode(["".join(g) for g in groups])]
        sizes = np.concatenate([self._sizes(ids, g) if len(g) > 1 else np.array([len(ids)])
                                for ids, g in zip(encoded, groups)])
        ids = np.concatenate(encoded)
        n = len(self.slot)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + len(new) > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        self.flat[self.used:self.used + len(ids)] = ids
        self.size[n:n + len(new)] = sizes
        self.start[n:n + len(new)] = self.used + np.cumsum(sizes) - sizes
        self.slot.update(zip((x for g in groups for x in g), range(n, n + len(new))))
        self.used += len(ids)

    def _gather(self, segments: list[str], lengths: list[int]) -> Iterator[np.ndarray]:
        at = np.fromiter(map(self.slot.get, segments, repeat(-1)), np.int64, len(segments))
        unknown = np.flatnonzero(at < 0)
        if len(unknown):
            new = list(dict.fromkeys(segments[i] for i in unknown.tolist()))
            if len(self.slot) + len(new) > self.held and self.slot:
                self.clear()
                unknown, new = np.arange(len(segments)), list(dict.fromkeys(segments))
            self._add(new)
            at[unknown] = np.fromiter((self.slot[segments[i]] for i in unknown.tolist()), np.int64, len(unknown))
        size = self.size[at]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.start[at] - (ends - size), size) + np.arange(total)]
        bounds = np.concatenate([[0], ends])[np.cumsum(lengths)]
        begin = 0
        for stop in bounds.tolist():
            yield ids[begin:stop]
            begin = stop

    def texts(self, split: Iterable[list[str]]) -> Iterator[np.ndarray]:
        """Ids of each text, given as its list of segments."""
        segments, lengths = [], []
        for one in split:
            segments += one
            lengths.append(len(one))
            if len(segments) >= AT_ONCE:
                yield from self._gather(segments, lengths)
                segments, lengths = [], []
        if lengths:
            yield from self._gather(segments, lengths)
