"""Wu-Manber multi-pattern search over batches of texts."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

import numpy as np

#: Bytes of a block of the shift table, and bits of its hash.
BLOCK, BITS = 4, 18
#: Each cursor scans so many bytes.
STRETCH = 512
_FACTOR = np.uint32(2_654_435_761)


def _hash(blocks: np.ndarray) -> np.ndarray:
    return (blocks * _FACTOR) >> np.uint32(32 - BITS)


class PatternSearch:
    """Finds every occurrence of ``patterns`` (bytes, each at least ``BLOCK`` + 1 long) in a buffer.

    The shift table says how far no pattern can end for the block under a cursor; where it says 0 the hash of the last
    block and the bytes before it select the patterns to compare directly. Many cursors move in step, each over its own stretch of the buffer.
    """

    def __init__(self, patterns: Sequence[bytes]):
        self.patterns = list(patterns)
        self.least = least = min(map(len, self.patterns), default=BLOCK + 1)
        assert least > BLOCK, "patterns are too short"
        self.shift = np.full(1 << BITS, least - BLOCK + 1, np.uint16)
        # by their first bytes, as many as the shortest has
        self.buckets: dict[bytes, list[int]] = defaultdict(list)
        ends = set()
        for k, p in enumerate(self.patterns):
            head = np.frombuffer(p[:least], np.uint8).astype(np.uint32)
            blocks = head[: least - 3] | head[1 : least - 2] << 8 | head[2 : least - 1] << 16 | head[3:] << 24
            for j, h in enumerate(_hash(blocks)):
                self.shift[h] = min(self.shift[h], least - BLOCK - j)
            self.buckets[p[:least]].append(k)
            ends.add(int(blocks[-1]))
        self.last_blocks = np.array(sorted(ends), np.uint32)

    def find(self, buffer: bytes) -> list[tuple[int, int]]:
        """(start, pattern number) of every occurrence."""
        size = len(buffer)
        if not self.patterns or size < self.least:
            return []
        # every byte starts a view of four: unaligned, no copy
        view = np.ndarray((size - BLOCK + 1,), "<u4", buffer, 0, (1,))
        first = np.arange(0, size, STRETCH, dtype=np.int64)
        at = first + self.least - BLOCK
        end = np.minimum(first + STRETCH + self.least - BLOCK, size - BLOCK + 1)
        found: list[tuple[int, int]] = []
        live = at < end
        at, end = at[live], end[live]
        while at.size:
            blocks = view[at]
            step = self.shift[_hash(blocks)].astype(np.int64)
            stop = step == 0
            if stop.any():
                places, values = at[stop], blocks[stop]
                slot = np.minimum(np.searchsorted(self.last_blocks, values), len(self.last_blocks) - 1)
                real = self.last_blocks[slot] == values
                for place in (places[real] - self.least + BLOCK).tolist():
                    for k in self.buckets.get(buffer[place : place + self.least], ()):
                        if buffer.startswith(self.patterns[k], place):
                            found.append((place, k))
                step[stop] = 1
            at += step
            live = at < end
            if not live.all():
                at, end = at[live], end[live]
        return found
