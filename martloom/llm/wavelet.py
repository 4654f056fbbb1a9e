"""Wavelet matrices: one compressed, searchable image of a sequence of token ids.

Ids get prefix codes by their counts (Huffman), and bit-plane d holds the d-th code bit of every id whose code is that
long. From plane to plane ids are dealt stably, zeros before ones. Codes are given out so that the ids whose code ends
stand last and drop out: a plane is as long as there are ids left, all planes together about as long as the entropy says,
and a place is followed through them by rank alone.
"""

from __future__ import annotations

import functools

import numpy as np

MAGIC = 0x574D5831
#: Bits between two samples of the rank directory.
STRIDE = 2048
#: Ids below this are counted by place in a table, others by sorting.
DENSE = 1 << 20


def code_lengths(counts: np.ndarray) -> np.ndarray:
    """Huffman code length of every symbol, rising; a lone symbol gets one bit. ``counts`` must fall.

    The two rarest of the unused leaves and nodes are joined again and again; nodes come to be in rising order, so two
    queues replace a heap.
    """
    n = len(counts)
    if n < 2:
        return np.ones(n, np.int64)
    leaves, nodes = counts.tolist(), []
    leaf, node, parent = n - 1, 0, [0] * (2 * n - 1)
    for made in range(n - 1):
        total = 0
        for _ in range(2):
            if leaf >= 0 and (node >= made or leaves[leaf] <= nodes[node]):
                total += leaves[leaf]
                parent[leaf] = n + made
                leaf -= 1
            else:
                total += nodes[node]
                parent[n + node] = n + made
                node += 1
        nodes.append(total)
    depth = [0] * (2 * n - 1)
    for i in range(2 * n - 3, -1, -1):
        depth[i] = depth[parent[i]] + 1
    return np.array(depth[:n], np.int64)


def assign_codes(lengths: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Code of every symbol, bit d for plane d, and the symbols that end at each depth in the order they stand there.

    ``lengths`` must be rising. Open codes of a depth stand in the order in which plane after plane deals them; the last
    ones become leaves.
    """
    codes = np.zeros(len(lengths), np.uint64)
    open_, leaves, done = np.zeros(1, np.uint64), [np.zeros(0, np.int64)], 0
    for depth in range(1, int(lengths[-1]) + 1 if len(lengths) else 0):
        both = np.concatenate([open_, open_ | np.uint64(1 << (depth - 1))])
        k = int(np.searchsorted(lengths, depth, "right")) - done
        ends = np.arange(done, done + k)
        codes[ends] = both[len(both) - k:]
        open_ = both[:len(both) - k]
        leaves.append(ends)
        done += k
    return codes, leaves


def build(ids: np.ndarray) -> bytes:
    """The image of a sequence of ids (whole numbers under 2**32)."""
    ids = np.asarray(ids, np.uint32)
    if int(ids.max(initial=0)) < DENSE:
        known, place = np.arange(int(ids.max(initial=0)) + 1), ids
    else:
        known, place = np.unique(ids, return_inverse=True)
    every = np.bincount(place, minlength=len(known))
    order = np.lexsort((known, -every))[:np.count_nonzero(every)]
    symbols, counts = known[order], every[order]
    lengths = code_lengths(counts)
    codes, leaves = assign_codes(lengths)
    depth = len(leaves) - 1
    code_of = np.zeros(len(known), np.uint32 if depth <= 32 else np.uint64)
    code_of[order] = codes
    row = code_of[place]
    planes, n = [], len(row)
    for d in range(depth):
        bits = (row >> row.dtype.type(d) & row.dtype.type(1)).astype(bool)
        planes.append(np.packbits(bits, bitorder="little").tobytes())
        n -= int(counts[leaves[d + 1]].sum())
        # Places instead of masks: fancy selection by a mask is several times slower on bits without order.
        row = np.concatenate([row[np.flatnonzero(~bits)], row[np.flatnonzero(bits)]])[:n]
    head = np.array([MAGIC, len(ids) & 0xFFFFFFFF, len(ids) >> 32, len(symbols)], "<u4")
    return b"".join([head.tobytes(), symbols.astype("<u4").tobytes(), counts.astype("<u4").tobytes(), *planes])


class Wavelet:
    """An image of ``build`` with access, count and occurrence lookup; nothing but the image is needed."""

    def __init__(self, image: bytes):
        magic, low, high, kinds = np.frombuffer(image, "<u4", 4).tolist()
        if magic != MAGIC:
            raise ValueError("not an image of a wavelet matrix")
        self.size = low | high << 32
        self.symbols = np.frombuffer(image, "<u4", kinds, 16)
        self.counts = np.frombuffer(image, "<u4", kinds, 16 + 4 * kinds).astype(np.int64)
        self.lengths = code_lengths(self.counts)
        self.codes, self.leaves = assign_codes(self.lengths)
        at, n = 16 + 8 * kinds, self.size
        self.planes, self.sizes, self.samples, self.zeros = [], [], [], []
        for ends in self.leaves[1:]:
            plane = np.frombuffer(image, np.uint8, -(-n // 8), at)
            at += len(plane)
            full = np.zeros(-(-n // STRIDE) * STRIDE // 8, np.uint8)
            full[:len(plane)] = plane
            ones = np.bitwise_count(full.reshape(-1, STRIDE // 8)).sum(1, dtype=np.int64)
            self.samples.append(np.append(0, np.cumsum(ones)))
            self.planes.append(plane)
            self.sizes.append(n)
            self.zeros.append(n - int(self.samples[-1][-1]))
            n -= int(self.counts[ends].sum())

    @functools.cached_property
    def _leaf(self) -> dict[tuple[int, int], int]:
        """Row of a symbol by its code's length and bits."""
        return {pair: i for i, pair in enumerate(zip(self.lengths.tolist(), self.codes.tolist()))}

    @functools.cached_property
    def _row(self) -> dict[int, int]:
        return {s: i for i, s in enumerate(self.symbols.tolist())}

    def _ones(self, d: int, i: int) -> int:
        """Ones among the first ``i`` bits of plane d."""
        block = i // STRIDE
        found, byte = int(self.samples[d][block]), i >> 3
        found += int(np.bitwise_count(self.planes[d][block * STRIDE // 8:byte]).sum(dtype=np.int64))
        if i & 7:
            found += int(np.bitwise_count(np.uint8(self.planes[d][byte] & ((1 << (i & 7)) - 1))))
        return found

    def _select(self, d: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) such bit of plane d."""
        samples = self.samples[d] if bit else np.arange(len(self.samples[d])) * STRIDE - self.samples[d]
        block = int(np.searchsorted(samples, k, "right")) - 1
        part = np.unpackbits(self.planes[d][block * STRIDE // 8:(block + 1) * STRIDE // 8], bitorder="little")
        return block * STRIDE + int(np.flatnonzero(part == bit)[k - int(samples[block])])

    def access(self, i: int) -> int:
        """The id at place ``i``."""
        if not 0 <= i < self.size:
            raise IndexError(i)
        code = 0
        for d in range(len(self.planes)):
            bit = self.planes[d][i >> 3] >> (i & 7) & 1
            code |= int(bit) << d
            i = self.zeros[d] + self._ones(d, i) if bit else i - self._ones(d, i)
            leaf = self._leaf.get((d + 1, code))
            if leaf is not None:
                return int(self.symbols[leaf])
        raise AssertionError("a code without an end")

    def count(self, token: int, start: int = 0, stop: int | None = None) -> int:
        """How often an id stands in the places from ``start`` up to ``stop``."""
        row = self._row.get(token)
        lo, hi = max(0, start), self.size if stop is None else min(stop, self.size)
        if row is None or lo >= hi:
            return 0
        for d in range(int(self.lengths[row])):
            if int(self.codes[row]) >> d & 1:
                lo, hi = (self.zeros[d] + self._ones(d, x) for x in (lo, hi))
            else:
                lo, hi = (x - self._ones(d, x) for x in (lo, hi))
        return hi - lo

    def places(self, token: int) -> np.ndarray:
        """All places of an id, rising: its leaf is followed back through the planes of its code, all places at once."""
        row = self._row.get(token)
        if row is None:
            return np.zeros(0, np.int64)
        depth, code, lo = int(self.lengths[row]), int(self.codes[row]), 0
        for d in range(depth):
            lo = self.zeros[d] + self._ones(d, lo) if code >> d & 1 else lo - self._ones(d, lo)
        at = lo + np.arange(self.counts[row])
        for d in range(depth - 1, -1, -1):
            bit = code >> d & 1
            bits = np.unpackbits(self.planes[d], count=self.sizes[d], bitorder="little")
            at = np.flatnonzero(bits == bit)[at - self.zeros[d] * bit]
        return at

    def find(self, token: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of an id, -1 if there are fewer."""
        row = self._row.get(token)
        if row is None or not 0 <= k < self.counts[row]:
            return -1
        depth, code, lo = int(self.lengths[row]), int(self.codes[row]), 0
        for d in range(depth):
            lo = self.zeros[d] + self._ones(d, lo) if code >> d & 1 else lo - self._ones(d, lo)
        i = lo + k
        for d in range(depth - 1, -1, -1):
            bit = code >> d & 1
            i = self._select(d, bit, i - self.zeros[d] * bit)
        return i

    def decode(self) -> np.ndarray:
        """All ids, from the last plane up."""
        row = np.zeros(0, np.uint32)
        for d in range(len(self.planes) - 1, -1, -1):
            ends = self.leaves[d + 1]
            dealt = np.concatenate([row, np.repeat(self.symbols[ends], self.counts[ends])])
            bits = np.unpackbits(self.planes[d], count=self.sizes[d], bitorder="little").astype(bool)
            row = np.empty(self.sizes[d], np.uint32)
            row[np.flatnonzero(~bits)] = dealt[:self.zeros[d]]
            row[np.flatnonzero(bits)] = dealt[self.zeros[d]:]
        return row
