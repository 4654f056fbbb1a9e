"""Word shingles of whole texts as 64-bit hashes, computed for many texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are held at once; a longer text is a part of its own.
HELD = 1 << 20
# The bytes that part words.
BLANKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_random = np.random.Generator(np.random.PCG64(20))
_LETTER = _random.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = _LETTER.copy()
_LOWER[ord("A"):ord("Z") + 1] = _LETTER[ord("a"):ord("z") + 1]
_STEP, _FAR = (np.uint64(int(x) | 1) for x in _random.integers(1, 1 << 63, 2, np.uint64))
_PLACES = _random.integers(1, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
_BLANK = np.zeros(256, bool)
_BLANK[list(BLANKS)] = True


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_NEAR_POWERS = _powers(_STEP, 1 << 16)


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spreads 64-bit numbers; one to one for each salt."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_places(data: np.ndarray, starts: np.ndarray, parts: np.ndarray = _BLANK) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin in texts that lie one after the other, and which bytes part words (``parts`` of 256)."""
    blank = parts[data]
    begins = ~blank
    if len(begins):
        begins[1:] &= blank[:-1]
        inner = starts[:-1][starts[:-1] < len(data)]
        begins[inner] = ~blank[inner]
    return np.flatnonzero(begins), blank


def word_hashes(data: np.ndarray, starts: np.ndarray, lower: bool = True,
                parts: np.ndarray = _BLANK) -> tuple[np.ndarray, np.ndarray]:
    """A hash for every word of texts that lie one after the other, and the number of words of each text.

    ``starts``: where each text begins, and where the last one ends. A-Z are lower-cased if asked for.
    """
    first, last = int(starts[0]), int(starts[-1])
    data, starts = data[first:last], starts - first
    word_at, blank = word_places(data, starts, parts)
    if not len(word_at):
        return np.zeros(0, np.uint64), np.zeros(len(starts) - 1, np.int64)
    at = np.flatnonzero(~blank)
    begin_of = np.searchsorted(at, word_at)
    place = np.arange(len(at)) - np.repeat(begin_of, np.diff(np.append(begin_of, len(at))))
    value = (_LOWER if lower else _LETTER)[data[at]] * _NEAR_POWERS[place & 0xFFFF]
    if len(place) and int(place.max()) >> 16:
        value *= _powers(_FAR, (int(place.max()) >> 16) + 1)[place >> 16]
    counts = np.diff(np.searchsorted(word_at, starts))
    return mixed(np.add.reduceat(value, begin_of)), counts


def shingle_hashes(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words in each text, repeats included, and their number in each text.

    A text with fewer words has one: the run of all its words. A text without words has none.
    """
    ends = np.cumsum(counts)
    starts = ends - counts
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    total = int(runs.sum())
    out = np.zeros(total, np.uint64)
    owner_end = np.repeat(ends, runs)
    at = np.arange(total) - np.repeat(np.cumsum(runs) - runs, runs) + np.repeat(starts, runs)
    for k in range(size):
        inside = at + k < owner_end
        if inside.all():
            out += words[at + k] * _PLACES[k]
        else:
            i = np.flatnonzero(inside)
            out[i] += words[at[i] + k] * _PLACES[k]
    short = np.repeat(np.where(counts < size, counts, 0), runs).astype(np.uint64)
    return mixed(out + short, 1), runs


def text_parts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cuts a text column into runs of whole texts of about ``HELD`` bytes: (first row, last row, bytes, starts).

    Nulls count as empty.
    """
    if pa.types.is_large_string(column.type):
        kind, column = np.int64, column
    else:
        kind, column = np.int32, column.cast(pa.string())
    if not len(column):
        return
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(column):
        b = int(np.searchsorted(starts, starts[a] + HELD, "right")) - 1
        b = min(max(b, a + 1), len(column))
        yield a, b, data, starts[a:b + 1]
        a = b


def shingle_sets(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every text."""
    for a, b, data, starts in text_parts(column):
        words, counts = word_hashes(data, starts)
        hashes, runs = shingle_hashes(words, counts, size)
        end = np.cumsum(runs)
        for i, (hi, n) in enumerate(zip(end.tolist(), runs.tolist())):
            own = hashes[hi - n:hi]
            own.sort()
            if n > 1:
                keep = np.empty(n, bool)
                keep[0] = True
                np.not_equal(own[1:], own[:-1], out=keep[1:])
                if not keep.all():
                    own = own[keep]
            yield a + i, own


def prefix_hashes(data: np.ndarray, starts: np.ndarray, sizes: range,
                  parts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text of each word, hash of its first bytes), for the whole words and then for every size, of words as long."""
    words, counts = word_hashes(data, starts, True, parts)
    owner = np.repeat(np.arange(len(counts)), counts)
    yield owner, mixed(words, 40)
    first = int(starts[0])
    data, starts = data[first:int(starts[-1])], starts - first
    at, blank = word_places(data, starts, parts)
    value = np.zeros(len(at), np.uint64)
    stop = starts[1:][owner] if len(at) else np.zeros(0, np.int64)
    for k in range(sizes.stop - 1):
        live = at + k < stop
        live[live] = ~blank[at[live] + k]
        at, value, owner, stop = at[live], value[live], owner[live], stop[live]
        value = value + _LOWER[data[at + k]] * _NEAR_POWERS[k]
        if k + 1 in sizes:
            yield owner, mixed(value, 40 + k + 1)
