"""Token ids of whole texts by a word-wise pair-merge tokenizer, many words at a time."""

from __future__ import annotations

import json

import numpy as np

from martloom.llm.bpe import NONE, Transducer
from martloom.llm.shipping import kept

#: Symbols of a lane at least, unless the batch is smaller.
LANE = 128
SPACE, LETTER, NUMBER, OTHER, UNKNOWN = range(5)
# The endings that the tokenizer's own pattern splits from a word.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def _byte_chars() -> dict[str, int]:
    """The characters that byte-level vocabularies write for bytes: printable ones for themselves, others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@kept(2)
def compiled(path: str):
    """The library's tokenizer, the transducer over bytes (256 more at a word's end), and the classes and lower case of
    the code points whose treatment needs no library: Latin letters, ASCII, common punctuation."""
    import unicodedata

    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    chars, end = _byte_chars(), model["end_of_word_suffix"]

    def part(name: str) -> tuple[int, ...]:
        last = name.endswith(end)
        body = [chars[c] for c in (name[:-len(end)] if last else name)]
        return (*body[:-1], body[-1] + 256 * last)

    usable = {n: i for n, i in model["vocab"].items() if n != end and all(c in chars for c in n.removesuffix(end))}
    order = {}
    for i, m in enumerate(model["merges"]):
        a, b = m if isinstance(m, list) else m.split(" ")
        order[part(a), part(b)] = i
    whole = {part(n): i for n, i in usable.items()}
    machine = Transducer(whole, lambda a, b: order.get((a, b)), 512, with_tokens=True)

    kind = np.full(0x110000, UNKNOWN, np.int8)
    lower = np.arange(0x250, dtype=np.uint32)
    for c in [9, 10, 13, *range(0x20, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x180), *range(0x2013, 0x2027)]:
        name = unicodedata.category(chr(c))[0]
        kind[c] = SPACE if chr(c).isspace() else LETTER if name == "L" else NUMBER if name == "N" else OTHER
        if c < 0x250 and len(chr(c).lower()) == 1:
            lower[c] = ord(chr(c).lower())
    kind[0x130] = UNKNOWN
    return Tokenizer.from_file(path), machine, kind, lower


def word_starts(points: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Marks code points that begin a word: runs of letters, single digits, runs of other signs, split-off endings."""
    start = np.empty(len(kinds), bool)
    start[:1] = True
    start[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == NUMBER)
    start &= kinds != SPACE
    marks = np.flatnonzero((points[:-1] == ord("'")) & start[:-1] & (kinds[1:] == LETTER))
    open_ = np.ones(len(marks), bool)
    for ending in ENDINGS:
        n = len(ending)
        fit = open_ & (marks + n < len(points))
        for j, c in enumerate(ending):
            fit[fit] = points[marks[fit] + 1 + j] == ord(c)
        at = marks[fit]
        open_ &= ~fit
        start[at + 1] = False
        after = at[at + 1 + n < len(points)] + 1 + n
        start[after[kinds[after] == LETTER]] = True
    return start


def encode(texts: list[str | None], path: str, special: str = "<|") -> tuple[np.ndarray, np.ndarray]:
    """All token ids, one text after the other, and the number of ids of each text.

    Texts with characters outside the table, or with strings that could be special tokens, go to the library itself.
    """
    library, machine, kind, lower = compiled(path)
    counts = np.zeros(len(texts), np.int64)
    own, given = [], {}
    lengths = np.fromiter((len(t) if t else 0 for t in texts), np.int64, len(texts))
    points = np.frombuffer("\n".join(t or "" for t in texts).encode("utf-32-le"), np.uint32)
    kinds = kind.take(points)
    starts = np.cumsum(lengths + 1) - lengths - 1
    strange = np.zeros(len(texts), bool)
    odd = np.flatnonzero(kinds == UNKNOWN)
    strange[np.unique(np.searchsorted(starts, odd, "right") - 1)] = True
    for i in np.flatnonzero(lengths > 0):
        if strange[i] or special in texts[i]:
            strange[i] = True
            given[int(i)] = np.array(library.encode(texts[i], add_special_tokens=False).ids, np.uint32)
            counts[i] = len(given[int(i)])
        else:
            own.append(int(i))
    if own:
        if len(own) < len(texts):  # strange and empty texts leave no gap
            points = np.frombuffer("\n".join(texts[i] for i in own).encode("utf-32-le"), np.uint32)
            kinds = kind.take(points)
        small = points < len(lower)
        points = np.where(small, lower[np.where(small, points, 0)], points)
        ids, at = _encode_plain(points, kinds, machine)
        size = lengths[own] + 1
        bounds = np.cumsum(size)
        counts[own] = np.diff(np.searchsorted(at, np.append(0, bounds)))
    else:
        ids = np.zeros(0, np.uint32)
    if not given:
        return ids, counts
    parts, done = [], 0
    for i in range(len(texts)):
        if i in given:
            parts.append(given[i])
        else:
            parts.append(ids[done:done + counts[i]])
            done += counts[i]
    return np.concatenate(parts) if parts else ids, counts


def _encode_plain(points: np.ndarray, kinds: np.ndarray, machine: Transducer) -> tuple[np.ndarray, np.ndarray]:
    """Ids, and the code point in which each ends."""
    start = word_starts(points, kinds)
    inside = np.flatnonzero(kinds != SPACE)
    points, start = points[inside], start[inside]
    if not len(points):
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    last = np.append(start[1:], True)
    wide = 1 + (points >= 0x80) + (points >= 0x800)
    end = np.cumsum(wide)
    stream = np.empty(int(end[-1]), np.int32)
    one, two, three = (np.flatnonzero(wide == k) for k in (1, 2, 3))
    stream[end[one] - 1] = points[one]
    for at in (two, three):
        stream[end[at] - 1] = 0x80 | points[at] & 0x3F
    stream[end[two] - 2] = 0xC0 | points[two] >> 6
    stream[end[three] - 2] = 0x80 | points[three] >> 6 & 0x3F
    stream[end[three] - 3] = 0xE0 | points[three] >> 12
    word_ends = end[last]
    stream[word_ends - 1] += 256
    cuts = np.unique(np.searchsorted(word_ends, np.arange(LANE, len(stream) + LANE, LANE), "left").clip(max=len(word_ends) - 1))
    lane_ends = word_ends[cuts]
    lane_starts = np.append(0, lane_ends[:-1])
    tokens = np.empty(len(stream), np.int32)
    machine.run(stream, lane_starts, lane_ends, last=tokens)
    word_starts_ = np.append(0, word_ends[:-1])
    ends_token = np.zeros(len(stream), bool)
    at, low = word_ends - 1, word_starts_
    while len(at):
        ends_token[at] = True
        at = at - machine.lengths.take(tokens.take(at))
        more = np.flatnonzero(at >= low)
        at, low = at.take(more), low.take(more)
    where = np.flatnonzero(ends_token)
    return tokens.take(where).astype(np.uint32), np.repeat(inside, wide).take(where)
