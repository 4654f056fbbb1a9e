"""Pair-merge tokenizers compiled, as texts need it, to a deterministic transducer.

After every symbol of a word the tokenization of what has been read so far ends in one definite token. A token may follow
another only if merging the two alone gives them back, so that end token follows from the end tokens at the places where
a token could have begun. A state holds those places: for each, the path in the trie of tokens since then, the token that
ends there, and how many tokens came after it. Paths on which no token can follow any more are left out, and of end tokens
after which the same tokens can follow, one stands for all. Reading a symbol moves every path on and adds to the token count; the
transition is annotated with that addition and with the token that now ends the word. States are numbered when first
reached and kept in tables, so many stretches of text can be run side by side, one symbol of each at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np

NONE = -1
#: Cells of the tables before they are begun anew: 5 bytes each, 6 where they keep tokens.
MOST_CELLS = 12_000_000
#: Pairs of tokens, of parts, or of a place and a token of which an answer is remembered.
MOST_PAIRS = 200_000
#: Tokens below a place at most, where it is asked which of them may still follow.
FEW = 3
INF = float("inf")


class Transducer:
    """tokens: symbols of each token (small ints) -> id. rank: the order in which two adjacent parts merge, None if they don't."""

    def __init__(self, tokens: dict[tuple[int, ...], int], rank: Callable[[tuple, tuple], float | None], symbols: int,
                 breaks: tuple[int, ...] = (), with_tokens: bool = False, most_cells: int = MOST_CELLS):
        """``breaks``: tokens that the symbols from ``symbols`` on stand for; no token reaches over one.

        ``with_tokens``: keep the token that ends at every transition, and not the number of tokens.
        """
        self.with_tokens = with_tokens
        self.keys: list[tuple] = []
        self.rank, self.alphabet, self.breaks, self.most_cells = rank, symbols, breaks, most_cells
        self.children: list[dict[int, int]] = [{}]
        self.ends: list[int] = [NONE]
        self.parts: dict[int, tuple[int, ...]] = {}
        self.follows: set[tuple[int, int]] = set()
        self.inner: set[int] = set()
        self._made: dict[int, tuple] = {}
        self._number: dict[tuple[int, ...], int] = {}
        self._named: list[tuple[int, ...]] = []
        self._ranks: dict[int, float] = {}
        self._below: dict[int, tuple[int, ...] | None] = {}
        self._alike: dict[int, int | None] = {}
        self._first: dict[tuple[int, tuple[int, ...]], int] = {}
        for part, number in tokens.items():
            node = 0
            for s in part:
                nxt = self.children[node].get(s)
                if nxt is None:
                    nxt = self.children[node][s] = len(self.children)
                    self.children.append({})
                    self.ends.append(NONE)
                node = nxt
            self.ends[node] = number
            self.parts[number] = part
            self.follows.update(zip(part, part[1:]))
            self.inner.update(part[:-1])
        self.lengths = np.ones(max(self.parts) + 1, np.int32)
        for number, part in self.parts.items():
            self.lengths[number] = len(part)
        self._size = max(self.parts) + 2
        self._fit: dict[int, bool] = {}
        self.clear()

    def clear(self) -> None:
        """Begins the tables anew, with room for few states and symbols."""
        self.keys: list[tuple] = []
        self.numbers: dict[tuple, int] = {}
        self.column = np.full(self.alphabet + len(self.breaks), NONE, np.int32)
        self.symbol: list[int] = []
        self.tables(64)
        self.state(((0, NONE, 0),))

    def tables(self, columns: int) -> None:
        """Empty tables, or wider ones with what is there. Memory is taken up as cells are filled.

        A cell of ``next`` is 0 while unknown, else the state's number and 1. ``gain`` has the tokens counted, ``last``
        the token that ends; one of the two is kept.
        """
        old = (self.next, self.gain, self.last) if self.keys else ()
        shape = (max(len(self.keys) + 1, self.most_cells // columns), columns)
        small = max(self.parts) < 1 << 16 and not self.breaks
        self.next = np.zeros(shape, np.int32)
        self.gain = np.zeros((0, 0) if self.with_tokens else shape, np.int8)
        self.last = np.zeros(shape if self.with_tokens else (0, 0), np.uint16 if small else np.int32)
        for new, was in zip((self.next, self.gain, self.last), old):
            rows = min(len(self.keys), len(was))
            new[:rows, :was.shape[1]] = was[:rows]

    def _flat(self) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        return self.next.shape[1], self.next.reshape(-1), self.last.reshape(-1), self.gain.reshape(-1)

    def state(self, key: tuple) -> int:
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.keys)
            if number >= len(self.next):
                self.most_cells, limit = 2 * self.next.size, self.most_cells
                self.tables(self.next.shape[1])
                self.most_cells = limit
            self.keys.append(key)
        return number

    def renewed(self, states: np.ndarray) -> np.ndarray:
        """Forgets all states but the first and these, and gives the new numbers of these."""
        kept, place = np.unique(states, return_inverse=True)
        keys = [self.keys[s] for s in kept.tolist()]
        self.keys, self.numbers = [], {}
        self.tables(self.next.shape[1])
        self.state(((0, NONE, 0),))
        return np.array([self.state(key) for key in keys], np.int32)[place]

    def compact(self, symbols: np.ndarray) -> np.ndarray:
        """The table columns of symbols; a symbol gets one when first seen."""
        found = self.column[symbols]
        if (found < 0).any():
            for s in np.unique(symbols[found < 0]):
                self.column[s] = len(self.symbol)
                self.symbol.append(int(s))
            if len(self.symbol) > self.next.shape[1]:
                self.tables(max(2 * self.next.shape[1], len(self.symbol)))
            found = self.column[symbols]
        return found

    def merged(self, symbols: Iterable[int]) -> list[tuple[int, ...]]:
        """The tokens of a short run of symbols, by merging the first of the best pairs until none is left."""
        parts = [(s,) for s in symbols]
        while True:
            ranks = [(r, i) for i in range(len(parts) - 1) if (r := self.rank(parts[i], parts[i + 1])) is not None]
            if not ranks:
                return parts
            _, i = min(ranks)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    def _named_part(self, part: tuple[int, ...]) -> int:
        number = self._number.get(part)
        if number is None:
            number = self._number[part] = len(self._named)
            self._named.append(part)
        return number

    def made(self, token: int) -> tuple[bool, list[float], list[int], list[int]]:
        """How merging makes a token: whether it does, the rank of each merge, and the first and the last part before
        each merge and at the end. Infinity ends the ranks."""
        found = self._made.get(token)
        if found is None:
            parts = [(s,) for s in self.parts[token]]
            made, firsts, lasts = [], [self._named_part(parts[0])], [self._named_part(parts[-1])]
            while True:
                ranks = [(r, i) for i in range(len(parts) - 1) if (r := self.rank(parts[i], parts[i + 1])) is not None]
                if not ranks:
                    break
                r, i = min(ranks)
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
                made.append(r)
                firsts.append(self._named_part(parts[0]))
                lasts.append(self._named_part(parts[-1]))
            found = self._made[token] = (len(parts) == 1, [*made, INF], firsts, lasts)
        return found

    def _rank(self, left: int, right: int) -> float:
        key = left << 32 | right
        rank = self._ranks.get(key)
        if rank is None:
            if len(self._ranks) >= MOST_PAIRS:
                self._ranks.clear()
            rank = self.rank(self._named[left], self._named[right])
            rank = self._ranks[key] = INF if rank is None else rank
        return rank

    def apart(self, before: int, after: int) -> bool:
        """Whether merging two tokens side by side gives them back.

        As long as nothing merges over their border, each is merged as if alone; so their known merges are followed in
        the common order until the parts at the border would be first.
        """
        _, left, _, lasts = self.made(before)
        _, right, firsts, _ = self.made(after)
        i = j = 0
        x, y = lasts[0], firsts[0]
        across = self._rank(x, y)
        while True:
            a, b = left[i], right[j]
            if across < a and across <= b:
                return False
            if a <= b:
                if a == INF:
                    return True
                i += 1
                if lasts[i] != x:
                    x = lasts[i]
                    across = self._rank(x, y)
            else:
                j += 1
                if firsts[j] != y:
                    y = firsts[j]
                    across = self._rank(x, y)

    def fits(self, before: int, after: int) -> bool:
        """Whether ``after`` can follow ``before`` in a tokenization."""
        if before == NONE:
            return self.made(after)[0]
        key = before * self._size + after
        known = self._fit.get(key)
        if known is None:
            if len(self._fit) >= MOST_PAIRS:
                self._fit.clear()
            known = self.made(after)[0] and (
                (self.parts[before][-1], self.parts[after][0]) not in self.follows or self.apart(before, after))
            self._fit[key] = known
        return known

    def below(self, node: int) -> tuple[int, ...] | None:
        """The tokens that go on from a place in the trie, None if they are many."""
        if node not in self._below:
            found, todo = [], list(self.children[node].values())
            while todo and len(found) <= FEW:
                child = todo.pop()
                if self.ends[child] != NONE:
                    found.append(self.ends[child])
                todo += self.children[child].values()
            self._below[node] = tuple(found) if len(found) <= FEW else None
        return self._below[node]

    def alike(self, node: int, before: int) -> int | None:
        """A token that stands for ``before`` on a path at ``node``: the same tokens can still follow. None if none can."""
        tokens = self.below(node)
        if tokens is None:
            return before
        key = node * self._size + before + 1
        if key not in self._alike:
            if len(self._alike) >= MOST_PAIRS:
                self._alike.clear()
                self._first.clear()
            fit = tuple([t for t in tokens if self.fits(before, t)])
            self._alike[key] = self._first.setdefault((node, fit), before) if fit else None
        return self._alike[key]

    def step(self, state: int, column: int) -> None:
        """Adds a transition to the tables."""
        symbol = self.symbol[column]
        if symbol >= self.alphabet:
            self.next[state, column] = 1
            if self.with_tokens:
                self.last[state, column] = NONE
            else:
                self.gain[state, column] = self.breaks[symbol - self.alphabet]
            return
        key = self.keys[state]
        end = key[0][1]
        if end != NONE and (self.parts[end][-1], symbol) not in self.follows:
            key = self.keys[0]
        found, paths = None, []
        for node, before, since in key:
            child = self.children[node].get(symbol)
            if child is None:
                continue
            if found is None and self.ends[child] != NONE and self.fits(before, self.ends[child]):
                found = (self.ends[child], 1 - since)
            if self.children[child] and (same := self.alike(child, before)) is not None:
                paths.append((child, same, since))
        if found is None:
            raise ValueError(f"no token ends with symbol {symbol}")
        token, gain = found
        gain = 0 if self.with_tokens else gain
        end = token if self.parts[token][-1] in self.inner else NONE
        new = ((0, end, 0), *((c, b, s + gain) for c, b, s in paths)) if end != NONE else ((0, NONE, 0),)
        number = self.state(new)
        self.next[state, column] = number + 1
        if self.with_tokens:
            self.last[state, column] = token
        else:
            self.gain[state, column] = gain

    def run(self, stream: np.ndarray, starts: np.ndarray, ends: np.ndarray, states: np.ndarray | None = None,
            last: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Runs stretches of a stream of symbols side by side, each from its state (without: from the first).

        Returns the states at their ends and the tokens counted. ``last`` (as long as the stream) gets the token that
        ends at every symbol. Tables that are full are begun anew with the states at hand; not if states were given, as
        the caller may hold further ones.
        """
        fresh = states is None
        if states is None:
            states = np.zeros(len(starts), np.int32)
        columns = self.compact(stream)
        order = np.argsort(starts - ends, kind="stable")
        starts, lengths, own = starts[order], (ends - starts)[order], states[order].astype(np.int64)
        counts = np.zeros(len(starts), np.int64)
        steps = int(lengths[0]) if len(lengths) else 0
        live = np.searchsorted(-lengths, -np.arange(steps), side="left")
        width, cells, tokens, gains = self._flat()
        for i in range(steps):
            k = live[i]
            at = starts[:k] + i
            column = columns.take(at)
            cell = own[:k] * width + column
            new = cells.take(cell)
            holes = np.flatnonzero(new == 0)
            if len(holes):
                table = self.next
                missing = set((own.take(holes) << 32 | column.take(holes)).tolist())
                if fresh and (len(self.keys) + len(missing)) * width > self.most_cells:
                    own = self.renewed(own).astype(np.int64)
                    missing = set((own[:k] << 32 | column).tolist())
                for pair in missing:
                    self.step(pair >> 32, pair & 0xFFFFFFFF)
                if self.next is table:
                    new[holes] = cells.take(cell.take(holes))
                else:
                    width, cells, tokens, gains = self._flat()
                    cell = own[:k] * width + column
                    new = cells.take(cell)
            if not self.with_tokens:
                counts[:k] += gains.take(cell)
            if last is not None:
                last[at] = tokens.take(cell)
            np.subtract(new, 1, out=own[:k])
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return own[back].astype(np.int32), counts[back]
