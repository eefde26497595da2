"""Minimal acyclic transducers of sorted terms: a term's output is its place among all terms, in byte order.

Terms are added in order. A state is frozen once no later term can pass through it, and shared with an equal frozen one, so the
automaton is minimal when the last term is in. A transition puts out the number of terms that come before those behind it; along
a term's path these add up to its ordinal. Frozen, the states are two tables (state by byte class) that NumPy walks for all words
of a batch at once.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np

# Bytes of terms are everything but these; A-Z are lowered on the way in.
IS_TERM = np.ones(256, dtype=bool)
IS_TERM[0x00:0x41] = IS_TERM[0x5B:0x61] = IS_TERM[0x7B:0x80] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


@dataclass
class Transducer:
    """``symbols``: byte to class, the last class for bytes of no term. ``follow``: the next state, -1 for none. ``before``: output."""

    terms: int
    symbols: np.ndarray
    follow: np.ndarray
    before: np.ndarray
    final: np.ndarray
    root: int

    @property
    def bytes_held(self) -> int:
        return self.follow.nbytes + self.before.nbytes + self.final.nbytes + self.symbols.nbytes

    def ordinals(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The ordinal of each word ``data[start:start + length]``, -1 where it is no term. A word is left at its first dead end."""
        result = np.full(len(starts), -1, dtype=np.int64)
        alive = np.arange(len(starts))
        state = np.full(len(starts), self.root, dtype=np.int64)
        total = np.zeros(len(starts), dtype=np.int64)
        place, left = starts.astype(np.int64), lengths.astype(np.int64)
        width = self.follow.shape[1]
        follow, before = self.follow.ravel(), self.before.ravel()
        while alive.size:
            at = state * width + self.symbols[data[place]]
            state = follow[at].astype(np.int64)
            on = state >= 0
            total, alive, place, left, state = total[on] + before[at[on]], alive[on], place[on] + 1, left[on] - 1, state[on]
            ended = left == 0
            if ended.any():
                good = ended & self.final[state]
                result[alive[good]] = total[good]
                go = ~ended
                total, alive, place, left, state = total[go], alive[go], place[go], left[go], state[go]
        return result

    def term(self, ordinal: int) -> bytes:
        """The term of an ordinal: of the transitions that put out no more than is left, the last."""
        if not 0 <= ordinal < self.terms:
            raise IndexError(ordinal)
        byte_of = np.zeros(self.follow.shape[1], dtype=np.uint8)
        used = self.symbols < self.follow.shape[1] - 1
        byte_of[self.symbols[used]] = np.flatnonzero(used)
        state, word = self.root, bytearray()
        while not (ordinal == 0 and self.final[state]):
            open_to = np.flatnonzero((self.follow[state] >= 0) & (self.before[state] <= ordinal))
            symbol = open_to[np.argmax(self.before[state][open_to])]
            ordinal -= int(self.before[state][symbol])
            word.append(byte_of[symbol])
            state = int(self.follow[state][symbol])
        return bytes(word)


class Builder:
    """Adds terms in strictly ascending byte order; ``states`` counts the frozen ones."""

    def __init__(self):
        self.frozen: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
        self.behind: list[int] = []
        self.known: dict[tuple, int] = {}
        self.path: list[list] = [[False, []]]
        self.last = b""
        self.terms = 0

    @property
    def states(self) -> int:
        return len(self.frozen)

    def freeze(self, depth: int) -> None:
        """Freeze the states of the last term below ``depth``, deepest first."""
        while len(self.path) > depth + 1:
            final, out = self.path.pop()
            key = (final, tuple(out))
            number = self.known.get(key)
            if number is None:
                number = self.known[key] = len(self.frozen)
                self.frozen.append(key)
                self.behind.append(final + sum(self.behind[child] for _, child in out))
            self.path[-1][1].append((self.last[len(self.path) - 1], number))

    def add(self, term: bytes) -> None:
        if not term or (self.terms and term <= self.last):
            raise ValueError(f"{term!r} does not come after {self.last!r}")
        shared = 0
        for a, b in zip(self.last, term):
            if a != b:
                break
            shared += 1
        self.freeze(shared)
        self.path.extend([False, []] for _ in range(len(term) - shared))
        self.path[-1][0] = True
        self.last, self.terms = term, self.terms + 1

    def finish(self) -> Transducer:
        self.freeze(0)
        final, out = self.path[0]
        self.frozen.append((final, tuple(out)))
        used = sorted({byte for _, out in self.frozen for byte, _ in out})
        symbols = np.full(256, len(used), dtype=np.uint8 if len(used) < 256 else np.int64)
        symbols[used] = np.arange(len(used))
        follow = np.full((len(self.frozen), len(used) + 1), -1, dtype=np.int32)
        before = np.zeros_like(follow)
        for state, (final, out) in enumerate(self.frozen):
            passed = int(final)
            for byte, child in out:
                follow[state, symbols[byte]], before[state, symbols[byte]] = child, passed
                passed += self.behind[child]
        finals = np.array([final for final, _ in self.frozen], dtype=bool)
        return Transducer(self.terms, symbols, follow, before, finals, len(self.frozen) - 1)


def build(terms: Iterable[bytes]) -> Transducer:
    builder = Builder()
    for term in terms:
        builder.add(term)
    return builder.finish()


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, lengths) of the maximal runs of term bytes."""
    inside = np.concatenate(([False], IS_TERM[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2] - edges[::2]


def prefixes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The first eight bytes of each word as one number that sorts as they do."""
    keys = np.zeros(len(starts), dtype=np.uint64)
    most = len(data) - 1
    for i in range(8):
        byte = np.where(lengths > i, data[np.minimum(starts + i, most)], 0) if len(data) else np.zeros(len(starts), dtype=np.uint8)
        keys = (keys << np.uint64(8)) | byte.astype(np.uint64)
    return keys


def prefix(term: bytes) -> int:
    return int.from_bytes(term[:8].ljust(8, b"\0"), "big")
