"""Pre-tokens of many texts at once, as NumPy arrays inside a task.

A chunk of texts becomes one array of code points. Class changes give the token borders, prefix sums of
a polynomial give every token a 64-bit hash, and each worker keeps what it found out about a hash in a
`Memo` of bounded size. Strings are made for tokens never seen before only.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd

OTHER, LETTER, NUMBER, SPACE, END = range(5)
CHUNK_CHARS = 1 << 19
MEMO_ENTRIES = 400_000

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


@functools.cache
def char_classes() -> np.ndarray:
    """The class of every code point, by the Unicode properties L, N and white space."""
    import regex

    table = np.zeros(0x110000, np.uint8)
    chars = "".join(map(chr, range(0x110000)))
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
        for m in regex.finditer(pattern, chars):
            table[m.start() : m.end()] = kind
    return table


@functools.cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64."""
    room = 1 << max(20, (size - 1).bit_length())
    return _powers(room) if room == 1 << 20 else _powers.__wrapped__(room)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit number over all of them."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span values[start:end], in time that doesn't depend on their lengths."""
    up, down = powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(0x51ED27)) * up[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


@dataclass
class Chunk:
    """The tokens of some texts: where they are, whose they are and their hashes."""

    joined: str
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # of each text, and past the last

    def string(self, token: int) -> str:
        return self.joined[self.starts[token] : self.ends[token]]


def code_points(texts: Sequence[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """The texts, each with a line feed behind it; their code points; where those line feeds are."""
    joined = "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
    return joined, points, ends


def _chunk(joined, points, kinds, border, text_ends) -> Chunk:
    starts = np.flatnonzero(border)
    ends = np.append(starts[1:], len(points))
    kept = kinds[starts] != END
    return _finish(joined, points, starts[kept], ends[kept], text_ends)


def _finish(joined, points, starts, ends, text_ends) -> Chunk:
    first = np.concatenate([[0], np.searchsorted(starts, text_ends)])
    return Chunk(joined, starts, ends, span_hashes(points, starts, ends), first)


def _borders(points: np.ndarray, text_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    kinds = char_classes()[points]
    kinds[text_ends] = END
    border = np.ones(len(points), bool)
    border[1:] = kinds[1:] != kinds[:-1]
    border[text_ends] = True
    border[text_ends[:-1] + 1] = True
    return kinds, border


def _contractions(points, kinds, border, alone) -> None:
    """'s 't 're 've 'm 'll 'd where an apostrophe starts a token and stands alone in its run."""
    if not len(alone):
        return
    padded = np.append(points, np.zeros(3, np.uint32))
    one, two = padded[alone + 1], padded[alone + 2]
    letter = kinds[np.minimum(alone + 1, len(points) - 1)] == LETTER
    short = letter & np.isin(one, [ord(c) for c in "stmd"])
    long = letter & (
        ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    )
    for taken, length in ((alone[short], 2), (alone[long], 3)):
        border[taken + 1] = False
        if length == 3:
            border[taken + 2] = False
        border[taken + length] = True


def byte_level(texts: Sequence[str]) -> Chunk:
    """The matches of 's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+"""
    joined, points, text_ends = code_points(texts)
    kinds, border = _borders(points, text_ends)
    alone = np.flatnonzero(border & (kinds == OTHER) & (points == ord("'")))
    alone = alone[border[np.minimum(alone + 1, len(points) - 1)]]
    # the last character of white space before something else: a blank joins it, others stand alone
    after = np.flatnonzero(border[1:] & (kinds[:-1] == SPACE) & (kinds[1:] != END) & (kinds[1:] != SPACE)) + 1
    border[after - 1] = True
    border[after[points[after - 1] == ord(" ")]] = False
    _contractions(points, kinds, border, alone[border[alone]])
    return _chunk(joined, points, kinds, border, text_ends)


def word_level(texts: Sequence[str]) -> Chunk:
    """The matches of 's|'t|'re|'ve|'m|'ll|'d|\\p{L}+|\\p{N}|[^\\s\\p{L}\\p{N}]+"""
    joined, points, text_ends = code_points(texts)
    kinds, border = _borders(points, text_ends)
    alone = np.flatnonzero(border & (kinds == OTHER) & (points == ord("'")))
    alone = alone[border[np.minimum(alone + 1, len(points) - 1)]]
    border |= kinds == NUMBER
    _contractions(points, kinds, border, alone)
    starts = np.flatnonzero(border)
    ends = np.append(starts[1:], len(points))
    kept = (kinds[starts] != END) & (kinds[starts] != SPACE)
    return _finish(joined, points, starts[kept], ends[kept], text_ends)


def pieces(texts: Iterable[str | None], size: int = CHUNK_CHARS, cut: bool = True) -> Iterator[tuple[list[str], np.ndarray]]:
    """Chunks of at most about `size` characters: parts of texts, and the number of the text of each.

    A longer text is cut before a blank that stands between two characters which aren't white space; no
    token goes across such a place. A text without one stays whole, and so do all without `cut`.
    """
    parts, owners, room = [], [], size
    for owner, text in enumerate(texts):
        text, start = text or "", 0
        while True:
            end = len(text)
            if cut and end - start > size:
                end = _cut(text, start + size)
            if parts and end - start > room:
                yield parts, np.array(owners)
                parts, owners, room = [], [], size
            parts.append(text[start:end] if start or end < len(text) else text)
            owners.append(owner)
            room -= end - start
            start = end
            if start >= len(text):
                break
    if parts:
        yield parts, np.array(owners)


def _cut(text: str, at: int) -> int:
    while 0 <= (at := text.find(" ", at)) < len(text) - 1:
        if at and not text[at - 1].isspace() and not text[at + 1].isspace():
            return at
        at += 1
    return len(text)


class Memo:
    """What one worker knows of token hashes: a short array of numbers for each. Bounded: it starts anew."""

    def __init__(self, solve: Callable[[list[str]], Sequence[Sequence[int]]], entries: int = MEMO_ENTRIES):
        self.solve, self.entries = solve, entries
        self._clear()

    def _clear(self) -> None:
        self.keys, self.slots = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.flat, self.at, self.sizes = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def slots_of(self, chunk: Chunk) -> np.ndarray:
        """The entry of every token of the chunk."""
        codes, distinct = pd.factorize(chunk.hashes)
        if len(self.keys) and len(self.keys) + len(distinct) > self.entries:
            self._clear()
        place = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == distinct[inside]
        slots = np.empty(len(distinct), np.int64)
        slots[known] = self.slots[place[known]]
        new = np.flatnonzero(~known)
        if len(new):
            example = np.empty(len(distinct), np.int64)
            example[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
            joined, starts, ends = chunk.joined, chunk.starts[example[new]].tolist(), chunk.ends[example[new]].tolist()
            found = self.solve([joined[s:e] for s, e in zip(starts, ends)])
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            slots[new] = len(self.at) + np.arange(len(new))
            self.at = np.append(self.at, len(self.flat) + np.cumsum(sizes) - sizes)
            self.flat = np.append(self.flat, np.fromiter((x for ids in found for x in ids), np.int32, int(sizes.sum())))
            self.sizes = np.append(self.sizes, sizes)
            order = np.argsort(distinct[new])
            self.keys = np.insert(self.keys, place[new][order], distinct[new][order])
            self.slots = np.insert(self.slots, place[new][order], slots[new][order])
        return slots[codes]

    def expand(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All numbers of the entries one after the other; how many each has."""
        sizes = self.sizes[slots]
        return ragged(self.flat, self.at[slots], sizes), sizes


def ragged(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """flat[start:start+size] of each, one after the other."""
    ends = np.cumsum(sizes)
    shift = np.repeat(starts - (ends - sizes), sizes)
    shift += np.arange(len(shift))
    return flat[shift]


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values between consecutive entries of `first`, empty ranges included."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]
