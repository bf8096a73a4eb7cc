"""Hashes of the words and word n-grams of many texts at once. Words are lower-cased runs of letters and digits."""

from __future__ import annotations

import numpy as np

from wardenlake.llm import pretokens


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of some texts; the first word of each text, and past the last."""
    joined, points, text_ends = pretokens.code_points([t.lower() for t in texts])
    kinds = pretokens.char_classes()[points]
    inside = (kinds == pretokens.LETTER) | (kinds == pretokens.NUMBER)
    change = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = change[::2], change[1::2]
    return pretokens.span_hashes(points, starts, ends), np.concatenate([[0], np.searchsorted(starts, text_ends)])


def ngrams(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n consecutive words within a text; the position of the first word of each."""
    if len(hashes) < n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    total = len(hashes) - n + 1
    mixed = np.zeros(total, np.uint64)
    for i in range(n):
        mixed = (mixed ^ hashes[i : i + total]) * np.uint64(0x9FB21C651E98DF25 + 2 * i)
        mixed ^= mixed >> np.uint64(29)
    whole = np.ones(total, bool)
    for end in first[1:-1]:
        whole[max(0, end - n + 1) : min(end, total)] = False
    at = np.flatnonzero(whole)
    return mixed[at], at
