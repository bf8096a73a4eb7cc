"""Token counts by whole tokens.

Before any text is read, `prove` replays the merges over every string of the vocabulary and keeps the hashes of
those that come out as one token. A pre-token among them counts 1 without a merge; the merges run over the rest
only, once for each distinct one that a worker has not met yet.

The count of a text is that of the tokenizers library without added special tokens: strings of special
tokens inside a text count 1 each, everything else is normalized (NFC, lower case) and split into words. Nulls
count like empty texts, as 0. Other columns stay as they are.
"""

from __future__ import annotations

import functools
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from wardenlake.llm import merges, pretokens

TOKEN_LIMIT = 2048


def byte_chars() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable ones stand for themselves."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(moved)) for b in range(256)]


class Words:
    """The vocabulary of a word-level BPE file: byte characters, the last one of a word with a suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as lines:
            spec = json.load(lines)
        model = spec["model"]
        vocab, self.suffix = model["vocab"], model["end_of_word_suffix"]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.vocab = [v for v in vocab if v not in self.special]
        pairs, made = {}, {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            pairs.setdefault(vocab[left] << merges.SHIFT | vocab[right], rank)
            made[rank] = vocab[left + right]
        self.replay = merges.Replay(pairs, made)
        chars = byte_chars()
        self.inner = np.array([vocab[c] for c in chars], np.int64)
        self.final = np.array([vocab[c + self.suffix] for c in chars], np.int64)
        self.byte_of = {c: b for b, c in enumerate(chars)}

    def counts(self, words: list[str]) -> np.ndarray:
        """Tokens of each word, by replaying all merges."""
        raw = [w.encode() for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[data]
        last = np.cumsum(sizes)[sizes > 0] - 1
        symbols[last] = self.final[data[last]]
        return self.replay.run(symbols, sizes)[1]

    def whole_words(self) -> list[str]:
        """Vocabulary strings that can be whole words."""
        found = []
        for token in self.vocab:
            if token.endswith(self.suffix):
                try:
                    found.append(bytes(self.byte_of[c] for c in token[: -len(self.suffix)]).decode())
                except UnicodeDecodeError:
                    pass  # a part of a character is never a whole word
        return [w for w in found if w]


@functools.cache
def words_of(path: str) -> Words:
    return Words(path)


@functools.cache
def prove(path: str) -> np.ndarray:
    """Sorted hashes of all words that are one token by themselves."""
    words = words_of(path).whole_words()
    proven = [w for w, n in zip(words, words_of(path).counts(words)) if n == 1]
    joined, points, ends = pretokens.code_points(proven)
    starts = np.concatenate([[0], ends[:-1] + 1])
    return np.sort(pretokens.span_hashes(points, starts, ends))


def normalize(text: str) -> str:
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


class Counter:
    def __init__(self, path: str, proven: np.ndarray):
        self.words, self.proven = words_of(path), proven
        self.special = regex.compile("|".join(map(regex.escape, self.words.special)))
        self.starts = {s[:2] for s in self.words.special}
        self.memo = pretokens.Memo(lambda strings: self.words.counts(strings)[:, None].tolist())

    def count(self, texts: list[str | None]) -> np.ndarray:
        total = np.zeros(len(texts), np.int64)
        segments, owner = [], []
        for i, text in enumerate(texts):
            parts = [text or ""]
            if any(s in parts[0] for s in self.starts):
                parts = self.special.split(parts[0])
                total[i] = len(parts) - 1
            segments += map(normalize, parts)
            owner += [i] * len(parts)
        owner = np.array(owner, np.int64)
        for parts, numbers in pretokens.pieces(segments):
            chunk = pretokens.word_level(parts)
            place = np.minimum(np.searchsorted(self.proven, chunk.hashes), len(self.proven) - 1)
            whole = self.proven[place] == chunk.hashes
            sizes = np.ones(len(whole), np.int64)
            rest = np.flatnonzero(~whole)
            if len(rest):
                some = pretokens.Chunk(chunk.joined, chunk.starts[rest], chunk.ends[rest], chunk.hashes[rest], chunk.first)
                sizes[rest] = self.memo.expand(self.memo.slots_of(some))[0]
            np.add.at(total, owner[numbers], pretokens.sums(sizes, chunk.first))
        return total


@functools.cache
def _counter(path: str) -> Counter:
    return Counter(path, np.empty(0, np.uint64))


def token_count(text: str | Column, path: str) -> Column:
    """Tokens of a STRING column by the vocabulary file at `path`, BIGINT, never null."""
    proven = prove(path)  # at most one number for each vocabulary string

    @F.arrow_udf("bigint")
    def counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = _counter(path)
        counter.proven = proven
        for batch in batches:
            yield pa.array(counter.count(batch.to_pylist()), pa.int64())

    return counts(text)


def count_documents(docs: DataFrame, path: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    counted = docs.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        token_count("text", path).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
