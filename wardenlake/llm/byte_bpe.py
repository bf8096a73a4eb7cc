"""Byte-level BPE encoding and decoding by ranks.

A text is split by the GPT-2 pattern; merges never cross a match, so each distinct match is encoded once
per worker and block: all matches not seen before form a small corpus over which the merges are replayed
in rank order (`merges.Replay`). What a worker remembers is bounded and no part of the result.

Nulls encode like empty texts, to no ids. Other columns stay as they are. The ids come as BINARY,
little-endian unsigned 32-bit numbers; `ids_array` gives them as an array.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wardenlake.llm import merges, pretokens


@functools.cache
def load_ranks(path: str) -> dict[bytes, int]:
    """token -> rank of a rank file, one `base64 rank` a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Encoder:
    """Ids of many texts at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.replay = merges.Replay(merges.rank_pairs(ranks))
        self.ranks = ranks
        self.memo = pretokens.Memo(self._solve)

    def _solve(self, strings: list[str]) -> list[list[int]]:
        words = [s.encode() for s in strings]
        found = [self.ranks.get(w) for w in words]
        rest = [w for w, x in zip(words, found) if x is None]
        sizes = np.fromiter(map(len, rest), np.int64, len(rest))
        left, counts = self.replay.run(self.single[np.frombuffer(b"".join(rest), np.uint8)], sizes)
        left, ends, at = left.tolist(), np.cumsum(counts).tolist(), 0
        merged = []
        for end in ends:
            merged.append(left[at:end])
            at = end
        merged = iter(merged)
        return [next(merged) if x is None else [x] for x in found]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, little-endian unsigned 32-bit."""
        out = [b""] * len(texts)
        for parts, owners in pretokens.pieces(texts):
            chunk = pretokens.byte_level(parts)
            ids, sizes = self.memo.expand(self.memo.slots_of(chunk))
            ends = np.concatenate([[0], np.cumsum(sizes)])[chunk.first] * 4
            raw = ids.astype("<u4").tobytes()
            for owner, start, end in zip(owners.tolist(), ends[:-1].tolist(), ends[1:].tolist()):
                out[owner] += raw[start:end]
        return out


class Decoder:
    """Bytes of many id lists at once."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values()) + 1
        by_id: list[bytes | None] = [None] * size
        for token, rank in ranks.items():
            by_id[rank] = token
        self.known = np.array([t is not None for t in by_id])
        self.sizes = np.array([len(t or b"") for t in by_id], np.int64)
        self.at = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(t or b"" for t in by_id), np.uint8)

    def decode(self, raw: list[bytes | None]) -> list[bytes]:
        out, at, room = [], 0, 1 << 20
        while at < len(raw):
            upto, total = at, 0
            while upto < len(raw) and (upto == at or total + len(raw[upto] or b"") <= room):
                total += len(raw[upto] or b"")
                upto += 1
            ids = np.frombuffer(b"".join(x or b"" for x in raw[at:upto]), "<u4").astype(np.int64)
            if len(ids) and (ids.max() >= len(self.sizes) or not self.known[ids].all()):
                raise ValueError("an id isn't in the vocabulary")
            sizes = self.sizes[ids]
            text = pretokens.ragged(self.bytes, self.at[ids], sizes).tobytes()
            ends = np.concatenate([[0], np.cumsum(sizes)])
            cuts = ends[np.cumsum([0] + [len(x or b"") // 4 for x in raw[at:upto]])].tolist()
            out += [text[s:e] for s, e in zip(cuts[:-1], cuts[1:])]
            at = upto
        return out


@functools.cache
def _encoder(path: str) -> Encoder:
    return Encoder(load_ranks(path))


@functools.cache
def _decoder(path: str) -> Decoder:
    return Decoder(load_ranks(path))


def encode(text: str | Column, ranks_path: str) -> Column:
    """The ids of a STRING column as BINARY."""

    @F.arrow_udf("binary")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(_encoder(ranks_path).encode(batch.to_pylist()), pa.binary())

    return ids(text)


def decode(ids: str | Column, ranks_path: str) -> Column:
    """The bytes that BINARY ids stand for. Ids of a cut text may end within a character."""

    @F.arrow_udf("binary")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(_decoder(ranks_path).decode(batch.to_pylist()), pa.binary())

    return decoded(ids)


def ids_array(ids: str | Column) -> Column:
    """BINARY ids as an array of INT."""

    @F.arrow_udf("array<int>")
    def listed(batch: pa.Array) -> pa.Array:
        return pa.array([None if x is None else np.frombuffer(x, "<i4") for x in batch.to_pylist()], pa.list_(pa.int32()))

    return listed(ids)


def round_trip(text: str | Column, ranks_path: str) -> Column:
    """(ids, decoded) of a STRING column: `encode`, and `decode` of what it gave, in one worker."""

    @F.arrow_udf("struct<ids: binary, decoded: binary>")
    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            ids = _encoder(ranks_path).encode(batch.to_pylist())
            decoded = _decoder(ranks_path).decode(ids)
            yield pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())], ["ids", "decoded"])

    return coded(text)


def round_trip_digests(docs: DataFrame, ranks_path: str) -> DataFrame:
    """Per document: doc_id, n_tokens, and the digests of its ids and of what they decode to. Repeated rows stay."""
    coded = docs.select("doc_id", round_trip("text", ranks_path).alias("coded"))
    return coded.select(
        "doc_id",
        F.floor(F.octet_length("coded.ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("coded.ids", 256).alias("ids_sha256"),
        F.sha2("coded.decoded", 256).alias("decoded_sha256"),
    )
