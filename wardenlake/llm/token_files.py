"""Token files: ids in patched frame-of-reference blocks.

A file holds the ids of documents in ascending doc_id order, in blocks of 4,096. A block stores its
minimum, the differences to it packed at the width that holds nine tenths of them, and the high bits of
the others with their positions (exceptions). A footer has the byte offset of every block, so a reader fetches
any span of tokens without what is before it, and the key and the number of tokens of every document.

    magic | blocks of ids | blocks of document sizes | keys | null keys | block starts | counts | magic

Files are named after the range of keys they hold; their order is that of the corpus.
Documents without text are as empty ones: the end id alone. A null key comes first. Rows of equal keys
stand next to each other, ordered by their text.
"""

from __future__ import annotations

import functools
import os
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from wardenlake.functions.storage import new_folder
from wardenlake.llm import binary_files, pretokens, ranges

MAGIC = b"PFORTOK1"
BLOCK = 4096
LANES = 64
KEPT_SHARE = 0.9
AT_ONCE = 256
HEAD = struct.Struct("<IBHH")
TAIL = struct.Struct("<QQQQQQ8s")


# ---------------------------------------------------------------------------------------------
# blocks


def _pack(rows: np.ndarray, width: int) -> np.ndarray:
    """(m, BLOCK) numbers below 2^width -> (m, width, LANES) words: value k of a lane starts at bit k * width."""
    values = rows.reshape(len(rows), BLOCK // LANES, LANES).astype(np.uint64)
    words = np.zeros((len(rows), width, LANES), np.uint64)
    for k in range(BLOCK // LANES):
        word, bit = divmod(k * width, 64)
        words[:, word] |= values[:, k] << np.uint64(bit)
        if bit + width > 64:
            words[:, word + 1] |= values[:, k] >> np.uint64(64 - bit)
    return words


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    values = np.empty((len(words), BLOCK // LANES, LANES), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for k in range(BLOCK // LANES):
        word, bit = divmod(k * width, 64)
        got = words[:, word] >> np.uint64(bit)
        if bit + width > 64:
            got = got | words[:, word + 1] << np.uint64(64 - bit)
        values[:, k] = got & mask
    return values.reshape(len(words), BLOCK)


def encode_blocks(values: np.ndarray) -> list[bytes]:
    """One byte string for each block of an array of unsigned 32-bit numbers."""
    if not len(values):
        return []
    short = -len(values) % BLOCK
    rows = np.append(values, np.full(short, values[-1], np.uint32)).reshape(-1, BLOCK).astype(np.uint32)
    if short:
        rows[-1, BLOCK - short :] = rows[-1, : BLOCK - short].min()
    least = rows.min(axis=1)
    rows = rows - least[:, None]
    kth = int(KEPT_SHARE * (BLOCK - 1))
    widths = np.frexp(np.partition(rows, kth, axis=1)[:, kth].astype(np.float64))[1]  # bits of the percentile
    out: list[bytes] = [b""] * len(rows)
    for width in np.unique(widths).tolist():
        these = np.flatnonzero(widths == width)
        group = rows[these]
        high = group >> np.uint32(width) if width < 32 else np.zeros_like(group)
        packed = _pack(group & np.uint32((1 << width) - 1), width) if width else None
        for i, block in enumerate(these.tolist()):
            odd = np.flatnonzero(high[i])
            n = BLOCK - short if block == len(rows) - 1 else BLOCK
            out[block] = b"".join(
                (
                    HEAD.pack(int(least[block]), width, len(odd), n),
                    packed[i].tobytes() if width else b"",
                    odd.astype("<u2").tobytes(),
                    high[i][odd].astype("<u4").tobytes(),
                )
            )
    return out


def decode_blocks(blocks: list[bytes]) -> np.ndarray:
    """The numbers of consecutive blocks."""
    rows = np.empty((len(blocks), BLOCK), np.uint32)
    heads = [HEAD.unpack_from(b) for b in blocks]
    by_width: dict[int, list[int]] = {}
    for i, (_, width, _, _) in enumerate(heads):
        by_width.setdefault(width, []).append(i)
    for width, these in by_width.items():
        if width:
            size = width * LANES
            words = np.stack([np.frombuffer(blocks[i], "<u8", size, HEAD.size) for i in these])
            rows[these] = _unpack(words.reshape(-1, width, LANES), width)
        else:
            rows[these] = 0
    for i, (least, width, odd, _) in enumerate(heads):
        if odd:
            at = HEAD.size + width * LANES * 8
            where = np.frombuffer(blocks[i], "<u2", odd, at)
            rows[i, where] |= np.frombuffer(blocks[i], "<u4", odd, at + 2 * odd) << np.uint32(width)
        rows[i] += np.uint32(least)
    flat = rows.reshape(-1)
    return flat[: len(flat) - BLOCK + heads[-1][3]] if blocks else flat


# ---------------------------------------------------------------------------------------------
# files


class Writer:
    """Appends documents to a file; holds the ids of at most a few hundred blocks."""

    def __init__(self, out):
        self.out, self.at = out, out.write(MAGIC) or len(MAGIC)
        self.starts, self.keys, self.sizes = [], [], []
        self.waiting, self.room = [], AT_ONCE * BLOCK
        self.tokens = 0

    def append(self, key: int | None, ids: np.ndarray) -> None:
        self.keys.append(key)
        self.sizes.append(len(ids))
        self.tokens += len(ids)
        self.waiting.append(ids)
        self.room -= len(ids)
        if self.room <= 0:
            self._flush(False)

    def _write(self, blocks: list[bytes]) -> None:
        for block in blocks:
            self.starts.append(self.at)
            self.at += len(block)
        self.out.write(b"".join(blocks))

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.empty(0, np.uint32)
        whole = len(ids) if last else len(ids) // BLOCK * BLOCK
        self._write(encode_blocks(ids[:whole]))
        self.waiting = [ids[whole:]]
        self.room = AT_ONCE * BLOCK - (len(ids) - whole)

    def close(self) -> None:
        self._flush(True)
        id_blocks = len(self.starts)
        self._write(encode_blocks(np.array(self.sizes, np.uint32)))
        footer = self.at
        self.out.write(np.array([k or 0 for k in self.keys], "<i8").tobytes())
        self.out.write(np.packbits(np.array([k is None for k in self.keys], bool)).tobytes())
        self.out.write(np.array([*self.starts, footer], "<u8").tobytes())
        self.out.write(TAIL.pack(footer, len(self.keys), self.tokens, id_blocks, len(self.starts), 0, MAGIC))


class Reader:
    def __init__(self, uri: str):
        self.file = binary_files.random_access(uri)
        size = self.file.size()
        tail = self.file.read_at(TAIL.size, size - TAIL.size)
        footer, docs, self.tokens, self.id_blocks, blocks, _, magic = TAIL.unpack(tail)
        if magic != MAGIC:
            raise ValueError(f"{uri} isn't a token file")
        rest = self.file.read_at(size - TAIL.size - footer, footer)
        keys = np.frombuffer(rest, "<i8", docs)
        flags = -(-docs // 8)
        nulls = np.unpackbits(np.frombuffer(rest, np.uint8, flags, 8 * docs), count=docs).astype(bool)
        self.keys = [None if gone else key for key, gone in zip(keys.tolist(), nulls.tolist())]
        self.starts = np.frombuffer(rest, "<u8", blocks + 1, 8 * docs + flags).astype(np.int64)
        self.sizes = self._blocks(self.id_blocks, blocks).astype(np.int64)
        self.ends = np.cumsum(self.sizes)

    def _blocks(self, first: int, past: int) -> np.ndarray:
        if first >= past:
            return np.empty(0, np.uint32)
        starts = self.starts[first : past + 1]
        raw = self.file.read_at(int(starts[-1] - starts[0]), int(starts[0]))
        cuts = (starts - starts[0]).tolist()
        return decode_blocks([raw[s:e] for s, e in zip(cuts[:-1], cuts[1:])])

    def span(self, start: int, end: int) -> np.ndarray:
        """The tokens [start, end) of the file; reads the blocks that hold them and no others."""
        first, past = start // BLOCK, -(-end // BLOCK)
        return self._blocks(first, past)[start - first * BLOCK : end - first * BLOCK] if end > start else np.empty(0, np.uint32)

    def document(self, i: int) -> np.ndarray:
        return self.span(int(self.ends[i] - self.sizes[i]), int(self.ends[i]))

    def chunks(self) -> Iterator[tuple[int, np.ndarray]]:
        """(position of the first token, tokens), from the first block to the last, a few hundred at a time."""
        for first in range(0, self.id_blocks, AT_ONCE):
            yield first * BLOCK, self._blocks(first, min(first + AT_ONCE, self.id_blocks))


# ---------------------------------------------------------------------------------------------
# the corpus


class LibraryEncoder:
    """Ids of many texts by the tokenizers library, which encodes every distinct pre-token once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark spreads the work
        import regex
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.special, self.starts = special, {s[:2] for s in special}
        self.pattern = regex.compile("(" + "|".join(map(regex.escape, special)) + ")")
        self.memo = pretokens.Memo(self._solve)

    def _solve(self, strings: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(strings, add_special_tokens=False)]

    def encode(self, texts: list[str | None], end: int | None = None) -> list[np.ndarray]:
        """The ids of each text, followed by `end` if it is given."""
        segments, owner, marks = [], [], {}
        for i, text in enumerate(texts):
            parts = [text or ""]
            if any(s in parts[0] for s in self.starts):
                parts = self.pattern.split(parts[0])
            for part in parts[::2]:
                segments.append(part)
                owner.append(i)
            for at, part in enumerate(parts[1::2]):
                marks[len(segments) - len(parts[::2]) + at] = self.special[part]
        out: list[list[np.ndarray]] = [[] for _ in texts]
        done = 0  # segments whose mark has been written
        for parts, numbers in pretokens.pieces(segments):
            chunk = pretokens.byte_level(parts)
            ids, sizes = self.memo.expand(self.memo.slots_of(chunk))
            cuts = np.concatenate([[0], np.cumsum(sizes)])[chunk.first].tolist()
            ids = ids.astype(np.uint32)
            for number, start, stop in zip(numbers.tolist(), cuts[:-1], cuts[1:]):
                while marks and done < number:
                    if done in marks:
                        out[owner[done]].append(np.array([marks.pop(done)], np.uint32))
                    done += 1
                out[owner[number]].append(ids[start:stop])
        last = np.empty(0, np.uint32) if end is None else np.array([end], np.uint32)
        return [np.concatenate([*parts, last]) for parts in out]


@functools.cache
def library_encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def write_corpus(docs: DataFrame, folder: str, tokenizer: str, end: int = 0) -> DataFrame:
    """Write the ids of all documents, each followed by `end`; one row per file: number, path, docs, tokens, start.

    One exchange, by ranges of doc_id; a task encodes and writes its range as a stream.
    """
    splits = ranges.key_splits(docs, "doc_id", ranges.wanted_ranges(docs, "text"))
    placed = ranges.with_range(docs.select("doc_id", "text"), "doc_id", splits, "file_no")
    sorted_docs = placed.repartitionById(ranges.count_ranges(splits), "file_no").sortWithinPartitions("file_no", "doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, rows = library_encoder(tokenizer), _runs(batches)
        for number, texts in rows:
            path = f"{folder}/tokens-{number:08d}.pfor"
            with binary_files.publish(path) as out:
                writer = Writer(out)
                for keys, part in texts:
                    for key, ids in zip(keys, encoder.encode(part, end)):
                        writer.append(key, ids)
                writer.close()
            yield pa.RecordBatch.from_pydict(
                {"file_no": [number], "path": [path], "docs": [len(writer.keys)], "tokens": [writer.tokens]}
            )

    files = sorted_docs.mapInArrow(write, "file_no long, path string, docs long, tokens long")
    files.write.parquet(f"{folder}/manifest.parquet")
    manifest = docs.sparkSession.read.parquet(f"{folder}/manifest.parquet")
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    return manifest.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator]]:
    """(file number, batches of (keys, texts)) of rows sorted by file number; each must be used up before the next."""
    ahead: list[tuple[int, list, list]] = []

    def parts() -> Iterator[tuple[int, list, list]]:
        for batch in batches:
            numbers = batch.column("file_no").to_numpy()
            cuts = [0, *(np.flatnonzero(numbers[1:] != numbers[:-1]) + 1).tolist(), len(numbers)]
            for s, e in zip(cuts[:-1], cuts[1:]):
                if e > s:
                    some = batch.slice(s, e - s)
                    yield int(numbers[s]), some.column("doc_id").to_pylist(), some.column("text").to_pylist()

    source = parts()

    def of(number: int) -> Iterator[tuple[list, list]]:
        while ahead or (nxt := next(source, None)) is not None:
            part = ahead.pop() if ahead else nxt
            if part[0] != number:
                ahead.append(part)
                return
            yield part[1], part[2]

    while ahead or (nxt := next(source, None)) is not None:
        if not ahead:
            ahead.append(nxt)
        yield ahead[0][0], of(ahead[0][0])


def read_corpus(manifest: DataFrame, value: Callable[[bytes, object], object], seed: object, name: str, kind: str) -> DataFrame:
    """Per document from the files: doc_id, start, n_tokens, and `name`: a fold of `value` over its ids.

    value(ids as little-endian unsigned 32-bit numbers, value so far) is called for consecutive parts of a document.
    """
    schema = f"doc_id long, start long, n_tokens long, {name} {kind}"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                reader = Reader(path)
                found, doc = [seed] * len(reader.keys), 0
                begins, ends = (reader.ends - reader.sizes).tolist(), reader.ends.tolist()
                for first, ids in reader.chunks():
                    raw, past = memoryview(ids.astype("<u4").tobytes()), first + len(ids)
                    while doc < len(ends) and begins[doc] < past:
                        at, stop = max(begins[doc], first) - first, min(ends[doc], past) - first
                        if stop > at:
                            found[doc] = value(raw[4 * at : 4 * stop], found[doc])
                        if ends[doc] > past:
                            break  # goes on in the next blocks
                        doc += 1
                starts = start + reader.ends - reader.sizes
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": pa.array(reader.keys, pa.int64()), "start": starts, "n_tokens": reader.sizes, name: found}
                )

    files = manifest.select("path", "start", "file_no")
    return files.repartition(max(1, manifest.count()), "file_no").mapInArrow(read, schema)


def coded_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the corpus, read it back: doc_id, start, n_tokens and the CRC-32 of the ids of every document."""
    manifest = write_corpus(docs, f"{new_folder(docs.sparkSession)}/tokens", tokenizer)
    return read_corpus(manifest, zlib.crc32, 0, "ids_crc32", "long")
