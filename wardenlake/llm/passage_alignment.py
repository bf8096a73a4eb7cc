"""Benchmark decontamination: seeds that no passage over the threshold can do without, then Smith-Waterman alignment.

1. One pass over the corpus counts the words of the test items.
2. Seeds of an item are all its runs of three words and its rarest words. An alignment with m matched words, c matched
   runs of three and e other steps (edits, insertions, omissions) has e + 1 >= (m - c) / 2, so a score of 2m - e >= s needs
   3m + c >= 2s - 2. The item's most frequent words are left out as far as they can't reach that alone: every passage
   that scores `THRESHOLD` holds a seed, whichever words are edited. Counts only decide which words are cheap to look for.
3. A second pass joins texts to items on the seeds. Such a passage has e <= 2 x words of the item - s, so it lies in a window of
   known length around each of its seeds; windows that overlap are one candidate. Those with too few words of
   the item for the bound in 2 are dropped.
4. Word-level Smith-Waterman (match 2, other -1, gap -1) scores each candidate. score / (2 x words of the item) tells how
   much of the item is there; at least `THRESHOLD` is contamination, through edits, insertions and omissions. It is
   the score over the whole text.

Test items go to the tasks in blocks of at most `BLOCK_BYTES` of text (measured), each block with passes of its own;
documents never move. Words are lower-cased runs of letters and digits. Items of one or two words must be there whole; items that
are null or have no words are in no text. Rows of `benchmark` with equal ids count as items of their own; a document's best
passage for an id is reported. Rows of documents that repeat id and text are one document; others never merge, with or without an id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wardenlake.llm import pretokens
from wardenlake.llm.word_ngrams import ngrams, words

SEED_WORDS = 3
THRESHOLD = 0.5
BLOCK_BYTES = 4 << 20
CELLS_AT_ONCE = 1 << 21
MATCH, OTHER, GAP = 2, -1, -1


@dataclass
class Seeds:
    """Places of items to look for, sorted by hash."""

    hashes: np.ndarray
    places: np.ndarray  # word position, in all items together
    owner: np.ndarray  # the item

    @classmethod
    def of(cls, hashes: np.ndarray, places: np.ndarray, first: np.ndarray) -> Seeds:
        order = np.argsort(hashes, kind="stable")
        return cls(hashes[order], places[order], np.searchsorted(first, places[order], side="right") - 1)

    def hits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of hashes and of the seeds that equal them."""
        low = np.searchsorted(self.hashes, hashes, side="left")
        counts = np.searchsorted(self.hashes, hashes, side="right") - low
        hit = np.flatnonzero(counts)
        return np.repeat(hit, counts[hit]), pretokens.ragged(np.arange(len(self.hashes)), low[hit], counts[hit])


@dataclass
class Items:
    """Test items of one block, as arrays."""

    ids: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    grams: Seeds
    rare: Seeds
    need: np.ndarray  # 3 x matched words + matched runs of three, at least, in a passage over the threshold
    reach: np.ndarray  # other steps, at most, in such a passage
    threshold: np.ndarray  # share that counts
    words: np.ndarray  # sorted distinct hashes

    def words_of(self, item: int) -> np.ndarray:
        return self.hashes[self.first[item] : self.first[item + 1]]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for parts, owners in pretokens.pieces(batch.column("text").to_pylist(), cut=False):
            hashes, first = words(parts)
            yield batch, owners, hashes, first


def count_words(docs: DataFrame, wanted: np.ndarray) -> np.ndarray:
    """How often each wanted word (sorted hashes) occurs in all texts."""
    sent = docs.sparkSession.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, found = sent.value, np.zeros(len(sent.value), np.int64)
        for _, _, hashes, _ in _rows(batches):
            place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            found += np.bincount(place[known[place] == hashes], minlength=len(known))
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_pydict({"word": some, "n": found[some]})

    counted = docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    often = np.zeros(len(wanted), np.int64)
    for r in counted.toLocalIterator():  # at most as many as the block has
        often[r["word"]] = r["n"]
    return often


def choose_seeds(ids: list, texts: list[str], docs: DataFrame, threshold: float = THRESHOLD) -> Items:
    hashes, first = words(texts)
    size = np.diff(first)
    grams, at = ngrams(hashes, first, SEED_WORDS)
    distinct, number = np.unique(hashes, return_inverse=True)
    often = count_words(docs, distinct)[number] if len(hashes) else np.zeros(0, np.int64)
    share = np.where(size < SEED_WORDS, 1.0, threshold)
    least = MATCH * share * size - 1e-6  # scores are whole numbers
    need, reach = 2 * least - 2, np.maximum(0, np.floor(MATCH * size - least)).astype(np.int64)
    left_out = np.clip(np.ceil(need / 3).astype(np.int64) - 1, 0, size)
    owner = np.repeat(np.arange(len(size)), size)
    order = np.lexsort((-often, owner))
    rank = np.arange(len(hashes)) - first[:-1][owner]
    rare = np.sort(order[rank >= left_out[owner]])
    return Items(
        np.array(ids, object), hashes, first, Seeds.of(grams, at, first), Seeds.of(hashes[rare], rare, first), need, reach, share, distinct
    )


# ---------------------------------------------------------------------------------------------
# alignment


def align(items: np.ndarray, passages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment scores of rows of words, and the passage position past the end of each. 0 pads."""
    rows, width = passages.shape
    h = np.zeros((rows, width + 1), np.int32)
    best, end = np.zeros(rows, np.int32), np.zeros(rows, np.int64)
    slope = np.arange(width + 1, dtype=np.int32) * -GAP
    every = np.arange(rows)
    for i in range(items.shape[1]):
        word = items[:, i : i + 1]
        diagonal = h[:, :-1] + np.where((passages == word) & (word != 0), MATCH, OTHER)
        after = np.maximum(h + GAP, 0)
        after[:, 1:] = np.maximum(after[:, 1:], diagonal)
        after = np.maximum.accumulate(after + slope, axis=1) - slope  # runs of words only the passage has
        after[word[:, 0] == 0] = h[word[:, 0] == 0]
        h = after
        top = h.argmax(axis=1)
        value = h[every, top]
        better = value > best
        best[better], end[better] = value[better], top[better]
    return best, end


def _candidates(items: Items, hashes: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(text, item, from word, to word): what passages around seed hits can span, overlapping ones together."""
    grams, at = ngrams(hashes, first, SEED_WORDS)
    hit, seed = items.grams.hits(grams)
    word, rare = items.rare.hits(hashes)
    run = np.arange(len(hit) + len(word)) < len(hit)
    place = np.concatenate([items.grams.places[seed], items.rare.places[rare]])
    item = np.concatenate([items.grams.owner[seed], items.rare.owner[rare]])
    word = np.concatenate([at[hit], word])
    if not len(word):
        return []
    diagonal = word - (place - items.first[item])  # where the item would begin
    text = np.searchsorted(first, word, side="right") - 1
    order = np.lexsort((diagonal, item, text))
    text, item, diagonal, run = text[order], item[order], diagonal[order], run[order]
    size = np.diff(items.first)
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (np.diff(diagonal) > (size + 2 * items.reach)[item[1:]])
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(text)) - 1
    runs = pretokens.sums(run, np.append(heads, len(text)))
    text, item = text[heads], item[heads]
    start = np.maximum(first[text], diagonal[heads] - items.reach[item])
    stop = np.minimum(first[text + 1], diagonal[tails] + size[item] + items.reach[item])
    kept = 3 * _shared(items, hashes, item, start, stop) + runs >= items.need[item]
    return list(zip(text[kept].tolist(), item[kept].tolist(), start[kept].tolist(), stop[kept].tolist()))


def _shared(items: Items, hashes: np.ndarray, item: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """How many words of each item are among the words [start, stop)."""
    number = np.minimum(np.searchsorted(items.words, hashes), len(items.words) - 1)
    known = np.flatnonzero(items.words[number] == hashes)
    # (word, position) as one sorted number; the last one is past all that are looked for
    room = len(hashes) + 1
    there = np.append(np.sort(number[known] * room + known), len(items.words) * room)
    of_item = np.searchsorted(items.words, items.hashes)
    size = np.diff(items.first)[item]
    total, ends = np.zeros(len(item), np.int64), np.cumsum(size)
    at = 0
    while at < len(item):
        upto = max(at + 1, int(np.searchsorted(ends, ends[at] - size[at] + CELLS_AT_ONCE // 8, side="right")))
        part = slice(at, upto)
        mine = pretokens.ragged(of_item, items.first[item[part]], size[part]) * room
        owner = np.repeat(np.arange(upto - at), size[part])
        next_one = there[np.searchsorted(there, mine + start[part][owner])]
        total[part] = np.bincount(owner[next_one < mine + stop[part][owner]], minlength=upto - at)
        at = upto
    return total


def _score(items: Items, hashes: np.ndarray, found: list[tuple[int, int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Scores of candidates as shares of the item (0 below what counts), and their last words; similar sizes are aligned together."""
    scores, ends = np.zeros(len(found)), np.zeros(len(found), np.int64)
    sizes = np.diff(items.first)
    order = sorted(range(len(found)), key=lambda c: (sizes[found[c][1]], found[c][3] - found[c][2]))
    at = 0
    while at < len(order):
        upto = at
        while upto < len(order):
            longest = max(found[order[upto]][3] - found[order[upto]][2], 1)
            if upto > at and (upto + 1 - at) * (longest + 1) > CELLS_AT_ONCE // 8:
                break
            upto += 1
        group = order[at:upto]
        wide = max(found[c][3] - found[c][2] for c in group)
        tall = max(sizes[found[c][1]] for c in group)
        left, right = np.zeros((len(group), tall), np.uint64), np.zeros((len(group), wide), np.uint64)
        for row, c in enumerate(group):
            _, item, start, stop = found[c]
            left[row, : sizes[item]] = items.words_of(item)
            right[row, : stop - start] = hashes[start:stop]
        best, end = align(left, right)
        for row, c in enumerate(group):
            scores[c] = best[row] / (MATCH * sizes[found[c][1]])
            ends[c] = found[c][2] + end[row]
        at = upto
    item = np.array([c[1] for c in found], np.int64)
    return np.where(scores >= items.threshold[item], scores, 0.0), ends


def _blocks(benchmark: DataFrame, size: int, least_words: int = 1) -> Iterator[tuple[list, list[str]]]:
    """The test items of so many words at least, in blocks of at most `size` bytes of text; one block at a time is on the driver."""
    ids, texts, room = [], [], size
    for row in benchmark.select("item_id", "text").where("text IS NOT NULL").orderBy("item_id", "text").toLocalIterator():
        if least_words > 1 and len(words([row["text"]])[0]) < least_words:
            continue
        need = len(row["text"].encode())
        if need > room and ids:
            yield ids, texts
            ids, texts, room = [], [], size
        ids.append(row["item_id"])
        texts.append(row["text"])
        room -= need
    if ids:
        yield ids, texts


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, score, last_word: one row for each document and item that it has `threshold` or more of."""
    spark: SparkSession = docs.sparkSession
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_hash long, item_id {benchmark.schema['item_id'].dataType.simpleString()}, score double, last_word long"
    kinds = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("last_word", pa.int64())])
    results = []
    for ids, texts in _blocks(benchmark, block_bytes):
        items = choose_seeds(ids, texts, docs, threshold)
        if not len(items.rare.hashes):
            continue
        sent = spark.sparkContext.broadcast(items)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            known = sent.value
            for batch, owners, hashes, first in _rows(batches):
                found = _candidates(known, hashes, first)
                scores, ends = _score(known, hashes, found)
                keys, versions, best = batch.column("doc_id"), batch.column("text_hash"), {}
                for (text, item, _, _), score, end in zip(found, scores.tolist(), ends.tolist()):
                    pair = (int(owners[text]), known.ids[item])
                    if score >= threshold and score > best.get(pair, (0, 0))[0]:
                        best[pair] = (score, int(end - first[text]))
                rows = [{"doc_id": keys[o].as_py(), "text_hash": versions[o].as_py(), "item_id": i, "score": s, "last_word": e} for (o, i), (s, e) in best.items()]
                yield pa.RecordBatch.from_pylist(rows, kinds)

        results.append(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(search, schema))
    if not results:
        return spark.createDataFrame([], schema).drop("text_hash")
    union = results[0]
    for more in results[1:]:
        union = union.unionByName(more)
    best = F.max(F.struct("score", "last_word")).alias("best")
    return union.groupBy("doc_id", "text_hash", "item_id").agg(best).select("doc_id", "item_id", "best.score", "best.last_word")


def largest_share(text: str | Column, items: Items) -> Column:
    """The largest share of any of the items that a STRING column has, DOUBLE, if it is over the items' threshold; else that or less."""
    sent = SparkSession.active().sparkContext.broadcast(items)

    @F.arrow_udf("double")
    def share(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            most = np.zeros(len(batch))
            for parts, owners in pretokens.pieces(batch.to_pylist(), cut=False):
                hashes, first = words(parts)
                found = _candidates(sent.value, hashes, first)
                scores, _ = _score(sent.value, hashes, found)
                np.maximum.at(most, owners[[c[0] for c in found]] if found else np.empty(0, np.int64), scores)
            yield pa.array(most, pa.float64())

    return share(text)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents that have less than `threshold` of every item, as they are; no row moves.

    Items of fewer than three words tell nothing about where a text is from and reject none.
    """
    kept = docs
    for ids, texts in _blocks(benchmark, block_bytes, SEED_WORDS):
        items = choose_seeds(ids, texts, docs, threshold)
        if len(items.rare.hashes):
            kept = kept.where(largest_share("text", items) < threshold)
    return kept
