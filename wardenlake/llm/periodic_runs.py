"""Runs of words that repeat with a period, found by matching diagonals, and texts with the repeats taken out.

A diagonal is a lag: the word at i continues it when it equals the word `lag` places before. Following every
earlier occurrence of every word would be quadratic where one word fills a text, so the occurrences are those of windows
of 1, 2, 4, 8 ... words, and only the nearest earlier one counts. That loses no run: a run of smallest period q has
at least 4 q words, so it holds windows of between q and 2 q - 1 words, and such a window's nearest earlier
occurrence inside the run is exactly q back (a nearer one would give the run a smaller period). So each window has one
active lag; consecutive windows with the same lag lengthen its match, and a match that ends with enough words is
a run. It needs no extension: every window inside the run is in the match. A window of 2 L words is looked at only if
both its halves repeat in the text, so natural text is done after two or three sizes; the longest texts take
n log n steps.

Words are runs of bytes other than space and \\t \\n \\v \\f \\r. Texts are taken whole; a worker holds about sixty bytes for
each word of a batch of 4 MB, or of one text that is longer. Null, empty and blank texts have no words and no runs.
Every row is one result, also with a null or repeated id.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wardenlake.llm.pretokens import mix

LEAST_WORDS = 6
LEAST_PERIODS = 4
MULTIPLY = np.uint64(0x9E3779B97F4A7C15)

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUN_COLUMNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def find_runs(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start (from the first word of all texts), length and period of every run, by start, then period.

    `ids` are the word numbers of some texts, one text after the other; `first` where each begins, and the end.
    """
    n = len(ids)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    left = first[1:][owner] - np.arange(n)
    size = np.diff(first)[owner]
    hashes = mix(ids.astype(np.uint64) + (owner.astype(np.uint64) << np.uint64(32)))
    alive, window, found = np.flatnonzero(size >= LEAST_WORDS), 1, []
    while len(alive):
        order = alive[np.argsort(hashes[alive], kind="stable")]
        same = hashes[order[1:]] == hashes[order[:-1]]
        now, before = order[1:][same], order[:-1][same]
        found.append(_ended_matches(now, now - before, window))
        repeats = np.zeros(n, bool)
        repeats[now] = repeats[before] = True
        longer = np.flatnonzero(repeats & (left >= 2 * window) & (size >= LEAST_PERIODS * (window + 1)))
        alive = longer[repeats[longer + window]]
        hashes[alive] = mix(hashes[alive] * MULTIPLY + mix(hashes[alive + window]))
        window *= 2
    start, length, period = (np.concatenate([f[k] for f in found] or [np.empty(0, np.int64)]) for k in range(3))
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _ended_matches(at: np.ndarray, lag: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs whose period this window size is for; windows begin at `at` and were last seen `lag` before."""
    fits = (lag > window // 2) & (lag <= window)
    at, lag = at[fits], lag[fits]
    order = np.argsort(at)
    at, lag = at[order], lag[order]
    ends = np.flatnonzero(np.append((np.diff(at) != 1) | (np.diff(lag) != 0), True)) if len(at) else np.empty(0, np.int64)
    begins = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    period = lag[begins]
    start = at[begins] - period
    length = at[ends] + window - start
    enough = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
    return start[enough], length[enough], period[enough]


def repeated_words(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of n words are in a run after its first period."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, start + period, 1)
    np.add.at(steps, start + length, -1)
    return np.cumsum(steps[:-1]) > 0


def _collapse(batches: Iterator[pa.RecordBatch], edit: Callable[[int | None, list[bytes]], list[bytes]] | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc_ids = batch.column("doc_id").to_pylist()
        texts = [(text or b"").split() for text in batch.column("text").to_pylist()]
        if edit:
            texts = [edit(doc_id, words) for doc_id, words in zip(doc_ids, texts)]
        numbers: dict[bytes, int] = {}
        first = np.concatenate([[0], np.cumsum([len(words) for words in texts], dtype=np.int64)])
        ids = np.fromiter((numbers.setdefault(w, len(numbers)) for words in texts for w in words), np.int64, first[-1])
        start, length, period = find_runs(ids, first)
        bounds = np.searchsorted(start, first)
        gone = repeated_words(len(ids), start, length, period)
        collapsed = []
        for k, words in enumerate(texts):
            if bounds[k] < bounds[k + 1]:
                words = [words[i] for i in np.flatnonzero(~gone[first[k] : first[k + 1]]).tolist()]
            collapsed.append(b" ".join(words))
        owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
        spans = pa.StructArray.from_arrays([pa.array(x) for x in (start - first[owner], length, period)], fields=list(RUN))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(np.diff(first)),
                pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), spans),
                pa.array(collapsed, pa.binary()).cast(pa.string()),
            ],
            ["doc_id", "n_words", "runs", "collapsed"],
        )


def collapse_runs(docs: DataFrame, edit: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and collapsed text of every document.

    The collapsed text has the words that no run holds after its first period, joined by one space.
    `edit` may change the words of a document before.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(lambda batches: _collapse(batches, edit), RUN_COLUMNS)


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period; of equal ones the first by start, then period."""
    def earlier(a: Column, b: Column) -> Column:
        one, two = a["length"] * b["period"], b["length"] * a["period"]
        by_place = F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["period"] - b["period"])
        order = F.when(one != two, two - one).otherwise(by_place)
        return F.signum(order).cast("int")

    return F.get(F.array_sort(runs, earlier), F.lit(0))


def with_periodic_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Every tenth document by the crc32 of its id repeats words from some place on; one without an id doesn't."""
    if doc_id is None or not words:
        return words
    g, tenth = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if tenth:
        return words
    n = len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def run_digests(docs: DataFrame) -> DataFrame:
    """Number of runs, the strongest run and digests of runs and collapsed text, of documents with periodic tails."""
    found = collapse_runs(docs, with_periodic_tail).withColumn("best", strongest(F.col("runs")))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    lines = F.concat_ws("", F.transform(line, lambda text: F.concat(text, F.lit("\n"))))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )
