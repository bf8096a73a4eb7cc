"""Quality by ordinal cumulative-link regression on graded ratings.

Ratings form grades: 0 poor, 1 fine but toxic, 2 fine. P(grade <= k) = sigmoid(threshold_k - x . w): all grades share
the weights of the hashed text and differ in ordered thresholds. From them come the expected grade and the tail
probability P(grade >= 2) that documents are selected by.

x has a 1 for every distinct token of a text (runs of letters, single digits, runs of other signs, case kept), for the first
four letters of longer words, and for the classes of three shares (capitals among letters, signs among characters, distinct among all words), hashed into
2^18 places. Places that few rated documents have, or whose documents have grades like the others, get no weight;
an L1 penalty of half a standard error of the pull at the start shrinks the rest.

The model is fitted on about `FIT_ROWS` rated documents, chosen by a hash of the id: bounded, so the driver fits it. Scoring
takes every text whole. Rows of `labels` without an id or a rating don't count; of several ratings of a document
the worst counts. Without any rating nothing is rejected. A null text is as an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wardenlake.llm import pretokens
from wardenlake.llm.batches import sampled

FIT_ROWS = 8192
PLACE_BITS = 18
LEAST_DOCS = 8
STEM = 4
SHRINK = 0.5
ROUNDS = 500
LEAST_PULL = 4.0
GRADES = 3
KEEP_FROM = 0.5


# ---------------------------------------------------------------------------------------------
# features


def _shares(values: np.ndarray, first: np.ndarray, of: np.ndarray) -> np.ndarray:
    return pretokens.sums(values, first) / np.maximum(1, pretokens.sums(of, first))


def features(parts: list[str], owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, place) pairs, sorted and distinct, of consecutive parts of texts."""
    chunk = pretokens.word_level(parts)
    counts = np.diff(chunk.first)
    owner = np.repeat(owners, counts)
    places = (chunk.hashes >> np.uint64(64 - PLACE_BITS)).astype(np.int64)
    keys = owner << PLACE_BITS | places
    points = np.frombuffer(chunk.joined.encode("utf-32-le"), np.uint32)
    kinds = pretokens.char_classes()[points]
    long = np.flatnonzero((chunk.ends - chunk.starts > STEM) & (kinds[chunk.starts] == pretokens.LETTER))
    stems = pretokens.span_hashes(points, chunk.starts[long], chunk.starts[long] + STEM) * np.uint64(3)
    stems = owner[long] << PLACE_BITS | (pretokens.mix(stems) >> np.uint64(64 - PLACE_BITS)).astype(np.int64)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    bounds = np.concatenate([[0], ends])
    letters = kinds == pretokens.LETTER
    capital = letters & (points >= 65) & ((points <= 90) | (points >= 192) & (points <= 222))
    signs = kinds == pretokens.OTHER
    distinct = np.bincount(np.unique(keys) >> PLACE_BITS, minlength=int(owners.max()) + 1)[owners]
    classes = [
        np.minimum(9, 10 * _shares(capital, bounds, letters)),
        np.minimum(9, 20 * _shares(signs, bounds, np.ones(len(signs), bool))),
        np.minimum(9, 10 * distinct / np.maximum(1, counts)) + 10 * np.minimum(4, np.log10(np.maximum(1, counts)).astype(int)),
    ]
    shape = []
    for i, values in enumerate(classes):
        hashed = pretokens.mix(values.astype(np.uint64) + np.uint64(1000 * (i + 1)))
        shape.append(owners << PLACE_BITS | (hashed >> np.uint64(64 - PLACE_BITS)).astype(np.int64))
    keys = np.unique(np.concatenate([keys, stems, *shape]))
    return keys >> PLACE_BITS, keys & ((1 << PLACE_BITS) - 1)


def _texts(batch: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (text, place) of a batch, a text in one piece after the other."""
    for parts, owners in pretokens.pieces(batch):
        yield features(parts, owners)


# ---------------------------------------------------------------------------------------------
# fitting


@dataclass
class Model:
    weights: np.ndarray  # by place
    thresholds: np.ndarray  # GRADES - 1, ascending

    def tails(self, score: np.ndarray) -> np.ndarray:
        """(rows, GRADES - 1): P(grade >= 1), P(grade >= 2), ..."""
        return _sigmoid(score[:, None] - self.thresholds[None])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(rows: np.ndarray, places: np.ndarray, grades: np.ndarray) -> Model:
    """Accelerated proximal gradient on the mean negative log likelihood. rows, places: where x is 1; grades: by row.

    Every weight has a step of its own, one over a bound of the curvature; the bound shares a row's curvature out so that
    places few rows have take longer steps than those which most rows have.
    """
    n = len(grades)
    weights = np.zeros(1 << PLACE_BITS)
    if not n:
        return Model(weights, np.full(GRADES - 1, -40.0))
    share = np.cumsum(np.bincount(grades, minlength=GRADES) + 0.5)[:-1] / (n + 0.5 * GRADES)
    start = np.log(share / (1 - share))
    # places whose rows pull the likelihood one way, by so many standard errors of their own or of as many rows of any grade
    edges = np.concatenate([[0], share, [1]])
    pull = 1 - edges[grades + 1] - edges[grades]
    size = 1 << PLACE_BITS
    pulled = np.bincount(places, weights=pull[rows], minlength=size)
    error = np.sqrt(np.bincount(places, weights=pull[rows] ** 2, minlength=size)) + 1e-9
    docs = np.bincount(places, minlength=size)
    telling = (docs >= LEAST_DOCS) & (np.abs(pulled) >= LEAST_PULL * np.minimum(error, np.sqrt(docs * np.mean(pull**2))))
    columns = np.flatnonzero(telling)
    number = np.full(size, -1)
    number[columns] = np.arange(len(columns))
    kept = telling[places]
    rows, at = rows[kept], number[places[kept]]
    penalty = SHRINK * error[columns] / n
    # thresholds are ordered by construction: the first one and the logarithms of the steps
    m = len(columns)
    now = np.concatenate([np.zeros(m), [start[0]], np.log(np.maximum(1e-3, np.diff(start)))])
    reach = (np.log(n / np.maximum(1, np.bincount(at, minlength=m))) + 0.1) ** 2
    spread = np.bincount(rows, weights=reach[at], minlength=n).astype(float)  # whole numbers if no place is left
    tenth = 0.1 * spread.mean() + 1
    spread += (GRADES - 1) * tenth
    curve = np.full(len(now), 0.5 * spread.mean() / tenth)
    curve[:m] = 0.5 * np.bincount(at, weights=spread[rows], minlength=m) / n / reach
    index, old, pace = np.arange(n), now, 1.0
    ahead = now
    for _ in range(ROUNDS):
        w, gaps = ahead[:m], np.clip(ahead[m + 1 :], -7, 4)
        thresholds = ahead[m] + np.concatenate([[0], np.cumsum(np.exp(gaps))])
        score = np.bincount(rows, weights=w[at], minlength=n)
        below = np.zeros((n, GRADES + 1))
        below[:, GRADES] = 1
        below[:, 1:GRADES] = _sigmoid(thresholds[None] - score[:, None])
        upper, lower = below[index, grades + 1], below[index, grades]
        likely = np.maximum(upper - lower, 1e-12)
        by_score = (1 - upper - lower) / n
        by_threshold = np.bincount(grades + 1, weights=-upper * (1 - upper) / likely / n, minlength=GRADES + 1)
        by_threshold += np.bincount(grades, weights=lower * (1 - lower) / likely / n, minlength=GRADES + 1)
        by_threshold = by_threshold[1:GRADES]
        behind = np.cumsum(by_threshold[::-1])[::-1]  # what moves with each threshold
        gradient = np.concatenate([np.bincount(at, weights=by_score[rows], minlength=m), behind[:1], np.exp(gaps) * behind[1:]])
        after = ahead - gradient / curve
        after[:m] = np.sign(after[:m]) * np.maximum(0, np.abs(after[:m]) - penalty / curve[:m])
        step = (1 + np.sqrt(1 + 4 * pace**2)) / 2
        ahead = after + (pace - 1) / step * (after - old)
        old, pace = after, step
    weights[columns] = old[:m]
    return Model(weights, old[m] + np.concatenate([[0], np.cumsum(np.exp(np.clip(old[m + 1 :], -7, 4)))]))


def graded(labels: DataFrame) -> DataFrame:
    """doc_id, grade: one row for each rated document."""
    worst = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.max("toxic").alias("toxic")
    )
    grade = F.when(F.col("quality") < 1, 0).when(F.col("toxic") > 0, 1).otherwise(2)
    return worst.select("doc_id", grade.alias("grade"))


def train(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Learn from about `rows` ratings, chosen by a hash of the id. Of documents that share an id, one text is rated."""
    ratings = graded(labels)
    picked = ratings.where(sampled(rows, ratings.count(), "doc_id"))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = [np.empty(0, np.int32)] * len(texts)
            for owner, place in _texts(texts):
                for text in np.unique(owner).tolist():
                    mine = place[owner == text]
                    found[text] = np.union1d(found[text], mine).astype(np.int32)
            yield pa.RecordBatch.from_pydict(
                {"grade": batch.column("grade"), "places": pa.array([f.astype("<i4").tobytes() for f in found], pa.binary())}
            )

    # about `rows` ratings, so small; each document has at most 2^PLACE_BITS places
    rated = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    rated = rated.groupBy("doc_id", "grade").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    found = rated.mapInArrow(places, "grade int, places binary").collect()
    lists = [np.frombuffer(r["places"], "<i4") for r in found]
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    flat = np.concatenate(lists).astype(np.int64) if lists else np.empty(0, np.int64)
    order = np.lexsort((flat, row))  # sums don't depend on the order of collected rows
    return fit(row[order], flat[order], np.array([r["grade"] for r in found], np.int64))


# ---------------------------------------------------------------------------------------------
# scoring


def scores(model: Model, batch: list[str | None]) -> np.ndarray:
    total = np.zeros(len(batch))
    seen: dict[int, np.ndarray] = {}  # places of a text that comes in several pieces
    for owner, place in _texts(batch):
        for text in {int(owner[0]), int(owner[-1])}:
            if len(batch[text] or "") > pretokens.CHUNK_CHARS:
                mine = owner == text
                old = seen.get(text, np.empty(0, np.int64))
                fresh = mine & ~np.isin(place, old)
                seen[text] = np.union1d(old, place[mine])
                keep = ~mine | fresh
                owner, place = owner[keep], place[keep]
                if not len(owner):
                    break
        np.add.at(total, owner, model.weights[place])
    return total


def rated(text: str | Column, model: Model) -> Column:
    """(expected_grade, p_good) of a STRING column."""
    sent = SparkSession.active().sparkContext.broadcast(model)  # 2^PLACE_BITS numbers

    @F.arrow_udf("struct<expected_grade: double, p_good: double>")
    def rate(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            tails = sent.value.tails(scores(sent.value, batch.to_pylist()))
            yield pa.StructArray.from_arrays(
                [pa.array(tails.sum(axis=1), pa.float64()), pa.array(tails[:, -1], pa.float64())], ["expected_grade", "p_good"]
            )

    return rate(text)


def good_documents(docs: DataFrame, labels: DataFrame, keep_from: float = KEEP_FROM) -> DataFrame:
    """The documents whose P(grade >= 2) is at least `keep_from`, as they are."""
    marked = docs.withColumn("__rated", rated("text", train(docs, labels)))
    return marked.where(F.col("__rated.p_good") >= keep_from).select(*docs.columns)


def rate_documents(docs: DataFrame, labels: DataFrame, keep_from: float = KEEP_FROM) -> DataFrame:
    """doc_id, expected_grade, p_good, keep: whether P(grade >= 2) is at least `keep_from`."""
    guess = docs.select("doc_id", rated("text", train(docs, labels)).alias("guess"))
    return guess.select("doc_id", "guess.expected_grade", "guess.p_good", (F.col("guess.p_good") >= keep_from).alias("keep"))
