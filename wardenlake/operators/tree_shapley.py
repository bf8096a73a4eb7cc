"""Exact Shapley values of sums of trees against background rows, in closed form.

Every leaf is a box: an interval for each feature on its path. A hybrid that takes some features from the row and the others
from a background row falls into the box if each interval holds the value it gets. Intervals that hold both values
don't matter; if one holds neither, the leaf gives nothing; otherwise a of them hold only the row's value and b only the
background's, and the leaf counts in exactly those coalitions that have all of the a and none of the b. So its value is
shared: (a - 1)! b! / (a + b)! of it to each of the a, minus a! (b - 1)! / (a + b)! to each of the b. Background rows
that lie in the same intervals of a leaf count once, and so do rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import factorial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wardenlake.models.trees import Trees

MOST_FEATURES = 62  # of one path; they are bits of a number
FEW_FEATURES = 6  # of a path whose masks are all tabulated, without looking which of them occur
ROWS_AT_ONCE = 50_000  # share a leaf's table


class Leaf(NamedTuple):
    value: float
    features: np.ndarray
    low: np.ndarray  # exclusive
    high: np.ndarray  # inclusive
    masks: np.ndarray  # which intervals hold a background row's values, as bits
    shares: np.ndarray  # of the background rows that have the mask


def _masks(x: np.ndarray, leaf_features: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    cells = x[:, leaf_features]
    return ((cells > low) & (cells <= high)) @ (np.int64(1) << np.arange(len(low), dtype=np.int64))


def leaves(trees: Trees, background: np.ndarray) -> list[Leaf]:
    """The boxes of all leaves of a forest (mean of shares) or of a boosted margin (weighted sum)."""
    stops = trees.stops(None)
    found = []
    for t, root in enumerate(trees.roots.tolist()):
        weight = trees.weights[t] if trees.boosted else 1.0 / len(trees.roots)
        todo: list[tuple[int, dict]] = [(root, {})]
        while todo:
            node, box = todo.pop()
            if not stops[node]:
                j, cut = int(trees.feature[node]), float(trees.threshold[node])
                low, high = box.get(j, (-np.inf, np.inf))
                todo.append((int(trees.left[node]), {**box, j: (low, min(high, cut))}))
                todo.append((int(trees.right[node]), {**box, j: (max(low, cut), high)}))
            elif box and (value := weight * float(trees.value[node])):
                if len(box) > MOST_FEATURES:
                    raise ValueError(f"a path uses more than {MOST_FEATURES} features")
                features = np.array(sorted(box))
                low, high = np.array([box[j] for j in features.tolist()]).T
                masks, counts = np.unique(_masks(background, features, low, high), return_counts=True)
                found.append(Leaf(value, features, low, high, masks, counts / len(background)))
    return found


def _weights(most: int) -> tuple[np.ndarray, np.ndarray]:
    """Shares of a leaf for features that only the row has, and that only the background has, by a and b."""
    own, other = np.zeros((most + 1, most + 1)), np.zeros((most + 1, most + 1))
    for a in range(most + 1):
        for b in range(most + 1 - a):
            if a:
                own[a, b] = factorial(a - 1) * factorial(b) / factorial(a + b)
            if b:
                other[a, b] = factorial(a) * factorial(b - 1) / factorial(a + b)
    return own, other


def contributions(x: np.ndarray, boxes: Sequence[Leaf]) -> np.ndarray:
    """(rows, features) exact Shapley values of the sum of the leaves."""
    columns = np.ascontiguousarray(x.T)
    out = np.zeros(columns.shape)
    own, other = _weights(max((len(leaf.features) for leaf in boxes), default=0))
    for leaf in boxes:
        masks = _column_masks(columns, leaf)
        if len(leaf.features) <= FEW_FEATURES:
            mine, row = np.arange(1 << len(leaf.features), dtype=np.int64), masks.astype(np.intp)
        else:
            mine, row = np.unique(masks, return_inverse=True)
        a, b = mine[:, None] & ~leaf.masks, leaf.masks & ~mine[:, None]
        whole = (mine[:, None] | leaf.masks) == (np.int64(1) << np.int64(len(leaf.features))) - 1
        na, nb = np.bitwise_count(a), np.bitwise_count(b)
        gain, loss = (np.where(whole, w[na, nb] * (leaf.shares * leaf.value), 0.0) for w in (own, other))
        for bit, j in enumerate(leaf.features.tolist()):
            out[j] += ((((a >> bit) & 1) * gain).sum(axis=1) - (((b >> bit) & 1) * loss).sum(axis=1))[row]
    return out.T


def _column_masks(columns: np.ndarray, leaf: Leaf) -> np.ndarray:
    """What `_masks` gives, in small numbers where they do."""
    kind = np.uint8 if len(leaf.features) <= FEW_FEATURES else np.int64
    out = np.zeros(columns.shape[1], kind)
    for bit, (j, low, high) in enumerate(zip(leaf.features.tolist(), leaf.low, leaf.high)):
        inside = (columns[j] > low) & (columns[j] <= high)
        out |= inside.astype(kind) << kind(bit)
    return out


def _larger(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches joined until they have ROWS_AT_ONCE rows."""
    held, rows = [], 0
    for batch in batches:
        held, rows = [*held, batch], rows + batch.num_rows
        if rows >= ROWS_AT_ONCE:
            yield pa.concat_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.concat_batches(held)


def tree_shapley_values(
    rows: DataFrame, background: DataFrame, trees: Trees, names: Sequence[str], key: str = "tx_id", vector: str = "x", most: int = 100
) -> DataFrame:
    """(key, feature, phi) as `explain.shapley_values` has them, exact for the given background of at most `most` rows."""
    base = [r[vector] for r in background.orderBy(key).limit(most).collect()]
    if not base:
        raise ValueError("the background has no rows")
    sent = rows.sparkSession.sparkContext.broadcast(leaves(trees, np.array(base, float)))  # has the size of the model

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _larger(batches):
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            phi = contributions(x, sent.value)
            ends = np.arange(0, phi.size + 1, len(names), dtype=np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.ListArray.from_arrays(pa.array(ends), pa.array(phi.ravel()))], ["key", "phi"])

    table = rows.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("x"))
    kind = table.schema["key"].dataType.simpleString()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    found = table.repartition(cores, "key").mapInArrow(explain, f"key {kind}, phi array<double>")
    labels = F.array(*[F.lit(n) for n in names])
    return found.select(F.col("key").alias(key), F.posexplode("phi").alias("at", "phi")).select(key, labels[F.col("at")].alias("feature"), "phi")
