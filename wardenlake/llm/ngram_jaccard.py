"""Jaccard join of documents on their word 5-grams, with Bayesian pruning of candidates.

1. Texts with equal sets of 5-grams are one node; copies are counted, never compared. A node has `VALUES` MinHash values.
2. Nodes that agree in a band of `BAND` values meet in a bucket. Buckets with the same members count once.
3. In a bucket pairs compare their MinHash values `STEP` at a time. With m of n values equal and a flat prior, the
   chance that their similarity reaches the threshold is P(Binomial(n + 1, threshold) <= m); when it falls below
   `TOLERANCE` the pair goes. What stays only has to connect the bucket: a search visits every node once, so a
   bucket of alike texts costs as many comparisons as it has nodes.
4. The nodes so connected fetch their texts. Pairs that pass the pruning are verified on the whole sets of
   5-grams. Every node gets the number of its links, and one link of a spanning forest to make classes from.

A pair with similarity s meets in some bucket with probability 1 - (1 - s^4)^24: 0.999997 at 0.8. Large buckets
and groups are compared in pairs of blocks, so no task holds a whole group, and rows go out per node, not per pair.

Texts with fewer than five words have their words as their only n-gram. Texts without words equal only texts that are the
same, and null or empty ones nothing. Rows without an id are counted; the class of a text is its smallest id.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wardenlake.functions.storage import materialize
from wardenlake.llm import pretokens
from wardenlake.llm.components import components
from wardenlake.llm.word_ngrams import ngrams, words

WORDS = 5
THRESHOLD = 0.8
VALUES, BAND, STEP = 96, 4, 16
TOLERANCE = 1e-6
BUCKET_BLOCK = 4096
VERIFY_BLOCK = 256
COLUMNS = 4096
NO_ID = (1 << 63) - 1

_RANDOM = np.random.default_rng(20)
_FLIPS = _RANDOM.integers(0, 1 << 32, VALUES, dtype=np.uint64).astype(np.uint32)
_FACTORS = _RANDOM.integers(0, 1 << 32, VALUES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)


# ---------------------------------------------------------------------------------------------
# sets and signatures


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text, sorted, one text after the other; how many each has."""
    hashes, first = words(texts)
    grams, at = ngrams(hashes, first, WORDS)
    owner = np.searchsorted(first, at, side="right") - 1
    sizes = np.diff(first)
    few = np.flatnonzero((sizes > 0) & (sizes < WORDS))
    if len(few):
        short = [ngrams(hashes[first[t] : first[t + 1]], np.array([0, sizes[t]]), int(sizes[t]))[0][:1] for t in few]
        grams, owner = np.concatenate([grams, *short]), np.concatenate([owner, few])
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    return grams[new], np.bincount(owner[new], minlength=len(texts))


def signatures(grams: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(texts with n-grams, VALUES) smallest hash values."""
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    low = (pretokens.mix(grams) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts), VALUES), np.uint32)
    for k in range(VALUES):
        out[:, k] = np.minimum.reduceat((low ^ _FLIPS[k]) * _FACTORS[k], starts)
    return out


def _names(grams: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(texts with n-grams, 2): 128 bits that name a set."""
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    one, two = pretokens.mix(grams ^ np.uint64(0x1234567)), pretokens.mix(grams * np.uint64(5) + np.uint64(9))
    return np.column_stack([np.add.reduceat(one, starts), np.add.reduceat(two, starts)])


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        nodes: list[bytes | None] = [None] * len(texts)
        values: list[bytes | None] = [None] * len(texts)
        for parts, owners in pretokens.pieces(texts, cut=False):
            grams, sizes = shingles(parts)
            if len(grams):
                named, signed = _names(grams, sizes), signatures(grams, sizes)
                for row, owner in enumerate(owners[sizes > 0].tolist()):
                    nodes[owner], values[owner] = named[row].tobytes(), signed[row].tobytes()
        for i, text in enumerate(texts):
            if nodes[i] is None and text and not text.isspace():
                nodes[i] = hashlib.blake2b(text.encode(), digest_size=16).digest()  # no words: equal texts only
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(nodes, pa.binary()), pa.array(values, pa.binary())],
            ["doc_id", "text_hash", "node", "signature"],
        )


# ---------------------------------------------------------------------------------------------
# pruning


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """For n values compared: the fewest equal ones with which a pair may still reach the threshold."""
    need = {}
    for n in range(STEP, VALUES + 1, STEP):
        below, m = 0.0, 0
        while True:
            below += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if below >= tolerance:
                break
            m += 1
        need[n] = m
    return need


def survivors(signature: np.ndarray, others: np.ndarray, need: dict[int, int]) -> np.ndarray:
    """Which of the other signatures stay candidates."""
    alive, equal = np.arange(len(others)), np.zeros(len(others), np.int64)
    for n in range(STEP, VALUES + 1, STEP):
        equal = equal + (others[alive, n - STEP : n] == signature[n - STEP : n]).sum(axis=1)
        stays = equal >= need[n]
        alive, equal = alive[stays], equal[stays]
        if not len(alive):
            break
    return alive


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[list[dict]]:
    """Rows of equal keys, of rows sorted by them."""
    now, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[k] for k in keys)
            if key != now and held:
                yield held
                held = []
            now = key
            held.append(row)
    if held:
        yield held


def _connect(batches: Iterator[pa.RecordBatch], need: dict[int, int]) -> Iterator[pa.RecordBatch]:
    """Edges that connect what survives the pruning in every block pair of a bucket."""
    a, b = [], []
    for rows in _groups(batches, ["bucket", "low", "high"]):
        table = np.frombuffer(b"".join(r["signature"] for r in rows), np.uint32).reshape(-1, VALUES)
        waiting = np.ones(len(rows), bool)
        for root in range(len(rows)):
            if not waiting[root]:
                continue
            waiting[root], front = False, [root]
            while front:
                i, rest = front.pop(), np.flatnonzero(waiting)
                if not len(rest):
                    break
                for j in rest[survivors(table[i], table[rest], need)].tolist():
                    waiting[j] = False
                    front.append(j)
                    a.append(rows[i]["node"])
                    b.append(rows[j]["node"])
        if len(a) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])
            a, b = [], []
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])


def _block_pairs(rows: DataFrame, size: str, block: int) -> DataFrame:
    """A row for every pair of blocks (low, high) that the row's own block is in; blocks of about `block` rows."""
    blocks = F.ceil(F.col(size) / block).cast("int")
    own = F.pmod(F.xxhash64("node", F.lit("block")), blocks).cast("int")
    dealt = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return dealt.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")}).drop("other")


def connected(nodes: DataFrame, threshold: float) -> DataFrame:
    """Edges a, b between nodes: enough of the candidates that survive the pruning to connect them all."""
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(VALUES // BAND - 1)),
        lambda i: F.xxhash64(i, F.substring(F.col("signature"), i * (4 * BAND) + 1, F.lit(4 * BAND))),
    )
    placed = nodes.select("node", F.explode(bands).alias("bucket"))
    members = (
        placed.groupBy("bucket")
        .agg(F.count("*").alias("size"), F.bit_xor(F.xxhash64("node")).alias("one"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("two"))
        .where("size > 1")
    )
    kept = members.groupBy("size", "one", "two").agg(F.min("bucket").alias("bucket")).select("bucket", "size")
    rows = _block_pairs(placed.join(kept, "bucket"), "size", BUCKET_BLOCK).select("bucket", "low", "high", "node")
    signed = rows.join(nodes.select("node", "signature"), "node")
    dealt = signed.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high", "node")
    need = least_matches(threshold)
    return dealt.mapInArrow(lambda batches: _connect(batches, need), "a binary, b binary")


# ---------------------------------------------------------------------------------------------
# verification


def similar(sets: list[np.ndarray], pairs: list[tuple[int, np.ndarray]], threshold: float) -> np.ndarray:
    """(sets, sets) booleans: which of the candidate pairs (i, all its j) have the similarity, by their whole sets."""
    n = len(sets)
    linked = np.zeros((n, n), bool)
    count = sum(len(js) for _, js in pairs)
    sizes = np.array([len(s) for s in sets])
    if count > 8 * n:
        flat = np.concatenate(sets)
        _, column, often = np.unique(flat, return_inverse=True, return_counts=True)
        number = np.cumsum(often > 1) - 1
        kept = often[column] > 1
        row, column = np.repeat(np.arange(n), sizes)[kept], number[column[kept]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        shared = np.zeros((n, n), np.float64)
        for start in range(0, int(number[-1]) + 1 if len(number) else 0, COLUMNS):
            low, high = np.searchsorted(column, [start, start + COLUMNS])
            part = np.zeros((n, COLUMNS), np.float32)
            part[row[low:high], column[low:high] - start] = 1
            shared += part @ part.T
        for i, js in pairs:
            both = np.rint(shared[i, js])
            linked[i, js] = both >= threshold * (sizes[i] + sizes[js] - both)
    else:
        for i, js in pairs:
            for j in js.tolist():
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                linked[i, j] = both >= threshold * (sizes[i] + sizes[j] - both)
    return linked | linked.T


def _verify(batches: Iterator[pa.RecordBatch], need: dict[int, int], threshold: float) -> Iterator[pa.RecordBatch]:
    kinds = pa.schema([("node", pa.binary()), ("links", pa.int64()), ("parent", pa.binary())])
    for rows in _groups(batches, ["label", "low", "high"]):
        rows = list({r["node"]: r for r in rows}.values())  # rows that repeat an id and its text
        grams, sizes = shingles([r["text"] for r in rows])
        sets = np.split(grams, np.cumsum(sizes)[:-1])
        table = np.frombuffer(b"".join(r["signature"] for r in rows), np.uint32).reshape(-1, VALUES)
        copies, own = np.array([r["copies"] for r in rows]), np.array([r["own"] for r in rows])
        low, high = rows[0]["low"], rows[0]["high"]
        pairs, across = [], low != high
        for i in range(len(rows)):
            if across and own[i] != low:
                continue
            rest = np.flatnonzero(own == high) if across else np.arange(i + 1, len(rows))
            if len(rest) and len(js := rest[survivors(table[i], table[rest], need)]):
                pairs.append((i, js))
        linked = similar(sets, pairs, threshold)
        parent: list[bytes | None] = [None] * len(rows)
        waiting = np.ones(len(rows), bool)
        for root in range(len(rows)):
            front = [root] if waiting[root] else []
            waiting[root] = False
            while front:
                i = front.pop()
                for j in np.flatnonzero(linked[i] & waiting).tolist():
                    waiting[j], parent[j] = False, rows[i]["node"]
                    front.append(j)
        links = linked @ copies
        yield pa.RecordBatch.from_pylist(
            [{"node": r["node"], "links": int(x), "parent": p} for r, x, p in zip(rows, links, parent)], kinds
        )


def jaccard_join(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id, links, copies of every document.

    links: other documents with at least the similarity; copies: those among them with the same n-grams;
    class_id: the smallest id of the documents that a chain of links leads to.
    """
    return _classed(docs, threshold).select("doc_id", "class_id", "links", "copies")


def _classed(docs: DataFrame, threshold: float) -> DataFrame:
    """The columns of `jaccard_join`, text_hash, and the text hash of the first document of the class."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    signed = materialize(rows.mapInArrow(_signed, "doc_id long, text_hash long, node binary, signature binary"))
    key = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "text_hash")
    nodes = materialize(
        signed.where("node IS NOT NULL")
        .groupBy("node")
        .agg(F.count("*").alias("copies"), F.min(key).alias("key"), F.first("signature").alias("signature"))
    )
    groups = components(connected(nodes.where("signature IS NOT NULL"), threshold))
    sizes = groups.groupBy("label").agg(F.count("*").alias("size"))
    members = _block_pairs(groups.join(sizes, "label"), "size", VERIFY_BLOCK).join(nodes, "node")
    wanted = members.select("label", "low", "high", "own", "node", "copies", "signature", "key.id", "key.text_hash")
    texts = rows.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "text_hash", "text")
    dealt = wanted.join(texts, ["id", "text_hash"]).select("label", "low", "high", "own", "node", "copies", "signature", "text")
    dealt = dealt.repartition("label", "low", "high").sortWithinPartitions("label", "low", "high", "node")
    need = least_matches(threshold)
    found = materialize(
        dealt.mapInArrow(lambda batches: _verify(batches, need, threshold), "node binary, links long, parent binary")
    )
    links = found.groupBy("node").agg(F.sum("links").alias("others"))
    classes = components(found.where("parent IS NOT NULL").select(F.col("node").alias("a"), F.col("parent").alias("b")))
    named = nodes.select("node", "copies", "key").join(links, "node", "left").join(classes, "node", "left")
    named = named.withColumn("label", F.coalesce("label", "node"))
    smallest = named.groupBy("label").agg(F.min("key").alias("first"))
    known = named.join(smallest, "label").select("node", "copies", F.coalesce("others", F.lit(0)).alias("others"), "first")
    named_rows = signed.where("node IS NOT NULL").select("doc_id", "text_hash", "node").join(known, "node")  # a node of very many: AQE splits them
    linked = named_rows.select(
        "doc_id",
        "text_hash",
        F.nullif("first.id", F.lit(NO_ID)).alias("class_id"),
        F.col("first.text_hash").alias("class_hash"),
        (F.col("others") + F.col("copies") - 1).alias("links"),
        (F.col("copies") - 1).alias("copies"),
    )
    zero = F.lit(0).cast("long")
    alone = signed.where("node IS NULL").select("doc_id", "text_hash", F.col("doc_id").alias("class_id"), F.col("text_hash").alias("class_hash"), zero.alias("links"), zero.alias("copies"))
    return linked.unionByName(alone)


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of every class: that with the smallest id, of several such that with the smallest text hash.

    Documents without an id come after all others. Each repeated row stays once.
    """
    classes = _classed(docs, threshold).where("doc_id <=> class_id AND text_hash = class_hash")
    chosen = classes.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__hash"))
    return docs.join(chosen, same, "left_semi").dropDuplicates(["doc_id", "text"])
