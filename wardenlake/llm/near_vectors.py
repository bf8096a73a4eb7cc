"""Links between vectors of high cosine: sign hashing in several tables, exact verification, connected components.

1. Rows with the same vector are one node, which has the signs of its projections on random hyperplanes.
2. `key_bits` signs are a node's key in one of several tables; nodes with the same key meet in a bucket. Two vectors at
   the threshold agree in one sign with probability p = 1 - acos(threshold) / pi, and the number of tables is such
   that they meet nowhere with probability `MISS` at most; closer ones meet more surely. Keys grow with the number of
   rows, so that a bucket of unrelated vectors keeps its size.
3. In a bucket, nodes whose `SKETCH` further signs differ in more places than a pair at the threshold does but once in
   a million are apart. The others only have to connect the bucket: a row goes out per node, not per pair.
4. Only connected nodes fetch their vectors. Every pair of a connected group is verified in double precision, whichever
   table it met in, and each node gets its exact number of links and one link of a spanning forest.
5. Components of the forest are the components of all links.

Buckets and groups larger than a block are dealt out as pairs of blocks. A group of m different vectors takes m * m
comparisons in blocks, as an exact count of links does; copies of a vector are counted, never compared.

Vectors that are null, empty, zero or have null or non-finite entries link with nothing. Vectors of unequal length never
link. Rows without an id are linked and counted like others; the component of a row is the smallest id in it (null if no
row in it has one), and `kept` says that it is the row's own. Repeated rows each count.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wardenlake.functions.storage import materialize
from wardenlake.llm.components import components

THRESHOLD = 0.95
MISS = 1e-3
SKETCH = 128
SKETCH_DEVIATIONS = 4.75
BUCKET_ROWS = 64
LEAST_KEY_BITS, MOST_KEY_BITS = 8, 40
BLOCK_ROWS = 2048
SAMPLE_STEP = 16
HOT_KEYS = 20_000
CLOSE_CALL = 1e-9
NO_ID = (1 << 63) - 1


def agreement(threshold: float) -> float:
    """Chance that two vectors of that cosine lie on the same side of a random hyperplane."""
    return 1 - math.acos(threshold) / math.pi


def table_shape(rows: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int]:
    """Bits of a key, and number of tables."""
    bits = min(MOST_KEY_BITS, max(LEAST_KEY_BITS, math.ceil(math.log2(max(rows, 1) / BUCKET_ROWS))))
    return bits, math.ceil(math.log(miss) / math.log1p(-(agreement(threshold) ** bits)))


def most_differences(threshold: float) -> int:
    p = agreement(threshold)
    return math.ceil(SKETCH * (1 - p) + SKETCH_DEVIATIONS * math.sqrt(SKETCH * p * (1 - p)))


# ---------------------------------------------------------------------------------------------
# vectors and their signs


def unit_vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, unit vectors in double precision) of the vectors that can link, for every length."""
    kind = column.type.value_type
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.values.cast(pa.float64()) if kind != pa.float64() else column.values
    values = flat.to_numpy(zero_copy_only=False)
    starts = column.offsets.to_numpy()[:-1]
    usable = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False) & (lengths > 0))
    for length in np.unique(lengths[usable]).tolist():
        rows = usable[lengths[usable] == length]
        taken = values[starts[rows][:, None] + np.arange(length)]  # a null entry is NaN here
        largest = np.abs(taken).max(axis=1)
        good = np.isfinite(largest) & (largest > 0)
        rows, taken = rows[good], taken[good]
        taken = np.ldexp(taken, -np.frexp(largest[good])[1][:, None])  # no square over- or underflows
        if len(rows):
            yield rows, taken / np.sqrt(np.einsum("ij,ij->i", taken, taken))[:, None]


def _hyperplanes(length: int, bits: int) -> np.ndarray:
    return np.random.default_rng([11, length]).standard_normal((bits, length)).T


def _signed(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    planes: dict[int, np.ndarray] = {}
    for batch in batches:
        column = batch.column("vec")
        digests: list[bytes | None] = [None] * len(column)
        signs: list[bytes | None] = [None] * len(column)
        for rows, units in unit_vectors(column):
            length = units.shape[1]
            if length not in planes:
                planes[length] = _hyperplanes(length, bits)
            packed = np.packbits(units @ planes[length] >= 0, axis=1)
            for i, row in enumerate(rows.tolist()):
                digests[row] = hashlib.blake2b((units[i] + 0.0).tobytes(), digest_size=16).digest()
                signs[row] = packed[i].tobytes()
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("vec_hash"), pa.array(digests, pa.binary()), pa.array(signs, pa.binary())],
            ["vec_id", "vec_hash", "node", "signs"],
        )


# ---------------------------------------------------------------------------------------------
# candidates


def _placed(batches: Iterator[pa.RecordBatch], bits: int, tables: int) -> Iterator[pa.RecordBatch]:
    """bucket, name, sketch of every node in every table."""
    powers = np.int64(1) << np.arange(bits, dtype=np.int64)
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        names = batch.column("name").to_numpy()
        packed = np.frombuffer(b"".join(batch.column("signs").to_pylist()), np.uint8).reshape(n, -1)
        sketch = np.ascontiguousarray(packed[:, : SKETCH // 8]).view(np.int64)
        signs = np.unpackbits(packed[:, SKETCH // 8 :], axis=1)[:, : bits * tables].reshape(n, tables, bits)
        keys = (signs.astype(np.int64) @ powers) + (np.arange(tables, dtype=np.int64) << MOST_KEY_BITS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (keys.ravel(), *(np.repeat(v, tables) for v in (names, sketch[:, 0], sketch[:, 1])))],
            ["bucket", "name", "one", "two"],
        )


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each group, of rows sorted by integer keys."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        if held and last != tuple(c[0] for c in columns):
            yield pa.Table.from_batches(held)
            held = []
        start = 0
        for cut in cuts.tolist():
            held.append(batch.slice(start, cut - start))
            yield pa.Table.from_batches(held)
            held, start = [], cut
        held.append(batch.slice(start))
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)


def spanning_pairs(near, n: int) -> Iterator[tuple[int, int]]:
    """Pairs i, j that connect what `near(i, others)` connects: a search that meets every node once."""
    waiting = np.ones(n, bool)
    for root in range(n):
        if not waiting[root]:
            continue
        waiting[root], front = False, [root]
        while front:
            rest = np.flatnonzero(waiting)
            if not len(rest):
                break
            i = front.pop()
            for j in rest[near(i, rest)].tolist():
                waiting[j] = False
                front.append(j)
                yield i, j


def _connect(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    kinds = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for group in sorted_groups(batches, ["bucket", "low", "high"]):
        if group.num_rows < 2:
            continue
        names = group.column("name").to_numpy()
        one, two = (group.column(c).to_numpy().view(np.uint64) for c in ("one", "two"))

        def near(i: int, others: np.ndarray) -> np.ndarray:
            apart = np.bitwise_count(one[others] ^ one[i]) + np.bitwise_count(two[others] ^ two[i])
            return np.flatnonzero(apart <= most)

        if len(names) <= 1024:  # mostly nothing is near: one look at all pairs tells
            apart = np.bitwise_count(one[:, None] ^ one) + np.bitwise_count(two[:, None] ^ two)
            if (apart <= most).sum() == len(names):
                continue
        if pairs := list(spanning_pairs(near, len(names))):
            a, b = np.array(pairs).T
            yield pa.RecordBatch.from_arrays([pa.array(names[a]), pa.array(names[b])], schema=kinds)


def _block_pairs(rows: DataFrame, blocks: Column, by: Column) -> DataFrame:
    """A row for every pair of blocks (low, high) that the row's own block is in."""
    dealt = rows.withColumn("blocks", blocks.cast("int")).withColumn("own", F.pmod(by, F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")}).drop("other", "blocks")


def candidates(nodes: DataFrame, bits: int, tables: int, threshold: float) -> DataFrame:
    """Edges a, b between the names of nodes: enough of the candidates to connect them all.

    Two nodes with one name, a 64-bit hash, would only be verified with each other's candidates too.
    """
    kinds = "bucket long, name long, one long, two long"
    signed = nodes.select("name", "signs")
    placed = signed.mapInArrow(lambda batches: _placed(batches, bits, tables), kinds)
    # A sample tells which buckets to deal out in blocks. That is a matter of balance: any number of blocks compares all pairs.
    part = signed.where(F.pmod(F.xxhash64("name", F.lit(7)), F.lit(SAMPLE_STEP)) == 0)
    counts = part.mapInArrow(lambda batches: _placed(batches, bits, tables), kinds).groupBy("bucket").count()
    large = counts.where(F.col("count") * SAMPLE_STEP > BLOCK_ROWS)
    large = materialize(large.select("bucket", F.ceil(F.col("count") * SAMPLE_STEP / BLOCK_ROWS).alias("n")))
    few = large.count() <= HOT_KEYS
    sized = placed.join(F.broadcast(large) if few else large, "bucket", "left")
    dealt = _block_pairs(sized, F.coalesce("n", F.lit(1)), F.xxhash64("name", F.lit(3))).select("bucket", "low", "high", "name", "one", "two")
    dealt = dealt.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    most = most_differences(threshold)
    return dealt.mapInArrow(lambda batches: _connect(batches, most), "a long, b long")


# ---------------------------------------------------------------------------------------------
# verification


def linked(one: np.ndarray, two: np.ndarray, threshold: float) -> np.ndarray:
    """(rows of one, rows of two) booleans: cosines of unit vectors at or over the threshold."""
    cosines = one @ two.T
    out = cosines >= threshold
    for i, j in np.argwhere(np.abs(cosines - threshold) < CLOSE_CALL).tolist():
        out[i, j] = math.fsum(one[i] * two[j]) / math.sqrt(math.fsum(one[i] ** 2) * math.fsum(two[j] ** 2)) >= threshold
    return out


def _forest(close: np.ndarray, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs that connect what `close` connects; its rows are the nodes `a`, its columns the nodes `b` (the same, or others)."""
    if a is b:
        yield from ((a[i], a[j]) for i, j in spanning_pairs(lambda i, others: np.flatnonzero(close[i, others]), len(a)))
        return
    both, n = np.concatenate([a, b]), len(a)

    def near(i: int, others: np.ndarray) -> np.ndarray:
        if i < n:
            side = others >= n
            return np.flatnonzero(side)[close[i, others[side] - n]]
        side = others < n
        return np.flatnonzero(side)[close[others[side], i - n]]

    yield from ((both[i], both[j]) for i, j in spanning_pairs(near, len(both)))


def _verify(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Every node's number of links in a block pair (parent null), and forest edges (no links)."""
    kinds = pa.schema([("node", pa.binary()), ("links", pa.int64()), ("parent", pa.binary())])
    for group in sorted_groups(batches, ["label", "low", "high"]):
        names, row_of = np.unique(np.array(group.column("node").to_pylist(), object), return_index=True)
        group = group.take(pa.array(row_of))  # once each, also where rows repeat an id and its vector
        copies, own = group.column("copies").to_numpy(), group.column("own").to_numpy()
        low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
        links = np.zeros(len(names), np.int64)
        edges: list[tuple[int, int]] = []
        for rows, units in unit_vectors(group.column("vec").combine_chunks()):
            if low == high:
                parts = np.split(np.arange(len(rows)), range(BLOCK_ROWS, len(rows), BLOCK_ROWS))
                pairs = [(x, y) for k, x in enumerate(parts) for y in parts[k:]]
            else:
                pairs = [(np.flatnonzero(own[rows] == low), np.flatnonzero(own[rows] == high))]
            for x, y in pairs:
                close = linked(units[x], units[y], threshold)
                if x is y:
                    np.fill_diagonal(close, False)
                else:
                    links[rows[y]] += copies[rows[x]] @ close
                links[rows[x]] += close @ copies[rows[y]]
                if close.any():
                    a = rows[x]
                    edges += _forest(close, a, a if x is y else rows[y])
        parent, child = np.array(edges, np.int64).reshape(-1, 2).T
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([*names.tolist(), *names[child].tolist()], pa.binary()),
                pa.array(np.concatenate([links, np.zeros(len(child), np.int64)])),
                pa.array([*[None] * len(names), *names[parent].tolist()], pa.binary()),
            ],
            schema=kinds,
        )


def _join_counted(rows: DataFrame, known: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """Left join of `rows` with `known`, which has a row per key and tells how many rows the key has at most.

    Keys that hold more than a share of 1 / HOT_KEYS of all rows, so HOT_KEYS of them at most, go to every task.
    """
    hot = F.col(count) > max(BLOCK_ROWS, total // HOT_KEYS)
    many, others = F.broadcast(known.where(hot)), known.where(~hot)
    rest = rows.join(many.select(key), key, "left_anti")
    return rows.join(many, key).unionByName(rest.join(others, key, "left"))


def cosine_components(vectors: DataFrame, vec: str = "embedding", vec_id: str = "vec_id", threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept, copies of every row.

    n_links: other rows whose vector has at least that cosine with this one; copies: those among them that point the same
    way; component_id: the smallest id that a chain of links leads to.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vec).alias("vec"), F.xxhash64(vec).alias("vec_hash"))
    total = rows.count()
    bits, tables = table_shape(total, threshold)
    kinds = "vec_id long, vec_hash long, node binary, signs binary"
    signed = materialize(rows.mapInArrow(lambda batches: _signed(batches, SKETCH + bits * tables), kinds))
    key = F.struct(F.coalesce("vec_id", F.lit(NO_ID)).alias("id"), "vec_hash")
    nodes = signed.where("node IS NOT NULL").groupBy("node")
    nodes = nodes.agg(F.count("*").alias("copies"), F.min(key).alias("key"), F.first("signs").alias("signs"))
    nodes = materialize(nodes.withColumn("name", F.xxhash64("node")))

    groups = components(candidates(nodes, bits, tables, threshold)).withColumnRenamed("node", "name")
    sizes = groups.groupBy("label").agg(F.count("*").alias("members"))
    grouped = _join_counted(groups, sizes, "label", "members", total)
    grouped = grouped.join(nodes.select("name", "node", "copies", "key"), "name")
    members = _block_pairs(grouped, F.ceil(F.col("members") / BLOCK_ROWS), F.xxhash64("node", F.lit(5)))
    wanted = members.select("label", "low", "high", "own", "node", "copies", "key.id", "key.vec_hash")
    fetched = rows.select(F.coalesce("vec_id", F.lit(NO_ID)).alias("id"), "vec_hash", "vec")
    dealt = wanted.join(fetched, ["id", "vec_hash"]).drop("id", "vec_hash").repartition("label", "low", "high")
    dealt = dealt.sortWithinPartitions("label", "low", "high")
    found = materialize(dealt.mapInArrow(lambda batches: _verify(batches, threshold), "node binary, links long, parent binary"))

    links = found.groupBy("node").agg(F.sum("links").alias("others")).where("others > 0")
    classes = components(found.where("parent IS NOT NULL").select(F.col("parent").alias("a"), F.col("node").alias("b")))
    placed = materialize(classes.join(links, "node").join(nodes.select("node", "copies", "key.id"), "node"))
    first = placed.groupBy("label").agg(F.count("*").alias("members"), F.min("id").alias("first"))
    linked_nodes = _join_counted(placed, first, "label", "members", total).select("node", "copies", "others", "first")
    zero = F.lit(0).cast("long")
    alone = nodes.where("copies > 1").join(placed.select("node"), "node", "left_anti")
    known = materialize(linked_nodes.unionByName(alone.select("node", "copies", zero.alias("others"), F.col("key.id").alias("first"))))
    named = _join_counted(signed.where("node IS NOT NULL").select("vec_id", "node"), known, "node", "copies", total)
    named = named.unionByName(signed.where("node IS NULL").select("vec_id", "node"), allowMissingColumns=True)
    copies = F.coalesce("copies", F.lit(1)) - 1
    component = F.when(F.col("first").isNull(), F.col("vec_id")).otherwise(F.nullif("first", F.lit(NO_ID)))
    return named.select(
        "vec_id",
        (F.coalesce("others", zero) + copies).alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
        copies.alias("copies"),
    )
