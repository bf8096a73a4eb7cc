"""Histogram sort into shards of near equal size.

Rows are ordered by a key. Rounds of one small aggregation each count the exact bytes (and rows) between
candidate boundaries of the key, which are its prefixes; a round looks only into cells that hold a wanted
boundary too coarsely or are too heavy for one task, and cuts them 4,096 times finer. When every
splitter is within the tolerance the rows move once, by ranges finer than shards, and every row gets its place.

Ranges follow the rows: `PIECES` at least, and one for every `RANGE_ROWS` rows, so a task sorts no more of a larger table.
The driver sees cells only: of those it looks into, at most `shards` + the number of ranges, it gets 4,096 finer ones each,
or 16 each where that would be over `MOST_CELLS`. A text that a third of all rows share is a heavy cell, cut by doc_id.

Nulls: no text counts no bytes and has the checksum of the empty one; a row without key comes first of its text.
Rows that are equal in text and doc_id stay together in one shard.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardenlake.functions.storage import materialize

SHARDS = 16
TOLERANCE = 0.001
DIGITS = 3
PIECES = 512
RANGE_ROWS = 1_000_000
MOST_CELLS = 4 << 20
KEY_DIGITS = 32


def hex_digits(value: Column) -> Column:
    """16 hexadecimal digits that sort like the signed 64-bit number; null first."""
    flipped = value.cast("long").bitwiseXOR(F.lit(-(1 << 63)))
    return F.when(value.isNull(), F.lit("0" * 16)).otherwise(F.lpad(F.hex(flipped), 16, "0"))


def text_then_id(text: str = "text", key: str = "doc_id") -> Column:
    """A key of 32 digits: copies of a text are neighbours, ordered by their id."""
    return F.concat(F.lpad(F.hex(F.xxhash64(F.coalesce(text, F.lit("")))), 16, "0"), hex_digits(F.col(key)))


@dataclass
class Cell:
    prefix: str
    size: int
    rows: int


def _count(rows: DataFrame, digits: int, within: list[str] | None = None) -> list[Cell]:
    """Exact size and rows of all cells with `digits` digits, or of those inside the given shorter ones."""
    if within:
        rows = rows.where(F.substring("__key", 1, len(within[0])).isin(within))
    found = rows.groupBy(F.substring("__key", 1, digits).alias("prefix")).agg(
        F.sum("__size").alias("size"), F.count("*").alias("rows")
    )
    return [Cell(r["prefix"], int(r["size"]), r["rows"]) for r in found.collect()]


def find_cells(rows: DataFrame, shards: int, tolerance: float, range_rows: int = RANGE_ROWS) -> list[Cell]:
    """Cells in key order, fine enough around every boundary and nowhere too heavy for one range."""
    digits, cells = DIGITS, sorted(_count(rows, DIGITS), key=lambda c: c.prefix)
    total = sum(c.size for c in cells)
    pieces = max(PIECES, -(-sum(c.rows for c in cells) // range_rows))
    slack = tolerance * total / shards
    while digits < KEY_DIGITS:
        coarse, before = [], 0
        for cell in cells:
            after = before + cell.size
            # wanted boundaries strictly inside this cell
            first = int(before * shards // total) + 1 if total else shards
            inside = [i * total / shards for i in range(first, shards) if i * total / shards < after]
            missed = any(min(x - before, after - x) > slack for x in inside)
            if len(cell.prefix) == digits and cell.rows > 1 and (missed or cell.size * pieces > total or cell.rows > range_rows):
                coarse.append(cell.prefix)
            before = after
        if not coarse:
            break
        digits = min(KEY_DIGITS, digits + (DIGITS if len(coarse) << 4 * DIGITS <= MOST_CELLS else 1))
        finer, gone = _count(rows, digits, coarse), set(coarse)
        cells = sorted([c for c in cells if c.prefix not in gone] + finer, key=lambda c: c.prefix)
    return cells


@dataclass
class Range:
    start: str
    shard: int
    slot: int


def plan_ranges(cells: list[Cell], shards: int, range_rows: int = RANGE_ROWS) -> list[Range]:
    """Consecutive cells as ranges for one task each: their shard and the first slot in it."""
    total = sum(c.size for c in cells)
    pieces = max(PIECES, -(-sum(c.rows for c in cells) // range_rows))
    edges, at = [0], 0
    for c in cells:
        edges.append(at := at + c.size)
    cuts = []
    for i in range(1, shards):
        x = i * total / shards
        k = bisect.bisect_left(edges, x)
        if k == len(edges) or k and x - edges[k - 1] <= edges[k] - x:
            k -= 1
        cuts.append(max(k, cuts[-1] if cuts else 0))
    ranges, shard, held, of_rows, slot = [], -1, 0, 0, 0
    for k, cell in enumerate(cells):
        mine = bisect.bisect_right(cuts, k)
        if mine != shard:
            shard, slot, held = mine, 0, total
        if held * pieces >= total or of_rows >= range_rows or not ranges:
            ranges.append(Range(cell.prefix, shard, slot))
            held = of_rows = 0
        held += cell.size
        of_rows += cell.rows
        slot += cell.rows
    return ranges


def _last_start(starts: str, key: str, most: int) -> Column:
    """How many of the ascending `starts`, at most `most`, aren't above the key: a binary search."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(most.bit_length()))])
    return F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get(F.col(starts), at + step - 1) <= F.col(key), at + step).otherwise(at)
    )


def shard(
    df: DataFrame, key: Column, size: Column, shards: int = SHARDS, tolerance: float = TOLERANCE, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """Adds shard, slot (from 0, without gaps, in key order) and law to every row; columns so named are replaced.

    key: a string of KEY_DIGITS hexadecimal digits. `df` is read once for every round and once to move the rows, so
    give a table on disk.
    """
    spark = df.sparkSession
    rows = df.select(key.alias("__key"), size.cast("long").alias("__size"))
    ranges = plan_ranges(find_cells(rows, shards, tolerance, range_rows), shards, range_rows)
    kept = df.drop("shard", "slot", "law")
    if not ranges:
        return kept.select("*", F.lit("bytes").alias("law"), F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    starts = [r.start for r in ranges]
    firsts = [format(i, f"0{DIGITS}X") for i in range(16**DIGITS)]
    lookup = []
    for first in firsts:
        low, high = bisect.bisect_right(starts, first), bisect.bisect_left(starts, first + "G")
        lookup.append((first, max(0, low - 1), starts[low:high]))
    # 4,096 rows with the ranges' starts, and a row per range: 40 bytes for RANGE_ROWS rows of the table
    prefixes = spark.createDataFrame(lookup, "__first string, __base int, __starts array<string>")
    places = spark.createDataFrame([(i, r.shard, r.slot) for i, r in enumerate(ranges)], "__range int, shard int, __slot long")
    found = _last_start("__starts", "__key", max(len(of) for _, _, of in lookup))
    number = F.col("__base") + (found if any(of for _, _, of in lookup) else F.lit(0))
    ranged = (
        kept.withColumn("__key", key)
        .withColumn("__first", F.substring("__key", 1, DIGITS))
        .join(F.broadcast(prefixes), "__first")
        .withColumn("__range", number)
        .drop("__first", "__base", "__starts")
    )
    order = Window.partitionBy("__range").orderBy("__key")
    placed = ranged.withColumn("__row", F.row_number().over(order) - 1).join(F.broadcast(places), "__range")
    return placed.select(
        *kept.columns, F.lit("bytes").alias("law"), "shard", (F.col("__slot") + F.col("__row")).cast("long").alias("slot")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder for each shard; files hold consecutive slots."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def shard_documents(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document, from one pass over the texts."""
    sizes = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        text_then_id().alias("sort_key"),
    )
    placed = shard(materialize(sizes), F.col("sort_key"), F.col("size"))
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
