import bisect
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from wardenlake.llm import histogram_shards
from wardenlake.llm.catalog import op3_histogram_shards


def check(rows, docs, most_over):
    """Rows against what brute force says of them."""
    texts = defaultdict(list)
    for doc, text in docs:
        texts[doc].append(text)
    assert len(rows) == len(docs)
    size, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        sized = {(len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for t in texts[r["doc_id"]]}
        assert (r["size"], r["text_crc32"]) in sized and r["law"] == "bytes" and r["grown_shard"] is None
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert set(size) <= set(range(16))
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))
    total, largest = sum(size.values()), max(r["size"] for r in rows)
    assert all(abs(size[i] - total / 16) <= most_over * total / 16 + largest for i in range(16))


def run(spark, path, docs):
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, shard string, slot int")
    frame.repartition(5).write.parquet(f"{path}/documents.parquet")
    return op3_histogram_shards(spark, str(path)).collect()


def test_near_equal_with_a_text_of_a_third_of_all_rows(spark, tmp_path):
    docs = [(i, "the same text in a third of the rows" if i % 3 == 0 else f"text {i} " * (i % 40)) for i in range(-2000, 4000)]
    rows = run(spark, tmp_path, docs)
    check(rows, docs, 0.002)
    hot = [r["shard"] for r in rows if r["doc_id"] % 3 == 0]
    assert len(set(hot)) <= 4  # neighbours, except where a boundary runs through them


def test_odd_rows(spark, tmp_path):
    docs = [(1, None), (1, ""), (None, "a"), (None, "b"), (7, "again"), (7, "again"), (2, "y" * 100_000), (3, "é")]
    check(run(spark, tmp_path, docs), docs, 8.0)


def test_same_result_from_any_partitioning(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab"), (F.col("id") % 90).cast("int")).alias("text"))
    results = [
        sorted(map(tuple, histogram_shards.shard_documents(docs.repartition(n)).drop("grown_shard").collect())) for n in (1, 7)
    ]
    assert results[0] == results[1]


def test_empty_table_and_files(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert histogram_shards.shard_documents(docs).collect() == []
    some = spark.range(100).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    whole = histogram_shards.shard(some, histogram_shards.text_then_id(), F.octet_length("text"), shards=4)
    histogram_shards.write_shards(whole, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 100 and back.select("shard").distinct().count() == 4


@pytest.mark.parametrize("most_cells", [1, 4 << 20])
def test_ranges_follow_rows(spark, monkeypatch, most_cells):
    """The same places from many small ranges, a hot text cut among them, as from few large ones."""
    monkeypatch.setattr(histogram_shards, "PIECES", 4)
    monkeypatch.setattr(histogram_shards, "MOST_CELLS", most_cells)
    text = F.when(F.col("id") % 3 == 0, "the hot text").otherwise(F.concat(F.lit("text "), F.col("id").cast("string")))
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), text.alias("text")).cache()
    key, size = histogram_shards.text_then_id(), F.octet_length("text") + 1
    rows = docs.select(key.alias("__key"), size.cast("long").alias("__size"))
    cells = histogram_shards.find_cells(rows, 4, 0.001, range_rows=50)
    assert max(c.rows for c in cells) <= 50 and sum(c.rows for c in cells) == 3000
    ranges = histogram_shards.plan_ranges(cells, 4, range_rows=50)
    assert len(ranges) >= 60
    starts = [r.start for r in ranges]
    placed = histogram_shards.shard(docs, key, size, shards=4, range_rows=50).withColumn("key", key).collect()
    by_key = sorted(placed, key=lambda r: r["key"])
    slots = defaultdict(int)
    for r in by_key:
        assert r["slot"] == slots[r["shard"]]
        slots[r["shard"]] += 1
        assert r["shard"] == ranges[max(0, bisect.bisect_right(starts, r["key"]) - 1)].shard
    few = histogram_shards.shard(docs, key, size, shards=4).collect()
    assert len(few) == len(placed) and set(slots) == {0, 1, 2, 3}


@pytest.mark.parametrize("shards", [1, 2, 5])
def test_plan_takes_nearest_edges(shards):
    cells = [histogram_shards.Cell(format(i, "03X"), 10, 1) for i in range(100)]
    ranges = histogram_shards.plan_ranges(cells, shards)
    firsts = [r.start for r in ranges if r.slot == 0]
    assert len(firsts) == shards and all(abs(int(f, 16) - i * 100 / shards) <= 1 for i, f in enumerate(firsts))
