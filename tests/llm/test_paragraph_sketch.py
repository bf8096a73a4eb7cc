import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from wardenlake.llm import paragraph_sketch
from wardenlake.llm.catalog import op1_paragraph_sketch

PARAGRAPH = re.compile(r"(?:[^\s.!?]+[^\S\n]*){1,12}[.!?]*|[.!?]+", re.ASCII)


def paragraphs(text):
    return set(PARAGRAPH.findall(text))


def jaccard(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(docs):
    """doc_id, n_chars, edited_sha256, near_edited, near_next by plain Python."""
    docs = sorted(((d, t or "") for d, t in docs), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    for i, (doc, text) in enumerate(docs):
        following = docs[(i + 1) % len(docs)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        yield doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), jaccard(text, edited), jaccard(text, following)


def run(spark, path, docs):
    frame = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, own int")
    frame.repartition(4).write.parquet(f"{path}/documents.parquet")
    return op1_paragraph_sketch(spark, str(path)).collect()


def test_same_as_brute_force(spark, tmp_path):
    rng = random.Random(1)
    words = ["the", "quick", "Größe", "日本", "fox.", "end!\n", "a", "  b", "?"]
    docs = [(7 * i, " ".join(rng.choices(words, k=rng.randrange(1, 300)))) for i in range(60)]
    docs += [(1000 + i, docs[i][1]) for i in range(5)] + [(2000, "only one sentence without an end " * 2000), (3000, None), (3001, "")]
    rows = run(spark, tmp_path, docs)
    got = [(r["doc_id"], r["n_chars"], r["edited_sha256"], pytest.approx(r["near_edited"]), pytest.approx(r["near_next"])) for r in rows]
    assert sorted(got, key=lambda r: r[0]) == list(brute(docs))
    prints = {}
    texts = dict(docs)
    for r in rows:
        assert prints.setdefault(texts[r["doc_id"]] or "", r["fingerprint"]) == r["fingerprint"]
        if r["near_edited"] < 1:
            assert r["fingerprint"] != r["edited_fingerprint"]


def test_odd_ids(spark, tmp_path):
    docs = [(5, "b. c."), (5, "a. b."), (5, "a. b."), (None, "n. m."), (None, "o."), (-3, "x. y. z."), (2**62, "big."), (2**62 + 1, "bigger.")]
    rows = run(spark, tmp_path, docs)
    got = [(r["doc_id"], r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in rows]
    assert sorted(map(str, got)) == sorted(map(str, brute(docs)))


@pytest.mark.parametrize("docs", [[], [(1, "alone here. and here.")], [(None, "x."), (None, "y. z.")]])
def test_few_rows(spark, tmp_path, docs):
    rows = run(spark, tmp_path, docs)
    assert sorted(r["edited_sha256"] for r in rows) == sorted(b[2] for b in brute(docs))


def test_peeling_recovers_the_digests_and_retries(spark):
    """Tables far too small for the difference at first."""
    rng = random.Random(2)
    sets = []
    for i in range(40):
        shared = [rng.getrandbits(64) - 2**63 for _ in range(rng.randrange(100))]
        a, b = ([rng.getrandbits(64) - 2**63 for _ in range(rng.randrange(60))] for _ in range(2))
        sets.append((i, shared + a, b + shared))
    df = spark.createDataFrame(sets, "i int, a array<bigint>, b array<bigint>")
    found = paragraph_sketch.differences(F.col("a"), [F.col("b")])
    for row in df.withColumn("d", found[0]).collect():
        a, b = set(row["a"]), set(row["b"])
        assert set(row["d"]["left"]) == a - b and set(row["d"]["right"]) == b - a
        assert len(row["d"]["left"]) == len(a - b) and len(row["d"]["right"]) == len(b - a)


def test_sketches_are_linear(spark):
    df = spark.createDataFrame([([1, 2, 3], [2, 3, 9])], "a array<bigint>, b array<bigint>")
    cells = paragraph_sketch.subtract(paragraph_sketch.sketch(F.col("a")), paragraph_sketch.sketch(F.col("b")))
    row = df.select(paragraph_sketch.peel(cells, F.lit(6)).alias("p")).first()["p"]
    assert row["left"] == [1] and row["right"] == [9] and all(c["n"] == 0 for c in row["cells"])
