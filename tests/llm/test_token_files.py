import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from wardenlake.llm import token_files
from wardenlake.llm.catalog import op4_token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")
SPECIAL = st.lists(st.sampled_from(["<|endoftext|>", "<|", "it's", " The", "|>", "\n\n", "x"]), max_size=7).map("".join)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 3), st.integers(0, 32), st.integers(0, 300), st.randoms(use_true_random=False))
def test_blocks_round_trip(blocks, bits, odd, random):
    rng = np.random.default_rng(random.randrange(1 << 30))
    values = rng.integers(0, 1 << bits, blocks * token_files.BLOCK + random.randrange(3000), dtype=np.uint64).astype(np.uint32)
    if len(values):
        values[rng.integers(0, len(values), odd)] = rng.integers(0, 1 << 32, odd, dtype=np.uint64).astype(np.uint32)
    coded = token_files.encode_blocks(values)
    assert np.array_equal(token_files.decode_blocks(coded), values)


def test_outliers_do_not_widen_a_block():
    values = np.full(token_files.BLOCK, 1000, np.uint32)
    values[::2] += 3
    values[::100] = 4_000_000_000
    (block,) = token_files.encode_blocks(values)
    assert len(block) < token_files.BLOCK * 2 / 8 + 41 * 6 + 20


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), SPECIAL), min_size=1, max_size=6))
def test_ids_of_the_library(library, texts):
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    got = token_files.library_encoder(PATH).encode(texts, 0)
    assert [x.tolist() for x in got] == [[*library.encode(t, add_special_tokens=False).ids, 0] for t in texts]


def test_query_on_odd_rows(spark, tmp_path, library):
    texts = [None, "", "same", "same", "<|endoftext|>a<|endoftext|>", "x " * 40_000, *[f"text number {i}" for i in range(60)]]
    rows = [(None if i == 1 else (i * 7919) % 50, t, 1) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = list(map(tuple, op4_token_files(spark, str(tmp_path)).orderBy("start").collect()))
    want, start = [], 0
    for doc, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want


def test_reader_fetches_single_documents(spark, tmp_path, library):
    docs = spark.createDataFrame([(i, "word " * (i * 900)) for i in range(12)], "doc_id long, text string")
    manifest = token_files.write_corpus(docs, str(tmp_path), PATH)
    assert manifest.agg({"docs": "sum"}).first()[0] == 12
    for row in manifest.collect():
        reader = token_files.Reader(row["path"])
        for i, key in enumerate(reader.keys):
            assert reader.document(i).tolist() == [*library.encode("word " * (key * 900), add_special_tokens=False).ids, 0]


def test_empty_table(spark):
    assert token_files.coded_digests(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
