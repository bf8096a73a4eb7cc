import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from wardenlake.llm import byte_bpe, merges
from wardenlake.llm.catalog import op5_byte_bpe

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(RANKS), special_tokens={}
    )


def ids(raw):
    return memoryview(raw).cast("I").tolist()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=60), st.text("aehnrtsi ", max_size=60)), min_size=1, max_size=5))
def test_same_as_the_library_on_any_text(library, texts):
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    coded = byte_bpe._encoder(RANKS).encode(texts)
    assert [ids(x) for x in coded] == [library.encode_ordinary(t) for t in texts]
    assert byte_bpe._decoder(RANKS).decode(coded) == [t.encode() for t in texts]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=12), min_size=1, max_size=6), st.randoms(use_true_random=False))
def test_any_order_of_ranks(words, random):
    """Also where a merge makes a pair of a lower rank."""
    tokens = ["ab", "bc", "ca", "aa", "abc", "bca", "abca", "aab", "cab", "abab", "bb", "cc"]
    random.shuffle(tokens)
    ranks = {bytes([b]): b for b in range(256)} | {t.encode(): 256 + i for i, t in enumerate(tokens)}
    coded = byte_bpe.Encoder(ranks)._solve(words)
    pairs = merges.rank_pairs(ranks)
    for word, got in zip(words, coded):
        if word.encode() in ranks:
            assert got == [ranks[word.encode()]]
            continue
        parts = list(word.encode())
        while options := [(pairs[k], i) for i in range(len(parts) - 1) if (k := parts[i] << 20 | parts[i + 1]) in pairs]:
            rank, i = min(options)
            parts[i : i + 2] = [rank]
        assert got == parts


def test_query_on_odd_rows(spark, tmp_path, library):
    texts = [None, "", " ", "It's  a\n\ntest", "<|endoftext|> x", "aaaa" * 5000 + " b" * 3000, "Größe 日本 😀 12345", "It's  a\n\ntest"]
    rows = [(i % 7, t, i) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, ids int").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, op5_byte_bpe(spark, str(tmp_path)).collect()))
    want = []
    for doc, text, _ in rows:
        coded = library.encode_ordinary(text or "")
        raw = b"".join(x.to_bytes(4, "little") for x in coded)
        want.append((doc, len(coded), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want)


def test_empty_table_and_arrays(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.round_trip_digests(none, RANKS).collect() == []
    one = spark.createDataFrame([(1, "hello world"), (2, None)], "doc_id long, text string")
    rows = one.select("doc_id", byte_bpe.ids_array(byte_bpe.encode("text", RANKS)).alias("ids")).orderBy("doc_id").collect()
    assert rows[1]["ids"] == [] and len(rows[0]["ids"]) >= 2


def test_unknown_ids_are_refused():
    with pytest.raises(ValueError):
        byte_bpe._decoder(RANKS).decode([(60_000).to_bytes(4, "little")])


def test_one_worker_does_as_two(spark):
    docs = spark.createDataFrame([(1, "wide river"), (2, None), (2, None), (3, "é中 " * 2000)], "doc_id long, text string")
    both = docs.select(byte_bpe.round_trip("text", RANKS).alias("c")).select("c.*").collect()
    ids = docs.select(byte_bpe.encode("text", RANKS).alias("ids"))
    apart = ids.select("ids", byte_bpe.decode("ids", RANKS).alias("decoded")).collect()
    assert sorted(map(tuple, both)) == sorted(map(tuple, apart))
