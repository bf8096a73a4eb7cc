import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from wardenlake.llm import whole_tokens
from wardenlake.llm.catalog import op9_whole_tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    return whole_tokens.Counter(PATH, whole_tokens.prove(PATH))


ODD = st.text(st.sampled_from("aeThs'rtIİΣςé é\n\t12½<|>!😀日ﬁ"), max_size=40)
SPECIAL = st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|", "it's", " The", "|>", "x"]), max_size=6).map("".join)


@settings(max_examples=800, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), ODD, SPECIAL), min_size=1, max_size=5))
def test_same_as_the_library(library, counter, texts):
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    want = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert counter.count(texts).tolist() == want


def test_most_vocabulary_words_are_proven(library):
    proven = whole_tokens.prove(PATH)
    words = whole_tokens.words_of(PATH).whole_words()
    assert len(words) * 0.9 < len(proven) <= len(words)
    assert all(proven[1:] > proven[:-1])


def test_query_on_odd_rows(spark, tmp_path, library):
    texts = [None, "", "  ", "The the THE", "<|endoftext|> Größe", "a" * 30_000 + " b" * 3000, "The the THE"]
    rows = [(i, t, 7) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, n_tokens int").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in op9_whole_tokens(spark, str(tmp_path)).collect()}
    for doc, text, _ in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert tuple(got[doc]) == (doc, len((text or "").encode()), n, n > 2048)
    assert whole_tokens.count_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
