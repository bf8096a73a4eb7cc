"""Every stage against plain Python over its own input."""

import hashlib

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from tests.llm.test_ngram_jaccard import same
from tests.llm.test_passage_alignment import score
from wardenlake.llm import byte_bpe, language_spans, ordinal_quality

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    """What goes into every stage and what comes out of the last."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out.append(docs)
        stage(spark, docs, SF).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return [*out, docs]


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_names_and_columns(inputs):
    assert [len(corpus_pipeline.STAGES), len({n for n, _ in corpus_pipeline.STAGES})] == [5, 5]
    assert all(df.columns == inputs[0].columns for df in inputs[:5])
    assert all(len(rows(a)) >= len(rows(b)) > 0 for a, b in zip(inputs, inputs[1:]))
    for before, after in zip(inputs[:4], inputs[1:5]):
        assert all(r == rows(before)[k] for k, r in rows(after).items())


def test_language(inputs):
    docs, kept = rows(inputs[0]), rows(inputs[1])
    langs, shares = language_spans.classify(language_spans.train(inputs[0]), [r["text"] for r in docs.values()])
    assert set(kept) == {k for k, lang, s in zip(docs, langs, shares) if lang != "und" and s >= 0.5}
    assert len(kept) > 0.95 * len(docs)


def test_quality(spark, inputs):
    docs, kept = rows(inputs[1]), rows(inputs[2])
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = ordinal_quality.train(inputs[1], labels)
    good = model.tails(ordinal_quality.scores(model, [r["text"] for r in docs.values()]))[:, -1] >= 0.5
    assert set(kept) == {k for k, g in zip(docs, good) if g}
    fine = {r["doc_id"] for r in labels.where("quality = 1 AND toxic = 0").collect()} & set(docs)
    assert len(fine & set(kept)) > 0.95 * len(fine)


def test_near_duplicates(inputs):
    docs, kept = rows(inputs[2]), rows(inputs[3])
    texts = {k: r["text"] for k, r in docs.items()}
    group = {k: k for k in texts}
    for k in sorted(texts):
        for j in sorted(texts):
            if j < k and group[j] != group[k] and same(texts[j], texts[k]):
                old, new = max(group[j], group[k]), min(group[j], group[k])
                group = {x: new if g == old else g for x, g in group.items()}
    assert set(kept) == {k for k in texts if group[k] == k}


def test_decontamination(spark, inputs):
    docs, kept = rows(inputs[3]), rows(inputs[4])
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    some = [k for k, r in docs.items() if len(r["text"]) < 1500 or k not in kept]
    assert {k for k in some if k in kept} == {k for k in some if all(score(i, docs[k]["text"]) < 0.5 for i in items)}


def test_encoding(inputs):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(path), special_tokens={})
    docs, out = rows(inputs[4]), rows(inputs[5])
    assert set(docs) == set(out)
    for k, r in out.items():
        ids = library.encode_ordinary(docs[k]["text"])
        assert r["n_tokens"] == len(ids) and r["decoded_sha256"] == hashlib.sha256(docs[k]["text"].encode()).hexdigest()


def test_run_is_the_stages_in_turn(spark, inputs):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, inputs[5].collect()))


def test_odd_rows(spark, tmp_path):
    docs = spark.createDataFrame(
        [(1, None, "en", "a", None), (2, "", None, None, 0), (None, "the river and the house", "en", None, 1), (3, "the river and the house", "en", None, 1)]
        + [(4, "the river and the house", "en", None, 1), (5, "!!! 12", "fr", None, 2), (6, "the wide river", "en", None, 2), (6, "the wide river", "en", None, 2)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted(r["doc_id"] or 0 for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert got == [3, 6]  # the row without an id is a copy of document 3
