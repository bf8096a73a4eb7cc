import math
import random
import re

import numpy as np

from wardenlake.llm import ngram_jaccard
from wardenlake.llm.catalog import op2_ngram_jaccard
from wardenlake.llm.components import components


def grams(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def same(a, b):
    x, y = grams(a), grams(b)
    if x and y:
        return len(x & y) >= 0.8 * len(x | y)
    return not x and not y and a == b and bool((a or "").strip())


def brute(docs):
    """{row number: (class, links)}"""
    n = len(docs)
    near = {i: [j for j in range(n) if j != i and same(docs[i][1], docs[j][1])] for i in range(n)}
    out, seen = {}, {}
    for i in range(n):
        if i not in seen:
            group, front = {i}, [i]
            while front:
                for j in near[front.pop()]:
                    if j not in group:
                        group.add(j)
                        front.append(j)
            ids = [docs[k][0] for k in group if docs[k][0] is not None]
            seen |= {k: min(ids, default=None) for k in group}
        out[i] = (docs[i][0], seen[i], len(near[i]))
    return sorted(out.values(), key=str)


def corpus(rng):
    def text(n):
        return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))

    docs = []
    for _ in range(40):
        base = text(rng.randrange(30, 200))
        docs.append(base)
        for _ in range(rng.randrange(4)):
            w = base.split()
            for _ in range(rng.randrange(5)):
                w[rng.randrange(len(w))] = "changed"
            docs.append(rng.choice([" ".join(w), base, base.upper() + "!"]))
    hot = text(300).split()
    for i in range(80):  # a large group of near copies, chained
        w = list(hot)
        for k in range(1 + i % 7):
            w[(37 * i + 11 * k) % 300] = f"x{i}"
        docs.append(" ".join(w))
    docs += ["a b", "a b", "a  B!", "a c", "???", "???", "!", "", " ", None, "long " * 20_000, "word"]
    rng.shuffle(docs)
    return [(None if i % 41 == 5 else 3 * i, t) for i, t in enumerate(docs)]


def test_same_as_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ngram_jaccard, "VERIFY_BLOCK", 20)
    monkeypatch.setattr(ngram_jaccard, "BUCKET_BLOCK", 30)
    docs = corpus(random.Random(11))
    docs += docs[:3]  # repeated rows
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, links int, node string")
    frame.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    rows = op2_ngram_jaccard(spark, str(tmp_path)).collect()
    got = sorted(((r["doc_id"], r["class_id"], r["links"]) for r in rows), key=str)
    assert got == brute(docs)


def test_nothing_alike(spark):
    docs = spark.createDataFrame([(1, "one text that stands alone here"), (2, None)], "doc_id long, text string")
    assert sorted(map(tuple, ngram_jaccard.jaccard_join(docs).collect())) == [(1, 1, 0, 0), (2, 2, 0, 0)]
    assert ngram_jaccard.jaccard_join(docs.limit(0)).collect() == []


def test_one_of_each_with_null_and_repeated_ids(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(60)) for c in "abc")
    docs = [(1, one), (None, one), (None, one + " more"), (None, two), (None, two + " more"), (None, two), (7, three), (7, three + " more")]
    docs += [(7, one + " end"), (8, three), (9, None), (None, None), (9, ""), (1, one)]
    kept = [tuple(r) for r in ngram_jaccard.one_of_each(spark.createDataFrame(docs, "doc_id long, text string")).collect()]
    assert len(kept) == len(set(kept)) == 6 and {(1, one), (9, None), (None, None), (9, "")} < set(kept)
    assert len({(None, two), (None, two + " more")} & set(kept)) == len({(7, three), (7, three + " more")} & set(kept)) == 1


def test_pruning_keeps_what_may_reach_the_threshold():
    need = ngram_jaccard.least_matches(0.8, 1e-6)
    for n, m in need.items():
        chance = lambda k: sum(math.comb(n + 1, x) * 0.8**x * 0.2 ** (n + 1 - x) for x in range(k + 1))
        assert chance(m) >= 1e-6 and (m == 0 or chance(m - 1) < 1e-6)
    rng = np.random.default_rng(1)
    one = rng.integers(0, 1 << 32, 96, dtype=np.uint64).astype(np.uint32)
    close = np.where(rng.random((200, 96)) < 0.85, one, 7).astype(np.uint32)
    apart = np.where(rng.random((200, 96)) < 0.3, one, 7).astype(np.uint32)
    kept = ngram_jaccard.survivors(one, np.concatenate([close, apart]), need)
    assert set(range(200)) <= set(kept.tolist()) and len(kept) < 205


def test_minhash_estimates_similarity():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 1 << 64, 3000, dtype=np.uint64)
    for overlap in (200, 600, 900):
        a, b = np.sort(pool[:1000]), np.sort(pool[1000 - overlap : 2000 - overlap])
        table = ngram_jaccard.signatures(np.concatenate([a, b]), np.array([1000, 1000]))
        true = overlap / (2000 - overlap)
        assert abs((table[0] == table[1]).mean() - true) < 4 * math.sqrt(true * (1 - true) / 96) + 0.01


def test_matrix_and_pairwise_verification_agree():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 1 << 64, 60, dtype=np.uint64)
    sets = [np.unique(rng.choice(pool, 50)) for _ in range(30)]
    pairs = [(i, np.arange(i + 1, 30)) for i in range(29)]
    every = ngram_jaccard.similar(sets, pairs, 0.5)
    for i, js in pairs:
        few = ngram_jaccard.similar(sets, [(i, js[:3])], 0.5)
        assert (few[i, js[:3]] == every[i, js[:3]]).all()


def test_components_of_a_path_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 20)] + [(7, 7)]
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r["node"]: r["label"] for r in components(frame).collect()}
    assert found == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(20)}
