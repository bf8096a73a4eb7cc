import numpy as np
import pytest

from wardenlake.llm import ordinal_quality, pretokens
from wardenlake.llm.catalog import op7_ordinal_quality

SF = "/root/testdata/sf0.1"


def loss(model, rows, places, grades):
    score = np.bincount(rows, weights=model.weights[places], minlength=len(grades))
    below = np.column_stack([np.zeros(len(grades)), 1 - model.tails(score), np.ones(len(grades))])
    at = np.arange(len(grades))
    return -np.log(below[at, grades + 1] - below[at, grades]).mean()


def test_fit_finds_ordered_effects():
    rng = np.random.default_rng(3)
    n, pairs = 3000, []
    grades = np.full(n, 2)
    for i in range(n):
        kind = rng.integers(0, 4)
        pairs += [(i, p) for p in rng.choice(np.arange(100, 160), 20, replace=False)]
        if kind == 0:
            grades[i] = 0
            pairs.append((i, 7))
        elif kind == 1:
            grades[i] = 1
            pairs.append((i, 9))
    rows, places = np.array(sorted(pairs)).T
    model = ordinal_quality.fit(rows, places, grades)
    assert model.weights[7] < model.weights[9] < 0 and model.thresholds[0] < model.thresholds[1]
    assert np.abs(model.weights[100:160]).max() < 0.5
    tails = model.tails(np.bincount(rows, weights=model.weights[places], minlength=n))
    assert np.mean((tails > 0.5).sum(axis=1) == grades) > 0.99
    flat = ordinal_quality.Model(np.zeros_like(model.weights), model.thresholds)
    assert loss(model, rows, places, grades) < 0.3 * loss(flat, rows, places, grades)


@pytest.mark.parametrize("docs", [8, 15])
def test_words_of_few_toxic_documents_have_weight(docs):
    rng = np.random.default_rng(4)
    grades = np.full(3000, 2)
    grades[:200], grades[200:400] = 0, 1
    pairs = [(i, p) for i in range(3000) for p in rng.choice(np.arange(100, 160), 20, replace=False)]
    pairs += [(200 + i, 9) for i in range(docs)]
    model = ordinal_quality.fit(*np.array(sorted(pairs)).T, grades)
    assert model.weights[9] < -1 and np.abs(model.weights[100:160]).max() < 0.5


def test_unseen_documents(spark):
    """Rows that the fit didn't see."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = ordinal_quality.train(docs.where("doc_id % 3 != 0"), labels)
    rest = docs.where("doc_id % 3 = 0").join(ordinal_quality.graded(labels), "doc_id").select("text", "grade").collect()
    good = model.tails(ordinal_quality.scores(model, [r["text"] for r in rest]))[:, -1] >= ordinal_quality.KEEP_FROM
    grade = np.array([r["grade"] for r in rest])
    assert good[grade == 2].mean() > 0.97 and good[grade == 0].mean() < 0.06 and good[grade == 1].mean() < 0.45


def test_pieces_of_a_long_text_count_once(monkeypatch):
    model = ordinal_quality.Model(np.random.default_rng(0).normal(size=1 << 18), np.zeros(2))
    places = set()
    text = "alpha beta gamma. " * 400
    monkeypatch.setattr(pretokens.pieces, "__defaults__", (500, True))
    monkeypatch.setattr(pretokens, "CHUNK_CHARS", 500)
    for _, place in ordinal_quality._texts([text]):
        places |= set(place.tolist())
    got = ordinal_quality.scores(model, ["x", text, "y"])
    assert got[1] == pytest.approx(model.weights[sorted(places)].sum())
    assert got[0] != 0 and got[2] != 0


def test_odd_rows_and_no_ratings(spark, tmp_path):
    docs = spark.createDataFrame(
        [(1, None, 1), (1, None, 1), (2, "", 1), (None, "a text", 1), (3, "word " * 50_000, 1), (4, "!!! ### |||", 1)],
        "doc_id long, text string, keep int",
    )
    labels = spark.createDataFrame([(None, 1, 0), (1, None, 0), (9, 1, None)], "doc_id long, quality int, toxic int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    rows = op7_ordinal_quality(spark, str(tmp_path)).collect()
    assert len(rows) == 6 and all(r["keep"] and 0 <= r["expected_grade"] <= 2 for r in rows)
    some = spark.createDataFrame([(1, 0, 0), (1, 1, 1), (3, 1, 0), (4, 0, 1)], "doc_id long, quality int, toxic int")
    assert {r["doc_id"]: r["grade"] for r in ordinal_quality.graded(some).collect()} == {1: 0, 3: 2, 4: 0}
    assert len(ordinal_quality.rate_documents(docs, some).collect()) == 6
    assert ordinal_quality.rate_documents(docs.limit(0), some).collect() == []


def test_fit_takes_one_text_of_an_id(spark, monkeypatch):
    """An id that a third of all rows share is one rating, whatever its texts."""
    sizes = []
    whole = ordinal_quality.fit
    monkeypatch.setattr(ordinal_quality, "fit", lambda rows, places, grades: (sizes.append(len(grades)), whole(rows, places, grades))[1])
    docs = spark.range(900).selectExpr("IF(id % 3 = 0, 0, id) AS doc_id", "concat('word and text ', id) AS text")
    labels = spark.range(900).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality", "0 AS toxic")
    first = ordinal_quality.train(docs.repartition(3), labels)
    again = ordinal_quality.train(docs.repartition(7), labels)
    assert sizes == [601, 601] and np.array_equal(first.weights, again.weights)
    ordinal_quality.train(docs, labels, rows=90)
    assert 30 < sizes[2] < 100


def test_fit_against_coordinate_search():
    """The smallest penalised loss that a plain search, one number at a time, finds by evaluating it."""
    rng = np.random.default_rng(5)
    n, has = 600, rng.random((600, 4)) < 0.5
    grades = np.digitize(has @ np.array([3.0, 2.0, -2.0, -3.0]) + rng.logistic(size=n), [-1.0, 1.5])
    model = ordinal_quality.fit(*np.nonzero(has), grades)
    found = np.concatenate([model.weights[:4], model.thresholds])
    assert np.all(found[:4] != 0) and not model.weights[4:].any()
    below = np.concatenate([[0], (np.cumsum(np.bincount(grades)[:2] + 0.5)) / (n + 1.5), [1]])
    pull = 1 - below[grades + 1] - below[grades]
    penalty = ordinal_quality.SHRINK * np.sqrt((has * pull[:, None] ** 2).sum(axis=0)) / n

    def objective(x):
        upto = 1 / (1 + np.exp(-(x[4:][None] - (has @ x[:4])[:, None])))
        upto = np.column_stack([np.zeros(n), upto, np.ones(n)])
        likely = upto[np.arange(n), grades + 1] - upto[np.arange(n), grades]
        return np.inf if likely.min() <= 0 else -np.log(likely).mean() + penalty @ np.abs(x[:4])

    best, step = np.array([0.0, 0.0, 0.0, 0.0, -1.0, 1.0]), 1.0
    while step > 1e-7:
        tries = [best + sign * step * unit for unit in np.eye(6) for sign in (1, -1)]
        better = min(tries, key=objective)
        if objective(better) < objective(best) - 1e-15:
            best = better
        else:
            step /= 2
    assert objective(found) <= objective(best) + 1e-6
    assert np.abs(found - best).max() < 0.02
