import itertools
from math import factorial

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector

from wardenlake.models import training
from wardenlake.models.trees import read_trees
from wardenlake.operators import tree_shapley
from wardenlake.plans import runs


def enumerated(f, x, background):
    """Shapley values by all coalitions of four features."""
    d = len(x)
    phi = np.zeros(d)
    for z in background:
        value = {s: f(np.where([j in s for j in range(d)], x, z)) for r in range(d + 1) for s in itertools.combinations(range(d), r)}
        for j in range(d):
            for s in value:
                if j not in s:
                    weight = factorial(len(s)) * factorial(d - len(s) - 1) / factorial(d)
                    phi[j] += weight * (value[tuple(sorted((*s, j)))] - value[s]) / len(background)
    return phi


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(8)
    x = np.round(rng.standard_normal((400, 4)), 1)  # values on the cut points too
    y = ((x[:, 0] * x[:, 1] > 0) ^ (x[:, 2] + 0.3 * x[:, 3] > 0.8)).astype(int)
    rows = [(i, int(c), [float(v) for v in row]) for i, (c, row) in enumerate(zip(y, x))]
    return spark.createDataFrame(rows, "tx_id long, Class int, x array<double>").withColumn("features", array_to_vector("x")).cache(), x


@pytest.mark.parametrize("learner,size", [(RandomForestClassifier, {"numTrees": 4, "maxDepth": 6}), (GBTClassifier, {"maxIter": 4, "maxDepth": 4})])
def test_equal_to_all_coalitions(table, learner, size):
    df, x = table
    trees = read_trees(df, learner(labelCol="Class", seed=1, **size).fit(df))
    stops, background = trees.stops(None), x[50:57]

    def f(row):
        values = trees.leaf_values(row[None, :], stops, len(trees.roots))[0]
        return (values * trees.weights).sum() if trees.boosted else values.mean()

    boxes = tree_shapley.leaves(trees, background)
    got = tree_shapley.contributions(x[:12], boxes)
    for i in range(12):
        assert np.allclose(got[i], enumerated(f, x[i], background), atol=1e-9)
        assert got[i].sum() == pytest.approx(f(x[i]) - np.mean([f(z) for z in background]), abs=1e-9)


def test_a_run_explains_every_row(spark, signal):
    model = training.train_champion(signal, params={"n_estimators": 5, "max_depth": 5})
    few = signal.where("tx_id < 300")
    phi = runs.explain_run(model, few, permutations=10, method="tree").collect()
    names = model.stages[0].features_names()
    total = {}
    for r in phi:
        total[r["tx_id"]] = total.get(r["tx_id"], 0.0) + r["phi"]
    assert len(phi) == 300 * len(names) and len(total) == 300
    scores = {r["tx_id"]: r["score"] for r in training.score_table(model, few).collect()}
    apart = {round(scores[i] - t, 9) for i, t in total.items()}
    assert len(apart) == 1  # the mean score of the background
    sampled = {(r["tx_id"], r["feature"]): r["phi"] for r in runs.explain_run(model, few, samples=5, permutations=10).collect()}
    exact = {(r["tx_id"], r["feature"]): r["phi"] for r in phi}
    assert np.corrcoef([sampled[k] for k in sampled], [exact[k] for k in sampled])[0, 1] > 0.8
    with pytest.raises(ValueError, match="forests"):
        runs.explain_run(training.train_baseline(signal), few, method="tree")


def test_no_rows(spark, table):
    df, _ = table
    trees = read_trees(df, RandomForestClassifier(labelCol="Class", numTrees=2, maxDepth=2).fit(df))
    assert tree_shapley.tree_shapley_values(df.limit(0), df, trees, list("abcd")).count() == 0
    with pytest.raises(ValueError, match="background"):
        tree_shapley.tree_shapley_values(df, df.limit(0), trees, list("abcd"))


def test_small_batches_share_the_tables_of_leaves():
    x = np.arange(12_000.0).reshape(-1, 2)
    batch = pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1])], ["a", "b"])
    joined = list(tree_shapley._larger(iter([batch] * 20)))
    assert [b.num_rows for b in joined] == [54_000, 54_000, 12_000]
    features, low, high = np.array([0, 1]), np.array([5.0, -np.inf]), np.array([9000.0, 8000.0])
    leaf = tree_shapley.Leaf(1.0, features, low, high, np.array([0, 3]), np.array([0.5, 0.5]))
    assert (tree_shapley._column_masks(x.T, leaf) == tree_shapley._masks(x, features, low, high)).all()
