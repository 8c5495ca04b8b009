"""Leaf-wise boosting: both ways of summing, plain code, the penalty, storing."""
import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lettera.operators import boosting
from lettera.operators.boosting import Leafwise, LeafwiseModel, Params


def data(n=200, seed=3):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.normal(size=n).round(2), rng.integers(0, 4, n), rng.normal(size=n).round(1), np.ones(n)], axis=1)
    y = (x[:, 0] + 0.7 * (x[:, 1] == 2) + rng.normal(scale=.6, size=n) > .2).astype(float)
    return x, y, rng.integers(1, 4, n).astype(float)


def frame(spark, x, y, w):
    return spark.createDataFrame([(Vectors.dense(a), float(b), float(c)) for a, b, c in zip(x, y, w)], ["features", "y", "w"])


def plain(x, y, w, p):
    """Every split of every leaf tried on the rows themselves; raw scores of the rows."""
    rate = (w * y).sum() / w.sum()
    raw = np.full(len(y), np.log(rate / (1 - rate)))
    for _ in range(p.max_iter):
        q = 1 / (1 + np.exp(-raw))
        g, h = w * (q - y), w * q * (1 - q)
        score = lambda i: g[i].sum() ** 2 / (h[i].sum() + p.l2_regularization)
        leaves = [np.arange(len(y))]
        while len(leaves) < p.max_leaf_nodes:
            best = (1e-9, None)
            for k, rows in enumerate(leaves):
                for c in range(x.shape[1]):
                    values = np.unique(x[:, c])
                    for t in (values[1:] + values[:-1]) / 2:
                        a, b = rows[x[rows, c] <= t], rows[x[rows, c] > t]
                        if min(len(a), len(b)) >= p.min_samples_leaf:
                            gain = score(a) + score(b) - score(rows)
                            if gain > best[0] + 1e-9:
                                best = (gain, (k, a, b))
            if best[1] is None:
                break
            k, a, b = best[1]
            leaves[k:k + 1] = [a]
            leaves.append(b)
        new = raw.copy()
        for rows in leaves:
            new[rows] -= p.learning_rate * g[rows].sum() / (h[rows].sum() + p.l2_regularization)
        raw = new
    return raw


@pytest.mark.parametrize("l2", [0.0, 5.0])
def test_equals_plain_code(spark, l2):
    x, y, w = data()
    p = Params(0.2, 6, 7, 8, l2)
    want = plain(x, y, w, p)
    for cells in (boosting.ONE_TASK_CELLS, 0):
        model = Leafwise(p, cells).fit(frame(spark, x, y, w).repartition(3))
        assert model.raw(x) == pytest.approx(want, abs=1e-8)
        leaves = {}
        for t, *_ in model.nodes:
            leaves[t] = leaves.get(t, 0) + 1
        assert len(leaves) == 6 and max(leaves.values()) <= 13


def test_penalty_changes_the_fit_and_scores_are_chances(spark):
    x, y, w = data()
    d = frame(spark, x, y, w)
    raw = {l2: Leafwise(Params(0.2, 5, 7, 8, l2)).fit(d).raw(x) for l2 in (0.0, 0.1, 10.0)}
    assert abs(raw[0.0] - raw[0.1]).max() > 1e-4 and np.abs(raw[10.0] - raw[0.0].mean()).mean() < np.abs(raw[0.0] - raw[0.0].mean()).mean()
    model = Leafwise(Params(0.2, 5, 7, 8)).fit(d)
    got = model.score(d.withColumn("id", F.monotonically_increasing_id())).orderBy("id").toPandas()
    assert got.p.to_numpy() == pytest.approx(1 / (1 + np.exp(-model.raw(x)))) and got.p.between(0, 1).all()
    share = model.featureImportances.toArray()
    assert share.sum() == pytest.approx(1) and share[0] > share[2] and share[3] == 0


def test_rows_are_stored_anew_between_trees(spark, monkeypatch):
    monkeypatch.setattr(boosting, "STORE_EVERY", 2)
    x, y, w = data(120, 5)
    p = Params(0.3, 5, 4, 10, 1.0)
    far, near = (Leafwise(p, c).fit(frame(spark, x, y, w)) for c in (0, boosting.ONE_TASK_CELLS))
    assert far.raw(x) == pytest.approx(near.raw(x), abs=1e-9)


def test_stored_models_score_alike(spark, tmp_path):
    x, y, w = data(100, 6)
    model = Leafwise(Params(0.2, 4, 5, 5)).fit(frame(spark, x, y, w))
    model.save(spark, str(tmp_path / "m"))
    assert LeafwiseModel.load(spark, str(tmp_path / "m")).raw(x) == pytest.approx(model.raw(x), abs=0)


def test_many_values_are_cut_into_groups_of_equal_frequency(spark):
    d = spark.range(3000).select(F.array(F.col("id").cast("double"), (F.col("id") % 7).cast("double")).alias("x"))
    limits = boosting.cuts(d.withColumn("fit", F.lit("a")), 2)["a"]
    assert len(limits[0]) == 254 and np.diff(limits[0]).max() <= 13 and limits[1].tolist() == [.5, 1.5, 2.5, 3.5, 4.5, 5.5]


def test_one_class_and_few_rows(spark):
    x, _, w = data(12)
    model = Leafwise(Params(0.2, 3, 7, 20)).fit(frame(spark, x, np.ones(12), w))
    assert len(model.nodes) == 3 and (1 / (1 + np.exp(-model.raw(x))) > .99).all()
    with pytest.raises(ValueError):
        Leafwise(Params()).fit(frame(spark, x, np.ones(12), w).limit(0))


def test_several_fits_grow_side_by_side(spark):
    parts = {"a": data(150, 1), "b": data(90, 2), "c": data(60, 3)}
    rows = None
    for k, (x, y, w) in parts.items():
        one = frame(spark, x, y, w).withColumn("fit", F.lit(k))
        rows = one if rows is None else rows.unionByName(one)
    p = Params(0.3, 4, 5, 6, 1.0)
    only = {"a": [0, 1, 2, 3], "b": [2, 0], "c": [1]}
    for cells in (boosting.ONE_TASK_CELLS, 100 * 4, 0):
        models = Leafwise(p, cells).fit_many(rows, only)
        for k, (x, y, w) in parts.items():
            narrow = x.copy()
            narrow[:, [c for c in range(4) if c not in only[k]]] = 0
            assert models[k].raw(x) == pytest.approx(plain(narrow, y, w, p), abs=1e-8)
            assert {r[2] for r in models[k].nodes} <= {-1, *only[k]}
        got = boosting.score_many(rows.withColumn("id", F.monotonically_increasing_id()), models).orderBy("fit", "id").toPandas()
        want = np.concatenate([1 / (1 + np.exp(-models[k].raw(parts[k][0]))) for k in "abc"])
        assert got.p.to_numpy() == pytest.approx(want)


def test_rows_of_a_node_give_the_same_histograms(monkeypatch):
    """Column by column and all columns at once sum the same rows in the same order."""
    rng = np.random.default_rng(3)
    bins = rng.integers(0, 255, (500, 6)).astype(np.uint8)
    g, h = rng.normal(size=500), rng.random(500)
    at = np.flatnonzero(rng.random(500) < .6)
    want = boosting.histograms(bins[at], g[at], h[at])
    columns = np.ascontiguousarray(bins.T)
    for many in (1, 10_000):
        monkeypatch.setattr(boosting, "MANY_ROWS", many)
        assert (boosting.histograms_at(columns, at, g, h) == want).all()


def test_sets_of_columns_share_the_bins_of_a_part(spark):
    rng = np.random.default_rng(4)
    rows = spark.createDataFrame([(str(i % 2), Vectors.dense(rng.normal(size=3)), float(rng.random() < .5), 1.0) for i in range(200)],
                                 ["fit", "features", "y", "w"])
    ready = boosting.binned(rows)
    both = ready.copied({"0": ["a/0", "b/0"], "1": ["a/1", "b/1"], "2": ["a/2"]})
    assert set(both.sizes) == {"a/0", "b/0", "a/1", "b/1"} and both.rows.count() == 400
    p = boosting.Params(max_iter=3, max_leaf_nodes=4, min_samples_leaf=5)
    plain = boosting.Leafwise(p).fit_binned(ready, {k: [0, 2] for k in "01"})
    shared = boosting.Leafwise(p).fit_binned(both, {f"{s}/{k}": cs for s, cs in (("a", [0, 1, 2]), ("b", [0, 2])) for k in "01"})
    assert [shared[f"b/{k}"].nodes for k in "01"] == [plain[k].nodes for k in "01"]
