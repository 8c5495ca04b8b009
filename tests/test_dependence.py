"""Curves of a forest from one walk down its trees, next to scores of every row at every point."""
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lettera.operators import dependence as dep
from lettera.operators import modeling as mod
from lettera.operators.prepare import Design

DESIGN = Design(["x", "z", "few"], ["kind"], {"no_x": "x", "no_z": "z"})
VARIABLES = ["x", "few", "z", "absent"]
TREE = {"n_estimators": 7, "max_depth": 7, "min_samples_leaf": 2, "max_features": 0.7}


@pytest.fixture(scope="module")
def units(spark):
    rng = np.random.default_rng(5)
    n = 300
    x, z, few = rng.normal(size=n), np.round(rng.normal(size=n), 1), rng.integers(0, 3, n).astype(float)
    p = pd.DataFrame({"sigla_uf": rng.choice(["A", "B"], n), "kind": rng.choice(["k", "l", "m"], n), "x": x, "z": z, "few": few, "absent": rng.normal(size=n),
                      "bateu_meta": (x * z + few + rng.normal(size=n) > 1).astype(int)})
    p.loc[::7, "x"], p.loc[::5, "z"] = np.nan, np.nan
    d = spark.createDataFrame(p)
    return d.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("x", "z")})


@pytest.fixture(scope="module")
def fitted(units, tmp_path_factory):
    return mod.fit(units, DESIGN, mod.FOREST, TREE, 3, str(tmp_path_factory.mktemp("forest")))


def in_groups(units):
    other = F.when(F.col("kind") == "k", "first").when(F.col("kind") == "l", "second")      # null for the third kind
    return units.withColumn("grupo", F.lit("amostra")).unionByName(units.withColumn("grupo", other))


def table(curve):
    return {(r.grupo, r.variavel, r.ponto): (r.media, r.linhas) for r in curve.collect()}


def test_a_forest_is_walked_once_for_all_points(spark, units, fitted, tmp_path, monkeypatch):
    rows, real = in_groups(units), mod.score
    monkeypatch.setattr(mod, "score", lambda *_: pytest.fail("rows were scored point by point"))
    got = table(mod.partial_dependence(fitted, rows, VARIABLES, str(tmp_path / "a")))
    monkeypatch.setattr(mod, "score", real)
    monkeypatch.setattr(dep, "MOST_CELLS", 0)                       # every row at every point, by the model
    plain = table(mod.partial_dependence(fitted, rows, VARIABLES, str(tmp_path / "b")))
    assert got.keys() == plain.keys() and {k[0] for k in got} == {"amostra", "first", "second"}
    for k, (mean, n) in plain.items():
        assert got[k] == (pytest.approx(mean, abs=1e-12), n)
    for group, v in (("amostra", "x"), ("first", "few"), ("second", "z")):
        point = max(k[2] for k in got if k[:2] == (group, v))
        one = fitted.score(rows.where(F.col("grupo") == group).withColumn(v, F.lit(point))).agg(F.avg("p"), F.count("*")).first()
        assert got[group, v, point] == (pytest.approx(one[0], abs=1e-12), one[1])
    assert len({got[k][0] for k in got if k[:2] == ("amostra", "few")}) == 3
    assert len({round(got[k][0], 12) for k in got if k[:2] == ("first", "absent")}) == 1


def test_other_models_are_scored_at_every_point(units, tmp_path):
    rows = in_groups(units)
    for family, params in ((mod.LOGISTIC, {"C": 1.0}), (mod.BOOSTING, {"max_iter": 3, "max_leaf_nodes": 4})):
        model = mod.fit(units, DESIGN, family, params, 3, str(tmp_path / "m"))
        assert not dep.can_walk(model.model, model.preparation, 1)
        got = table(mod.partial_dependence(model, rows, ["few"], str(tmp_path / "g")))
        one = model.score(units.withColumn("few", F.lit(2.0))).agg(F.avg("p")).first()[0]
        assert got["amostra", "few", 2.0] == (pytest.approx(one, abs=1e-12), 300)


def test_rows_walk_in_chunks_whatever_the_batches(monkeypatch):
    monkeypatch.setattr(dep, "CHUNK", 8)
    batches = [pa.RecordBatch.from_pydict({"a": pa.array(range(k, k + n), pa.int64())}) for k, n in ((0, 3), (3, 0), (3, 20), (23, 7))]
    found = [t.column(0).to_pylist() for t in dep.chunks(iter(batches))]
    assert [v for f in found for v in f] == list(range(30)) and [len(f) for f in found] == [8, 8, 8, 6]


def test_the_table_of_factors_follows_from_the_walk(units, fitted, tmp_path, monkeypatch):
    """Effects, regions that agree and verdicts are those of the curves that the model's own scores give."""
    factors = {"x": ("X", "educação", "+"), "z": ("Z", "outra pasta", "-"), "few": ("F", "território", "?")}
    order = {"educação": 0, "outra pasta": 1, "território": 2}

    def found(name):
        curve = mod.partial_dependence(fitted, in_groups(units), list(factors), str(tmp_path / name))
        return [tuple(r) for r in mod.factor_table(mod.factor_effects(curve, units, list(factors)), factors, order).collect()]

    real, calls = mod.score, []
    monkeypatch.setattr(mod, "score", lambda *a: calls.append(a) or real(*a))
    got = found("a")
    assert not calls and [r[0] for r in got] == ["x", "z", "few"]
    monkeypatch.setattr(dep, "MOST_CELLS", 0)
    for a, b in zip(got, found("b"), strict=True):
        assert a[:6] + a[7:] == b[:6] + b[7:] and a[6] == pytest.approx(b[6], abs=1e-9)
    assert calls
