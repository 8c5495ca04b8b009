import json

import pytest
from pyspark.sql import functions as F

from lettera.sources import geojson, lake


def test_newest_snapshot_wins_and_none_stops(spark, tmp_path):
    root = str(tmp_path / "t")
    with pytest.raises(lake.StopRun):
        lake.read_latest(spark, root)
    old, new = (spark.createDataFrame([(v,)], "v int") for v in (1, 2))
    lake.write_snapshot(old, root, "2024-01-31")
    lake.write_snapshot(new, root, "2024-10-02")
    lake.write_snapshot(old.union(new), root, "2024-02-01")
    assert lake.snapshots(spark, root) == ["2024-01-31", "2024-02-01", "2024-10-02"]
    assert [r.v for r in lake.read_latest(spark, root, ["v"]).collect()] == [2]


def test_a_day_is_replaced_and_the_others_stay(spark, tmp_path):
    root = str(tmp_path / "t")
    d = spark.range(5).toDF("v")
    lake.write_snapshot(d, root, "2024-01-01")
    lake.write_snapshot(d.limit(2), root, "2024-01-02")
    done = lake.write_snapshot(d.limit(3), root, "2024-01-02")
    assert spark.read.parquet(root).count() == 8
    assert lake.reconcile(spark, done).first().confere
    assert not lake.reconcile(spark, {**done, "rows": 99}).first().confere


def test_materialise_builds_once_and_again_when_a_column_is_missing(spark, tmp_path):
    path, calls = str(tmp_path / "m"), []

    def build(cols):
        return lambda: calls.append(cols) or spark.createDataFrame([(1, 2)], "a int, b int").select(*cols)

    assert lake.materialize_if_stale(spark, path, build(["a"]), ["a"])[1] == "consultada"
    assert lake.materialize_if_stale(spark, path, build(["a"]), ["a"])[1] == "cache"
    assert lake.materialize_if_stale(spark, path, build(["a", "b"]), ["b"])[1] == "consultada"
    assert lake.materialize_if_stale(spark, path, build(["a", "b"]), ["b"], refresh=True)[1] == "consultada"
    assert len(calls) == 3


def test_report_rounds_half_to_even(spark, tmp_path):
    d = spark.createDataFrame([("x", 0.125), ("y", 0.375), ("z", None)], "k string, v double")
    got = {r.k: r.v for r in lake.write_report(d, str(tmp_path / "r"), 2).collect()}
    assert got == {"x": 0.12, "y": 0.38, "z": None}


def test_control_table_drives_the_design(spark, tmp_path):
    rows = [("rede_taxa_ant", "H8", "numérica", "entra", "", "mediana da UF", "sem_rede_ant", None, None),
            ("mun_populacao", "controle", "numérica", "entra", "", None, None, "logarítmica", None),
            ("mun_gini", "H7", "numérica", "sai", "redundante", None, None, None, None),
            ("sigla_uf", "controle", "categórica", "entra", "", None, None, None, "one-hot")]
    path = str(tmp_path / "c")
    spark.createDataFrame(rows, lake.CONTROL_SCHEMA).write.option("header", True).csv(path)
    design = lake.design_of(lake.read_control(spark, path))
    assert design["numericas"] == ["rede_taxa_ant", "mun_populacao"] and design["categoricas"] == ["sigla_uf"]
    assert design["indicadores"] == {"sem_rede_ant": "rede_taxa_ant"} and design["com_log"] == ["mun_populacao"]


def test_register_round_trip(spark, tmp_path):
    path = str(tmp_path / "r")
    lake.write_register(spark, path, {"familia": "random forest", "parametros": {"n": 4.0}, "semente": 42,
                                      "criterio": "menor", "metricas": {"auc": .88564}, "variaveis": ["a", "b"]})
    r = lake.read_register(spark, path).first()
    assert r.metricas["auc"] == .88564 and r.variaveis == ["a", "b"] and r.semente == 42


def test_nan_becomes_null_on_load(spark):
    d = spark.createDataFrame([(float("nan"), 1), (1.0, 2)], "v double, k int")
    assert [r.v for r in lake.read_clean(d).orderBy("k").collect()] == [None, 1.0]


def features():
    ring = lambda o: [[o, 0.0], [o, 1.0], [o + 1, 1.0], [o, 0.0]]
    one = {"type": "Feature", "properties": {"codarea": "1"},
           "geometry": {"type": "Polygon", "coordinates": [ring(0.0), [[9.0, 9.0]]]}}
    two = {"type": "Feature", "properties": {"codarea": "2"},
           "geometry": {"type": "MultiPolygon", "coordinates": [[ring(5.0)], [ring(7.0), [[9.0, 9.0]]]]}}
    return [one, two]


@pytest.mark.parametrize("lines", [True, False])
def test_geojson_outer_rings(spark, tmp_path, lines):
    path = tmp_path / "mesh.json"
    text = "\n".join(json.dumps(f) for f in features()) if lines else json.dumps(
        {"type": "FeatureCollection", "features": features()})
    path.write_text(text)
    got = geojson.rings(geojson.read_features(spark, str(path), lines)).orderBy("codarea", "poligono").collect()
    assert [(r.codarea, r.poligono, r.pontos, r.contorno[0][0]) for r in got] == [
        ("1", 0, 4, 0.0), ("2", 0, 4, 5.0), ("2", 1, 4, 7.0)]


def test_search_parameters_survive_csv(spark, tmp_path):
    d = spark.createDataFrame([('{"C": 0.1, "m": "a,b"}',)], "p string")
    path = str(tmp_path / "b")
    d.write.option("header", True).option("escape", '"').csv(path)
    back = spark.read.schema("p string").option("header", True).option("escape", '"').csv(path)
    assert back.select(F.from_json("p", "map<string,string>")["m"]).first()[0] == "a,b"


def test_bucketed_result_is_built_once_and_again_when_cut_short(spark, tmp_path):
    from pathlib import Path

    path, built = str(tmp_path / "t"), []

    def build():
        built.append(1)
        return spark.range(100).selectExpr("id % 7 as k", "id as v", "case when id = 3 then double('nan') else 1.0 end as x")

    read = lambda: lake.bucketed_if_absent(spark, path, "teste_buckets", build, ["k"], 3)
    try:
        assert read().count() == 100 and read().where("x is null").count() == 1 and len(built) == 1
        assert len(list(Path(path).glob("*.parquet"))) <= 3
        (Path(path) / "_SUCCESS").unlink()
        assert read().agg({"v": "sum"}).first()[0] == 4950 and len(built) == 2
    finally:
        spark.sql("drop table if exists teste_buckets")


def test_fact_sums_agree_with_the_lines(spark, sf_dir):
    """Enrolment, cycle results and means from the stored sums against plain pandas over all lines."""
    import pandas as pd

    from lettera.plans.workspace import Workspace

    t = Workspace(spark, sf_dir).tables
    raw = pd.read_parquet(f"{sf_dir}/lineitem.parquet")
    raw["ano"] = pd.to_datetime(raw.l_shipdate).dt.year
    assert t.matriculas([1998]).agg({"todos": "sum"}).first()[0] == (raw.ano == 1998).sum()
    want = raw[raw.l_suppkey % 11 != 0].groupby(["ano", "l_suppkey", "l_linestatus"]).l_quantity.mean() / 50
    got = t.avs().toPandas()
    assert len(got) == len(want)
    assert abs(sorted(got.ivs_capital_humano) - pd.Series(sorted(want))).max() < 1e-9
    right = raw[(raw.l_discount > 0) & raw.l_returnflag.isin(["A", "R"])]
    share = right[right.l_extendedprice >= 50000].l_quantity.sum() / right.l_quantity.sum()
    five = t._cycle_sums().where("rede = '5'").agg({"wy": "sum", "w": "sum"}).first()
    assert abs(five["sum(wy)"] / five["sum(w)"] - share) < 1e-12


def test_two_cycles_do_not_share_tables(spark, sf_dir):
    from dataclasses import replace

    from lettera.constants import DEMO
    from lettera.plans.workspace import Workspace

    now, other = Workspace(spark, sf_dir), Workspace(spark, sf_dir, replace(DEMO, target=DEMO.target - 2))
    assert now.key != other.key
    pupils = lambda ws: ws.units.agg({"alunos": "sum"}).first()[0]
    assert pupils(now) == now.pupil_sums().agg({"alunos": "sum"}).first()[0]
    assert pupils(other) == other.pupil_sums().agg({"alunos": "sum"}).first()[0]


def test_nan_counts_as_missing(spark):
    from lettera.operators.ordering import value_counts

    d = spark.createDataFrame([(1.5,), (3.0,), (float("nan"),), (None,), (3.0,)], "v double")
    assert sorted((r.v, r.n) for r in value_counts(d, "v").collect()) == [(1.5, 1), (3.0, 2)]
