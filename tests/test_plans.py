"""What the physical plans must and must not contain."""
import pathlib
import re

import pytest

from lettera.operators import context as ctx
from lettera.operators import metrics, ordering
from lettera.plans import registry

ROOT = pathlib.Path(__file__).resolve().parents[1]


@pytest.fixture(scope="module")
def ws(spark, sf_dir):
    return registry.workspace(spark, sf_dir)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_years_and_columns_reach_the_scan(ws):
    text = plan(ctx.school_census(ws.tables.escola([1999]), ws.cycle).select("id_municipio", "esc_quantidade"))
    scan = next(line for line in text.splitlines() if "lineitem" in line)
    assert "GreaterThanOrEqual(l_shipdate,1999-01-01" in scan
    assert "l_extendedprice" not in scan and "l_tax" not in scan


def test_base_tables_scan_the_order_lines_six_times(ws):
    ws.tables.facts()
    plans = [ws.tables._fact_sums(), ws.pupil_sums(), ws.split(), *(df for _, df, _ in ws.sources())]
    scans = [sum("Scan parquet" in line and "lineitem" in line for line in plan(d).splitlines()) for d in plans]
    # facts, pupils, then census, classes, sewage and pre-school, which need more than the sums
    assert sum(scans) <= 6, scans


def test_stored_sources_are_joined_and_tested_without_a_shuffle(ws, spark):
    from lettera.operators import guards

    sources = ws.stored_sources
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "hashpartitioning" not in plan(guards.join_fanout(sources))
        for grain in (["id_municipio", "rede_nome"], ["id_municipio"]):
            first, *rest = [df for _, df, keys in sources if keys == grain]
            assert len(rest) >= 4
            for df in rest:
                first = first.join(df, grain, "left")
            assert "hashpartitioning" not in plan(first) and "SortMergeJoin" in plan(first)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_aggregations_sum_before_they_shuffle(ws):
    text = plan(ws.pupil_sums())
    assert text.count("partial_sum") >= 2 and "SortAggregate" not in text


def test_pupils_are_joined_once_for_the_base_table(ws):
    text = plan(ws.abt())
    assert len(re.findall("LeftOuter", text)) == 1 and "CartesianProduct" not in text


def test_order_statistics_have_no_single_task_sort(ws, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        units = ws.units
        for df in (ordering.quantiles(units, "rede_taxa_ant", {"m": .5}, ["sigla_uf"], "alunos"),
                   metrics.measure(units.selectExpr("rede_nome as g", "bateu_meta as y", "1 as w", "taxa_real / 100 as p"), ["g"])):
            text = plan(df)
            assert "SinglePartition" not in text and "ObjectHashAggregate" not in text
            assert "percentile" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_top_rows_are_cut_in_every_task(ws):
    from lettera.plans.profile_queries import large_unit_effect

    text = plan(large_unit_effect(ws))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_sources_keep_the_rules():
    for path in (ROOT / "lettera").rglob("*.py"):
        text = path.read_text()
        assert "localCheckpoint" not in text and ".rdd" not in text and "monotonically_increasing" not in text
        assert not re.search(r"@F\.udf|F\.udf\(|percentile_approx", text)


def test_ablation_takes_every_hypothesis_block_in_and_out():
    from lettera.functions.metadata import HYPOTHESIS_OF, TERRITORY
    from lettera.plans import model_queries as mq

    every = mq.DESIGN.variables
    of = {v: HYPOTHESIS_OF[v].split(" ")[0] for v in every}
    base = [v for v in every if of[v] in ("H8", "controle")]
    want = {"todas": every, "sem território": [v for v in every if v not in TERRITORY], "base": base}
    for h in set(of.values()) - {"H8", "controle"}:
        want[f"base + {h}"] = base + [v for v in every if of[v] == h]
        want[f"todas menos {h}"] = [v for v in every if of[v] != h]
    sets, blocks = mq.ablation_sets(every)
    assert sets == want and len(want) == 15 and blocks == sorted(blocks, key=lambda h: int(h[1:]))
