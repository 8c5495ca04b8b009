"""Registered queries against their SQL on the smallest data, and the contract of the entry file."""
import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_points
from tools.check import TABLES, compare

FAST = ["modelable_population", "network_context", "municipal_context", "school_census_agg", "teacher_indicators",
        "early_childhood", "abt", "network_table", "split_by_group", "group_folds", "weighted_groups",
        "check_group_invariance", "describe_by_group", "rate_by_quantile", "spearman_matrix", "metrics_weighted",
        "calibration_bins", "risk_list", "region_overlap", "probability_bands", "impute_by_group", "geojson_rings"]


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", FAST)
def test_query_equals_sql(spark, sf_dir, duck, name):
    got = entry_points.queries()[name](spark, sf_dir).toPandas()
    cur = duck.execute(entry_points.oracle_sql()[name])
    want = pd.DataFrame(cur.fetchall(), columns=[d[0] for d in cur.description])
    assert compare(got, want) in ("exact", "near (last digits)")
    assert len(got) > 0


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert len(entry_points.queries()) >= 110


def test_entry_returns_rows(spark):
    d = entry_points.entry(spark)
    assert d.count() == 20 and "taxa_real" in d.columns
