import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lettera.operators import ordering as O


def skewed(n=400, seed=3):
    """A third of the rows share one value; negatives and zeros included."""
    rng = np.random.default_rng(seed)
    v = np.where(rng.random(n) < 1 / 3, 0.0, np.round(rng.normal(0, 50, n), 1))
    return pd.DataFrame({"g": rng.choice(["a", "b"], n, p=[.9, .1]), "v": v, "w": rng.integers(1, 6, n),
                         "k": [f"r{i}" for i in range(n)]})


def test_quantiles_match_numpy_per_group(spark):
    p = skewed()
    probs = {"p01": .01, "q1": .25, "m": .5, "q3": .75, "top": 1.0, "low": 0.0}
    got = {r.g: r for r in O.quantiles(spark.createDataFrame(p), "v", probs, ["g"]).collect()}
    for g, d in p.groupby("g"):
        for name, q in probs.items():
            assert got[g][name] == pytest.approx(np.quantile(d.v, q), abs=1e-12)


def test_weighted_quantiles_equal_repeated_rows(spark):
    p = skewed()
    got = O.quantiles(spark.createDataFrame(p), "v", {"q1": .25, "m": .5}, [], "w").first()
    long = np.repeat(p.v, p.w)
    assert got.m == pytest.approx(np.median(long)) and got.q1 == pytest.approx(np.quantile(long, .25))


def test_average_ranks_match_pandas(spark):
    p = skewed()
    p.loc[5:15, "v"] = None
    got = O.average_ranks(spark.createDataFrame(p[["v"]]).select(F.nanvl("v", F.lit(None)).alias("v")), "v")
    want = p.v.rank()
    ranks = {r.v: r["rank"] for r in got.collect()}
    assert all(ranks[v] == r for v, r in zip(p.v, want) if not np.isnan(v))


@pytest.mark.parametrize("n_rows,bins", [(7, 3), (10, 4), (11, 5), (23, 5), (101, 10), (400, 5)])
def test_bins_follow_the_rank_formula(spark, n_rows, bins):
    p = skewed(n_rows)
    p["h"] = [hashlib.md5(k.encode()).hexdigest() for k in p.k]
    order = p.sort_values(["v", "h", "k"]).reset_index(drop=True)
    order["want"] = [max(1, -(-(r * bins) // (n_rows - 1))) for r in range(n_rows)]
    want = dict(zip(order.k, order.want))
    d = spark.createDataFrame(p).withColumn("one", F.lit(1).cast("bigint"))
    got = O.equal_frequency_bins(d, "v", "k", "one", bins).select("k", "faixa", "in_bin").collect()
    assert {r.k: r.faixa for r in got} == want and all(r.in_bin == 1 for r in got)


def test_weighted_rows_are_shared_out_like_single_units(spark):
    p = skewed(60)
    d = spark.createDataFrame(p).withColumn("w", F.col("w").cast("bigint"))
    got = O.equal_frequency_bins(d, "v", "k", "w", 5).toPandas()
    p["h"] = [hashlib.md5(k.encode()).hexdigest() for k in p.k]
    o = p.sort_values(["v", "h", "k"])
    units = np.repeat(o.k.to_numpy(), o.w)
    bins = [max(1, -(-(r * 5) // (len(units) - 1))) for r in range(len(units))]
    want = pd.DataFrame({"k": units, "faixa": bins}).groupby(["k", "faixa"]).size()
    have = got.set_index(["k", "faixa"]).in_bin
    assert have.sort_index().to_dict() == want.sort_index().to_dict()


def test_single_row_and_too_few_values(spark):
    one = spark.createDataFrame([("a", 1.0, 1)], "k string, v double, w bigint")
    assert O.quantiles(one, "v", {"m": .5}).first().m == 1.0
    r = O.equal_frequency_bins(one, "v", "k", "w", 5).first()
    assert (r.faixa, r.in_bin) == (1, 1)
    three = spark.createDataFrame([("x", 1.0), ("x", 1.0), ("x", 2.0)], "g string, v double")
    assert O.with_enough_values(three, "v", 3, ["g"]).count() == 0
    assert O.with_enough_values(three, "v", 2, ["g"]).count() == 3


def test_running_total_goes_largest_first(spark):
    p = pd.DataFrame({"k": list("abcd"), "v": [1.0, 5.0, 3.0, 5.0]})
    got = O.running_total(spark.createDataFrame(p), "v", "k").toPandas()
    got = got.sort_values("cum_before")
    assert list(got.v) == [5.0, 5.0, 3.0, 1.0]
    assert list(got.cum_before + got.v) == [5.0, 10.0, 13.0, 14.0] and set(got.cum_total) == {14.0}


def test_hash_positions_cover_every_place_whatever_the_layout(spark):
    d = spark.createDataFrame([(f"m{i}",) for i in range(500)], "k string")
    a = {r.k: r.pos for r in O.hash_positions(d, "k", 42).collect()}
    b = {r.k: r.pos for r in O.hash_positions(d.repartition(13), "k", 42).collect()}
    assert a == b and sorted(a.values()) == list(range(1, 501))
    want = sorted(a, key=lambda k: (hashlib.md5(f"{k}|42".encode()).hexdigest(), k))
    assert [k for k, _ in sorted(a.items(), key=lambda kv: kv[1])] == want


@pytest.mark.parametrize("levels, least", [(0, 1), (1, 100), (2, 100)])
def test_buckets_follow_a_narrow_range(spark, levels, least):
    """A day's timestamps in seconds share one bucket of the logarithm."""
    seconds = spark.range(100_000).select((F.col("id") + 1_700_000_000).alias("v"), F.lit(1).alias("n"))
    d, names = O.split_crowded(seconds, "v", [], levels)
    sizes = d.groupBy(*names).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy(*names).collect()
    assert len(sizes) >= least and (levels == 0 or max(r.n for r in sizes) <= O.CROWDED)
    assert all(a.hi < b.lo for a, b in zip(sizes, sizes[1:]))


def test_a_cluster_inside_a_narrow_range_is_cut_again(spark):
    """Nearly all values lie in one piece of the first level; the results do not depend on the levels."""
    v = F.when(F.col("id") < 20, F.col("id") * 1e5).otherwise(F.col("id") / 1e4) + 1e11
    d = spark.range(30_000).select(v.alias("v"), (F.col("id") % 3).alias("n"))
    most = []
    for levels in (0, 1, 2):
        cut, names = O.split_crowded(d, "v", [], levels)
        most.append(cut.groupBy(*names).count().agg(F.max("count")).first()[0])
    assert most[2] <= O.CROWDED < most[1] <= most[0]
    ranks = [O.average_ranks(d, "v", weight="n", levels=k).orderBy("v").collect() for k in (0, 2)]
    assert ranks[0] == ranks[1]
    got = O.quantiles(d, "v", {"m": .5}, levels=2).first().m
    assert got == pytest.approx(d.select(F.median("v")).first()[0], rel=1e-15)
