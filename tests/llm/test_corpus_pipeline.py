"""The corpus pipeline, stage by stage, and the registered queries against their SQL."""
import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lettera.llm import common, queries


def test_stages_keep_the_columns_and_their_decisions(spark, sf_dir):
    docs = common.documents(spark, sf_dir)
    before = docs.count()
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), name)
        seen[name] = docs
    first = common.documents(spark, sf_dir)
    assert all(d.columns == first.columns for d in list(seen.values())[:-1])
    n = {k: d.count() for k, d in seen.items()}
    assert 0.95 * before <= n["language"] <= before and n["near_copies"] < n["language"] and n["personal_data"] == n["near_copies"]
    assert seen["near_copies"].select("doc_id").distinct().count() == n["near_copies"]
    assert seen["personal_data"].join(first, "text", "left_anti").count() > 0
    repeats = seen["mixture"].groupBy("doc_id").count()
    assert repeats.agg(F.max("count")).first()[0] <= 3
    back = seen["tokens"].select("text").exceptAll(seen["mixture"].select(F.coalesce("text", F.lit("")).alias("text")))
    assert n["tokens"] == n["mixture"] and back.count() == 0


def test_the_mix_keeps_columns_with_names_of_its_own(spark, sf_dir):
    docs = common.documents(spark, sf_dir)
    want = corpus_pipeline.mix_sources(spark, docs, sf_dir)
    more = docs.select("*", F.lit(None).cast("long").alias("size"), *[F.lit(7).alias(c) for c in ("rate", "source_size", "target", "repeats")])
    got = corpus_pipeline.mix_sources(spark, more, sf_dir)
    assert got.columns == more.columns and got.filter("size is null and rate = 7 and source_size = 7 and target = 7 and repeats = 7").count() == got.count()
    assert want.count() > 0 and got.select(*want.columns).exceptAll(want).count() == 0 and got.count() == want.count()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_equal_their_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "conversations"):
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    got = queries.queries()[name](spark, sf_dir).toPandas()
    want = con.sql(queries.oracle_sql()[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    for d in (got, want):                 # a nullable number comes back as another type from each side
        d[[c for c in cols if c == "parent_conv_id"]] = d[[c for c in cols if c == "parent_conv_id"]].astype("Int64")
    rows = lambda d: sorted(map(str, d[cols].itertuples(index=False, name=None)))
    assert rows(got) == rows(want)
