"""Tables in long form are never collected on the driver, and one order of the rows serves several numbers of bins."""
import pytest
from pyspark.sql import functions as F

from lettera.operators import modeling, ordering, profile, relations
from lettera.operators.prepare import to_long

COLUMNS = [f"c{i}" for i in range(12)]


@pytest.fixture(scope="module")
def units(spark, tmp_path_factory):
    """A stored table, which Spark takes for small in long form too."""
    path = str(tmp_path_factory.mktemp("units") / "u")
    d = spark.range(400).select(
        F.concat(F.lit("u"), "id").alias("unidade"), (F.col("id") % 40).cast("string").alias("id_municipio"),
        (F.col("id") % 9 + 2).alias("alunos"), (F.col("id") % 3).alias("alfabetizados"),
        *[F.when(F.col("id") % (i + 5) > 0, (F.col("id") * (i + 3) % (3 if i == 0 else 7 if i == 1 else 97)).cast("double")).alias(c)
          for i, c in enumerate(COLUMNS)])
    d.write.parquet(path)
    return spark.read.parquet(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranks_and_positions_go_through_no_broadcast(units):
    long = to_long(units, COLUMNS, ["unidade", "alunos"])
    for d in (relations.rank_frame(units, COLUMNS, "unidade", ["alunos"], "alunos"),
              ordering.average_ranks(long, "valor", ["variavel"]),
              ordering.tied_positions(long, "valor", "unidade", "alunos", ["variavel"]),
              modeling.shuffled_blocks(units, "unidade", {"b": COLUMNS[:2]}, 3, 1)):
        assert "Broadcast" not in plan(d)


def test_pairwise_ranks_are_not_broadcast(units, monkeypatch):
    seen = []
    monkeypatch.setattr(relations, "_list_pair_sums", lambda rows, *_: seen.append(rows) or units.select(F.lit("a").alias("a"), F.lit("b").alias("b"), *[
        F.lit(2.0).alias(s) for s in relations.PAIR_SUMS]))
    relations.pairwise_spearman(units, COLUMNS, "unidade")
    assert "Broadcast" not in plan(seen[0])


def test_the_counted_values_stay_where_they_are(units):
    """Only the side with one row per variable is sent around."""
    for d in (profile.scale_concentration(units, COLUMNS), profile.variable_histogram(units, COLUMNS)):
        joins = [line for line in plan(d).splitlines() if "BroadcastHashJoin" in line]
        assert joins and all("BuildRight" in line for line in joins)


def test_several_numbers_of_bins_in_one_pass(units):
    both = relations.rates_by_quantile(units, COLUMNS, (5, 10))
    for n in (5, 10):
        got = both.where(F.col("faixas") == n).drop("faixas").orderBy("variavel", "faixa").collect()
        want = relations.rate_by_quantile(units, COLUMNS, n).orderBy("variavel", "faixa").collect()
        assert len(got) == len(want) > 0
        for a, b in zip(got, want):
            assert list(a) == pytest.approx(list(b))
    assert {r.variavel for r in both.where("faixas = 10").select("variavel").distinct().collect()} == set(COLUMNS[2:])
