import hashlib

import pytest
from pyspark.sql import functions as F

from lettera.constants import CONTRACT
from lettera.operators import guards as G
from lettera.operators import modeling
from lettera.operators.prepare import weighted_groups
from lettera.operators.splits import group_folds, sample_rows, split_by_group
from lettera.sources.lake import StopRun


def test_duplicate_keys_and_fanout(spark):
    d = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, v int")
    assert [r.k for r in G.duplicate_keys(d, ["k"]).collect()] == ["a"]
    r = G.join_fanout([("x", d, ["k"]), ("y", d, ["k", "v"])]).collect()
    assert {(x.fonte, x.chaves_duplicadas, x.linhas_a_mais) for x in r} == {("x", 1, 1), ("y", 0, 0)}


def test_enforce_stops_the_run(spark):
    bad = spark.createDataFrame([("a",)], "k string")
    with pytest.raises(StopRun):
        G.enforce(bad, "duplicate keys")
    G.enforce(bad.where("k = 'z'"), "nothing")


def test_invariance_counts_null_as_a_value(spark):
    d = spark.createDataFrame([("g", 1.0, None, 5.0), ("g", 1.0, 2.0, 5.0), ("h", 1.0, None, 1.0), ("h", 2.0, None, 1.0)],
                              "k string, a double, b double, c double")
    got = {r.variavel: r.grupos_que_variam for r in G.group_invariance(d, ["k"], ["a", "b", "c"]).collect()}
    assert got == {"a": 1, "b": 1, "c": 0}


def test_contract_reports_missing_columns_and_tables(spark):
    d = spark.createDataFrame([(1,)], "ano int")
    rows = G.contract(spark, {"alunos": d}, CONTRACT).collect()
    assert {r.situacao for r in rows if r.tabela == "municipio"} == {"tabela ausente"}
    assert {r.coluna for r in rows if r.tabela == "alunos" and r.situacao == "ok"} == {"ano"}


def test_leakage_audit(spark):
    names = ["rede_taxa_ant", "proficiencia", "nota_final", "mun_idhm", "falta"]
    got = {r.variavel: r.situacao for r in G.leakage(spark, names, names[:-1], ["rede_nome"]).collect()}
    assert got == {"rede_taxa_ant": "ok", "proficiencia": "proibida", "mun_idhm": "ok",
                   "nota_final": "sem justificativa temporal", "falta": "declarada mas ausente"}


def test_constant_column_and_empty_column(spark):
    d = spark.createDataFrame([(1.0, None, 1.0), (1.0, None, 2.0)], "a double, b double, c double")
    got = {r.variavel: r.constante for r in G.constants(d, ["a", "b", "c"]).collect()}
    assert got == {"a": True, "b": True, "c": False}


def test_target_correlation_of_constant_is_missing(spark):
    d = spark.createDataFrame([(1.0, 0.0, 10, 0), (1.0, 1.0, 10, 10), (1.0, None, 5, 2)],
                              "a double, b double, n int, y int")
    got = {r.variavel: r for r in G.target_correlation(d, ["a", "b"], "y", "n").collect()}
    assert got["a"].correlacao is None and not got["a"].extrema
    assert got["b"].correlacao == pytest.approx(1.0) and got["b"].extrema


def test_parts_sum_key_format_not_null_match_rate(spark):
    d = spark.createDataFrame([(100.4, "1000001"), (98.0, "10"), (None, "x000001")], "s double, k string")
    assert G.parts_sum(d, "s").first().fora == 1
    assert G.key_format(d, "k").first().fora_do_formato == 2
    assert G.not_null(d, ["s", "k"]).where("coluna = 's'").first().vazias == 1
    r = G.match_rate(d, d.limit(1), "k").first()
    assert r.casados >= 1 and r.contornos == 3


def test_dictionary_and_decisions(spark):
    cols = spark.createDataFrame([("a",), ("b",)], "variavel string")
    dic = spark.createDataFrame([("a", "H1"), ("c", None)], "variavel string, hipotese string")
    got = {(r.variavel, r.problema) for r in G.dictionary_gaps(cols, dic).collect()}
    assert got == {("b", "sem descricao"), ("c", "sem coluna"), ("c", "sem hipotese")}
    lista = spark.createDataFrame([("a", "entra"), ("a", "entra"), ("z", "sai")], "variavel string, situacao string")
    groups = spark.createDataFrame([("a", ["b"])], "variavel string, membros array<string>")
    got = {(r.variavel, r.problema) for r in G.decisions(lista, cols, groups, dic.limit(1), cols).collect()}
    assert {("b", "sem decisao"), ("z", "decisao sem variavel"), ("a", "mais de uma decisao"),
            ("a", "representante fora do grupo")} <= got


def test_weighted_rows_preserve_pupils_and_rate(spark):
    units = spark.createDataFrame([("t", "a", 10, 4), ("t", "b", 5, 5), ("v", "c", 3, 0)],
                                  "particao string, unidade string, alunos bigint, alfabetizados bigint")
    rows = weighted_groups(units)
    assert rows.count() == 4                      # a class without pupils has no row
    pupils = units.select("particao", F.explode(F.sequence(F.lit(1), "alunos")).alias("i"), "alfabetizados") \
        .select("particao", (F.col("i") <= F.col("alfabetizados")).cast("int").alias("alvo"))
    assert all(r.preserva for r in G.aggregation_preserves(pupils, rows).collect())
    broken = rows.withColumn("peso", F.col("peso") + 1)
    assert not any(r.preserva for r in G.aggregation_preserves(pupils, broken).collect())


def test_split_is_disjoint_seeded_and_proportional(spark):
    d = spark.createDataFrame([(f"m{i % 97}",) for i in range(1000)], "id string")
    a = {r.id: r.particao for r in split_by_group(d, "id", 42).collect()}
    b = {r.id: r.particao for r in split_by_group(d.repartition(7), "id", 42).collect()}
    c = {r.id: r.particao for r in split_by_group(d, "id", 43).collect()}
    sizes = [list(a.values()).count(p) for p in ("treino", "validacao", "teste")]
    assert a == b and a != c and sizes == [58, 19, 20]
    assert G.split_integrity(d.join(split_by_group(d, "id", 42), "id"), "id").count() == 0


def test_folds_are_nearly_equal(spark):
    d = spark.createDataFrame([(f"m{i}",) for i in range(23)], "id string")
    sizes = [r["count"] for r in group_folds(d, "id", 42, 5).groupBy("fold").count().collect()]
    assert sorted(sizes) == [4, 4, 5, 5, 5]


def test_sample_is_seeded(spark):
    d = spark.createDataFrame([(f"m{i}",) for i in range(200)], "id string")
    a = {r.id for r in sample_rows(d, "id", 1, 20).collect()}
    assert a == {r.id for r in sample_rows(d.repartition(9), "id", 1, 20).collect()} and len(a) == 20


def test_groups_are_opened_only_where_rows_differ(spark):
    rows = [(None, 1, "a", None), (None, 1, "a", None), (1, 1, "a", None), (1, 1, None, "a"), (2, 3, "x", "y"), (2, 4, "x", "y")]
    d = spark.createDataFrame(rows, "k int, n int, s string, t string")
    assert sorted(r.k for r in G.uneven_groups(d, ["k"], ["n", "s", "t"]).collect()) == [1, 2]
    for columns in (["n", "s", "t"], ["n"], ["s"]):
        got = {r.variavel: r.grupos_que_variam for r in G.group_invariance(d, ["k"], columns).collect()}
        want = {c: sum(len({r[" nst".index(c[0])] for r in rows if r[0] == k}) > 1 for k in (None, 1, 2)) for c in columns}
        assert got == want
    even = G.group_invariance(d.where("k is null"), ["k"], ["n", "s"])
    assert {r.variavel: r.grupos_que_variam for r in even.collect()} == {"n": 0, "s": 0}
    assert G.group_invariance(d.limit(0), ["k"], ["n"]).first().grupos_que_variam == 0


@pytest.mark.parametrize("n", [0, 1, 37, 500, 501])
def test_seeded_sample_is_exact_and_repeatable(spark, n):
    d = spark.range(500).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("__other"))
    want = sorted((hashlib.md5(f"{i}|amostra7".encode()).hexdigest(), str(i)) for i in range(500))[:n]
    for parts in (1, 5):
        got = sample_rows(d.repartition(parts), "k", 7, n)
        assert got.columns == d.columns and {r.k for r in got.collect()} == {k for _, k in want}


def test_parameter_draws_are_a_permutation_of_the_grid():
    for size in (1, 2, 7, 120, 1000):
        assert sorted(modeling.permuted(i, size, 5) for i in range(size)) == list(range(size))
    space = {"a": [1, 2, 3], "b": ["x", "y"], "c": list(range(20))}
    drawn = modeling.draw(space, 50, 1)
    assert len({tuple(d.items()) for d in drawn}) == 50 and all(d[k] in space[k] for d in drawn for k in space)
    assert drawn[:10] == modeling.draw(space, 10, 1) != modeling.draw(space, 10, 2)
    assert len({tuple(d.items()) for d in modeling.draw(space, 500, 1)}) == 120
