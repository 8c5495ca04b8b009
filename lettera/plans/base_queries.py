"""Sources, context, guards and splits as registered queries."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import CONTRACT, PRIVATE
from ..functions.exprs import hash_number
from ..functions.metadata import (CATEGORICAL, FEATURES, NOT_FEATURES, NUMERIC,
                                  variable_metadata)
from ..operators import context as ctx
from ..operators import guards
from ..operators.prepare import weighted_groups
from ..operators.splits import group_folds, sample_rows
from ..sources import geojson, lake
from .workspace import REGIONS, UNIT, Workspace


def modelable_population(ws: Workspace) -> DataFrame:
    pop = ctx.modelable_population(ws.alunos)
    return pop.groupBy("ano", "rede_nome").agg(
        F.count(F.lit(1)).alias("alunos"), F.sum("alvo").alias("alfabetizados"),
        (F.lit(100.0) * F.avg("alvo")).alias("taxa"))


def pruned_scan(ws: Workspace) -> DataFrame:
    return (ws.alunos.select("ano", "rede_nome", "presente", "peso_aluno")
            .groupBy("ano", "rede_nome", "presente")
            .agg(F.count(F.lit(1)).alias("alunos"), F.sum("peso_aluno").alias("peso")))


def filtered_scan(ws: Workspace) -> DataFrame:
    c = ws.cycle
    d = ws.tables.turma([c.previous]).where(
        (F.col("ano") == c.previous) & F.col("rede").isin("estadual", "municipal")
        & (F.col("etapa_ensino") == "15"))
    return d.groupBy("rede").agg(F.count(F.lit(1)).alias("turmas"),
                                 F.sum("quantidade_matriculas").alias("matriculas"))


def latest_snapshot(ws: Workspace) -> DataFrame:
    root = lake.run_folder(ws.spark, "bronze", "diretorio", ws.key)
    names = ws.tables.diretorio_municipio()
    lake.write_snapshot(names.where("id_municipio is null"), root, "2024-01-31")
    lake.write_snapshot(names, root, "2024-02-29")
    d = lake.read_latest(ws.spark, root, ["id_municipio", "nome", lake.PARTITION])
    return d.withColumn(lake.PARTITION, F.col(lake.PARTITION).cast("string"))


def materialize(ws: Workspace) -> DataFrame:
    """Three calls: first builds, second reuses, third lacks a required column and rebuilds."""
    path = lake.run_folder(ws.spark, "externas", "economia", ws.key)
    narrow = lambda: ws.economy.drop("mun_populacao")
    steps = [lake.materialize_if_stale(ws.spark, path, narrow, ["mun_pib_per_capita"], True)[1],
             lake.materialize_if_stale(ws.spark, path, narrow, ["mun_pib_per_capita"])[1]]
    d, last = lake.materialize_if_stale(ws.spark, path, lambda: ws.economy, ["mun_populacao"])
    return d.agg(F.count(F.lit(1)).alias("linhas"), F.sum("mun_populacao").alias("populacao")) \
            .withColumn("origens", F.lit(", ".join([*steps, last])))


def partitioned_write(ws: Workspace) -> DataFrame:
    root = lake.run_folder(ws.spark, "ml", "porte", ws.key)
    size = ws.enrollment[0]
    for day in ("2024-03-01", "2024-03-02", "2024-03-02"):     # the second day is replaced
        lake.write_snapshot(size, root, day)
    return (ws.spark.read.parquet(root)
            .groupBy(F.col(lake.PARTITION).cast("string").alias(lake.PARTITION))
            .agg(F.count(F.lit(1)).alias("linhas"),
                 F.count_if(F.col(lake.STAMP).isNull()).alias("sem_horario")))


def write_reconcile(ws: Workspace) -> DataFrame:
    root = lake.run_folder(ws.spark, "ml", "modelavel", ws.key)
    done = lake.write_snapshot(ctx.modelable_population(ws.alunos_now), root, "2024-03-01")
    return lake.reconcile(ws.spark, done)


def report_csv(ws: Workspace) -> DataFrame:
    d = ws.redes.groupBy("nome_regiao").agg(
        F.count(F.lit(1)).alias("redes"),
        (F.sum("peso_alfabetizados") / F.sum("peso_total") * 100).alias("taxa"))
    return lake.write_report(d, lake.run_folder(ws.spark, "reports", "regioes",
                                                ws.key), 3)


def geojson_rings(ws: Workspace) -> DataFrame:
    """Mesh text built from the places: a square each, and a second polygon for every third."""
    x = hash_number("s_suppkey", "lon") % 90
    y = hash_number("s_suppkey", "lat") % 60
    point = lambda a, b: F.array((x + a).cast("double"), (y + b).cast("double"))
    square = lambda o: F.array(F.array(point(o, o), point(o, o + 1), point(o + 1, o + 1),
                                       point(o, o)))
    props = F.struct(F.col("id_municipio").alias("codarea"))
    geo = lambda kind, c: F.to_json(F.struct(
        F.lit("Feature").alias("type"), props.alias("properties"),
        F.struct(F.lit(kind).alias("type"), c.alias("coordinates")).alias("geometry")))
    text = F.when(F.col("s_suppkey") % 3 == 0,
                  geo("MultiPolygon", F.array(square(0), square(2)))) \
        .otherwise(geo("Polygon", square(0)))
    found = geojson.rings(ws.tables.places().select(text.alias("value")))
    return found.select("codarea", "poligono", "pontos",
                        F.element_at(F.element_at("contorno", 1), 1).alias("x0"),
                        F.element_at(F.element_at("contorno", 1), 2).alias("y0"))


# -- context ----------------------------------------------------------------------------------
def municipal_context(ws):
    c = ws.cycle
    return ctx.municipal_context(ws.tables.indicador_municipio([c.previous, c.target]), c)


def region_from_code(ws):
    d = ws.tables.places().select("id_municipio", ctx.region_from_code("id_municipio", REGIONS)
                                  .alias("nome_regiao"))
    return d.groupBy("nome_regiao").agg(F.count(F.lit(1)).alias("municipios"))


def enrollment_size(ws):
    by_net, by_mun = ws.enrollment
    return by_net.join(by_mun, "id_municipio")


def network_table(ws):
    """Scan, sum per network, seeded split by municipality: no context is needed for it."""
    public = ws.pupil_sums().where(F.col("rede_nome") != PRIVATE)
    return public.join(ws.split(), "id_municipio").select("particao", *UNIT, "alunos", "alfabetizados", "peso_total",
                           "peso_alfabetizados", "taxa_real", "bateu_meta")


def transport(ws):
    census = ctx.school_census(ws.tables.escola([ws.cycle.previous]), ws.cycle)
    d = ws.enrollment[0].join(census, UNIT, "left")
    return ctx.transport_share(d).select(*UNIT, "esc_pct_transporte")


# -- guards -----------------------------------------------------------------------------------
def check_contract(ws):
    t = ws.tables
    have = {"alunos": ws.alunos, "municipio": t.municipio(),
            "indicador_municipio": t.indicador_municipio()}
    found = guards.contract(ws.spark, have, CONTRACT)
    # the rows behind each table, so that an empty table cannot pass
    rows = None
    for name, df in have.items():
        one = df.agg(F.count(F.lit(1)).alias("linhas")).withColumn("tabela", F.lit(name))
        rows = one if rows is None else rows.unionByName(one)
    return found.join(rows, "tabela", "left")


def check_join_fanout(ws):
    """The stored sources, tested where they lie: their buckets are groups of the key already."""
    return guards.join_fanout(ws.stored_sources)


def check_unique_key(ws):
    t, c = ws.tables, ws.cycle
    raw = guards.duplicate_keys(t.indicadores_educacionais(), ["id_municipio", "rede"])
    kept = guards.duplicate_keys(ctx.teacher_indicators(t.indicadores_educacionais(), c), UNIT)
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("chaves_repetidas")) \
        .withColumn("tabela", F.lit(name))
    return count(raw, "fonte").unionByName(count(kept, "indicadores docentes"))


def check_parts_sum(ws):
    d = ctx.teacher_indicators(ws.tables.indicadores_educacionais(), ws.cycle, keep_sum=True)
    return guards.parts_sum(d, "soma_grupos_formacao")


def check_key_format(ws):
    return guards.key_format(ctx.births(ws.tables.sinasc(), ws.cycle), "id_municipio")


def audit_leakage(ws):
    found = guards.leakage(ws.spark, FEATURES, ws.units.columns, CATEGORICAL)
    filled = ws.units.select(*FEATURES).agg(*[F.count(f).alias(f) for f in FEATURES])
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("variavel"), F.col(f).alias("redes_com_valor"))
                                for f in FEATURES]))
    return found.join(filled.select(pairs.alias("x")).select("x.*"), "variavel")


def audit_constant(ws):
    return guards.constants(ws.units, FEATURES)


def audit_target_corr(ws):
    d = guards.target_correlation(ws.units.withColumn("__y", F.col("alfabetizados")), NUMERIC,
                                  "__y", "alunos")
    return d.withColumn("correlacao", F.round("correlacao", 6))


def check_split_integrity(ws):
    bad = guards.split_integrity(ws.abt().select("id_municipio", "particao"), "id_municipio")
    return bad.agg(F.count(F.lit(1)).alias("municipios_em_duas_particoes"))


def split_balance(ws):
    """Counts, rate and context coverage per part, from the unit table."""
    w = F.col("alunos")
    return ws.units.groupBy("particao").agg(
        F.sum(w).alias("alunos"), F.count_distinct("id_municipio").alias("municipios"),
        (F.lit(100.0) * F.sum("alfabetizados") / F.sum(w)).alias("taxa"),
        (F.lit(100.0) * F.coalesce(F.sum(F.when(F.col("mun_taxa_ant").isNotNull(), w)), F.lit(0))
         / F.sum(w)).alias("cobertura_mun_taxa_ant"),
        F.count_if(F.col("particao").isNull()).alias("sem_particao"))


def seeded_sample(ws):
    """A seeded draw of a hundred networks."""
    return sample_rows(ws.redes, "unidade", ws.cycle.seed, 100).select("unidade", "sigla_uf", "alunos")


def check_group_invariance(ws):
    abt = ws.abt()
    return guards.group_invariance(abt, ["particao", *UNIT], [*NUMERIC, "sigla_uf", "nome_regiao"])


def check_agg_preserves(ws):
    before = ws.abt().where(F.col("rede_nome") != PRIVATE).select("particao", "alvo")
    return guards.aggregation_preserves(before, weighted_groups(ws.redes))


def check_dictionary(ws):
    """A table with one undescribed column and a dictionary with one orphan description."""
    meta = variable_metadata(ws.spark, ws.cycle).select("variavel", "hipotese")
    columns = [c for c in ws.units.columns if c in FEATURES + NOT_FEATURES] + ["taxa_real"]
    cols = ws.units.agg(*[F.count(c).alias(c) for c in columns])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("variavel"), F.col(c).alias("n"))
                                for c in columns]))
    have = cols.select(pairs.alias("x")).select("x.*").where("n > 0").select("variavel")
    return guards.dictionary_gaps(have, meta)


def check_lookup_complete(ws):
    names = ws.tables.diretorio_municipio()
    bad = guards.lookup_gaps(ws.redes, names, "id_municipio")
    short = guards.lookup_gaps(ws.redes, names.where(~F.col("nome").endswith("7")), "id_municipio")
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("sem_nome")) \
        .withColumn("diretorio", F.lit(name))
    return count(bad, "completo").unionByName(count(short, "sem os nomes de final 7"))


def check_not_null(ws):
    return guards.not_null(ws.units, ["sigla_uf", "nome_regiao", "rede_taxa_ant"], "alunos")


def check_match_rate(ws):
    keys = ws.tables.places().select("id_municipio")
    return guards.match_rate(keys, municipal_context(ws), "id_municipio")


def weighted_vs_simple_rate(ws):
    d = ctx.modelable_population(ws.alunos)
    simple = F.lit(100.0) * F.avg("alvo")
    weighted = F.lit(100.0) * F.sum(F.col("peso_aluno") * F.col("alvo")) / F.sum("peso_aluno")
    return (d.groupBy("ano").agg(F.count(F.lit(1)).alias("alunos"), simple.alias("simples"),
                                 weighted.alias("ponderada"))
            .withColumn("diferenca", F.round(F.col("ponderada") - F.col("simples"), 9)))


def rows_below_target(ws):
    """Pupils of municipalities below their agreed target, by semi-join."""
    rate = ws.units.groupBy("id_municipio").agg(
        (F.lit(100.0) * F.sum("alfabetizados") / F.sum("alunos")).alias("taxa"),
        F.max("mun_meta_ciclo").alias("meta"))
    below = rate.where(F.col("taxa") < F.col("meta")).select("id_municipio")
    pupils = ctx.modelable_population(ws.alunos_now).join(below, "id_municipio", "left_semi")
    return pupils.groupBy("rede_nome").agg(F.count(F.lit(1)).alias("alunos"),
                                           F.sum("alvo").alias("alfabetizados"))


# -- splits -----------------------------------------------------------------------------------
def split_query(ws):
    return ws.split()


def fold_balance(ws):
    """Group folds of the training part and how balanced they are."""
    train = ws.redes.where("particao = 'treino'")
    folds = group_folds(train, "id_municipio", ws.cycle.seed, ws.cycle.folds)
    return train.join(folds, "id_municipio").groupBy("fold").agg(
        F.count_distinct("id_municipio").alias("municipios"), F.count(F.lit(1)).alias("redes"),
        F.sum("alunos").alias("alunos"),
        (F.lit(100.0) * F.sum("alfabetizados") / F.sum("alunos")).alias("taxa"))


def weighted_rows(ws):
    return weighted_groups(ws.redes).select("particao", *UNIT, "alvo", "peso", "rede_taxa_ant")


QUERIES = {
    "modelable_population": modelable_population,
    "pruned_scan": pruned_scan,
    "filtered_scan": filtered_scan,
    "latest_snapshot": latest_snapshot,
    "materialize_if_stale": materialize,
    "partitioned_write": partitioned_write,
    "write_reconcile": write_reconcile,
    "report_csv": report_csv,
    "geojson_rings": geojson_rings,
    "network_context": lambda ws: ctx.network_context(
        ws.tables.municipio([ws.cycle.previous]), ws.cycle),
    "municipal_context": municipal_context,
    "enrollment_size": enrollment_size,
    "school_census_agg": lambda ws: ctx.school_census(
        ws.tables.escola([ws.cycle.previous]), ws.cycle),
    "class_size": lambda ws: ctx.class_size(ws.tables.turma([ws.cycle.previous]), ws.cycle),
    "municipal_economy": lambda ws: ws.economy,
    "human_development": lambda ws: ctx.human_development(
        ws.tables.adh(), ws.tables.avs([ws.cycle.atlas_year]), ws.cycle),
    "homicide_rate": lambda ws: ctx.homicide_rate(ws.economy, ws.tables.sim(), ws.cycle),
    "census_indicators": lambda ws: ws.census,
    "region_from_code": region_from_code,
    "teacher_indicators": lambda ws: ctx.teacher_indicators(
        ws.tables.indicadores_educacionais(), ws.cycle),
    "socioeconomic_level": lambda ws: ctx.socioeconomic_level(ws.tables.inse(), ws.cycle),
    "early_childhood": lambda ws: ctx.early_childhood(
        ws.tables.sinasc(), ws.tables.escola([ws.cycle.preschool_year]), ws.cycle),
    "transport_share": transport,
    "abt": lambda ws: ws.abt(),
    "network_table": network_table,
    "check_contract": check_contract,
    "check_join_fanout": check_join_fanout,
    "check_unique_key": check_unique_key,
    "check_parts_sum": check_parts_sum,
    "check_key_format": check_key_format,
    "audit_leakage": audit_leakage,
    "audit_constant": audit_constant,
    "audit_target_corr": audit_target_corr,
    "seeded_sample": seeded_sample,
    "check_split_integrity": check_split_integrity,
    "split_balance": split_balance,
    "check_group_invariance": check_group_invariance,
    "check_agg_preserves": check_agg_preserves,
    "check_dictionary": check_dictionary,
    "check_lookup_complete": check_lookup_complete,
    "check_not_null": check_not_null,
    "check_match_rate": check_match_rate,
    "weighted_vs_simple_rate": weighted_vs_simple_rate,
    "rows_below_target": rows_below_target,
    "split_by_group": split_query,
    "group_folds": fold_balance,
    "weighted_groups": weighted_rows,
}
