"""Lagged and external context: each function reduces one source to its own grain.

Filters sit directly on the source (they reach the scan) and every source is aggregated
before anything is joined to it.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import Cycle, NETWORK_BY_CODE, NETWORK_BY_NAME
from ..functions.exprs import clip_upper, is_label_one, ratio, recode
from .ordering import quantiles

UNIT = ["id_municipio", "rede_nome"]


def modelable_population(alunos: DataFrame) -> DataFrame:
    """Pupils present at the test, with the 0/1 response; a missing label counts as 0."""
    return alunos.where("presente").withColumn("alvo", is_label_one("alfabetizado"))


def network_context(municipio: DataFrame, cycle: Cycle) -> DataFrame:
    """Previous result of each network and its distance to the state median of its peers."""
    ctx = (municipio
           .where((F.col("ano") == cycle.previous) & F.col("rede").isin(*NETWORK_BY_CODE))
           .select("id_municipio", "rede_nome", "sigla_uf",
                   F.col("taxa_alfabetizacao").alias("rede_taxa_ant"),
                   F.col("media_portugues").alias("rede_media_portugues_ant")))
    peers = quantiles(ctx, "rede_taxa_ant", {"uf_rede_taxa_ant": .5}, ["sigla_uf", "rede_nome"])
    return (ctx.join(peers, ["sigla_uf", "rede_nome"], "left")
            .withColumn("rede_vs_uf", F.col("rede_taxa_ant") - F.col("uf_rede_taxa_ant"))
            .drop("sigla_uf"))


def municipal_context(indicador: DataFrame, cycle: Cycle, source: str = "oficial_inep") -> DataFrame:
    """Previous result of the municipality and the target agreed for the current cycle."""
    official = indicador.where(F.col("origem") == source)
    before = official.where(F.col("ano") == cycle.previous).select(
        "id_municipio", F.col("taxa").alias("mun_taxa_ant"),
        F.col("percentual_participacao").alias("mun_participacao_ant"),
        F.col("taxa_ajustada").alias("mun_taxa_ajustada_ant"),
        F.col("alunos_presentes").alias("mun_alunos_ant"))
    goals = official.where(F.col("ano") == cycle.target).select(
        "id_municipio", F.col("meta_taxa").alias("mun_meta_ciclo"))
    return before.join(goals, "id_municipio", "left").withColumn(
        "mun_gap_meta", F.col("mun_meta_ciclo") - F.col("mun_taxa_ant"))


def enrollment_size(alunos: DataFrame, cycle: Cycle, rows: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Registered pupils (present or not) per network and per municipality; `rows` names the count of
    pupils where they come summed."""
    now = alunos.where(F.col("ano") == cycle.target)
    by_net = now.groupBy(*UNIT).agg(
        (F.sum(rows) if rows else F.count(F.lit(1))).alias("rede_porte_atual"))
    by_mun = by_net.groupBy("id_municipio").agg(
        F.sum("rede_porte_atual").alias("mun_porte_atual"))
    return by_net, by_mun


def _share(c) -> F.Column:
    return F.round(F.lit(100) * F.avg(F.coalesce(c, F.lit(0))), 1)


def school_census(escola: DataFrame, cycle: Cycle) -> DataFrame:
    """Active public schools rolled up to municipality and network."""
    active = escola.where((F.col("ano") == cycle.previous)
                          & F.col("rede").isin(*NETWORK_BY_CODE)
                          & (F.col("tipo_situacao_funcionamento").cast("string") == "1"))
    second = "quantidade_matricula_fundamental_2_ano"
    rural, urban = (F.sum(f"quantidade_matricula_zona_residencia_{z}") for z in ("rural", "urbana"))
    flags = {"esc_pct_agua_rede": F.col("agua_rede_publica"),
             "esc_pct_esgoto_rede": F.col("esgoto_rede_publica"),
             "esc_pct_energia_rede": F.col("energia_rede_publica"),
             "esc_pct_internet": F.col("internet"),
             "esc_pct_biblioteca_ou_sala_leitura":
                 F.expr("try_cast(biblioteca_sala_leitura as double)"),
             "esc_pct_lab_informatica": F.col("laboratorio_informatica"),
             "esc_pct_quadra": F.col("quadra_esportes"),
             "esc_pct_alimentacao": F.col("alimentacao"),
             "esc_pct_coordenador": F.col("profissional_coordenador"),
             "esc_pct_psicologo": F.col("profissional_psicologo"),
             "esc_pct_assistente_social": F.col("profissional_assistente_social")}
    special = F.expr("try_cast(tipo_localizacao_diferenciada as double)") > 0
    per_teacher = ratio(F.sum("quantidade_matricula_fundamental_anos_iniciais"),
                        F.sum("quantidade_docente_fundamental_anos_iniciais"))
    return (active.groupBy("id_municipio", "rede").agg(
        F.count(F.lit(1)).alias("esc_quantidade"),
        F.round(100 * ratio(F.sum(F.when(F.col("tipo_localizacao") == "2", F.col(second))
                                  .otherwise(0)), F.sum(second)), 1).alias("esc_pct_rural"),
        F.round(100 * ratio(rural, rural + urban), 1).alias("esc_pct_alunos_zona_rural"),
        *[_share(c).alias(name) for name, c in flags.items()],
        F.round(100 * F.avg(F.when(special, 1).otherwise(0)), 1).alias("esc_pct_area_diferenciada"),
        F.round(per_teacher, 1).alias("esc_alunos_por_docente"),
        F.sum("quantidade_sala_utilizada").alias("esc_salas"),
        F.sum("quantidade_matricula_utiliza_transporte_publico").alias("esc_alunos_transporte"),
        F.sum("quantidade_matricula_educacao_basica").alias("esc_matriculas"))
        .withColumn("rede_nome", recode("rede", NETWORK_BY_CODE)).drop("rede"))


def class_size(turma: DataFrame, cycle: Cycle) -> DataFrame:
    return (turma.where((F.col("ano") == cycle.previous) & F.col("rede").isin(*NETWORK_BY_NAME)
                        & (F.col("etapa_ensino") == "15"))
            .groupBy("id_municipio", recode("rede", NETWORK_BY_NAME).alias("rede_nome"))
            .agg(F.round(F.avg("quantidade_matriculas"), 1).alias("turma_media_alunos")))


def municipal_economy(pib: DataFrame, populacao: DataFrame, cycle: Cycle) -> DataFrame:
    year = F.col("ano") == cycle.economy_year
    d = pib.where(year).join(populacao.where(year), ["id_municipio", "ano"])
    return d.select(
        "id_municipio",
        F.round(ratio("pib", "populacao"), 0).alias("mun_pib_per_capita"),
        F.round(F.try_divide(100 * F.col("va_agropecuaria"), F.col("va")), 1)
        .alias("mun_pct_agropecuaria"),
        F.round(F.try_divide(100 * F.col("va_servicos"), F.col("va")), 1).alias("mun_pct_servicos"),
        F.col("populacao").alias("mun_populacao"))


def human_development(adh: DataFrame, avs: DataFrame, cycle: Cycle) -> DataFrame:
    indices = ["ivs", "ivs_infraestrutura_urbana", "ivs_capital_humano"]
    v = avs.where(F.col("ano") == cycle.atlas_year).groupBy("id_municipio").agg(
        *[F.avg(c).alias(c) for c in indices])
    return adh.where(F.col("ano") == cycle.atlas_year).join(v, "id_municipio", "left").select(
        "id_municipio", F.col("idhm").alias("mun_idhm"),
        F.col("idhm_e").alias("mun_idhm_educacao"), F.col("idhm_r").alias("mun_idhm_renda"),
        F.col("renda_pc").alias("mun_renda_per_capita"), F.col("indice_gini").alias("mun_gini"),
        F.col("taxa_analfabetismo_18_mais").alias("mun_analfabetismo_adulto"),
        F.col("expectativa_anos_estudo").alias("mun_expectativa_estudo"),
        F.col("taxa_vulner_desloc_1_hora").alias("mun_pct_vulner_deslocamento_1h"),
        F.col("ivs").alias("mun_ivs"),
        F.col("ivs_infraestrutura_urbana").alias("mun_ivs_infraestrutura"),
        F.col("ivs_capital_humano").alias("mun_ivs_capital_humano"))


HOMICIDE_CODES = "^(X8[5-9]|X9[0-9]|Y0[0-9])"   # CID-10 assault, X85 to Y09


def homicide_rate(economy: DataFrame, sim: DataFrame, cycle: Cycle) -> DataFrame:
    """Assault deaths per 100,000; a municipality with no record had none."""
    deaths = (sim.where((F.col("ano") == cycle.violence_year)
                        & F.col("causa_basica").rlike(HOMICIDE_CODES))
              .groupBy("id_municipio").agg(F.sum("numero_obitos").alias("obitos_agressao")))
    rate = ratio(100000 * F.coalesce("obitos_agressao", F.lit(0)), "mun_populacao")
    return (economy.select("id_municipio", "mun_populacao").join(deaths, "id_municipio", "left")
            .select("id_municipio", F.round(rate, 1).alias("mun_taxa_homicidio")))


def census_indicators(base: DataFrame, sewage: DataFrame, water: DataFrame, regions: dict[str, str],
                      sewage_category: str, water_category: str) -> DataFrame:
    """Census rates; each category is its own numerator, as the source's categories nest."""
    e = (sewage.where(F.col("tipo_esgotamento_sanitario") == sewage_category)
         .groupBy("id_municipio").agg(F.sum("populacao").alias("com_esgoto")))
    a = (water.where(F.col("tipo_ligacao_rede_geral") == water_category)
         .groupBy("id_municipio").agg(F.sum("populacao").alias("com_agua")))
    d = base.join(e, "id_municipio", "left").join(a, "id_municipio", "left")
    return d.select(
        "id_municipio", "sigla_uf", region_from_code("id_municipio", regions).alias("nome_regiao"),
        F.round(ratio("populacao", "area"), 1).alias("mun_densidade_demografica"),
        F.round(ratio("populacao", "domicilios"), 2).alias("mun_pessoas_por_domicilio"),
        F.round(100 * F.col("taxa_alfabetizacao"), 1).alias("mun_alfabetizacao_adulta"),
        F.col("idade_mediana").alias("mun_idade_mediana"),
        F.round(ratio(100 * F.col("com_esgoto"), "populacao"), 1).alias("mun_pct_esgoto_adequado"),
        F.round(ratio(100 * F.col("com_agua"), "populacao"), 1).alias("mun_pct_agua_rede_geral"))


def region_from_code(key: str, regions: dict[str, str]):
    """Region named by the first digit of the municipality code."""
    return recode(F.substring(key, 1, 1), regions)


def teacher_indicators(source: DataFrame, cycle: Cycle, keep_sum: bool = False) -> DataFrame:
    num = lambda c: F.expr(f"try_cast({c} as double)")
    group = "afd_ef_anos_iniciais_grupo_{}"
    parts = num(group.format(1))
    for i in range(2, 6):
        parts = parts + num(group.format(i))
    word = F.lower(F.col("rede").cast("string"))
    d = source.where((F.col("ano") == cycle.teacher_year)
                     & (F.lower(F.col("localizacao").cast("string")) == "total")
                     & word.isin(*NETWORK_BY_NAME))
    out = d.select(
        "id_municipio", F.initcap(F.col("rede").cast("string")).alias("rede_nome"),
        num(group.format(1)).alias("esc_pct_docentes_formacao_adequada"),
        (num("ird_baixa_regularidade") + num("ird_media_baixa"))
        .alias("esc_pct_docentes_baixa_regularidade"),
        (num("ied_ef_anos_iniciais_nivel_5") + num("ied_ef_anos_iniciais_nivel_6"))
        .alias("esc_pct_docentes_alto_esforco"),
        num("had_ef_anos_iniciais").alias("esc_horas_aula_diarias"),
        parts.alias("soma_grupos_formacao"))
    return out if keep_sum else out.drop("soma_grupos_formacao")


def socioeconomic_level(inse: DataFrame, cycle: Cycle) -> DataFrame:
    """Mean socio-economic level; zero is outside the scale and counts as missing."""
    d = inse.where((F.col("ano") == cycle.socio_year)
                   & (F.col("tipo_localizacao").cast("string") == "0")
                   & F.col("rede").cast("string").isin(*NETWORK_BY_CODE))
    return d.select("id_municipio", recode(F.col("rede").cast("string"), NETWORK_BY_CODE)
                    .alias("rede_nome"),
                    F.nullif(F.expr("try_cast(inse as double)"), F.lit(0.0)).alias("esc_inse_medio"))


def births(sinasc: DataFrame, cycle: Cycle) -> DataFrame:
    """Mothers' schooling and age; an unknown code stays out of the denominator."""
    school = F.col("escolaridade_mae").cast("string")
    age = F.expr("try_cast(idade_mae as bigint)")
    share = lambda a, b: F.round(100 * ratio(F.count_if(a), F.count_if(b)), 1)
    return (sinasc.where(F.col("ano").isin(*cycle.birth_years)
                         & F.col("id_municipio_residencia").isNotNull())
            .groupBy(F.col("id_municipio_residencia").cast("string").alias("id_municipio"))
            .agg(share(school.isin("4", "5"), school.isin("1", "2", "3", "4", "5"))
                 .alias("mun_pct_maes_8_anos_estudo"),
                 share(age.between(10, 19), age.between(10, 60))
                 .alias("mun_pct_maes_adolescentes")))


def preschool_supply(escola: DataFrame, cycle: Cycle) -> DataFrame:
    """Pre-school places per year of age over early-grade places per grade, all networks."""
    return (escola.where((F.col("ano") == cycle.preschool_year)
                         & (F.col("tipo_situacao_funcionamento").cast("string") == "1"))
            .groupBy("id_municipio")
            .agg(F.round(ratio(F.sum("quantidade_matricula_infantil_pre_escola") / 2,
                               F.sum("quantidade_matricula_fundamental_anos_iniciais") / 5), 2)
                 .alias("mun_indice_pre_escola")))


def early_childhood(sinasc: DataFrame, escola: DataFrame, cycle: Cycle) -> DataFrame:
    return births(sinasc, cycle).join(preschool_supply(escola, cycle), "id_municipio", "full_outer")


def derived_columns(df: DataFrame) -> DataFrame:
    """Differences and ratios that need several sources at once."""
    return df.withColumns({
        "rede_vs_municipio": F.col("rede_taxa_ant") - F.col("mun_taxa_ant"),
        "rede_peso_no_municipio": ratio("rede_porte_atual", "mun_porte_atual"),
        "esc_alunos_por_sala": ratio("esc_matriculas", "esc_salas"),
        "esc_pct_transporte": ratio(100 * F.col("esc_alunos_transporte"), "esc_matriculas"),
    }).drop("esc_salas", "esc_alunos_transporte", "esc_matriculas")


def transport_share(df: DataFrame) -> DataFrame:
    """Transported pupils over network size, capped at 100; a missing share stays missing."""
    share = ratio(100 * F.col("esc_alunos_transporte"), "rede_porte_atual")
    return df.withColumn("esc_pct_transporte", clip_upper(share, 100.0))
