"""Profiling, relations and curation as registered queries."""
from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import PUBLIC_NETWORKS
from ..functions.exprs import band, pct, ratio, with_totals
from ..functions.metadata import (BLOCKS, CATEGORICAL, FEATURES, HYPOTHESIS_OF, INDICATORS,
                                  NUMERIC, variable_metadata)
from ..operators import context as ctx
from ..operators import curation, guards, prepare, profile, relations, screening
from ..operators.moments import correlation_pairs, matrix_of
from ..operators.ordering import quantiles
from ..operators.sweep import Swept
from .workspace import Workspace



def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c)
                       for c, t in df.dtypes])


# -- response and territory --------------------------------------------------------------------
def near_cutoff_share(ws: Workspace) -> DataFrame:
    """Share of pupils near the score cut (half-open) and of networks near the target (closed)."""
    cut, target = ws.cycle.score_cut, ws.cycle.unit_target
    scores = ws.alunos_now.where("presente").select("proficiencia").where("proficiencia is not null")
    near = lambda j: (F.col("proficiencia") >= cut - j) & (F.col("proficiencia") < cut + j)
    pupil_steps = (500, 1000, 2000, 5000)
    a = scores.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(near(j)).alias(f"j{j}") for j in pupil_steps])
    b = ws.redes.agg(F.count(F.lit(1)).alias("total"), *[
        F.count_if(F.abs(F.col("taxa_real") - target) <= j).alias(f"j{j}") for j in (3, 5)])

    def long(one, steps, what):
        return one.select(F.lit(what).alias("medida"), "total", F.inline(F.array(*[
            F.struct(F.lit(j).alias("distancia"), F.col(f"j{j}").alias("perto")) for j in steps])))

    both = long(a, pupil_steps, "proficiencia").unionByName(long(b, (3, 5), "taxa da rede"))
    return both.withColumn("pct", pct("perto", "total"))


def response_by_group(ws):
    d = ws.units.groupBy("rede_nome").agg(F.sum("alunos").alias("alunos"),
                                          F.sum("alfabetizados").alias("alfabetizados"))
    return d.where("alunos > 100").withColumn("taxa", pct("alfabetizados", "alunos"))


def describe_by_group(ws):
    places = profile.by_place(ws.units).where(F.col("alunos") >= ws.cycle.min_stable)
    return rounded(profile.describe(places, "taxa", "nome_regiao", "Brasil", "nome_regiao"))


def pooled_vs_mean_rate(ws):
    places = profile.by_place(ws.units)
    parts = [profile.pooled_vs_mean(ws.units, places, by, ws.cycle.min_stable)
             .select(F.lit(by).alias("nivel"), F.col(by).alias("grupo"), "alunos", "municipios",
                     "taxa_entre_alunos", "media_das_taxas_municipais", "efeito_do_peso")
             for by in ("nome_regiao", "sigla_uf")]
    return rounded(parts[0].unionByName(parts[1]))


def large_unit_effect(ws):
    """Per region: what the ten largest municipalities weigh, and where the largest stands."""
    places = profile.by_place(ws.units)
    w = Window.partitionBy("nome_regiao").orderBy(F.col("alunos").desc(), "id_municipio")
    top = places.withColumn("ordem", F.row_number().over(w)).where("ordem <= 10")
    big = top.groupBy("nome_regiao").agg(
        F.sum("alunos").alias("alunos_dez_maiores"),
        pct(F.sum("alfabetizados"), F.sum("alunos")).alias("taxa_dez_maiores"))
    first = places.groupBy("nome_regiao").agg(
        F.min_by("taxa", F.struct(-F.col("alunos"), F.col("id_municipio"))).alias("taxa_da_maior"),
        F.sum("alunos").alias("alunos"))
    stable = places.where(F.col("alunos") >= ws.cycle.min_stable)
    above = stable.join(first, "nome_regiao").groupBy("nome_regiao").agg(
        profile.share(F.col("taxa") > F.col("taxa_da_maior")).alias("acima_da_maior_pct"))
    return rounded(big.join(first, "nome_regiao").join(above, "nome_regiao").withColumn(
        "fracao_dez_maiores", ratio("alunos_dez_maiores", "alunos")))


def top_bottom(ws):
    """Five largest and smallest state medians; five first municipalities by a skewed value."""
    net = ctx.network_context(ws.tables.municipio([ws.cycle.previous]), ws.cycle) \
        .join(ws.census.select("id_municipio", "sigla_uf"), "id_municipio")
    bench = net.select("sigla_uf", "rede_nome", "uf_rede_taxa_ant").distinct()
    key = F.concat_ws("/", "sigla_uf", "rede_nome")
    pick = lambda order, what: profile.top_rows(
        bench.select(key.alias("chave"), F.col("uf_rede_taxa_ant").alias("valor")),
        [order, F.col("chave")], 5).withColumn("lista", F.lit(what))
    top_places = profile.top_rows(
        ws.units.groupBy("id_municipio").agg(F.max("mun_densidade_demografica").alias("valor"))
        .where("valor is not null").select(F.col("id_municipio").alias("chave"), "valor"),
        [F.col("valor").desc(), F.col("chave")], 5).withColumn("lista", F.lit("densidade"))
    return pick(F.col("valor").desc(), "maiores").unionByName(
        pick(F.col("valor").asc(), "menores")).unionByName(top_places)


def target_distance_by_state(ws):
    places = profile.by_place(ws.units).where("meta is not null")
    gap = F.col("taxa") - F.col("meta")
    d = places.withColumns({"distancia": gap, "abaixo": gap < 0})
    long = d.select("alunos", "distancia", "abaixo", F.inline(F.array(
        F.struct(F.lit("região").alias("nivel"), F.col("nome_regiao").alias("grupo")),
        F.struct(F.lit("UF").alias("nivel"), F.col("sigla_uf").alias("grupo")))))
    return rounded(long.groupBy("nivel", "grupo").agg(
        F.count(F.lit(1)).alias("municipios"), profile.share(F.col("abaixo")).alias("pct_abaixo"),
        F.coalesce(F.sum(F.when(F.col("abaixo"), F.col("alunos"))), F.lit(0)).alias("alunos_abaixo"),
        F.avg("distancia").alias("distancia_media")))


def _evolution(ws):
    return (profile.by_place(ws.units).where("taxa_2023 is not null")
            .where(F.col("alunos") >= ws.cycle.min_stable)
            .withColumn("variacao", F.col("taxa") - F.col("taxa_2023")))


def cycle_persistence(ws):
    """Slope, intercept and correlation between cycles, and the paired change by state."""
    d = _evolution(ws)
    x, y = "taxa_2023", "taxa"
    one = d.agg(F.count(F.lit(1)).alias("municipios"), F.regr_slope(y, x).alias("inclinacao"),
                F.regr_intercept(y, x).alias("intercepto"), F.corr(x, y).alias("correlacao"),
                profile.share(F.col("variacao") < 0).alias("pct_que_piorou"))
    country = one.select(F.lit("país").alias("grupo"), "*")
    med = quantiles(d.withColumn("grupo", F.lit("país")).unionByName(
        d.withColumn("grupo", F.col("sigla_uf"))), "variacao", {"variacao_mediana": .5}, ["grupo"])
    states = d.groupBy(F.col("sigla_uf").alias("grupo")).agg(
        F.count(F.lit(1)).alias("municipios"),
        profile.share(F.col("variacao") < 0).alias("pct_que_piorou"))
    return rounded(country.unionByName(states, allowMissingColumns=True).join(med, "grupo"))


def change_by_quartile(ws, left_out: str = "NATION_0"):
    """Change by quartile of the previous rate, with all states and without one."""
    d = _evolution(ws)
    both = d.withColumn("recorte", F.lit("todos")).unionByName(
        d.where(F.col("sigla_uf") != left_out).withColumn("recorte", F.lit("sem um estado")))
    edges = quantiles(both, "taxa_2023", {"q1": .25, "q2": .5, "q3": .75}, ["recorte"])
    v = F.col("taxa_2023")
    labels = ["Q1 mais baixo", "Q2", "Q3", "Q4 mais alto"]
    quartile = (F.when(v <= F.col("q1"), labels[0]).when(v <= F.col("q2"), labels[1])
                .when(v <= F.col("q3"), labels[2]).otherwise(labels[3]))
    cut = both.join(edges, "recorte").withColumn("quartil", quartile)
    long = prepare.to_long(cut, ["taxa_2023", "taxa", "variacao"], ["recorte", "quartil"])
    med = quantiles(long, "valor", {"m": .5}, ["recorte", "quartil", "variavel"])
    pick = lambda c: F.max(F.when(F.col("variavel") == c, F.col("m")))
    sizes = cut.groupBy("recorte", "quartil").agg(F.count(F.lit(1)).alias("municipios"))
    return rounded(med.groupBy("recorte", "quartil").agg(
        pick("taxa_2023").alias("taxa_2023"), pick("taxa").alias("taxa_2024"),
        pick("variacao").alias("variacao")).join(sizes, ["recorte", "quartil"]))


# -- two networks of one municipality ----------------------------------------------------------
INFRA = ["esc_pct_quadra", "esc_pct_biblioteca_ou_sala_leitura", "esc_alunos_por_docente",
         "esc_inse_medio"]
SOCIO_STEP = 0.05


def _network_pairs(ws):
    """Municipalities with both networks, one row each; `pivot` with the values given."""
    d = ws.redes.where(F.col("rede_nome").isin(*PUBLIC_NETWORKS)
                       & (F.col("alunos") >= ws.cycle.min_stable)) \
        .withColumn("taxa", pct("alfabetizados", "alunos"))
    wide = d.groupBy("id_municipio", "sigla_uf").pivot("rede_nome", list(PUBLIC_NETWORKS)).agg(
        F.max("taxa").alias("taxa"), *[F.max(c).alias(c) for c in INFRA])
    wide = wide.where("Estadual_taxa is not null and Municipal_taxa is not null")
    diffs = {f"d_{c}": F.col(f"Estadual_{c}") - F.col(f"Municipal_{c}") for c in ["taxa", *INFRA]}
    return wide.select("id_municipio", "sigla_uf",
                       *[e.alias(n) for n, e in diffs.items()])


def paired_network_gap(ws):
    """Gap between the two networks by state, by infrastructure and by families' level."""
    pairs = _network_pairs(ws)
    edges, labels = [float("-inf"), -SOCIO_STEP, SOCIO_STEP, float("inf")], [
        "estadual atende famílias de nível menor", "nível semelhante",
        "estadual atende famílias de nível maior"]
    row = lambda cut, group, value: F.struct(cut.alias("corte"), group.alias("grupo"), value.alias("d"))
    long = pairs.select(F.inline(F.array(
        row(F.lit("UF"), F.col("sigla_uf"), F.col("d_taxa")),
        row(F.lit("público"), band("d_esc_inse_medio", edges, labels), F.col("d_taxa")),
        *[row(F.lit("infraestrutura"), F.lit(c), F.col(f"d_{c}")) for c in INFRA])))
    long = long.where("grupo is not null and d is not null")
    med = quantiles(long, "d", {"diferenca_mediana": .5}, ["corte", "grupo"])
    rest = long.groupBy("corte", "grupo").agg(F.count(F.lit(1)).alias("municipios"),
                                              profile.share(F.col("d") > 0).alias("estadual_maior_pct"))
    out = rest.join(med, ["corte", "grupo"])
    # rank correlation over the pairs that have both differences
    both = pairs.where("d_esc_inse_medio is not null")
    ranks = relations.rank_frame(both, ["d_esc_inse_medio", "d_taxa"], "id_municipio", [])
    rho = correlation_pairs(ranks, ["d_esc_inse_medio", "d_taxa"]).where(
        "a = 'd_esc_inse_medio' and b = 'd_taxa'").select(
        F.lit("spearman").alias("corte"), F.lit("diferença de INSE").alias("grupo"),
        F.col("n").cast("bigint").alias("municipios"), F.col("rho").alias("diferenca_mediana"))
    return rounded(out.unionByName(rho, allowMissingColumns=True))


def network_share_by_state(ws):
    d = ws.redes.groupBy("sigla_uf").pivot("rede_nome", list(PUBLIC_NETWORKS)).agg(F.sum("alunos"))
    total = F.coalesce("Estadual", F.lit(0)) + F.coalesce("Municipal", F.lit(0))
    return d.select("sigla_uf", F.coalesce("Estadual", F.lit(0)).alias("Estadual"),
                    F.coalesce("Municipal", F.lit(0)).alias("Municipal"),
                    pct(F.coalesce("Estadual", F.lit(0)), total).alias("alunos_na_estadual_pct"))


# -- missing values ----------------------------------------------------------------------------
def missing_patterns(ws):
    found = profile.missing_patterns(ws.units, list(BLOCKS.values()))
    reach = profile.imputation_reach(ws.units, "sigla_uf", "mun_taxa_ajustada_ant").select(
        F.concat(F.when(F.col("sem_grupo"), "sem UF").otherwise("com UF"), F.lit(", "),
                 F.when(F.col("sem_historico"), "sem histórico").otherwise("com histórico"))
        .alias("padrao"), "linhas")
    return found.unionByName(reach, allowMissingColumns=True)


# -- ranks and relations -----------------------------------------------------------------------
def train_ranks(ws) -> DataFrame:
    """Ranks of the training units; stored, as three reports read them."""
    return ws.stored("postos", lambda: relations.rank_frame(
        ws.train_units, NUMERIC, "unidade", ["alunos", "alfabetizados"], "alunos"), NUMERIC[:1])


def quantile_rates(ws, n: int) -> DataFrame:
    """Rates in `n` bins; fives and tens are found in one pass and stored."""
    both = ws.stored("faixas", lambda: relations.rates_by_quantile(ws.train_units, NUMERIC, (5, 10)), ["taxa"])
    return both.where(F.col("faixas") == n).drop("faixas")


def ceiling(ws):
    return ws.stored("teto", lambda: relations.variance_ceiling(ws.train_units), ["teto"])


def correlations(ws) -> DataFrame:
    return ws.stored("correlacoes", lambda: relations.response_correlation(
        ws.train_units, train_ranks(ws), NUMERIC, "alfabetizados", "alunos"), ["spearman"])


def patterns(ws) -> DataFrame:
    return ws.stored("gradientes", lambda: relations.gradient_pattern(
        quantile_rates(ws, 5), quantile_rates(ws, 10)), ["padrao"])


def spearman_pairs(ws) -> DataFrame:
    return ws.stored("spearman", lambda: correlation_pairs(train_ranks(ws), NUMERIC, "alunos"),
                      ["rho"])


def response_correlation(ws):
    d = correlations(ws).transform(with_totals, ceiling(ws).select("teto"))
    return rounded(d.withColumn("pct_do_teto", F.lit(100.0) * F.abs("spearman") / F.col("teto"))
                   .drop("teto"))


def spearman_matrix(ws):
    d = spearman_pairs(ws).where("a < b and rho is not null")
    return rounded(d.select(F.col("a").alias("variavel_a"), F.col("b").alias("variavel_b"),
                            F.col("rho").alias("spearman")))


def strong_pairs(ws):
    return rounded(relations.strong_pairs(spearman_pairs(ws),
                                          variable_metadata(ws.spark, ws.cycle)))


def gradient_pattern(ws):
    return rounded(patterns(ws))


def _members(ws) -> DataFrame:
    """Every numeric variable with its redundancy group; stored, as several reports share it."""
    def build():
        group = relations.linked_groups(NUMERIC, matrix_of(spearman_pairs(ws), NUMERIC))
        strength = correlations(ws).select("variavel", F.col("spearman").alias("forca"))
        return relations.group_members(ws.spark, group, strength, HYPOTHESIS_OF)

    return ws.stored("grupos", build, ["representante"])


def redundancy_groups(ws):
    return rounded(relations.group_table(_members(ws), spearman_pairs(ws)))


def vif_rank(ws):
    """Inflation factors of all variables and of one representative per group."""
    matrix = matrix_of(spearman_pairs(ws), NUMERIC)
    leaders = {r.variavel for r in _members(ws).where("lugar = 1").select("variavel").collect()}
    rows = []
    for name, keep in (("todas", NUMERIC), ("um por grupo", [v for v in NUMERIC if v in leaders])):
        at = [NUMERIC.index(v) for v in keep]
        rows += [(name, v, f) for v, f in Swept(keep, matrix[np.ix_(at, at)]).factors().items()]
    return ws.spark.createDataFrame(rows, "conjunto string, variavel string, vif double")


def vif_ols(ws):
    values = curation.vif(ws.redes.where("particao = 'treino'"), NUMERIC)
    return ws.spark.createDataFrame([(k, float(v)) for k, v in values.items()],
                                    "variavel string, vif double")


def screened(ws) -> tuple[list[str], DataFrame]:
    train = ws.redes.where("particao = 'treino'")
    return screening.screen(train, NUMERIC, ws.cycle, lambda names: curation.filled_correlation(train, names),
                            lambda names: relations.pairwise_spearman(train, names, "unidade"))


def curate_redundancy(ws):
    return rounded(screened(ws)[1])


def screening_facts(ws):
    """What the rules of curation know of each variable, and the rank by which variables leave."""
    return rounded(screening.facts(ws.redes.where("particao = 'treino'"), NUMERIC, ws.cycle))


def concepts(ws) -> DataFrame:
    """One row per redundancy group: its representative with rank, shape and hypotheses."""
    base = _members(ws).groupBy(F.col("representante").alias("variavel")).agg(
        F.max("tamanho").alias("representa"), F.array_sort(F.collect_set(F.substring_index("hipotese", " ", 1))).alias("hipoteses"))
    shape = gradient_pattern(ws).select("variavel", "amplitude_pp_q", "padrao")
    corr = response_correlation(ws).select("variavel", "spearman", "pct_do_teto")
    hyp = variable_metadata(ws.spark, ws.cycle).select("variavel", "hipotese")
    return (base.join(hyp, "variavel").join(corr, "variavel", "left").join(shape, "variavel", "left"))


def evidence_ranking(ws):
    """Concepts by strength. The window runs over the variable list, not over data rows."""
    w = Window.partitionBy(F.lit(0)).orderBy(F.abs("spearman").desc_nulls_last(), "variavel")
    return concepts(ws).select(
        F.row_number().over(w).alias("posicao"), "variavel", "hipotese", "representa",
        F.array_join("hipoteses", ", ").alias("hipoteses_do_grupo"), "spearman", "pct_do_teto",
        "amplitude_pp_q", "padrao")


def evidence_by_hypothesis(ws):
    d = concepts(ws).where(~(F.col("hipotese").startswith("H8") | F.col("hipotese").startswith("controle")))
    d = d.withColumn("h", F.explode("hipoteses")).where(~F.col("h").isin("H8", "controle"))
    names = ws.spark.createDataFrame([(h.split()[0], h) for h in
                                      {HYPOTHESIS_OF[v] for v in NUMERIC}], "h string, nome string")
    order = F.struct(-F.abs("spearman"), F.col("variavel"))
    best = lambda c: F.min_by(c, order)
    return d.where("spearman is not null").groupBy("h").agg(
        F.count(F.lit(1)).alias("conceitos"), best("variavel").alias("melhor_conceito"),
        best("spearman").alias("spearman"), best("pct_do_teto").alias("pct_do_teto"),
        F.count_if(F.col("padrao") == "monotônica").alias("monotonicos"),
        F.count_if(F.col("padrao") == "sem gradiente").alias("sem_gradiente")) \
        .join(F.broadcast(names), "h").drop("h").withColumnRenamed("nome", "hipotese")


def gradient_by_hypothesis(ws):
    """Shapes per hypothesis, without inertia and controls."""
    hyp = variable_metadata(ws.spark, ws.cycle).select("variavel", "hipotese")
    d = patterns(ws).join(hyp, "variavel").where(
        ~(F.col("hipotese").startswith("H8") | F.col("hipotese").startswith("controle")))
    size = F.abs("amplitude_pp_q")
    shape = lambda s: F.count_if(F.col("padrao") == s)
    # the groups here hold the variables of one hypothesis
    return rounded(d.groupBy("hipotese").agg(
        F.count(F.lit(1)).alias("variaveis"), F.max(size).alias("amplitude_maxima"),
        F.median(size).alias("amplitude_mediana"), shape("monotônica").alias("monotonicas"),
        shape("tendência com baixo ruído").alias("baixo_ruido"),
        shape("tendência com alto ruído").alias("alto_ruido"),
        shape("sem direção estável").alias("sem_direcao"),
        shape("sem gradiente").alias("sem_gradiente")))


def _decisions(ws):
    shape = profile.shape_diagnostics(ws.units, NUMERIC).select("variavel", "assimetria")
    train = profile.numeric_summary(prepare.to_long(ws.train_units, NUMERIC, ["alunos"]), {}) \
        .select("variavel", "n", "minimo")
    every = F.transform(F.array_sort(F.collect_list(F.struct("lugar", "variavel")).over(Window.partitionBy("grupo"))), lambda x: x["variavel"])
    base = _members(ws).select("variavel", "representante", every.alias("membros")).withColumn(
        "outros", F.array_except("membros", F.array("variavel")))
    return curation.decision_list(ws, base, shape, train), base


def decision_list(ws):
    return _decisions(ws)[0]


def check_decisions(ws):
    lista, base = _decisions(ws)
    features = ws.spark.createDataFrame([(f,) for f in FEATURES], "variavel string")
    groups = base.select(F.col("representante").alias("variavel"), "membros")
    indicators = lista.where("indicador_ausencia is not null").select("variavel")
    themes = variable_metadata(ws.spark, ws.cycle).where("tipo <> 'controle'").select("variavel")
    return guards.decisions(lista, features, groups, indicators, themes)


def theme_evidence(ws):
    train = ws.redes.where("particao = 'treino'")
    return rounded(curation.theme_evidence(
        train, NUMERIC, "unidade", variable_metadata(ws.spark, ws.cycle)))


def data_dictionary(ws):
    prof = profile.column_profile(ws.units, NUMERIC, CATEGORICAL).select(
        "variavel", F.round("preenchido_pct", 1).alias("preenchimento"), "distintos")
    meta = variable_metadata(ws.spark, ws.cycle).select(
        "variavel", "hipotese", "grao", "referencia", "formula", F.col("tipo").alias("papel"))
    return meta.join(prof, "variavel")


def partition_summary(ws):
    """Units, units that met the target, pupils and small units per part; the national row too."""
    small = F.col("alunos") < ws.cycle.min_stable
    d = ws.redes.groupBy("particao").agg(
        F.count(F.lit(1)).alias("redes"), F.sum("bateu_meta").alias("bateram"),
        F.sum("alunos").alias("alunos"), profile.share(small).alias("pequenas_pct"))
    med = quantiles(ws.redes.where("rede_taxa_ant is not null"), "rede_taxa_ant",
                    {"mediana_ant": .5}, ["particao"], "alunos")
    return rounded(d.withColumn("bateram_pct", pct("bateram", "redes")).join(med, "particao", "left"))


# -- preparation -------------------------------------------------------------------------------
PREP = ["rede_taxa_ant", "mun_participacao_ant", "esc_horas_aula_diarias", "esc_inse_medio",
        "mun_ivs", "rede_vs_municipio"]


def impute_by_group(ws):
    train = ws.redes.where("particao = 'treino'")
    imputer = prepare.GroupMedianImputer(PREP).fit(train)
    return rounded(imputer.transform(ws.redes).select("unidade", *PREP))


def missing_indicators(ws):
    d = prepare.missing_indicators(ws.redes, INDICATORS)
    return d.select("unidade", *INDICATORS)


def one_hot(ws):
    """Levels come from train; the others turn up as all zeros."""
    levels = prepare.levels_of(ws.redes.where("particao = 'treino'"), "nome_regiao")[1:]
    return prepare.one_hot(ws.redes, "nome_regiao", levels).select(
        "unidade", *[f"nome_regiao_{v}" for v in levels])


def standardize(ws):
    cols = ["mun_densidade_demografica", "esc_pct_quadra"]
    d = prepare.log1p(ws.redes.where("mun_densidade_demografica is not null"), cols[:1])
    scaling = prepare.scaling_of(d.where("particao = 'treino'"), cols)
    return rounded(prepare.standardize(d, scaling, cols).select("unidade", *cols))


def z_scores(ws):
    """Every numeric variable in standard scores, for comparing shapes."""
    d = prepare.zscore(ws.redes, NUMERIC)
    return rounded(prepare.to_long(d, NUMERIC, ["unidade"]).where("valor is not null"))


def prepared_matrix(ws):
    """All prepared columns of a linear model over all variables: indicators, medians of train by state with the national
    one behind, logarithm, scaling, one column per level of train."""
    logged = ["mun_populacao", "mun_densidade_demografica"]
    prep = prepare.Preparation(prepare.Design(NUMERIC, CATEGORICAL, INDICATORS, logged), linear=True)
    prep.fit(ws.redes.where("particao = 'treino'"))
    d = prepare.to_long(prep.prepared(ws.redes), prep.columns(), ["unidade"])
    return rounded(d.where("valor is not null"))


QUERIES = {
    "z_scores": z_scores,
    "prepared_matrix": prepared_matrix,
    "near_cutoff_share": near_cutoff_share,
    "response_by_group": response_by_group,
    "describe_by_group": describe_by_group,
    "pooled_vs_mean_rate": pooled_vs_mean_rate,
    "large_unit_effect": large_unit_effect,
    "top_bottom": top_bottom,
    "target_distance_by_state": target_distance_by_state,
    "cycle_persistence": cycle_persistence,
    "change_by_quartile": change_by_quartile,
    "paired_network_gap": paired_network_gap,
    "network_share_by_state": network_share_by_state,
    "column_profile": lambda ws: rounded(profile.column_profile(ws.units, NUMERIC, CATEGORICAL)),
    "numeric_description": lambda ws: rounded(profile.numeric_description(ws.units, NUMERIC)),
    "scale_concentration": lambda ws: rounded(profile.scale_concentration(ws.units, NUMERIC)),
    "categorical_profile": lambda ws: rounded(profile.categorical_profile(ws.units, CATEGORICAL)),
    "rare_categories": lambda ws: rounded(profile.rare_categories(ws.units, CATEGORICAL, ws.cycle.rare_limit)),
    "shape_diagnostics": lambda ws: rounded(profile.shape_diagnostics(ws.units, NUMERIC)),
    "missing_summary": lambda ws: rounded(profile.missing_summary(ws.units, FEATURES)),
    "missing_patterns": missing_patterns,
    "missing_gap": lambda ws: rounded(profile.missing_gap(ws.units, FEATURES)),
    "block_coverage": lambda ws: profile.block_coverage(ws.units, BLOCKS),
    "variable_histogram": lambda ws: profile.variable_histogram(ws.units, NUMERIC),
    "data_dictionary": data_dictionary,
    "partition_summary": partition_summary,
    "variance_ceiling": lambda ws: rounded(ceiling(ws)),
    "rate_by_quantile": lambda ws: rounded(quantile_rates(ws, 5)),
    "monotonicity": lambda ws: rounded(relations.monotonicity(quantile_rates(ws, 5), 5, ceiling(ws))),
    "gradient_pattern": gradient_pattern,
    "gradient_by_hypothesis": gradient_by_hypothesis,
    "response_correlation": response_correlation,
    "spearman_matrix": spearman_matrix,
    "strong_pairs": strong_pairs,
    "ranking_agreement": lambda ws: rounded(relations.ranking_agreement(
        correlations(ws), patterns(ws), ceiling(ws))),
    "redundancy_groups": redundancy_groups,
    "vif_rank": vif_rank,
    "vif_ols": vif_ols,
    "curate_redundancy": curate_redundancy,
    "screening_facts": screening_facts,
    "evidence_ranking": evidence_ranking,
    "evidence_by_hypothesis": evidence_by_hypothesis,
    "decision_list": decision_list,
    "check_decisions": check_decisions,
    "theme_evidence": theme_evidence,
    "impute_by_group": impute_by_group,
    "missing_indicators": missing_indicators,
    "one_hot": one_hot,
    "standardize": standardize,
}
