"""The five planning questions, answered from the scored network table."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import BANDS
from ..functions.exprs import band, clean_key, histogram_bin, pct, ratio, with_totals
from .ordering import BEFORE, TOTAL, quantiles, running_total
from .prepare import to_long

EDGES = [BANDS[0][0], *[b[1] for b in BANDS]]
LABELS = [b[2] for b in BANDS]
P = "p_cumprir_pct"


def band_skeleton(df: DataFrame) -> DataFrame:
    """The fixed bands as a table, so that an empty band still shows."""
    return F.broadcast(df.sparkSession.createDataFrame(
        list(enumerate(LABELS)), "ordem int, faixa string"))


def flagged_and_missed(redes: DataFrame, threshold: float = 0.5) -> DataFrame:
    return redes.where((F.col("p_cumprir") < threshold) & (F.col("bateu_meta") == 0))


def national(redes: DataFrame) -> DataFrame:
    """One row: total weight and national rate."""
    return redes.agg(F.sum("peso_total").alias("peso_nacional"),
                     (F.lit(100.0) * F.sum("peso_alfabetizados") / F.sum("peso_total"))
                     .alias("taxa_nacional"))


def gains(redes: DataFrame, target: float) -> DataFrame:
    """What the country would gain if each flagged unit just reached the target."""
    gain = (F.lit(100.0) * (F.lit(target / 100) * F.col("peso_total") - F.col("peso_alfabetizados"))
            / F.col("peso_nacional"))
    return (flagged_and_missed(redes).transform(with_totals, national(redes))
            .withColumn("ganho_pp", gain))


def risk_list(redes: DataFrame, names: DataFrame, target: float) -> DataFrame:
    """Flagged units that did miss the target, largest national gain first, with running gain."""
    d = running_total(gains(redes, target), "ganho_pp", "unidade")
    run = F.col(BEFORE) + F.col("ganho_pp")
    return (d.withColumns({"ganho_acumulado": run,
                           "taxa_nacional_se_cumprissem": F.col("taxa_nacional") + run})
            .join(names, "id_municipio", "left")
            .select("id_municipio", "nome", "sigla_uf", "rede_nome", "alunos", "taxa_real", "risco",
                    "ganho_pp", "ganho_acumulado", "taxa_nacional_se_cumprissem", "particao"))


def risk_summary(redes: DataFrame, target: float, top: int = 15) -> DataFrame:
    """How many are flagged and confirmed, and how concentrated the possible gain is."""
    flagged = redes.agg(F.count_if(F.col("p_cumprir") < 0.5).alias("apontadas"))
    g = gains(redes, target)
    run = running_total(g, "ganho_pp", "unidade")
    half = F.col(BEFORE) + F.col("ganho_pp") < F.col(TOTAL) / 2
    whole = run.agg(F.count(F.lit(1)).alias("confirmadas"), F.sum("alunos").alias("alunos"),
                    F.max("taxa_nacional").alias("taxa_nacional"), F.sum("ganho_pp").alias("ganho"),
                    (F.count_if(half) + 1).alias("redes_para_metade_do_ganho"))
    first = g.orderBy(F.col("ganho_pp").desc(), F.md5("unidade"), "unidade").limit(top).agg(
        F.sum("ganho_pp").alias("quinze_primeiras_pp"))
    return (flagged.transform(with_totals, whole).transform(with_totals, first).select(
        "apontadas", "confirmadas", "alunos", "taxa_nacional",
        (F.col("taxa_nacional") + F.col("ganho")).alias("taxa_se_todas_cumprissem"),
        "quinze_primeiras_pp", pct("quinze_primeiras_pp", "ganho").alias("quinze_primeiras_pct_do_ganho"),
        "redes_para_metade_do_ganho"))


def risk_by_state(redes: DataFrame, target: float) -> DataFrame:
    return gains(redes, target).groupBy("sigla_uf").agg(
        F.count(F.lit(1)).alias("redes"), F.sum("alunos").alias("alunos"),
        F.sum("ganho_pp").alias("ganho_pp"))


def silhouettes(redes: DataFrame) -> DataFrame:
    """Share of each region's units in ten equal probability steps."""
    d = redes.groupBy("nome_regiao", histogram_bin(P, 0, 10, 10).alias("pedaco")).agg(
        F.count(F.lit(1)).alias("n"))
    totals = d.groupBy("nome_regiao").agg(F.sum("n").alias("total"))
    return d.join(totals, "nome_regiao").select("nome_regiao", "pedaco",
                                                ratio("n", "total").alias("fracao"))


def region_overlap(redes: DataFrame) -> DataFrame:
    """Sum of the smaller share, step by step, for every pair of regions, both ways round. Every
    region has all ten steps, so an equi-join on the step meets all pairs of regions."""
    seen = silhouettes(redes)
    steps = seen.select("nome_regiao").distinct().withColumn(
        "pedaco", F.explode(F.sequence(F.lit(0), F.lit(9))))
    s = steps.join(seen, ["nome_regiao", "pedaco"], "left").fillna({"fracao": 0.0})
    a = s.select(F.col("nome_regiao").alias("regiao_a"), "pedaco", F.col("fracao").alias("fa"))
    b = s.select(F.col("nome_regiao").alias("regiao_b"), "pedaco", F.col("fracao").alias("fb"))
    return a.join(b, "pedaco").groupBy("regiao_a", "regiao_b").agg(
        (F.lit(100.0) * F.sum(F.least("fa", "fb"))).alias("sobreposicao"))


def region_profile(redes: DataFrame) -> DataFrame:
    """Per region: units, pupils, medians, share of the units in each probability band."""
    base = redes.groupBy("nome_regiao").agg(
        F.count(F.lit(1)).alias("redes"), F.sum("alunos").alias("alunos"),
        *[(F.lit(100.0) * F.count_if(band(P, EDGES, LABELS) == label) / F.count(P)).alias(f"pct_{label}")
          for label in LABELS])
    rate = quantiles(redes, "taxa_real", {"taxa_mediana_2024": .5}, ["nome_regiao"])
    prob = quantiles(redes, P, {"prob_mediana_pct": .5}, ["nome_regiao"])
    return base.join(rate, "nome_regiao").join(prob, "nome_regiao")


def by_municipality(redes: DataFrame) -> DataFrame:
    """Municipal probability: mean of its networks, weighted by pupils."""
    return redes.groupBy(clean_key("id_municipio").alias("id_municipio")).agg(
        (F.sum(F.col(P) * F.col("alunos")) / F.sum("alunos")).alias(P),
        F.sum("alunos").alias("alunos"), F.count(F.lit(1)).alias("redes"))


def probability_bands(redes: DataFrame, test: DataFrame) -> DataFrame:
    """Observed outcome per band on the test part; municipalities and pupils of the country."""
    t = test.withColumn("faixa", band(P, EDGES, LABELS))
    seen = t.groupBy("faixa").agg(
        F.count(F.lit(1)).alias("redes_teste"), F.sum("alunos").alias("alunos_teste"),
        (F.lit(100.0) * F.avg(1 - F.col("bateu_meta"))).alias("nao_cumpriram_pct"),
        (F.lit(100.0) * F.avg("bateu_meta")).alias("cumpriram_pct"))
    med = quantiles(t.where("faixa is not null"), "taxa_real", {"taxa_mediana_2024": .5}, ["faixa"])
    m = by_municipality(redes).withColumn("faixa", band(F.round(P, 9), EDGES, LABELS))
    country = m.groupBy("faixa").agg(F.count(F.lit(1)).alias("municipios_pais"),
                                     F.sum("alunos").alias("alunos_pais"))
    whole = m.agg(F.count(F.lit(1)).alias("__m"), F.sum("alunos").alias("__a"))
    d = (band_skeleton(redes).join(seen, "faixa", "left").join(med, "faixa", "left")
         .join(country, "faixa", "left").transform(with_totals, whole))
    zero = ["redes_teste", "alunos_teste", "municipios_pais", "alunos_pais"]
    d = d.fillna(0, zero)
    return d.select("faixa", *zero[:2], "taxa_mediana_2024", "nao_cumpriram_pct", "cumpriram_pct",
                    *zero[2:], pct("municipios_pais", "__m").alias("pct_dos_municipios"),
                    pct("alunos_pais", "__a").alias("pct_dos_alunos"))


def alert_municipalities(redes: DataFrame) -> DataFrame:
    """Municipalities up to 25% and from 25% to 50%, and both bands together."""
    m = by_municipality(redes).withColumn("__p", F.round(P, 9))
    one = m.agg(F.count(F.lit(1)).alias("__m"), F.sum("alunos").alias("__a"), *[
        e for name, cond in (("baixa", F.col("__p") <= 25),
                             ("media", (F.col("__p") > 25) & (F.col("__p") <= 50)),
                             ("juntas", F.col("__p") <= 50))
        for e in (F.count_if(cond).alias(f"m_{name}"),
                  F.coalesce(F.sum(F.when(cond, F.col("alunos"))), F.lit(0)).alias(f"a_{name}"))])
    row = lambda label, k: F.struct(F.lit(label).alias("faixa"), F.col(f"m_{k}").alias("municipios"),
                                    F.col(f"a_{k}").alias("alunos"))
    return one.select("__m", "__a", F.inline(F.array(
        row("até 25%", "baixa"), row("25 a 50%", "media"), row("as duas faixas juntas", "juntas")))) \
        .select("faixa", "municipios", pct("municipios", "__m").alias("pct_dos_municipios"),
                "alunos", pct("alunos", "__a").alias("pct_dos_alunos"))


def trajectory_accuracy(test: DataFrame, target: float, threshold: float = 0.5) -> DataFrame:
    """Accuracy by path between cycles, and for those who stayed against those who moved."""
    above = F.col("rede_taxa_ant") >= target
    met = F.col("bateu_meta") == 1
    path = (F.when(F.col("rede_taxa_ant").isNull(), "sem resultado anterior")
            .when(~above & ~met, "permaneceu abaixo").when(above & met, "permaneceu acima")
            .when(~above & met, "virou para cima").otherwise("caiu"))
    d = test.withColumn("trajetoria", path).withColumn(
        "acertou", ((F.col("p_cumprir") >= threshold) == met).cast("double"))
    kind = (F.when(F.col("trajetoria").startswith("permaneceu"), "permanência")
            .when(F.col("trajetoria") != "sem resultado anterior", "mudança"))
    long = d.select("acertou", F.explode(F.array(F.col("trajetoria"), kind)).alias("grupo"))
    return long.where("grupo is not null").groupBy("grupo").agg(
        F.count(F.lit(1)).alias("redes"), (F.lit(100.0) * F.avg("acertou")).alias("acerto"))


def focus_contrast(redes: DataFrame, factors: Sequence[str], low_regions: Sequence[str],
                   high_regions: Sequence[str]) -> DataFrame:
    """Medians of each factor in the low and the high focus and in the country, and how many
    deviations apart the two are."""
    low = F.col("nome_regiao").isin(*low_regions) & (F.col(P) <= 25)
    high = F.col("nome_regiao").isin(*high_regions) & (F.col(P) > 75)
    groups = F.array_compact(F.array(F.lit("pais"), F.when(low, F.lit("baixo")),
                                     F.when(high, F.lit("alto"))))
    long = to_long(redes.withColumn("foco", F.explode(groups)), factors, ["foco"])
    med = quantiles(long, "valor", {"m": .5}, ["foco", "variavel"])
    pick = lambda g: F.max(F.when(F.col("foco") == g, F.col("m"))).alias(f"mediana_{g}")
    spread = long.where("foco = 'pais'").groupBy("variavel").agg(F.stddev_samp("valor").alias("__sd"))
    d = med.groupBy("variavel").agg(pick("baixo"), pick("alto"), pick("pais")).join(spread, "variavel")
    diff = F.col("mediana_alto") - F.col("mediana_baixo")
    return d.select("variavel", "mediana_baixo", "mediana_alto", "mediana_pais",
                    diff.alias("diferenca"), F.try_divide(diff, "__sd").alias("em_desvios"))


def unit_error(rows: DataFrame, key: str) -> DataFrame:
    """Predicted against real rate per group: median absolute error and correlation.
    `rows` has score p, response sums `yes` and weight w."""
    g = rows.groupBy(key).agg((F.lit(100.0) * F.sum(F.col("p") * F.col("w")) / F.sum("w")).alias("prevista"),
                              (F.lit(100.0) * F.sum("yes") / F.sum("w")).alias("real"))
    g = g.withColumn("erro", F.abs(F.col("prevista") - F.col("real")))
    med = quantiles(g, "erro", {"erro_absoluto_mediano": .5})
    rest = g.agg(F.count(F.lit(1)).alias("grupos"), F.corr("prevista", "real").alias("correlacao"))
    return rest.transform(with_totals, med)


def slice_report(test: DataFrame, state: str, min_stable: int, measure) -> DataFrame:
    """Size, population, region, network and one state: units, rates, gap and AUC per slice."""
    inf = float("inf")

    def cut(column, edges, labels):
        c = F.col(column)
        return F.when(c > edges[0], band(c, edges, labels))

    size = cut("alunos", [0, min_stable - 1, 100, 1000, inf],
               [f"menos de {min_stable}", f"{min_stable} a 100", "101 a 1.000", "mais de 1.000"])
    people = cut("mun_populacao", [0, 20000, 100000, inf],
                 ["até 20 mil", "20 a 100 mil", "mais de 100 mil"])
    row = lambda kind, value: F.struct(F.lit(kind).alias("corte"), value.alias("recorte"))
    long = test.select("alunos", "bateu_meta", "p_cumprir", F.inline(F.array(
        row("alunos avaliados", size), row("porte do município", people),
        row("região", F.col("nome_regiao")), row("rede", F.col("rede_nome")),
        row("estado", F.when(F.col("sigla_uf") == state, F.lit(state)).otherwise("demais UFs")))))
    long = long.where("recorte is not null")
    base = long.groupBy("corte", "recorte").agg(
        F.count(F.lit(1)).alias("redes"), F.sum("alunos").alias("alunos"),
        (F.lit(100.0) * F.avg("bateu_meta")).alias("bateram_pct"),
        (F.lit(100.0) * F.avg("p_cumprir")).alias("prob_media_prevista_pct"))
    scores = measure(long.select("corte", "recorte", F.col("p_cumprir").alias("p"),
                                 F.col("bateu_meta").alias("y"), F.lit(1).alias("w")),
                     ["corte", "recorte"]).select("corte", "recorte", "auc")
    return base.join(scores, ["corte", "recorte"]).withColumn(
        "diferenca_pp", F.col("prob_media_prevista_pct") - F.col("bateram_pct"))
