"""Metrics and reports on the deterministic score, as registered queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import hash_number, with_totals
from ..functions.metadata import FACTORS
from ..operators import metrics, reports
from ..operators.ordering import quantiles
from ..operators.prepare import weighted_groups
from ..operators.splits import group_folds
from .profile_queries import rounded

LOW, HIGH = ("AFRICA", "AMERICA"), ("ASIA", "EUROPE")
STATE = "NATION_1"


def test_part(ws):
    return ws.scored.where("particao = 'teste'")


def pupil_rows(ws, df):
    """Weighted class rows of scored units: response y, weight w, one text per row."""
    return weighted_groups(df).select(
        "*", F.col("alvo").alias("y"), F.col("peso").alias("w"),
        F.concat_ws("/", "unidade", F.col("alvo").cast("string")).alias("desempate"))


def three_scores(ws):
    """Pupil rows of validation and test under three scores: model, previous rate, ceiling."""
    rows = pupil_rows(ws, ws.scored.where("particao <> 'treino'"))
    fill = quantiles(ws.scored.where("particao <> 'treino'"), "rede_taxa_ant", {"__fill": .5}, ["particao"])
    d = rows.join(fill, "particao", "left")
    s = lambda n, p: F.struct(F.lit(n).alias("nota"), p.alias("p"))
    return d.select("particao", "y", "w", "desempate", F.inline(F.array(
        s("modelo", F.col("p_cumprir")),
        s("repetir o ciclo anterior", F.coalesce("rede_taxa_ant", "__fill") / F.lit(100.0)),
        s("AUC máxima possível", F.col("alfabetizados") / F.col("alunos")))))


def metrics_weighted(ws):
    return rounded(metrics.measure(three_scores(ws), ["particao", "nota"]))


def roc_points(ws):
    d = three_scores(ws).where("particao = 'teste' and nota <> 'AUC máxima possível'")
    return rounded(metrics.roc_points(d, ["nota"]))


def calibration_bins(ws):
    """Ten bins on validation: pupils in bins of equal rows and of equal weight; networks of the
    test part in bins of equal rows."""
    pupils = three_scores(ws).where("particao = 'validacao' and nota = 'modelo'")
    units = test_part(ws).select(F.col("p_cumprir").alias("p"), F.col("bateu_meta").alias("y"),
                                 F.lit(1).alias("w"), F.col("unidade").alias("desempate"))
    parts = [("alunos, linhas iguais", metrics.calibration(pupils, "desempate")),
             ("alunos, pesos iguais", metrics.calibration(pupils, "desempate", by_weight=True)),
             ("redes", metrics.calibration(units, "desempate"))]
    out = None
    for name, df in parts:
        one = df.withColumn("corte", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return rounded(out)


def confusion(ws):
    d = test_part(ws)
    s = lambda n, p: F.struct(F.lit(n).alias("nota"), p.alias("p"))
    both = d.select(F.col("bateu_meta").alias("y"), F.inline(F.array(
        s("modelo", F.col("p_cumprir")),
        s("só o ciclo anterior", F.coalesce(F.col("rede_taxa_ant") / F.lit(100.0), F.lit(0.5))))))
    return rounded(metrics.confusion(both, ["nota"]))


def fold_rows(ws):
    """Weighted training rows with their fold and the rate of the other folds."""
    train = ws.redes.where("particao = 'treino'")
    d = train.join(group_folds(train, "id_municipio", ws.cycle.seed, ws.cycle.folds), "id_municipio")
    per = d.groupBy("fold").agg(F.sum("alunos").alias("n"), F.sum("alfabetizados").alias("y"))
    whole = per.agg(F.sum("n").alias("tn"), F.sum("y").alias("ty"))
    rest = per.transform(with_totals, whole).select(
        "fold", ((F.col("ty") - F.col("y")) / (F.col("tn") - F.col("n"))).alias("taxa_treino"))
    return weighted_groups(d.join(F.broadcast(rest), "fold"))      # one row per fold


def baselines(ws):
    per_fold = metrics.baselines(fold_rows(ws))
    return rounded(metrics.summarize_folds(per_fold, ["referencia"]))


def search_table(ws):
    """A table of search results from the data: family, parameters and metrics per score mix."""
    train = ws.scored.where("particao = 'treino'")
    folds = group_folds(train, "id_municipio", ws.cycle.seed, ws.cycle.folds)
    d = train.join(folds, "id_municipio")
    mixes = [("regressão logística", 0.2), ("regressão logística", 0.4), ("gradient boosting", 0.6),
             ("random forest", 0.5), ("random forest", 0.8)]
    noise = hash_number("unidade", "mistura") % 10000 / F.lit(10000.0)
    long = d.select("fold", F.col("bateu_meta").alias("y"), F.lit(1).alias("w"), F.inline(F.array(*[
        F.struct(F.lit(f).alias("familia"), F.lit(f"mistura={m}").alias("parametros"),
                 F.round(F.lit(m) * F.col("p_cumprir") + F.lit(1 - m) * noise, 6).alias("p"))
        for f, m in mixes])))
    per_fold = metrics.measure(long, ["familia", "parametros", "fold"])
    return rounded(metrics.summarize_folds(per_fold, ["familia", "parametros"]))


def unit_error(ws):
    d = ws.scored.where("particao = 'validacao'").withColumn("yes", F.col("alfabetizados"))
    parts = []
    for name, p in (("modelo", F.col("p_cumprir")),
                    ("repetir o ciclo anterior", F.coalesce(F.col("rede_taxa_ant") / F.lit(100.0), F.lit(0.5)))):
        one = reports.unit_error(d.select("id_municipio", p.alias("p"), "yes", F.col("alunos").alias("w")),
                                 "id_municipio")
        parts.append(one.withColumn("nota", F.lit(name)))
    return rounded(parts[0].unionByName(parts[1]))


QUERIES = {
    "metrics_weighted": metrics_weighted,
    "roc_points": roc_points,
    "calibration_bins": calibration_bins,
    "confusion": confusion,
    "baselines": baselines,
    "best_per_family": lambda ws: metrics.best_per_family(search_table(ws)),
    "choose_family": lambda ws: metrics.choose_family(metrics.best_per_family(search_table(ws))),
    "slice_report": lambda ws: rounded(reports.slice_report(
        test_part(ws), STATE, ws.cycle.min_stable, metrics.measure)),
    "unit_error": unit_error,
    "ceiling_prediction": lambda ws: ws.redes.select(
        "unidade", "alunos", (F.col("alfabetizados") / F.col("alunos")).alias("melhor_previsao")),
    "risk_list": lambda ws: rounded(reports.risk_list(
        ws.scored, ws.tables.diretorio_municipio(), ws.cycle.unit_target), 9),
    "risk_summary": lambda ws: rounded(reports.risk_summary(ws.scored, ws.cycle.unit_target)),
    "risk_by_state": lambda ws: rounded(reports.risk_by_state(ws.scored, ws.cycle.unit_target)),
    "region_profile": lambda ws: rounded(reports.region_profile(ws.scored)),
    "region_overlap": lambda ws: rounded(reports.region_overlap(ws.scored)),
    "probability_bands": lambda ws: rounded(reports.probability_bands(ws.scored, test_part(ws))),
    "alert_municipalities": lambda ws: rounded(reports.alert_municipalities(ws.scored)),
    "trajectory_accuracy": lambda ws: rounded(reports.trajectory_accuracy(
        test_part(ws), ws.cycle.unit_target)),
    "focus_contrast": lambda ws: rounded(reports.focus_contrast(ws.scored, list(FACTORS), LOW, HIGH)),
}
