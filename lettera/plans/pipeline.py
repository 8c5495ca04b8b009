"""The four runs end to end: base table, pupil model, network model, planning answers.

Each run stops at the first guard that fails, writes its tables, registers and CSV reports under
`out`, and returns what the next run needs. `Settings` defaults to the full searches and rounds.
"""
from __future__ import annotations

import json
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import CONTRACT, TEST, TRAIN, VALID
from ..functions.exprs import with_totals
from ..functions.metadata import (CATEGORICAL, FACTOR_ORDER, FACTORS, FEATURES, INDICATORS, NUMERIC,
                                  STARTING_POINT, TERRITORY, variable_metadata)
from ..operators import curation, guards, metrics, modeling, profile, relations, reports, screening, stability
from ..operators.modeling import LINEAR, LOGISTIC, Fitted, Folds
from ..operators.prepare import Design, weighted_groups
from ..operators.recipes import Recipe, replayed
from ..operators.splits import group_folds, sample_rows
from ..sources import lake
from .profile_queries import check_decisions
from .workspace import UNIT, Workspace


@dataclass(frozen=True)
class Settings:
    spaces: dict | None = None        # None: modeling.SPACES for pupils, modeling.NETWORK_SPACES for networks
    folds: int = 5
    rounds: int = 5
    minimum_rounds: int = 4
    shuffles: int = 2
    repeats: int = 10
    sample: int | None = None         # networks behind the national curves; all unless a number is given
    parallelism: int = 4
    reuse_search: bool = False        # read the stored search results where there are any
    reuse_curation: bool = False      # read the stored variable selection where there is one
    instrument: dict = field(default_factory=lambda: modeling.INSTRUMENT)
    logged: tuple = ("mun_populacao", "mun_densidade_demografica")


def build_base(ws: Workspace, out: str, day: str | None = None) -> DataFrame:
    """Contract, joins, audit, split, snapshot, reconciliation and data dictionary."""
    t = ws.tables
    have = {"alunos": ws.alunos, "municipio": t.municipio(), "indicador_municipio": t.indicador_municipio()}
    guards.enforce(guards.contract(ws.spark, have, CONTRACT).where("situacao <> 'ok'"), "contract")
    for label, df, keys in ws.stored_sources:
        guards.enforce(guards.duplicate_keys(df, keys), f"duplicate keys in {label}")
    abt, units = ws.abt(), ws.units
    guards.enforce(guards.leakage(ws.spark, FEATURES, abt.columns, CATEGORICAL).where("situacao <> 'ok'"),
                   "leakage")
    guards.enforce(guards.constants(units, FEATURES).where("constante"), "variable without variation")
    guards.enforce(guards.target_correlation(units, NUMERIC, "alfabetizados", "alunos").where("extrema"),
                   "suspicious correlation with the response")
    guards.enforce(guards.split_integrity(units, "id_municipio"), "municipality in two parts")
    written = lake.write_snapshot(abt, f"{out}/ml/abt", day)
    guards.enforce(lake.reconcile(ws.spark, written, day).where("not confere"), "rows lost in the write")
    meta = variable_metadata(ws.spark, ws.cycle)
    names = ws.spark.createDataFrame([(c,) for c in abt.columns], "variavel string")
    guards.enforce(guards.dictionary_gaps(names, meta), "dictionary")
    seen = profile.column_profile(units, NUMERIC, CATEGORICAL).select("variavel", "preenchido_pct", "distintos")
    lake.write_report(meta.join(seen, "variavel", "left"), f"{out}/reports/dicionario_dados", 1)
    return lake.read_latest(ws.spark, f"{out}/ml/abt") if day is None else \
        ws.spark.read.parquet(f"{out}/ml/abt/{lake.PARTITION}={day}")


def part(ws: Workspace, *names: str) -> DataFrame:
    return ws.redes.where(F.col("particao").isin(*names))


def full_design(s: Settings) -> Design:
    return Design(list(NUMERIC), list(CATEGORICAL), dict(INDICATORS), list(s.logged))


def _scores(fitted: dict[str, Fitted], rows: DataFrame, y: str, w) -> DataFrame:
    out = None
    for name, f in fitted.items():
        one = f.score(rows).select(F.lit(name).alias("modelo"), "alunos", F.col(y).alias("y"), w.alias("w"), "p")
        out = one if out is None else out.unionByName(one)
    return out


def _search(ws, spaces: dict, s: Settings, folds: dict, out: str) -> tuple[DataFrame, str]:
    """Search results as CSV with JSON parameters, the best of each family, the chosen one."""
    found, origin = lake.materialize_if_stale(
        ws.spark, f"{out}/busca", lambda: modeling.search(folds, spaces, ws.cycle.seed, s.parallelism),
        ["familia", "parametros", "log_loss", "log_loss_desvio"], refresh=not s.reuse_search)
    found.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{out}/busca_csv")
    best = metrics.best_per_family(found)
    return best, metrics.choose_family(best, LOGISTIC).first().escolhida


NAMES = ("auc", "log_loss", "brier")
FOLD_NAMES = ("auc", "auc_desvio", "log_loss", "log_loss_desvio", "brier")
REPEAT, CEILING, CONSTANT = "repetir o ciclo anterior", "melhor previsão possível", "constante"


def _references(rows: DataFrame, train_rate: float) -> DataFrame:
    """(modelo, alunos, y, w, p) of the previous rate and of the best possible prediction."""
    score = lambda n, p: F.struct(F.lit(n).alias("modelo"), p.alias("p"))
    return rows.select("alunos", F.col("alvo").alias("y"), F.col("peso").alias("w"), F.inline(F.array(
        score(REPEAT, F.coalesce(F.col("rede_taxa_ant") / 100, F.lit(train_rate))),
        score(CEILING, F.col("alfabetizados") / F.col("alunos"))))).select("modelo", "alunos", "y", "w", "p")


def _fold_references(train: DataFrame, seed: int, folds: int) -> DataFrame:
    """Cross validation of the three references that learn nothing: one row each."""
    d = train.join(group_folds(train, "id_municipio", seed, folds), "id_municipio")
    per = d.groupBy("fold").agg(F.sum("peso").alias("n"), F.sum(F.col("peso") * F.col("alvo")).alias("y"))
    whole = per.agg(F.sum("n").alias("tn"), F.sum("y").alias("ty"))
    rest = per.transform(with_totals, whole).select("fold", ((F.col("ty") - F.col("y")) / (F.col("tn") - F.col("n"))).alias("taxa_treino"))
    return metrics.summarize_folds(metrics.baselines(d.join(F.broadcast(rest), "fold")), ["referencia"])        # one row per fold


def comparison(cv: DataFrame, references: DataFrame, seen: DataFrame) -> DataFrame:
    """Cross validation beside validation for finalists and references, with the way to the ceiling on both sides, and
    whether validation puts the families in the same order as cross validation."""
    left = references.select(F.col("referencia").alias("modelo"), F.lit("referência").alias("tipo"), *NAMES).unionByName(
        cv.select(F.col("familia").alias("modelo"), F.lit("finalista").alias("tipo"), *NAMES))
    both = left.select("modelo", "tipo", *[F.col(n).alias(f"cv_{n}") for n in NAMES]).join(
        seen.select("modelo", *[F.col(n).alias(f"validacao_{n}") for n in NAMES]), "modelo", "full_outer")
    top = both.where(F.col("modelo") == CEILING).select(F.col("cv_auc").alias("__cv"), F.col("validacao_auc").alias("__validacao"))
    for side in ("cv", "validacao"):
        way = F.try_divide(F.col(f"{side}_auc") - 0.5, F.col(f"__{side}") - 0.5)
        both = both.transform(with_totals, top) if side == "cv" else both
        both = both.withColumn(f"{side}_pct_do_caminho", F.bround(100 * way, 0))
    # windows over the few rows of the report
    place = lambda c: F.row_number().over(Window.partitionBy("tipo").orderBy(F.col(c).asc_nulls_last(), "modelo"))
    both = both.withColumn("mesma_ordem", place("cv_log_loss") == place("validacao_log_loss"))
    return both.withColumn("mesma_ordem", F.when(F.col("tipo") == "finalista", F.col("mesma_ordem"))).drop("__cv", "__validacao")


def model_pupils(ws: Workspace, out: str, s: Settings = Settings(), design: Design | None = None) -> str:
    """Pupil grain: weighted rows, preparation check, search, finalists against references."""
    design, seed, spaces = design or full_design(s), ws.cycle.seed, s.spaces or modeling.SPACES
    rows = weighted_groups(ws.redes).withColumn(
        "desempate", F.concat_ws("/", "unidade", F.col("alvo").cast("string")))
    pupils = ws.abt().where(F.col("rede_nome").isin("Estadual", "Municipal")).select("particao", "alvo")
    guards.enforce(guards.aggregation_preserves(pupils, rows).where("not preserva"), "compression")
    train, valid = (rows.where(F.col("particao") == p) for p in (TRAIN, VALID))
    folds = {b: Folds(train, design, b, f"{out}/partes_{b}", seed, s.folds, y="alvo", weight="peso",
                      row="desempate") for b in sorted({LINEAR[f] for f in spaces})}
    for fold in folds.values():
        guards.enforce(guards.empty_cells(fold.table, fold.preparation.columns()).where("celulas_vazias > 0"),
                       "empty cells after preparation")
    best, chosen = _search(ws, spaces, s, folds, out)
    found = {r.familia: r for r in best.collect()}          # one row per family
    recipes = {f: Recipe(f, json.loads(r.parametros), design, seed, "alvo", "peso") for f, r in found.items()}
    final = {f: r.refit(train, f"{out}/finalistas/{i}") for i, (f, r) in enumerate(recipes.items())}
    rate = train.agg((F.sum(F.col("peso") * F.col("alvo")) / F.sum("peso")).alias("m")).first().m
    flat = valid.select(F.lit(CONSTANT).alias("modelo"), "alunos", F.col("alvo").alias("y"), F.col("peso").alias("w"), F.lit(float(rate)).alias("p"))
    scores = _scores(final, valid, "alvo", F.col("peso")).unionByName(_references(valid, float(rate))).unionByName(flat)
    seen = modeling.measured(scores, ["modelo"])
    table = comparison(best, _fold_references(train, seed, s.folds), seen)
    lake.write_report(table, f"{out}/reports/comparacao_modelos", 5)
    lake.write_report(default_logistics(folds[True], design), f"{out}/reports/referencias_logisticas", 5) if True in folds else None
    mine = seen.where(F.col("modelo") == chosen).first()
    recipes[chosen].measured(folds={k: found[chosen][k] for k in FOLD_NAMES}, validation={k: mine[k] for k in NAMES}).write(
        ws.spark, f"{out}/registro")
    return chosen


def default_logistics(folds: Folds, design: Design) -> DataFrame:
    """Cross validation of a logistic with the default penalty, over all variables and over the previous rate alone."""
    sets = {"logística padrão": None, "logística só com o ciclo anterior": [v for v in ("rede_taxa_ant",) if v in design.variables]}
    per = None
    for name, variables in sets.items():
        if variables == []:
            continue
        one = modeling.cross_validate(folds, LOGISTIC, {"C": 1.0}, {"referencia": name}, variables)
        per = one if per is None else per.unionByName(one)
    return metrics.summarize_folds(per, ["referencia"])


CURATION_SCHEMA = "variavel string, etapa string, fica boolean, regra string, valor double, ligada string, rodadas long, sobrevivencia double"


def curate(ws: Workspace, out: str, s: Settings, design: Design, numeric: list[str]) -> tuple[list[str], list[str]]:
    """Variables that the screening leaves, and of these the selected ones; from the stored log when asked for."""
    path, train = f"{out}/reports/curadoria_variaveis", part(ws, TRAIN)
    if s.reuse_curation and lake.path_exists(ws.spark, f"{path}/_SUCCESS"):
        log = ws.spark.read.schema(CURATION_SCHEMA).option("header", True).csv(path)
        rows = log.where("etapa = 'B'").orderBy("sobrevivencia", "variavel").collect()
        unknown = [r.variavel for r in rows if r.variavel not in design.variables]
        if unknown:
            raise lake.StopRun(f"the stored curation names unknown variables: {unknown}")
        return [r.variavel for r in rows if r.variavel in numeric], [r.variavel for r in rows if r.fica]
    kept, log = screening.screen(train, numeric, ws.cycle, lambda names: curation.filled_correlation(train, names),
                                 lambda names: relations.pairwise_spearman(train, names, "unidade"))
    losses = stability.eliminate(train, design, [*kept, "rede_nome"], f"{out}/estabilidade", ws.cycle.seed, s.rounds, s.folds, s.shuffles, s.instrument)
    lasting = stability.verdicts(losses, s.minimum_rounds)
    a = log.where("regra is not null").select("variavel", F.lit("A").alias("etapa"), F.lit(False).alias("fica"), "regra", "valor", "ligada")
    both = a.unionByName(lasting.withColumn("etapa", F.lit("B")), allowMissingColumns=True).select(
        *[f.split()[0] for f in CURATION_SCHEMA.split(", ")])
    lake.write_report(both, path, 3)
    return kept, stability.select(losses, s.minimum_rounds)


def by_variables(ws: Workspace, out: str, s: Settings, design: Design, sets: dict[str, list[str]]) -> DataFrame:
    """The same cross validation over several sets of variables, with the instrument of the curation."""
    sets = {k: vs for k, vs in sets.items() if vs}
    every = design.only([v for vs in sets.values() for v in vs])
    folds = Folds(part(ws, TRAIN), every, False, f"{out}/partes_conjuntos", ws.cycle.seed, s.folds)
    return metrics.summarize_folds(modeling.compare_variables(folds, modeling.Params(**s.instrument), sets), ["configuracao", "variaveis"])


def _measured_networks(scores: DataFrame, least: int) -> DataFrame:
    """Metrics of each model, and its AUC over networks of `least` pupils or more."""
    stable = modeling.measured(scores.where(F.col("alunos") >= least), ["modelo"]).select("modelo", F.col("auc").alias("auc_redes_estaveis"))
    return modeling.measured(scores, ["modelo"]).join(stable, "modelo", "left")


def model_networks(ws: Workspace, out: str, s: Settings = Settings(),
                   candidates: list[str] | None = None) -> tuple[Fitted, list[str]]:
    """Network grain: curation in two stages, search, finalists on validation, final model, test table."""
    seed, train, spaces = ws.cycle.seed, part(ws, TRAIN), s.spaces or modeling.NETWORK_SPACES
    numeric = [v for v in candidates or NUMERIC if v in NUMERIC]
    design = full_design(s)
    guards.enforce(check_decisions(ws), "variable decisions")
    guards.enforce(guards.group_invariance(ws.units, ["particao", *UNIT], [*NUMERIC, *TERRITORY])
                   .where("grupos_que_variam > 0"), "variable that varies inside a network")
    kept, selected = curate(ws, out, s, design, numeric)
    chosen_design = design.only([*selected, *TERRITORY])
    lake.write_report(by_variables(ws, out, s, design, {"todas": [*numeric, *CATEGORICAL], "etapa A": [*kept, *CATEGORICAL], "selecionadas": chosen_design.variables}),
                      f"{out}/reports/conjuntos_variaveis", 5)
    folds = {x: Folds(train, chosen_design, x, f"{out}/partes_{x}", seed, s.folds)
             for x in sorted({LINEAR[f] for f in spaces})}
    best, family = _search(ws, spaces, s, folds, out)
    found = {r.familia: r for r in best.collect()}          # one row per family
    recipe = Recipe(family, json.loads(found[family].parametros), chosen_design, seed)
    previous = Recipe(LOGISTIC, {"C": 1.0}, Design(["rede_taxa_ant"], []), seed)
    variants = {"só o ciclo anterior": previous}
    if selected:
        variants["sem território"] = replace(recipe, design=design.only(selected))
    finalists = {f: replace(recipe, family=f, params=json.loads(r.parametros)) for f, r in found.items()}
    on_train = {n: r.refit(train, f"{out}/finalistas/{i}") for i, (n, r) in enumerate((finalists | variants).items())}
    seen = _measured_networks(_scores(on_train, part(ws, VALID), "bateu_meta", F.lit(1)), ws.cycle.min_stable)
    gain = territory_gain(folds[LINEAR[family]], recipe, selected, found[family].auc)
    lake.write_report(seen.withColumn("ganho_do_territorio", F.when(F.col("modelo") == family, F.lit(gain))), f"{out}/reports/validacao_rede", 5)
    both = part(ws, TRAIN, VALID)
    final = recipe.refit(both, f"{out}/final")
    models = {"modelo final": final} | {n: r.refit(both, f"{out}/variantes/{i}") for i, (n, r) in enumerate(variants.items())}
    test = part(ws, TEST)
    rate = both.agg(F.avg("bateu_meta").alias("m")).first().m
    flat = test.select(F.lit(CONSTANT).alias("modelo"), "alunos", F.col("bateu_meta").alias("y"), F.lit(1).alias("w"), F.lit(float(rate)).alias("p"))
    scores = _scores(models, test, "bateu_meta", F.lit(1)).unionByName(flat)
    every = _measured_networks(scores, ws.cycle.min_stable)
    lake.write_report(every.join(metrics.confusion(scores, ["modelo"]), "modelo"), f"{out}/reports/avaliacao_teste_rede", 5)
    mine, valid = every.where("modelo = 'modelo final'").first(), seen.where(F.col("modelo") == family).first()
    final.preparation.save(f"{out}/modelo/preparo")
    modeling.save_model(final.model, ws.spark, f"{out}/modelo/modelo")
    recipe.measured(folds={k: found[family][k] for k in FOLD_NAMES}, validation={k: valid[k] for k in (*NAMES, "auc_redes_estaveis")},
                    test={k: mine[k] for k in NAMES}).write(ws.spark, f"{out}/registro")
    return final, selected


def territory_gain(folds: Folds, recipe: Recipe, selected: list[str], auc: float) -> float | None:
    """What the territory adds to the AUC of the chosen recipe in cross validation; null where nothing else is left."""
    if not selected:
        return None
    per = modeling.cross_validate(folds, recipe.family, recipe.params, {"modelo": "sem território"}, selected)
    return float(auc) - metrics.summarize_folds(per, ["modelo"]).first().auc


def rebuilt(ws: Workspace, register: str, out: str) -> tuple[Fitted, Recipe]:
    """The registered network model, learned again from the register's text; it has to give the registered AUC."""
    recipe = Recipe.read(ws.spark, register)
    model = recipe.refit(part(ws, TRAIN, VALID), out)
    again = modeling.measured(model.score(part(ws, TEST)).select(F.col("bateu_meta").alias("y"), F.lit(1).alias("w"), "p"))
    guards.enforce(replayed(recipe, again).where("not confere"), "the recipe does not replay")
    return model, recipe


def answer_questions(ws: Workspace, out: str, model: Fitted, registered_auc: float | None,
                     s: Settings = Settings()) -> dict[str, DataFrame]:
    """Five answers from the final model, each written as a CSV report."""
    test, target, seed = part(ws, TEST), ws.cycle.unit_target, ws.cycle.seed
    again = modeling.measured(model.score(test).select(F.col("bateu_meta").alias("y"), F.lit(1).alias("w"), "p"))
    if registered_auc is not None:
        guards.enforce(again.where(F.abs(F.col("auc") - registered_auc) > 1e-4), "the model does not replay")
    model.score(ws.redes, "p_cumprir").write.mode("overwrite").parquet(f"{out}/pontuadas")
    scored = ws.spark.read.parquet(f"{out}/pontuadas").withColumns({
        "p_cumprir_pct": F.lit(100.0) * F.col("p_cumprir"),
        "risco": F.lit(100.0) * (1 - F.col("p_cumprir"))})
    in_test = scored.where(F.col("particao") == TEST)
    levers = [v for v in model.variables if v in FACTORS]
    names = ws.tables.diretorio_municipio()
    guards.enforce(guards.lookup_gaps(ws.redes, names, "id_municipio"), "municipality without a name")
    answers: dict[str, DataFrame] = {}
    if levers:
        chosen = ws.redes if s.sample is None else sample_rows(ws.redes, "unidade", seed, s.sample)
        groups = chosen.withColumn("grupo", F.lit("amostra")) \
            .unionByName(ws.redes.withColumn("grupo", F.col("nome_regiao")))
        curve = modeling.partial_dependence(model, groups, levers, f"{out}/grade")
        curve.write.mode("overwrite").parquet(f"{out}/dependencia")
        effects = modeling.factor_effects(ws.spark.read.parquet(f"{out}/dependencia"), ws.redes, levers)
        answers["fatores"] = modeling.factor_table(effects, {v: FACTORS[v] for v in levers}, FACTOR_ORDER)
    answers["redes_risco"] = reports.risk_list(scored, names, target)
    answers["resumo_risco"] = reports.risk_summary(scored, target)
    answers["perfil_regioes"] = reports.region_profile(scored)
    answers["semelhanca_regioes"] = reports.region_overlap(scored)
    answers["faixas_probabilidade"] = reports.probability_bands(scored, in_test)
    answers["trajetorias"] = reports.trajectory_accuracy(in_test, target)
    one_by_one = {v: [v] for v in model.variables}
    blocks = {"sem o ponto de partida": [v for v in STARTING_POINT if v in model.variables],
              "sem as alavancas": [v for v in model.variables if v not in STARTING_POINT],
              "sem o território": [v for v in TERRITORY if v in model.variables]}
    answers["influencia_variaveis"] = modeling.permutation(model, test, one_by_one, s.repeats, seed)
    answers["influencia_blocos"] = modeling.permutation(
        model, test, {k: v for k, v in blocks.items() if v}, s.repeats, seed)
    return {name: lake.write_report(df, f"{out}/reports/{name}", 4) for name, df in answers.items()}
