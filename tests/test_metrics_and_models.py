import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lettera.operators import metrics as M
from lettera.operators import modeling as mod
from lettera.operators import stability
from lettera.operators.prepare import Design, weighted_groups
from lettera.operators.recipes import Recipe, replayed, typed


def brute(y, p, w):
    y, p, w = map(np.asarray, (y, p, w))
    pos, neg = y == 1, y == 0
    pairs = sum(w[i] * w[j] * ((p[i] > p[j]) + .5 * (p[i] == p[j]))
                for i, j in itertools.product(np.where(pos)[0], np.where(neg)[0]))
    q = np.clip(p, 1e-6, 1 - 1e-6)
    return (pairs / (w[pos].sum() * w[neg].sum()),
            -(w * (y * np.log(q) + (1 - y) * np.log(1 - q))).sum() / w.sum(), (w * (y - q) ** 2).sum() / w.sum())


def test_weighted_metrics_with_ties(spark):
    rng = np.random.default_rng(1)
    p = pd.DataFrame({"g": rng.choice(["a", "b"], 80), "y": rng.integers(0, 2, 80), "w": rng.integers(1, 5, 80),
                      "p": np.round(rng.random(80), 1)})
    got = {r.g: r for r in M.measure(spark.createDataFrame(p), ["g"]).collect()}
    for g, d in p.groupby("g"):
        assert (got[g].auc, got[g].log_loss, got[g].brier) == pytest.approx(brute(d.y, d.p, d.w))


def test_one_class_has_no_auc(spark):
    d = spark.createDataFrame([(1, .2, 1), (1, .9, 1)], "y int, p double, w int")
    assert M.measure(d).first().auc is None


def test_roc_points_reach_the_corner_and_integrate_to_the_auc(spark):
    rng = np.random.default_rng(4)
    p = pd.DataFrame({"m": "x", "y": rng.integers(0, 2, 60), "w": 1, "p": np.round(rng.random(60), 2)})
    r = M.roc_points(spark.createDataFrame(p), ["m"]).toPandas().sort_values("limiar", ascending=False)
    x, y = np.r_[0, r.fpr], np.r_[0, r.tpr]
    assert (x[-1], y[-1]) == (1, 1)
    assert np.trapezoid(y, x) == pytest.approx(brute(p.y, p.p, p.w)[0])


def test_confusion_counts_the_missed_class(spark):
    d = spark.createDataFrame([(0, .1), (0, .6), (1, .4), (1, .9), (1, .8)], "y int, p double")
    r = M.confusion(d).first()
    assert (r.nao_cumpriu_previu_nao, r.nao_cumpriu_previu_cumprir, r.cumpriu_previu_nao,
            r.cumpriu_previu_cumprir) == (1, 1, 1, 2)
    assert r.sensibilidade == 50 and r.precisao == 50 and r.acuracia == 60


def test_linear_family_wins_within_one_deviation(spark):
    rows = [("regressão logística", "C", .61, .01), ("random forest", "n", .60, .02), ("random forest", "m", .62, .02)]
    d = spark.createDataFrame(rows, "familia string, parametros string, log_loss double, log_loss_desvio double")
    best = M.best_per_family(d)
    assert {r.familia: r.parametros for r in best.collect()} == {"regressão logística": "C", "random forest": "n"}
    assert M.choose_family(best).first().escolhida == "regressão logística"
    far = best.withColumn("log_loss", F.when(F.col("familia") == "regressão logística", .7).otherwise(F.col("log_loss")))
    assert M.choose_family(far).first().escolhida == "random forest"


def test_calibration_bins_split_rows_or_weight(spark):
    rows = [(f"r{i}", i / 10, i % 2, 1 + i % 3) for i in range(10)]
    d = spark.createDataFrame(rows, "k string, p double, y int, w bigint")
    a = M.calibration(d, "k", 5).toPandas()
    b = M.calibration(d, "k", 5, by_weight=True).toPandas()
    assert len(a) == len(b) == 5 and a.peso.sum() == b.peso.sum() == sum(r[3] for r in rows)
    assert b.peso.max() - b.peso.min() <= 1


def data(spark, n=160, seed=0):
    rng = np.random.default_rng(seed)
    x, z = rng.normal(size=n), rng.normal(size=n)
    pupils = rng.integers(5, 15, n)
    yes = rng.binomial(pupils, 1 / (1 + np.exp(-1.5 * x)))
    p = pd.DataFrame({"unidade": [f"u{i}" for i in range(n)], "id_municipio": [f"m{i // 2}" for i in range(n)],
                      "sigla_uf": rng.choice(["A", "B"], n), "x": x, "z": z, "alunos": pupils, "alfabetizados": yes})
    p["bateu_meta"] = (p.alfabetizados / p.alunos >= .5).astype(int)
    return spark.createDataFrame(p)


DESIGN = Design(["x", "z"], ["sigla_uf"])
TREE = {"n_estimators": 10, "max_depth": 4, "min_samples_leaf": 2, "max_features": "sqrt"}


def test_weighted_rows_fit_like_expanded_rows(spark, tmp_path):
    units = data(spark)
    rows = weighted_groups(units)
    many = rows.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("peso")))).withColumn("peso", F.lit(1))
    design = Design(["x", "z"], [])
    # both fits see the same total loss: C is per row of mean weight, so it is scaled by the row ratio
    ratio = many.count() / rows.count()
    a = mod.fit(rows, design, mod.LOGISTIC, {"C": 1.0}, 1, str(tmp_path / "a"), "alvo", "peso")
    b = mod.fit(many, design, mod.LOGISTIC, {"C": 1.0 / ratio}, 1, str(tmp_path / "b"), "alvo", "peso")
    # scaling is learned on rows, which differ between the two, so compare the scores
    sa = {r.unidade: r.p for r in a.score(units).collect()}
    sb = {r.unidade: r.p for r in b.score(units).collect()}
    assert max(abs(sa[k] - sb[k]) for k in sa) < .02


def test_folds_keep_groups_apart_and_cover_every_row(spark, tmp_path):
    units = data(spark, 60)
    folds = mod.Folds(units, DESIGN, False, str(tmp_path / "f"), 42, 3)
    t = folds.table.select("parte", "treina", "linha").toPandas()
    assert len(t) == 180 and (t[~t.treina].groupby("linha").size() == 1).all()
    place = dict(units.select("unidade", "id_municipio").collect())
    for _, d in t.groupby("parte"):
        groups = d.linha.map(place)
        assert not set(groups[d.treina]) & set(groups[~d.treina])


def test_search_returns_one_row_per_combination(spark, tmp_path):
    units = data(spark, 80)
    folds = {b: mod.Folds(units, DESIGN, b, str(tmp_path / f"f{b}"), 42, 2) for b in (True, False)}
    spaces = {mod.LOGISTIC: ({"C": [.1, 1.0], "max_iter": [20]}, 2), mod.FOREST: ({k: [v] for k, v in TREE.items()}, 1)}
    got = mod.search(folds, spaces, 42).toPandas()
    assert len(got) == 3 and got.auc.between(.6, 1).all() and (got.log_loss > 0).all()


def test_draw_is_seeded_and_without_replacement():
    space, n = mod.SPACES[mod.BOOSTING]
    a, b = mod.draw(space, n, 42), mod.draw(space, n, 42)
    assert a == b and len({str(sorted(p.items())) for p in a}) == n
    assert len(mod.draw(mod.SPACES[mod.LOGISTIC][0], 99, 1)) == 10


def test_permutation_of_an_unused_column_costs_nothing(spark, tmp_path):
    units = data(spark)
    # z does not vary where the model is fitted, so the model cannot use it
    train = units.withColumn("z", F.lit(5.0))
    fitted = mod.fit(train, Design(["x", "z"], []), mod.LOGISTIC, {"C": 1.0}, 1, str(tmp_path / "m"))
    blocks = {"x": ["x"], "x em bloco": ["x"], "z": ["z"]}
    r = {row.bloco: row for row in mod.permutation(fitted, units, blocks, 3, 7).collect()}
    assert r["x"].queda_auc == pytest.approx(r["x em bloco"].queda_auc) and r["x"].queda_auc > .05
    assert r["z"].queda_auc == pytest.approx(0) and r["z"].piora_log_loss == pytest.approx(0)


def test_shuffle_is_a_permutation_of_whole_blocks(spark):
    d = spark.createDataFrame([(f"u{i}", i, -i, 100 + i) for i in range(50)], "k string, a int, b int, c int")
    s = mod.shuffled_blocks(d, "k", {"ab": ["a", "b"], "c": ["c"]}, 2, 7).toPandas()
    assert len(s) == 200
    own = {f"u{i}": i for i in range(50)}
    for (block, _), g in s.groupby(["bloco", "repeticao"]):
        moved = g.k.map(own)
        assert (g.a == -g.b).all()                              # a block moves together
        if block == "ab":
            assert sorted(g.a) == list(range(50)) and (g.a != moved).all() and (g.c == 100 + moved).all()
        else:
            assert (g.a == moved).all() and sorted(g.c) == list(range(100, 150)) and (g.c != 100 + moved).all()


def test_interpolation_is_flat_beyond_the_ends(spark):
    pts = [(0.0, 1.0), (1.0, 3.0), (4.0, 0.0)]
    curve = spark.createDataFrame([("g", "v", *p) for p in pts], "grupo string, variavel string, ponto double, media double")
    for x in (-1.0, 0.0, .5, 1.0, 2.0, 4.0, 9.0):
        at = spark.createDataFrame([("v", x)], "variavel string, x double")
        got = mod.interpolate(curve, at, "x", "y").first().y
        assert got == pytest.approx(np.interp(x, *zip(*pts)))


def test_dependence_grid_uses_few_values_or_percentiles(spark):
    rows = [("g", float(i % 3), float(i)) for i in range(101)]
    d = spark.createDataFrame(rows, "grupo string, poucos double, muitos double")
    g = mod.dependence_grid(d, ["poucos", "muitos"]).toPandas()
    assert sorted(g[g.variavel == "poucos"].ponto) == [0, 1, 2]
    many = np.sort(g[g.variavel == "muitos"].ponto)
    assert many == pytest.approx(np.linspace(5, 95, 21))


def test_partial_dependence_rises_with_the_cause(spark, tmp_path):
    units = data(spark)
    fitted = mod.fit(units, DESIGN, mod.LOGISTIC, {"C": 1.0}, 1, str(tmp_path / "m"))
    rows = units.withColumn("grupo", F.lit("amostra"))
    curve = mod.partial_dependence(fitted, rows, ["x", "z"], str(tmp_path / "g"))
    e = {r.variavel: r.efeito_pp for r in mod.factor_effects(curve, units, ["x", "z"]).collect()}
    assert e["x"] > 20 and abs(e["z"]) < 15


def test_stability_keeps_the_cause_and_goes_on_where_it_ended(spark, tmp_path):
    units = data(spark, 120)
    params = {"learning_rate": .3, "max_iter": 3, "max_leaf_nodes": 4, "min_samples_leaf": 5}
    run = lambda resume: stability.eliminate(units, DESIGN, ["x", "z"], str(tmp_path / "s"), 42, 2, 2, 1, params, resume)
    losses = run(False)
    table = sorted(map(tuple, losses.collect()))
    assert [(r, p, v) for r, p, v, _ in table if p == 1] == [(r, 1, v) for r in (1, 2) for v in ("", "x", "z")]
    assert len(table) == 2 * (3 + 2) and stability.select(losses, 2)[0] == "x"
    got = {r.variavel: r for r in stability.verdicts(losses, 2).collect()}
    assert got["x"].rodadas == 2 and got["x"].sobrevivencia == 1 and got["z"].sobrevivencia == 2
    # the second step is taken out and done again
    half = spark.createDataFrame([r for r in table if r[1] == 1], stability.LOSS_SCHEMA)
    half.write.mode("overwrite").parquet(str(tmp_path / "s" / "perdas"))
    again = sorted(map(tuple, run(True).collect()))
    assert [r[:3] for r in again] == [r[:3] for r in table] and [r[3] for r in again] == pytest.approx([r[3] for r in table])


def test_verdicts_of_a_table_of_losses(spark):
    rows = [(1, 1, "", .5), (1, 1, "a", .9), (1, 1, "b", .6), (1, 1, "c", .51), (1, 2, "", .4), (1, 2, "a", .8), (1, 2, "b", .41), (1, 3, "", .4), (1, 3, "a", .7),
            (2, 1, "", .3), (2, 1, "a", .6), (2, 1, "b", .2), (2, 1, "c", .5), (2, 2, "", .6), (2, 2, "a", .9), (2, 2, "c", .8), (2, 3, "", .7), (2, 3, "a", .8)]
    d = spark.createDataFrame(rows, stability.LOSS_SCHEMA)
    got = {r.variavel: (r.rodadas, r.sobrevivencia, r.fica) for r in stability.verdicts(d, 2).collect()}
    assert got == {"a": (2, 1.0, True), "b": (1, 2.5, False), "c": (1, 2.5, False)}
    assert {(r.rodada, r.variavel) for r in stability.still_in(d.where("passo = 1"), ["a", "b", "c"]).collect()} == {(1, "a"), (1, "b"), (2, "a"), (2, "c")}


RECIPES = [(mod.LOGISTIC, {"C": 0.5}), (mod.BOOSTING, {"learning_rate": .2, "max_iter": 4, "max_leaf_nodes": 5, "min_samples_leaf": 5, "l2_regularization": 1.0}),
           (mod.FOREST, {"n_estimators": 5, "max_depth": None, "min_samples_leaf": 3, "max_features": "sqrt"})]


@pytest.mark.parametrize("family,params", RECIPES)
def test_a_recipe_refits_from_its_text(spark, tmp_path, family, params):
    units = data(spark, 90)
    recipe = Recipe(family, params, DESIGN, 7)
    first = recipe.refit(units, str(tmp_path / "a"))
    one = M.measure(first.score(units).select(F.col("bateu_meta").alias("y"), F.lit(1).alias("w"), "p"))
    recipe.measured(folds={"auc": .123456, "log_loss": None}, test={"auc": one.first().auc}).write(spark, str(tmp_path / "r"))
    back = Recipe.read(spark, str(tmp_path / "r"))
    assert (back.family, back.params, back.design, back.seed, back.folds) == (family, typed(family, params), DESIGN, 7, {"auc": .12346})
    again = back.refit(units, str(tmp_path / "b"))
    two = M.measure(again.score(units).select(F.col("bateu_meta").alias("y"), F.lit(1).alias("w"), "p"))
    assert replayed(back, two).first().confere
    mod.save_model(again.model, spark, str(tmp_path / "m"))
    kept = mod.Fitted(again.preparation, mod.load_model(family, spark, str(tmp_path / "m")), DESIGN.variables)
    p = lambda m: sorted((r.unidade, r.p) for r in m.score(units).select("unidade", "p").collect())
    assert p(kept) == p(again)


def test_parameters_are_checked():
    for family, params in ((mod.FOREST, {"n_estimators": 5}), (mod.LOGISTIC, {"C": "a"}), (mod.BOOSTING, {"depth": 1}), ("other", {}), (mod.LOGISTIC, {"C": True})):
        with pytest.raises(ValueError):
            typed(family, params)
    assert typed(mod.FOREST, {"n_estimators": 5.0, "max_depth": None, "min_samples_leaf": 2, "max_features": .3})["n_estimators"] == 5


def test_boosted_folds_of_several_sets(spark, tmp_path):
    units = data(spark, 100)
    folds = mod.Folds(units, DESIGN, False, str(tmp_path / "f"), 42, 2)
    params = {"learning_rate": .2, "max_iter": 4, "max_leaf_nodes": 5, "min_samples_leaf": 5}
    got = {(r.configuracao, r.parte): r.log_loss for r in mod.compare_variables(folds, mod.Params(**params), {"x": ["x"], "xz": ["x", "z"]}).collect()}
    for name, vs in (("x", ["x"]), ("xz", ["x", "z"])):
        for k in range(2):
            model = mod.estimator(mod.BOOSTING, params, 0, 0).fit(folds.part(k, True, vs))
            one = M.measure(mod.score(model, folds.part(k, False, vs)).select("y", F.col("peso_linha").alias("w"), "p")).first()
            assert got[name, k] == pytest.approx(one.log_loss)


def test_dependence_is_dealt_out_before_rows_meet_the_grid(spark, monkeypatch):
    """Rows of one stored file are scored in many tasks."""
    class Flat:
        design, group = Design(["x"], []), "g"

        def transform(self, df):
            return df

    rows = spark.range(50).coalesce(1).select((F.col("id") % 7).cast("double").alias("x"), F.lit("a").alias("g"), F.lit("amostra").alias("grupo"))
    seen = []
    monkeypatch.setattr(mod, "score", lambda _, df: seen.append(df) or df.withColumn("p", F.col("x")))
    import tempfile
    curve = mod.partial_dependence(mod.Fitted(Flat(), None, ["x"]), rows, ["x"], tempfile.mkdtemp())
    assert seen[0].rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism * mod.TASKS_A_CORE
    assert {r.ponto: (r.media, r.linhas) for r in curve.collect()} == {float(v): (float(v), 50) for v in range(7)}


class Flat:
    """A preparation that changes nothing."""
    design, group = Design(["x"], []), "g"

    def transform(self, df):
        return df


def test_a_permuted_row_is_scored_once(spark, monkeypatch):
    """Rows are dealt out before they meet the blocks, and the model looks at each of them one time."""
    calls, tasks = spark.sparkContext.accumulator(0), []

    @F.udf("double")
    def p(x):
        calls.add(1)
        return x / 50

    def score(_, df, name="p"):
        tasks.append(df)
        return df.withColumn(name, p("x"))

    monkeypatch.setattr(mod, "score", score)
    rows = spark.range(40).coalesce(1).select(F.col("id").alias("unidade"), F.col("id").cast("double").alias("x"), F.lit("a").alias("g"),
                                              (F.col("id") % 2).alias("bateu_meta"))
    got = mod.permutation(mod.Fitted(Flat(), None, ["x"]), rows, {"a": ["x"], "b": ["x"]}, 3, 1).collect()
    assert {r.bloco for r in got} == {"a", "b"} and calls.value == 40 + 40 * 2 * 3
    assert tasks[1].rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism * mod.TASKS_A_CORE


def test_rows_of_few_files_are_fitted_in_many_tasks(spark, tmp_path, monkeypatch):
    seen, real = [], mod.estimator

    class Watch:
        def __init__(self, *args):
            self.args = args

        def fit(self, rows):
            seen.append(rows.rdd.getNumPartitions())
            return real(*self.args).fit(rows)

    monkeypatch.setattr(mod, "ROWS_A_TASK", 20)
    monkeypatch.setattr(mod, "estimator", Watch)
    units = data(spark, 90)
    family, params = RECIPES[2]
    one, two = (mod.fit(d, DESIGN, family, params, 7, str(tmp_path / "m")) for d in (units.coalesce(1), units.repartition(3)))
    p = lambda m: sorted((r.unidade, r.p) for r in m.score(units).select("unidade", "p").collect())
    assert seen == [4, 4] and p(one) == p(two)          # the same rows, wherever they lie, give the same forest
    mod.cross_validate(mod.Folds(units, DESIGN, False, str(tmp_path / "f"), 42, 2), family, params, {"familia": family}).collect()
    assert seen[2:] == [2, 2]


def test_few_rows_stay_as_they_are(spark):
    rows = spark.range(10)
    assert mod.dealt(rows, 10) is rows
