"""Families of classifiers, grouped cross validation, search and model reading.

Folds are prepared once, all together, into one stored table; every fit then reads its part.
Fits of a search run side by side, each a distributed job, and all scores of a search are
measured in one job.
"""
from __future__ import annotations

import hashlib
import json
import math
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.classification import (LogisticRegression, LogisticRegressionModel, RandomForestClassificationModel,
                                       RandomForestClassifier)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import with_totals
from ..sources.lake import run_folder
from .boosting import Leafwise, LeafwiseModel, Params, binned, score_many
from .dependence import can_walk, forest_dependence, trees_of
from .metrics import measure, summarize_folds
from .ordering import BEFORE, cumulate, quantiles, sorted_side, value_counts
from .prepare import Design, Preparation, to_long
from .splits import group_folds

LOGISTIC, BOOSTING, FOREST = "regressão logística", "gradient boosting", "random forest"
LINEAR = {LOGISTIC: True, BOOSTING: False, FOREST: False}

# Search spaces and number of draws of each family (fixed values).
SPACES = {
    LOGISTIC: ({"C": [10 ** (-3 + 5 * i / 9) for i in range(10)]}, 10),
    BOOSTING: ({"learning_rate": [0.02, 0.05, 0.1, 0.2], "max_iter": [100, 200, 400],
                "max_leaf_nodes": [7, 15, 31, 63], "min_samples_leaf": [10, 20, 50, 100, 200],
                "l2_regularization": [0.0, 0.1, 1.0, 10.0]}, 20),
    FOREST: ({"n_estimators": [200, 400], "max_depth": [None, 8, 12, 20],
              "min_samples_leaf": [2, 5, 10, 20, 50], "max_features": ["sqrt", 0.3, 0.5]}, 12),
}
# The grain of networks has fewer rows: fewer draws, and no leaves of 200 (fixed values).
NETWORK_SPACES = {
    LOGISTIC: SPACES[LOGISTIC],
    BOOSTING: (SPACES[BOOSTING][0] | {"min_samples_leaf": [10, 20, 50, 100]}, 12),
    FOREST: (SPACES[FOREST][0], 10),
}
INSTRUMENT = {"min_samples_leaf": 10, "max_leaf_nodes": 15, "max_iter": 200, "learning_rate": 0.02,
              "l2_regularization": 0.1}
DEEPEST = 30          # Spark's limit on tree depth, used for "no limit"


def estimator(family: str, params: dict, rows: int, seed: int):
    """The estimator of a family. C weighs the summed loss, Spark's penalty the mean loss, hence 1 / (C * rows) with weights
    of mean 1. Boosting is `boosting.Leafwise`; it draws nothing, so it needs no seed."""
    common = dict(featuresCol="features", labelCol="y", weightCol="w")
    if family == LOGISTIC:
        return LogisticRegression(**common, regParam=1.0 / (params.get("C", 1.0) * rows),
                                  standardization=False, maxIter=params.get("max_iter", 3000), tol=1e-6)
    if family == BOOSTING:
        return Leafwise(Params(**params))
    if family != FOREST:
        raise ValueError(f"unknown family: {family}")
    return RandomForestClassifier(**common, numTrees=params["n_estimators"],
                                  maxDepth=params["max_depth"] or DEEPEST,
                                  minInstancesPerNode=params["min_samples_leaf"],
                                  featureSubsetStrategy=str(params["max_features"]), seed=seed)


def score(model, df: DataFrame, name: str = "p") -> DataFrame:
    """Add the probability of the response 1; drops the model's own columns."""
    if isinstance(model, LeafwiseModel):
        return model.score(df, name)
    return model.transform(df).withColumn(name, vector_to_array("probability")[1]) \
        .drop("rawPrediction", "probability", "prediction")


def save_model(model, spark: SparkSession, path: str) -> None:
    if isinstance(model, LeafwiseModel):
        model.save(spark, path)
    else:
        model.write().overwrite().save(path)


def load_model(family: str, spark: SparkSession, path: str):
    if family == BOOSTING:
        return LeafwiseModel.load(spark, path)
    return (LogisticRegressionModel if family == LOGISTIC else RandomForestClassificationModel).load(path)


def mean_one(df: DataFrame, weight: str, by: Sequence[str] = ()) -> DataFrame:
    """Weights scaled to mean 1, per value of `by` (one row each) or over all rows."""
    mean = df.groupBy(*by).agg(F.avg(weight).alias("__mean"))
    d = df.join(F.broadcast(mean), list(by)) if by else df.transform(with_totals, mean)
    return d.withColumn("w", F.col(weight) / F.col("__mean")).drop("__mean")


def own(path: str) -> str:
    """A fresh folder below `path`: a table that an earlier fit still reads is never replaced."""
    return f"{path}/{uuid.uuid4().hex[:12]}"


#: Rows below which a further task of a fit costs more than it takes over.
ROWS_A_TASK = 4_000


def dealt(rows: DataFrame, n: int, beside: int = 1) -> DataFrame:
    """`n` rows to fit on, one task a core, shared with the `beside` fits that run side by side: the few files they are stored in
    would leave a whole forest to one task, while each further task sums all nodes again. Task and place of a row follow from
    the row alone, so the same rows give the same forest again; equal rows share a task. Few rows stay as they are."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    tasks = min(math.ceil(n / ROWS_A_TASK), math.ceil(cores / beside))
    if n <= ROWS_A_TASK:
        return rows
    return rows.withColumn("__h", F.xxhash64("features", "y", "w")).repartition(tasks, "__h").sortWithinPartitions("__h").drop("__h")


def measured(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """`measure` for scores that a model has yet to give. They are stored first: the sums of a score are read twice, and rows
    without a score are left out by a filter, which would run the model three times."""
    spark = scores.sparkSession
    path = own(run_folder(spark, "ml", "notas"))
    scores.write.parquet(path)
    return measure(spark.read.parquet(path), by)


class Fitted:
    """Preparation and model together."""

    def __init__(self, preparation: Preparation, model, variables: Sequence[str]):
        self.preparation, self.model, self.variables = preparation, model, list(variables)

    def score(self, df: DataFrame, name: str = "p") -> DataFrame:
        """Rows as they came, with their score; the raw columns travel in a struct past the
        preparation, which replaces them."""
        d = df.withColumn("__row", F.struct(*df.columns))
        return score(self.model, self.preparation.transform(d), name).select("__row.*", name)


def fit(df: DataFrame, design: Design, family: str, params: dict, seed: int, path: str,
        y: str = "bateu_meta", weight: str | None = None) -> Fitted:
    """Prepare, store the prepared rows, fit on them."""
    spark, path = df.sparkSession, own(path)
    prep = Preparation(design, LINEAR[family]).fit(df).settled(spark, f"{path}/preparo")
    d = mean_one(df, weight) if weight else df.withColumn("w", F.lit(1.0))
    rows = prep.transform(d.withColumn("y", F.col(y).cast("double"))).select("features", "y", "w")
    rows.write.mode("overwrite").parquet(f"{path}/linhas")
    rows = spark.read.parquet(f"{path}/linhas")
    n = rows.count()
    model = estimator(family, params, n, seed).fit(rows if family == BOOSTING else dealt(rows, n))
    return Fitted(prep, model, design.variables)


# -- cross validation --------------------------------------------------------------------------
class Folds:
    """Grouped folds with preparation learned on the other parts, stored as one table.

    Each row appears once per part: as a row to measure in its own, as a row to train on in the
    others. Medians, scaling and weights are found per part in single passes.
    """

    def __init__(self, df: DataFrame, design: Design, linear: bool, path: str, seed: int,
                 folds: int = 5, key: str = "id_municipio", y: str = "bateu_meta",
                 weight: str | None = None, row: str = "unidade"):
        spark, path = df.sparkSession, own(path)
        self.n, self.seed = folds, seed
        d = df.join(group_folds(df, key, seed, folds), key) \
            .withColumn("parte", F.explode(F.sequence(F.lit(0), F.lit(folds - 1)))) \
            .withColumn("treina", F.col("fold") != F.col("parte"))
        d = d.withColumn("y", F.col(y).cast("double")) \
            .withColumn("peso_linha", F.col(weight).cast("double") if weight else F.lit(1.0))
        train = d.where("treina")
        self.preparation = Preparation(design, linear, ["parte"]).fit(train) \
            .settled(spark, f"{path}/preparo")
        mean = train.groupBy("parte").agg(F.avg("peso_linha").alias("__mean"))
        d = d.join(F.broadcast(mean), "parte").withColumn("w", F.col("peso_linha") / F.col("__mean"))
        keep = ["parte", "treina", "linha", "y", "w", "peso_linha", *self.preparation.columns()]
        d = d.withColumnRenamed(row, "linha")
        self.preparation.prepared(d).select(*keep).write.mode("overwrite") \
            .partitionBy("parte").parquet(f"{path}/partes")
        self.table = spark.read.parquet(f"{path}/partes")
        self.sizes = {r.parte: r.n for r in self.table.where("treina").groupBy("parte").agg(
            F.count(F.lit(1)).alias("n")).collect()}

    def part(self, k: int, train: bool, variables: Sequence[str] | None = None) -> DataFrame:
        rows = self.table.where((F.col("parte") == k) & (F.col("treina") == train))
        return self.preparation.assemble(rows, variables)


def scored_parts(folds: Folds, family: str, params: dict, tags: dict,
                 variables: Sequence[str] | None = None, pool: ThreadPoolExecutor | None = None, beside: int = 1) -> DataFrame:
    """Every row scored by the model that did not see its group; `tags` become columns. `beside` fits run side by side."""
    if family == BOOSTING:
        found = boosted_parts(folds, Params(**params), {"": variables}).drop("configuracao")
        return found.select(*[F.lit(v).alias(n) for n, v in tags.items()], "parte", "y", "w", "p")

    def one(k: int) -> DataFrame:
        rows = dealt(folds.part(k, True, variables), folds.sizes[k], beside)
        model = estimator(family, params, folds.sizes[k], folds.seed).fit(rows)
        return score(model, folds.part(k, False, variables)).select(
            *[F.lit(v).alias(n) for n, v in tags.items()], "parte", "y",
            F.col("peso_linha").alias("w"), "p")

    parts = list((pool.map if pool else map)(one, range(folds.n)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def boosted_parts(folds: Folds, params: Params, sets: dict[str, Sequence[str] | None]) -> DataFrame:
    """(configuracao, parte, y, w, p): every row scored by the boosted model of its part, for each set of variables. All
    fits of all sets grow side by side, from the rows of each part that were cut into bins once for all sets."""
    names = folds.preparation.columns()
    place = {c: i for i, c in enumerate(names)}
    rows = folds.preparation.assemble(folds.table).select("parte", "treina", "features", "y", F.col("w"), "peso_linha")
    rows = rows.withColumn("fit", F.col("parte").cast("string"))
    ready = binned(rows.where("treina")).copied({k: [f"{s}/{k}" for s in sets] for k in map(str, range(folds.n))})
    tagged = rows.where("not treina").withColumn("configuracao", F.explode(F.array(*map(F.lit, sets)))).withColumn(
        "fit", F.concat_ws("/", "configuracao", "fit"))
    only = {f"{s}/{k}": [place[c] for c in folds.preparation.columns(vs)] for s, vs in sets.items() for k in range(folds.n)}
    models = Leafwise(params).fit_binned(ready, only)
    return score_many(tagged, models).select("configuracao", "parte", "y", F.col("peso_linha").alias("w"), "p")


def compare_variables(folds: Folds, params: Params, sets: dict[str, Sequence[str]]) -> DataFrame:
    """One row per set of variables and part with AUC, log-loss and Brier of the boosted model."""
    per = measured(boosted_parts(folds, params, sets), ["configuracao", "parte"])
    sizes = per.sparkSession.createDataFrame([(s, len(vs)) for s, vs in sets.items()], "configuracao string, variaveis int")
    return per.join(F.broadcast(sizes), "configuracao")


def cross_validate(folds: Folds, family: str, params: dict, tags: dict,
                   variables: Sequence[str] | None = None) -> DataFrame:
    """One row per part with AUC, log-loss and Brier."""
    with ThreadPoolExecutor(folds.n) as pool:
        scores = scored_parts(folds, family, params, tags, variables, pool, folds.n)
    return measured(scores, [*tags, "parte"])


def permuted(place: int, size: int, seed: int) -> int:
    """Where a keyed permutation of 0..size-1 puts `place`: Feistel rounds on the two digits of the least square that
    holds `size`, repeated until the result falls inside."""
    base = math.isqrt(size - 1) + 1
    while True:
        left, right = divmod(place, base)
        for turn in range(4):
            key = hashlib.md5(f"{seed}|{turn}|{right}".encode()).hexdigest()
            left, right = right, (left + int(key, 16)) % base
        place = left * base + right
        if place < size:
            return place


def draw(space: dict, n: int, seed: int) -> list[dict]:
    """`n` different combinations of a grid, seeded; the whole grid when it is smaller.

    A combination is a number whose digits choose the values, so the grid itself is never built.
    """
    names = sorted(space)
    size = math.prod(len(space[k]) for k in names)

    def combination(number: int) -> dict:
        chosen = {}
        for k in reversed(names):
            number, digit = divmod(number, len(space[k]))
            chosen[k] = space[k][digit]
        return {k: chosen[k] for k in names}

    return [combination(i if n >= size else permuted(i, size, seed)) for i in range(min(n, size))]


def search(folds_of: dict[bool, Folds], spaces: dict = SPACES, seed: int = 42, parallelism: int = 4) -> DataFrame:
    """Random search over the families: one row per combination with fold means and deviations.
    All fits are independent; all of their scores are measured in one job."""
    jobs = [(family, params) for family, (space, n) in spaces.items() for params in draw(space, n, seed)]

    def one(job):
        family, params = job
        return scored_parts(folds_of[LINEAR[family]], family, params,
                            {"familia": family, "parametros": json.dumps(params, sort_keys=True)}, beside=parallelism)

    with ThreadPoolExecutor(parallelism) as pool:
        scores = list(pool.map(one, jobs))
    every = scores[0]
    for s in scores[1:]:
        every = every.unionByName(s)
    return summarize_folds(measured(every, ["familia", "parametros", "parte"]), ["familia", "parametros"])


# -- reading a model ---------------------------------------------------------------------------
TASKS_A_CORE = 4


def scoring_tasks(spark: SparkSession) -> int:
    """Tasks for rows that are scored many times over: few files or a small shuffle may hold hours of scoring."""
    return max(spark.sparkContext.defaultParallelism * TASKS_A_CORE, int(spark.conf.get("spark.sql.shuffle.partitions")))


def shuffled_blocks(df: DataFrame, key: str, blocks: dict[str, Sequence[str]], repeats: int,
                    seed: int, within: Sequence[str] = (), tasks: int | None = None) -> DataFrame:
    """Rows once per block and repeat, with the block's columns taken from another row.

    A repeat is one seeded hash order of the rows; each row borrows from the row ahead of it.
    The order is built bucket by bucket, and one equi-join serves all blocks of a repeat. Rows
    borrow from rows with equal values of `within`. With `tasks`, rows are dealt out to so many tasks before they meet the
    blocks.
    """
    part = ["repeticao", *within]
    columns = sorted({c for cs in blocks.values() for c in cs})
    r = df.withColumn("repeticao", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
    h = F.md5(F.concat(F.col(key), F.lit(f"|{seed}|"), F.col("repeticao").cast("string")))
    r = r.withColumn("__h", h).withColumn("__one", F.lit(1).cast("bigint"))
    r = cumulate(r, "__one", [F.substring("__h", 1, 3)], [F.col("__h"), F.col(key)], part)
    donor = r.select(*part, ((F.col(BEFORE) + 1) % F.col("cum_total")).alias(BEFORE),
                     *[F.col(c).alias(f"__d_{c}") for c in columns])
    both = r.join(sorted_side(donor), [*part, BEFORE])
    both = both.repartition(tasks) if tasks else both
    names = F.array(*[F.struct(F.lit(b).alias("bloco"), F.array(*map(F.lit, cs)).alias("__cols"))
                      for b, cs in blocks.items()])
    long = both.select("*", F.inline(names))
    swap = {c: F.when(F.array_contains("__cols", c), F.col(f"__d_{c}")).otherwise(F.col(c))
            for c in columns}
    return long.withColumns(swap).drop("__h", "__one", "__cols", BEFORE, "cum_total",
                                       *[f"__d_{c}" for c in columns])


def permutation(fitted: Fitted, test: DataFrame, blocks: dict[str, Sequence[str]], repeats: int,
                seed: int, key: str = "unidade", y: str = "bateu_meta") -> DataFrame:
    """Metrics of the whole model, and by block their mean over the shuffles and the loss."""
    rows = test.select(key, F.col(y).cast("double").alias("y"), F.lit(1.0).alias("w"),
                       *fitted.preparation.design.variables,
                       *[c for c in (fitted.preparation.group,)
                         if c not in fitted.preparation.design.variables])
    whole = measured(fitted.score(rows).select("y", "w", "p"))
    mixed = shuffled_blocks(rows, key, blocks, repeats, seed, tasks=scoring_tasks(test.sparkSession))
    each = measured(fitted.score(mixed).select("bloco", "repeticao", "y", "w", "p"), ["bloco", "repeticao"])
    mean = each.groupBy("bloco").agg(F.avg("auc").alias("auc"), F.avg("log_loss").alias("log_loss"))
    base = whole.select(F.col("auc").alias("auc_cheio"), F.col("log_loss").alias("perda_cheia"))
    return mean.transform(with_totals, base).select(
        "bloco", "auc", "log_loss", (F.col("auc_cheio") - F.col("auc")).alias("queda_auc"),
        (F.col("log_loss") - F.col("perda_cheia")).alias("piora_log_loss"), "auc_cheio", "perda_cheia")


GRID = 21


def dependence_grid(rows: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Grid of each variable per group: 21 steps from the 5th to the 95th percentile, or the
    distinct values where there are fewer."""
    long = to_long(rows, variables, ["grupo"]).where("valor is not null")
    ends = quantiles(long, "valor", {"a": .05, "b": .95}, ["grupo", "variavel"],
                     extra=[F.count(F.lit(1)).alias("distintos")])
    step = (F.col("b") - F.col("a")) / (GRID - 1)
    wide = ends.where(F.col("distintos") >= GRID).select(
        "grupo", "variavel", F.explode(F.sequence(F.lit(0), F.lit(GRID - 1))).alias("i"),
        "a", step.alias("step")).select("grupo", "variavel",
                                        (F.col("a") + F.col("i") * F.col("step")).alias("ponto"))
    few = value_counts(long, "valor", ["grupo", "variavel"]).join(
        F.broadcast(ends.where(F.col("distintos") < GRID).select("grupo", "variavel")), ["grupo", "variavel"])
    return wide.distinct().unionByName(few.select("grupo", "variavel", F.col("valor").alias("ponto")))


def partial_dependence(fitted: Fitted, rows: DataFrame, variables: Sequence[str], path: str) -> DataFrame:
    """Mean score per group, variable and grid point, with everything else left as it is.

    The grid holds at most 21 points per variable and group; it is stored, then broadcast. A few stored files hold rows
    for hours of scoring, so they are dealt out to `TASKS_A_CORE` tasks a core before each row meets the points of its group.
    A forest is walked once for all points of all variables (`dependence`); other models score each row at each point.
    """
    spark, path = rows.sparkSession, own(path)
    dependence_grid(rows, variables).write.mode("overwrite").parquet(f"{path}/grade")
    grid = spark.read.parquet(f"{path}/grade")
    needed = list(dict.fromkeys(["grupo", *fitted.preparation.design.variables, fitted.preparation.group]))
    if can_walk(fitted.model, fitted.preparation, grid.select("grupo").distinct().count()):
        trees = trees_of(fitted.model, spark, f"{path}/floresta")
        if trees:
            return forest_dependence(trees, fitted.preparation, rows.select(*needed).repartition(scoring_tasks(spark)), variables, grid)
    d = rows.repartition(scoring_tasks(spark)).join(F.broadcast(grid), "grupo")
    moved = {v: F.when(F.col("variavel") == v, F.col("ponto")).otherwise(F.col(v).cast("double"))
             for v in variables}
    names = ["grupo", "variavel", "ponto", *fitted.preparation.design.variables]
    if fitted.preparation.group not in names:
        names.append(fitted.preparation.group)
    # only the columns that are averaged go past the preparation, not the whole rows as in `Fitted.score`
    scored = score(fitted.model, fitted.preparation.transform(d.withColumns(moved).select(*names)))
    return scored.groupBy("grupo", "variavel", "ponto").agg(F.avg("p").alias("media"),
                                                            F.count(F.lit(1)).alias("linhas"))


def interpolate(curve: DataFrame, at: DataFrame, x: str, name: str) -> DataFrame:
    """Linear interpolation of each curve (at most 21 points) at `x`, flat beyond its ends.
    `at` has one row per variable."""
    w = Window.partitionBy("grupo", "variavel").orderBy("ponto")
    seg = curve.withColumns({"px": F.lead("ponto").over(w), "py": F.lead("media").over(w),
                             "before": F.lag("ponto").over(w)})
    d = seg.join(F.broadcast(at), "variavel")
    v = F.col(x)
    inside = F.col("media") + (F.col("py") - F.col("media")) * F.try_divide(
        v - F.col("ponto"), F.col("px") - F.col("ponto"))
    hit = (F.when((v >= F.col("ponto")) & (v < F.col("px")), inside)
           .when(F.col("px").isNull() & (v >= F.col("ponto")), F.col("media"))
           .when(F.col("before").isNull() & (v < F.col("ponto")), F.col("media")))
    return d.groupBy("grupo", "variavel").agg(F.max(hit).alias(name))


def factor_effects(curve: DataFrame, redes: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Points of probability between the lower and upper quartile of each variable, per group."""
    q = quantiles(to_long(redes, variables, []), "valor", {"baixo": .25, "alto": .75}, ["variavel"])
    low, high = interpolate(curve, q, "baixo", "y0"), interpolate(curve, q, "alto", "y1")
    return low.join(high, ["grupo", "variavel"]).join(q, "variavel").select(
        "grupo", "variavel", "baixo", "alto", (F.lit(100.0) * (F.col("y1") - F.col("y0"))).alias("efeito_pp"))


def factor_table(effects: DataFrame, factors: dict[str, tuple], order: dict[str, int],
                 whole: str = "amostra") -> DataFrame:
    """Effect of each lever, in how many regions it keeps its sign, and whether it goes the way
    expected; by who can move it, largest first."""
    spark = effects.sparkSession
    meta = spark.createDataFrame([(v, *f, order[f[1]]) for v, f in factors.items()],
                                 "variavel string, nome string, quem string, sinal string, ordem int")
    main = effects.where(F.col("grupo") == whole).drop("grupo")
    regional = effects.where(F.col("grupo") != whole).select(
        "variavel", F.col("efeito_pp").alias("regional"))
    agree = regional.join(main.select("variavel", "efeito_pp"), "variavel").groupBy("variavel").agg(
        F.count_if(F.signum("regional") == F.signum("efeito_pp")).alias("regioes"))
    way = F.when(F.col("efeito_pp") >= 0, "+").otherwise("-")
    verdict = F.when(F.col("sinal") == "?", "sem expectativa").when(F.col("sinal") == way, "sim").otherwise("nao")
    return (main.join(F.broadcast(meta), "variavel").join(agree, "variavel", "left")
            .withColumn("confere", verdict)
            .orderBy("ordem", F.abs("efeito_pp").desc(), "variavel")
            .select("variavel", "nome", "quem", "sinal", "baixo", "alto", "efeito_pp", "regioes", "confere"))
