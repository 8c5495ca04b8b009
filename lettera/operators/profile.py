"""Profiles of many columns at once.

The input is the unit table in long form: one row per unit and variable, standing for `alunos`
pupils. All positions, spreads and shares of a variable come from its counted values, so the
raw rows are shuffled once, already summed.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import histogram_bin, ratio, with_totals
from .ordering import cumulated_counts, quantile_columns, value_counts
from .prepare import to_long

VAR, VAL = "variavel", "valor"
QUARTILES = {"q1": .25, "mediana": .5, "q3": .75}


def numeric_summary(long: DataFrame, probs: dict[str, float], weight: str | None = "alunos",
                    by: Sequence[str] = (VAR,)) -> DataFrame:
    """n, distinct, mean, sample deviation, extremes, share of zeros and exact percentiles."""
    cum = cumulated_counts(long, VAL, by, weight)
    v, n = F.col(VAL), F.col("n")
    first = cum.groupBy(*by).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("distintos"),
        (F.sum(v * n) / F.sum("n")).alias("media"), F.min(v).alias("minimo"),
        F.max(v).alias("maximo"),
        F.coalesce(F.sum(F.when(v == 0, n)), F.lit(0)).alias("zeros"),
        *quantile_columns(VAL, probs))
    return spread(long, first, weight, by)


def spread(long: DataFrame, stats: DataFrame, weight: str | None, by: Sequence[str]) -> DataFrame:
    """Second pass: central sums around the mean; adds `desvio`, `m2`, `m3`, `m4`."""
    counts = value_counts(long, VAL, by, weight)
    mean = stats.select(*by, F.col("media").alias("__m"))
    d = F.col(VAL) - F.col("__m")
    central = counts.join(F.broadcast(mean), list(by)).groupBy(*by).agg(
        *[F.sum(F.col("n") * F.pow(d, F.lit(float(k)))).alias(f"m{k}") for k in (2, 3, 4)])
    return stats.join(central, list(by)).withColumn(
        "desvio", F.sqrt(F.try_divide(F.col("m2"), (F.col("n") - 1).cast("double"))))


def total_rows(df: DataFrame, weight: str) -> DataFrame:
    return df.agg(F.sum(weight).alias("__rows"))


def column_profile(units: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                   weight: str = "alunos") -> DataFrame:
    """Type, fill, distinct values, spread and alerts of every column."""
    long = to_long(units, numeric, [weight])
    stats = numeric_summary(long, {"mediana": .5}, weight)
    texts = units.select(weight, F.inline(F.array(*[
        F.struct(F.lit(c).alias(VAR), F.col(c).alias("__t")) for c in categorical])))
    cat = value_counts(texts, "__t", [VAR], weight).groupBy(VAR).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("distintos"))
    types = units.sparkSession.createDataFrame(
        [(c, t) for c, t in units.dtypes if c in {*numeric, *categorical}],
        f"{VAR} string, tipo string")
    found = stats.drop("m2", "m3", "m4").unionByName(cat, allowMissingColumns=True)
    d = (F.broadcast(types).join(found, VAR, "left")
         .transform(with_totals, total_rows(units, weight)))
    fill = F.lit(100.0) * F.coalesce("n", F.lit(0)) / F.col("__rows")
    distinct = F.coalesce("distintos", F.lit(0))
    zero = F.lit(100.0) * F.col("zeros") / F.col("n")
    alert = F.concat(F.when(distinct <= 1, "sem variação; ").otherwise(""),
                     F.when(fill < 80, "cobertura baixa; ").otherwise(""),
                     F.when(F.coalesce(zero, F.lit(0.0)) > 90, "quase tudo zero; ").otherwise(""))
    return d.select(VAR, "tipo", fill.alias("preenchido_pct"), distinct.alias("distintos"),
                    "media", "desvio", "minimo", "mediana", "maximo", zero.alias("zeros_pct"),
                    alert.alias("alerta"))


def numeric_description(units: DataFrame, numeric: Sequence[str], weight: str = "alunos") -> DataFrame:
    s = numeric_summary(to_long(units, numeric, [weight]),
                        {**QUARTILES, "p01": .01, "p99": .99}, weight)
    cv = F.when((F.col("minimo") >= 0) & (F.col("media") > 0), F.col("desvio") / F.col("media"))
    return s.select(VAR, "n", "media", "mediana", "desvio", (F.col("q3") - F.col("q1"))
                    .alias("amplitude_iq"), cv.alias("coef_variacao"),
                    (F.col("media") - F.col("mediana")).alias("media_menos_mediana"),
                    "minimo", "p01", "p99", "maximo")


def scale_concentration(units: DataFrame, numeric: Sequence[str], weight: str = "alunos",
                        min_rows: int = 100) -> DataFrame:
    """Share of the rows in the top and bottom tenth of each variable's range."""
    counts = value_counts(to_long(units, numeric, [weight]), VAL, [VAR], weight)
    ends = counts.groupBy(VAR).agg(F.min(VAL).alias("lo"), F.max(VAL).alias("hi"),
                                   F.sum("n").alias("total"), F.count(F.lit(1)).alias("valores_distintos"))
    ends = ends.where((F.col("total") >= min_rows) & (F.col("valores_distintos") >= 3))
    span = F.col("hi") - F.col("lo")
    share = lambda cond: F.lit(100.0) * F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)) / F.sum("n")
    return (counts.join(F.broadcast(ends), VAR).groupBy(VAR, "valores_distintos").agg(
        share(F.col(VAL) >= F.col("lo") + F.lit(.9) * span).alias("no_topo_da_escala_pct"),
        share(F.col(VAL) <= F.col("lo") + F.lit(.1) * span).alias("na_base_da_escala_pct")))


def category_counts(units: DataFrame, categorical: Sequence[str], weight: str = "alunos",
                    target: str = "alfabetizados") -> DataFrame:
    """Rows and response per category; a missing category is a category of its own."""
    d = units.select(weight, target, F.inline(F.array(*[
        F.struct(F.lit(c).alias(VAR), F.col(c).alias("categoria")) for c in categorical])))
    return d.groupBy(VAR, "categoria").agg(F.sum(weight).alias("n"), F.sum(target).alias("sim"))


def categorical_profile(units: DataFrame, categorical: Sequence[str], weight: str = "alunos") -> DataFrame:
    counts = category_counts(units, categorical, weight).transform(with_totals, total_rows(units, weight))
    mode = F.min_by("categoria", F.struct(-F.col("n"), F.col("categoria")))
    return counts.groupBy(VAR).agg(
        F.count("categoria").alias("categorias"),
        (F.lit(100.0) * F.coalesce(F.sum(F.when(F.col("categoria").isNotNull(), F.col("n"))), F.lit(0))
         / F.max("__rows")).alias("preenchido_pct"),
        mode.alias("categoria_mais_comum"),
        (F.lit(100.0) * F.max("n") / F.max("__rows")).alias("frequencia_da_maior_pct"),
        F.min("n").alias("menor_categoria_n"),
        F.count_if(F.col("n") / F.col("__rows") < .01).alias("categorias_abaixo_de_1pct"))


def rare_categories(units: DataFrame, categorical: Sequence[str], limit: int,
                    weight: str = "alunos") -> DataFrame:
    """Categories with fewer than `limit` rows, their share and response rate."""
    return (category_counts(units, categorical, weight)
            .transform(with_totals, total_rows(units, weight)).where(F.col("n") < limit)
            .select(VAR, "categoria", "n", (F.lit(100.0) * F.col("n") / F.col("__rows")).alias("pct"),
                    (F.lit(100.0) * F.col("sim") / F.col("n")).alias("taxa")))


def shape_diagnostics(units: DataFrame, numeric: Sequence[str], weight: str = "alunos",
                      min_rows: int = 100) -> DataFrame:
    """Bias-corrected skewness and kurtosis, share outside Tukey's fences, suggested transform."""
    long = to_long(units, numeric, [weight])
    s = numeric_summary(long, {**QUARTILES, "p99": .99}, weight)
    s = s.where((F.col("n") >= min_rows) & (F.col("distintos") >= 3))
    n = F.col("n").cast("double")
    var = F.col("m2") / n
    g1 = (F.col("m3") / n) / F.pow(var, F.lit(1.5))
    g2 = (F.col("m4") / n) / (var * var) - 3
    skew = g1 * F.sqrt(n * (n - 1)) / (n - 2)
    kurt = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)
    iqr = F.col("q3") - F.col("q1")
    s = s.withColumns({"iqr": iqr, "assimetria": skew, "curtose": kurt})
    counts = value_counts(long, VAL, [VAR], weight)
    outside = ((F.col(VAL) < F.col("q1") - F.lit(1.5) * F.col("iqr"))
               | (F.col(VAL) > F.col("q3") + F.lit(1.5) * F.col("iqr"))) & (F.col("iqr") > 0)
    out = counts.withColumnRenamed("n", "w").join(F.broadcast(s.select(VAR, "q1", "q3", "iqr")), VAR) \
        .groupBy(VAR).agg((F.lit(100.0) * F.coalesce(F.sum(F.when(outside, F.col("w"))), F.lit(0))
                           / F.sum("w")).alias("fora_de_tukey_pct"))
    size = F.abs(F.round("assimetria", 2))
    hint = F.when(size > 2, "logarítmica ou quantílica").when(size > 1, "avaliar").otherwise("nenhuma")
    return s.join(out, VAR).select(
        VAR, "assimetria", "curtose", "fora_de_tukey_pct",
        F.when(F.col("mediana") > 0, F.col("p99") / F.col("mediana")).alias("razao_p99_mediana"),
        hint.alias("transformacao_sugerida"))


# -- missing values ---------------------------------------------------------------------------
def missing_summary(units: DataFrame, columns: Sequence[str], weight: str = "alunos") -> DataFrame:
    """Variables with missing values: how many rows and what share."""
    one = units.agg(F.sum(weight).alias("__rows"), *[
        F.coalesce(F.sum(F.when(F.col(c).isNull(), F.col(weight))), F.lit(0)).alias(c)
        for c in columns])
    pairs = F.inline(F.array(*[F.struct(F.lit(c).alias(VAR), F.col(c).alias("ausentes"))
                               for c in columns]))
    return one.select("__rows", pairs).where("ausentes > 0").select(
        VAR, "ausentes", (F.lit(100.0) * F.col("ausentes") / F.col("__rows")).alias("pct"))


def missing_patterns(units: DataFrame, columns: Sequence[str], weight: str = "alunos") -> DataFrame:
    """Which variables are missing together: one row per combination."""
    flags = F.concat(*[F.when(F.col(c).isNull(), "X").otherwise(".") for c in columns])
    return (units.select(flags.alias("padrao"), weight).groupBy("padrao")
            .agg(F.sum(weight).alias("linhas"))
            .transform(with_totals, total_rows(units, weight))
            .select("padrao", "linhas", (F.lit(100.0) * F.col("linhas") / F.col("__rows")).alias("pct"),
                    F.regexp_count("padrao", F.lit("X")).alias("variaveis_ausentes")))


def imputation_reach(units: DataFrame, group: str, history: str, weight: str = "alunos") -> DataFrame:
    """Rows by missing group and missing history: where a group median can be used."""
    return (units.groupBy(F.col(group).isNull().alias("sem_grupo"),
                          F.col(history).isNull().alias("sem_historico"))
            .agg(F.sum(weight).alias("linhas")))


def missing_gap(units: DataFrame, columns: Sequence[str], weight: str = "alunos",
                target: str = "alfabetizados") -> DataFrame:
    """Response of the rows without a value against the rows with one."""
    d = units.select(weight, target, F.inline(F.array(*[
        F.struct(F.lit(c).alias(VAR), F.col(c).isNull().alias("falta")) for c in columns])))
    rate = lambda f: F.lit(100.0) * ratio(F.sum(F.when(f, F.col(target))), F.sum(F.when(f, F.col(weight))))
    gone, there = rate(F.col("falta")), rate(~F.col("falta"))
    return (d.groupBy(VAR).agg(gone.alias("taxa_ausente"), there.alias("taxa_presente"))
            .where("taxa_ausente is not null and taxa_presente is not null")
            .withColumn("diferenca", F.col("taxa_ausente") - F.col("taxa_presente")))


def block_coverage(units: DataFrame, blocks: dict[str, str], weight: str = "alunos") -> DataFrame:
    d = units.select(weight, F.inline(F.array(*[
        F.struct(F.lit(b).alias("bloco"), F.col(c).isNotNull().alias("tem"))
        for b, c in blocks.items()])))
    filled = F.coalesce(F.sum(F.when(F.col("tem"), F.col(weight))), F.lit(0))
    return d.groupBy("bloco").agg(filled.alias("alunos"), (filled / F.sum(weight)).alias("cobertura"))


def variable_histogram(units: DataFrame, numeric: Sequence[str], bins: int = 40,
                       weight: str = "alunos") -> DataFrame:
    """Equal-width histogram per variable between its own extremes, last bin closed."""
    counts = value_counts(to_long(units, numeric, [weight]), VAL, [VAR], weight)
    ends = counts.groupBy(VAR).agg(F.min(VAL).alias("lo"), F.max(VAL).alias("hi")).where("hi > lo")
    d = counts.join(F.broadcast(ends), VAR)
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    return (d.withColumn("faixa", histogram_bin(VAL, F.col("lo"), width, bins))
            .groupBy(VAR, "faixa").agg(F.sum("n").alias("linhas")))


# -- groups -----------------------------------------------------------------------------------
def by_place(units: DataFrame) -> DataFrame:
    """Municipalities: territory, pupils, rate, agreed target and previous rate. The territory
    follows from the municipality, so it groups along; the last two are the same in every
    network of a municipality, so their maximum is their value."""
    return units.groupBy("id_municipio", "sigla_uf", "nome_regiao").agg(
        F.sum("alunos").alias("alunos"), F.sum("alfabetizados").alias("alfabetizados"),
        (F.lit(100.0) * F.sum("alfabetizados") / F.sum("alunos")).alias("taxa"),
        F.max("mun_meta_ciclo").alias("meta"), F.max("mun_taxa_ant").alias("taxa_2023"))


def describe(df: DataFrame, value: str, by: str, total: str, key: str) -> DataFrame:
    """Descriptive block per group, and one row for all groups together named `total`."""
    long = df.select(F.col(by).alias("grupo"), F.col(value).alias(VAL))
    both = long.unionByName(long.withColumn("grupo", F.lit(total)))
    s = numeric_summary(both, QUARTILES, None, ["grupo"])
    return s.select(F.col("grupo").alias(key), F.col("n").alias("municipios"), "media", "desvio",
                    "minimo", "q1", "mediana", "q3", "maximo",
                    F.try_divide("desvio", "media").alias("coef_variacao"))


def pooled_vs_mean(units: DataFrame, places: DataFrame, by: str, min_rows: int) -> DataFrame:
    """Rate over pupils against the mean of the municipal rates, and the gap between them."""
    pooled = units.groupBy(by).agg(
        F.sum("alunos").alias("alunos"),
        (F.lit(100.0) * F.sum("alfabetizados") / F.sum("alunos")).alias("taxa_entre_alunos"))
    means = places.where(F.col("alunos") >= min_rows).groupBy(by).agg(
        F.count(F.lit(1)).alias("municipios"), F.avg("taxa").alias("media_das_taxas_municipais"))
    return pooled.join(means, by, "left").withColumn(
        "efeito_do_peso", F.col("taxa_entre_alunos") - F.col("media_das_taxas_municipais"))


def share(cond: Column) -> Column:
    return F.lit(100.0) * F.avg(cond.cast("double"))


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Top `n` rows: each task keeps its own best, only those are merged."""
    return df.orderBy(*order).limit(n)
