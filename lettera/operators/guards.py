"""Data-quality guards. Each returns the violations (or a one-row verdict) as a DataFrame;
`enforce` turns a non-empty result into a stopped run."""
from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import (CONTEXT_PREFIXES, DERIVED_CONTEXT, FORBIDDEN, KNOWN_BEFORE_TEST,
                         LAG_SUFFIX)
from ..sources.lake import StopRun
from .moments import response_moments

VERDICT = "tabela string, coluna string, situacao string"


def enforce(violations: DataFrame, message: str) -> None:
    """Stop the run when there is at least one violation row; reads one row, not all."""
    first = violations.limit(1).collect()
    if first:
        raise StopRun(f"{message}: {first[0].asDict()}")


def contract(spark: SparkSession, tables: dict[str, DataFrame],
             wanted: dict[str, list[str]]) -> DataFrame:
    """One row per contract column; no data is read, only the schemas."""
    rows = [(t, c, "ok" if t in tables and c in tables[t].columns else
             ("tabela ausente" if t not in tables else "coluna ausente"))
            for t, cols in wanted.items() for c in cols]
    return spark.createDataFrame(rows, VERDICT)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once: a join on them would multiply rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("linhas")).where("linhas > 1")


def join_fanout(sources: Iterable[tuple[str, DataFrame, Sequence[str]]]) -> DataFrame:
    """Per joined source, how many keys are duplicated. The fact is never recounted."""
    out = None
    for label, df, keys in sources:
        one = duplicate_keys(df, keys).agg(
            F.count(F.lit(1)).alias("chaves_duplicadas"),
            F.coalesce(F.sum(F.col("linhas") - 1), F.lit(0)).alias("linhas_a_mais")
        ).select(F.lit(label).alias("fonte"), "chaves_duplicadas", "linhas_a_mais")
        out = one if out is None else out.unionByName(one)
    return out


def parts_sum(df: DataFrame, total: str, expected: float = 100.0, tolerance: float = 1.0) -> DataFrame:
    off = F.abs(F.col(total) - expected) > tolerance
    return df.agg(F.count(F.lit(1)).alias("linhas"), F.count(total).alias("com_valor"),
                  F.count_if(off).alias("fora"))


def key_format(df: DataFrame, key: str, pattern: str = "^[0-9]{7}$") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("linhas"),
                  F.count_if(~F.col(key).cast("string").rlike(pattern)).alias("fora_do_formato"))


def leakage(spark: SparkSession, features: Sequence[str], columns: Sequence[str],
            categorical: Sequence[str]) -> DataFrame:
    """Declared but missing, forbidden, or without a reason in time; works on metadata only."""
    allowed = {*KNOWN_BEFORE_TEST, *DERIVED_CONTEXT, *categorical}
    meta = spark.createDataFrame([(f, f in columns, f in FORBIDDEN, f in allowed) for f in features],
                                 "variavel string, na_tabela boolean, proibida boolean, "
                                 "admitida boolean")
    prefix = F.lit(False)
    for p in CONTEXT_PREFIXES:
        prefix = prefix | F.col("variavel").startswith(p)
    justified = F.col("variavel").endswith(LAG_SUFFIX) | prefix | F.col("admitida")
    verdict = (F.when(~F.col("na_tabela"), "declarada mas ausente").when(F.col("proibida"), "proibida")
               .when(~justified, "sem justificativa temporal").otherwise("ok"))
    return meta.select("variavel", verdict.alias("situacao"))


def constants(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns with at most one non-null value. Least and greatest value settle it in one
    aggregation that keeps two values per column, where a distinct count would keep them all."""
    lows = [F.min(c).alias(f"lo_{c}") for c in columns]
    highs = [F.max(c).alias(f"hi_{c}") for c in columns]
    one = df.agg(*lows, *highs)
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("variavel"),
                 F.coalesce(F.col(f"lo_{c}") == F.col(f"hi_{c}"), F.lit(True)).alias("constante"))
        for c in columns]))
    return one.select(pairs.alias("x")).select("x.*")


def target_correlation(df: DataFrame, columns: Sequence[str], target: str, weight: str,
                       limit: float = 0.9) -> DataFrame:
    """Pearson correlation of every column with the response, flagged above `limit`."""
    r = response_moments(df, columns, target, weight)
    return r.withColumn("extrema", F.coalesce(F.abs("correlacao") > limit, F.lit(False)))


def split_integrity(df: DataFrame, key: str, part: str = "particao") -> DataFrame:
    """Keys that appear in more than one part: two hash aggregations, the first map-side."""
    return (df.groupBy(key, part).agg(F.count(F.lit(1)).alias("linhas"))
            .groupBy(key).agg(F.count(part).alias("particoes")).where("particoes > 1"))


def uneven_groups(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Groups whose rows do not all have one fingerprint: two numbers per group, whatever the columns. Equal rows have
    equal fingerprints; different ones share theirs with probability 2^-64."""
    row = F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])     # the hash itself skips nulls
    return (df.groupBy(*keys).agg(F.min(row).alias("__lo"), F.max(row).alias("__hi"))
            .where("__lo <> __hi").select(*keys))


def group_invariance(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per column, the groups inside which it varies; a null counts as a value of its own.

    Only groups with different row fingerprints are opened, and none are as a rule.
    """
    uneven = uneven_groups(df, keys, columns)
    if uneven.isEmpty():
        return df.sparkSession.createDataFrame([(c, 0) for c in columns], "variavel string, grupos_que_variam bigint")
    uneven = uneven.toDF(*[f"__{k}" for k in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return varying_groups(df.join(uneven, same, "left_semi"), keys, columns)


def varying_groups(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per column, the groups inside which it varies.

    Text columns group along in the first step, which keeps it a hash aggregation with partial
    sums before the shuffle; the second step sees one row per group and text combination.
    """
    kinds = dict(df.dtypes)
    texts = [c for c in columns if kinds[c] == "string"]
    numbers = [c for c in columns if c not in texts]
    first: list[Column] = [F.count(F.lit(1)).alias("__n")]
    for c in numbers:
        first += [F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"), F.count(c).alias(f"n_{c}")]
    g = df.groupBy(*keys, *texts).agg(*first)
    second: list[Column] = [F.sum("__n").alias("__n")]
    for c in numbers:
        second += [F.min(f"lo_{c}").alias(f"lo_{c}"), F.max(f"hi_{c}").alias(f"hi_{c}"),
                   F.sum(f"n_{c}").alias(f"n_{c}")]
    for c in texts:
        second += [F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"),
                   F.sum(F.when(F.col(c).isNotNull(), F.col("__n")).otherwise(0)).alias(f"n_{c}")]
    g = g.groupBy(*keys).agg(*second)
    varies = [F.sum(F.when((F.col(f"lo_{c}") != F.col(f"hi_{c}"))
                           | ((F.col(f"n_{c}") > 0) & (F.col(f"n_{c}") < F.col("__n"))), 1)
                    .otherwise(0)).alias(c) for c in columns]
    one = g.agg(*varies)
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("variavel"),
                                         F.coalesce(F.col(c), F.lit(0)).alias("grupos_que_variam"))
                                for c in columns]))
    return one.select(pairs.alias("x")).select("x.*")


def aggregation_preserves(before: DataFrame, after: DataFrame, key: str = "particao",
                          tolerance: float = 1e-8) -> DataFrame:
    """Row count and rate per part before and after compression into weighted rows.
    `before` has `alvo`; `after` has `alvo` and `peso`."""
    b = before.groupBy(key).agg(F.count(F.lit(1)).alias("alunos"), F.sum("alvo").alias("sim"))
    a = after.groupBy(key).agg(F.sum("peso").alias("alunos_agrupados"),
                               F.sum(F.col("peso") * F.col("alvo")).alias("sim_agrupados"))
    rate = F.col("sim") / F.col("alunos")
    rate_after = F.col("sim_agrupados") / F.col("alunos_agrupados")
    return b.join(a, key, "full_outer").select(
        key, "alunos", "alunos_agrupados", rate.alias("taxa"), rate_after.alias("taxa_agrupada"),
        (F.coalesce(F.col("alunos") == F.col("alunos_agrupados"), F.lit(False))
         & F.coalesce(F.abs(rate - rate_after) <= tolerance, F.lit(False))).alias("preserva"))


def empty_cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Empty cells over all the columns together; sums are kept per column, then added."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    total = sum((F.col(c) for c in columns), F.lit(0))
    return one.select(total.alias("celulas_vazias"))


def dictionary_gaps(table_columns: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Columns without a description, descriptions without a column, variables without a
    hypothesis. Both inputs have one row per variable."""
    missing = table_columns.join(dictionary, "variavel", "left_anti").select(
        "variavel", F.lit("sem descricao").alias("problema"))
    orphan = dictionary.join(table_columns, "variavel", "left_anti").select(
        "variavel", F.lit("sem coluna").alias("problema"))
    no_hypothesis = dictionary.where("hipotese is null").select(
        "variavel", F.lit("sem hipotese").alias("problema"))
    return missing.unionByName(orphan).unionByName(no_hypothesis)


def lookup_gaps(df: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Keys of `df` that the lookup does not know."""
    return df.join(lookup, key, "left_anti").select(key).distinct()


def decisions(lista: DataFrame, features: DataFrame, groups: DataFrame, indicators: DataFrame,
              themes: DataFrame) -> DataFrame:
    """Problems in the variable decisions: none or more than one decision, a representative
    outside its group, an indicator on a variable that left, a theme variable in no or two
    themes. All inputs are metadata tables with a `variavel` column."""
    tag = lambda df, text: df.select("variavel", F.lit(text).alias("problema"))
    repeated = lista.groupBy("variavel").count().where("count > 1")
    kept = lista.where("situacao = 'entra'")
    stray = groups.where(~F.expr("array_contains(membros, variavel)"))
    twice = themes.groupBy("variavel").count().where("count > 1")
    return (tag(features.join(lista, "variavel", "left_anti"), "sem decisao")
            .unionByName(tag(lista.join(features, "variavel", "left_anti"), "decisao sem variavel"))
            .unionByName(tag(repeated, "mais de uma decisao"))
            .unionByName(tag(stray, "representante fora do grupo"))
            .unionByName(tag(indicators.join(kept, "variavel", "left_anti"),
                             "indicador sobre variavel que saiu"))
            .unionByName(tag(twice, "em mais de um tema"))
            .unionByName(tag(kept.join(themes, "variavel", "left_anti"), "sem tema")))


def not_null(df: DataFrame, columns: Sequence[str], weight: str | None = None) -> DataFrame:
    w = F.col(weight) if weight else F.lit(1)
    one = df.agg(*[F.coalesce(F.sum(F.when(F.col(c).isNull(), w)), F.lit(0)).cast("bigint").alias(c)
                   for c in columns])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("coluna"), F.col(c).alias("vazias"))
                                for c in columns]))
    return one.select(pairs.alias("x")).select("x.*")


def match_rate(keys: DataFrame, base: DataFrame, key: str, minimum: float = 0.5) -> DataFrame:
    """Share of reference keys that the base knows."""
    known = base.select(key).distinct().withColumn("__hit", F.lit(1))
    return (keys.join(known, key, "left")
            .agg(F.count(F.lit(1)).alias("contornos"), F.count("__hit").alias("casados"))
            .withColumn("taxa", F.col("casados") / F.col("contornos"))
            .withColumn("suficiente", F.col("taxa") >= minimum))
