"""Lossless compression of pupils and the preparation steps that are learned on train only."""
from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import with_totals
from .ordering import quantiles


def weighted_groups(units: DataFrame) -> DataFrame:
    """Two weighted rows per unit: `alvo` 1 with the pupils who reached it, 0 with the others.
    A class without pupils has no row. The model sees the same information in far fewer rows."""
    yes = units.withColumn("alvo", F.lit(1)).withColumn("peso", F.col("alfabetizados"))
    no = units.withColumn("alvo", F.lit(0)).withColumn("peso", F.col("alunos") - F.col("alfabetizados"))
    return yes.unionByName(no).where("peso > 0")


def missing_indicators(df: DataFrame, indicators: dict[str, str]) -> DataFrame:
    """0/1 columns made before imputation, which would erase the signal."""
    return df.withColumns({n: F.col(v).isNull().cast("int") for n, v in indicators.items()})


def to_long(df: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row per row and column, as (variavel, valor); one pass, no shuffle."""
    pairs = F.array(*[F.struct(F.lit(c).alias("variavel"), F.col(c).cast("double").alias("valor"))
                      for c in columns])
    return df.select(*keep, F.inline(pairs))


class GroupMedianImputer:
    """Median of the group with the overall median behind it, both learned on train.

    The fitted medians are tables, one row per group, so a model can be stored and applied to
    any number of rows with one join. With `by`, medians are learned for each of its values on
    its own, as for the parts of a cross validation, in the same single pass.
    """

    def __init__(self, columns: Sequence[str], group: str = "sigla_uf", by: Sequence[str] = ()):
        self.columns, self.group, self.by = list(columns), group, list(by)
        self.by_group: DataFrame | None = None
        self.overall: DataFrame | None = None

    def _wide(self, medians: DataFrame, keys: list[str], prefix: str) -> DataFrame:
        picks = [F.max(F.when(F.col("variavel") == c, F.col("m"))).alias(prefix + c)
                 for c in self.columns]
        return medians.groupBy(*keys).agg(*picks)

    def fit(self, train: DataFrame, weight: str | None = None) -> "GroupMedianImputer":
        keep = [*self.by, self.group] + ([weight] if weight else [])
        long = to_long(train, self.columns, keep).where("valor is not null")
        grouped = long.where(F.col(self.group).isNotNull())
        keys = [*self.by, self.group]
        self.by_group = self._wide(
            quantiles(grouped, "valor", {"m": .5}, [*keys, "variavel"], weight), keys, "g_")
        self.overall = self._wide(
            quantiles(long, "valor", {"m": .5}, [*self.by, "variavel"], weight), self.by, "o_")
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        d = df.join(self.by_group, [*self.by, self.group], "left")
        # one row per part of the cross validation, or one row in all
        d = d.join(F.broadcast(self.overall), self.by, "left") if self.by else \
            d.transform(with_totals, self.overall)
        filled = {c: F.coalesce(F.col(c).cast("double"), F.col("g_" + c), F.col("o_" + c))
                  for c in self.columns}
        return d.withColumns(filled).drop(*[p + c for c in self.columns for p in ("g_", "o_")])


def one_hot(df: DataFrame, column: str, levels: Sequence[str]) -> DataFrame:
    """0/1 column per level seen in train; an unseen or missing level is all zeros."""
    return df.withColumns({f"{column}_{v}": F.coalesce(F.col(column) == F.lit(v), F.lit(False))
                          .cast("int") for v in levels})


MAX_LEVELS = 1000


def levels_of(train: DataFrame, column: str) -> list[str]:
    """Sorted levels of a categorical column. They become model columns, so a column with more
    than `MAX_LEVELS` of them (a key, not a category) is refused, not truncated."""
    levels = train.where(F.col(column).isNotNull()).select(column).distinct()
    found = sorted(r[0] for r in levels.limit(MAX_LEVELS + 1).collect())
    if len(found) > MAX_LEVELS:
        raise ValueError(f"{column} has more than {MAX_LEVELS} levels and cannot be one-hot encoded")
    return found


def scaling_of(train: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean and population deviation per column (0 deviation becomes 1): one row, or one per
    value of `by`."""
    aggs = []
    for c in columns:
        spread = F.stddev_pop(c)
        aggs += [F.avg(c).alias(f"mean_{c}"),
                 F.when(spread > 0, spread).otherwise(F.lit(1.0)).alias(f"sd_{c}")]
    return train.groupBy(*by).agg(*aggs)


def standardize(df: DataFrame, scaling: DataFrame, columns: Sequence[str],
                by: Sequence[str] = ()) -> DataFrame:
    d = df.join(F.broadcast(scaling), list(by), "left") if by else df.transform(with_totals, scaling)
    return d.withColumns({c: (F.col(c) - F.col(f"mean_{c}")) / F.col(f"sd_{c}") for c in columns}) \
            .drop(*[f"{k}_{c}" for c in columns for k in ("mean", "sd")])


def zscore(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Standard scores with the sample deviation, for comparing shapes; 0 without spread."""
    stats = df.agg(*[e for c in columns for e in (F.avg(c).alias(f"mean_{c}"),
                                                  F.stddev_samp(c).alias(f"sd_{c}"))])
    d = df.transform(with_totals, stats)
    score = lambda c: F.when(F.col(f"sd_{c}") > 0, (F.col(c) - F.col(f"mean_{c}")) / F.col(f"sd_{c}")) \
        .otherwise(F.col(c) * 0)
    return d.withColumns({c: score(c) for c in columns}) \
            .drop(*[f"{k}_{c}" for c in columns for k in ("mean", "sd")])


def log1p(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.log1p(F.col(c)) for c in columns})


@dataclass
class Design:
    """Which columns enter a model and how each is prepared."""
    numeric: list[str]
    categorical: list[str]
    indicators: dict[str, str] = field(default_factory=dict)
    logged: list[str] = field(default_factory=list)

    def only(self, variables: Sequence[str]) -> "Design":
        keep = set(variables)
        return Design([v for v in self.numeric if v in keep],
                      [v for v in self.categorical if v in keep],
                      {n: v for n, v in self.indicators.items() if v in keep},
                      [v for v in self.logged if v in keep])

    @property
    def variables(self) -> list[str]:
        return self.numeric + self.categorical


class Preparation:
    """Indicators, group-median imputation, one-hot, and for linear models log and scaling.

    `lineage` maps every variable to the prepared columns that come from it, so that a variable
    can be shuffled or left out with all of its columns and no other's.
    """

    def __init__(self, design: Design, linear: bool, by: Sequence[str] = (), group: str = "sigla_uf"):
        self.design, self.linear, self.by, self.group = design, linear, list(by), group
        self.imputer = GroupMedianImputer(design.numeric, group, by)
        self.levels: dict[str, list[str]] = {}
        self.scaling: DataFrame | None = None
        self.train: DataFrame | None = None

    @property
    def lineage(self) -> dict[str, list[str]]:
        out = {v: [v] for v in self.design.numeric}
        for name, v in self.design.indicators.items():
            out[v].append(name)
        out.update({c: [f"{c}__{i}" for i in range(len(self.levels[c]))]
                    for c in self.design.categorical})
        return out

    def columns(self, variables: Sequence[str] | None = None) -> list[str]:
        keep = set(variables or self.design.variables)
        return [c for v, cs in self.lineage.items() if v in keep for c in cs]

    def fit(self, train: DataFrame) -> "Preparation":
        self.levels = {c: levels_of(train, c) for c in self.design.categorical}
        if self.design.numeric:
            self.imputer.fit(train)
        self.train = train
        if self.linear:
            self.scaling = self._scaling()
        return self

    def _scaling(self) -> DataFrame:
        return scaling_of(self._filled(self.train), self.design.numeric + list(self.design.indicators), self.by)

    def _filled(self, df: DataFrame) -> DataFrame:
        d = missing_indicators(df, self.design.indicators) if self.design.indicators else df
        d = self.imputer.transform(d) if self.design.numeric else d
        return log1p(d, self.design.logged) if self.linear and self.design.logged else d

    def prepared(self, df: DataFrame) -> DataFrame:
        """Prepared columns next to the rows; the raw columns they replace are gone."""
        hot = {f"{c}__{i}": F.coalesce(F.col(c) == F.lit(v), F.lit(False)).cast("double")
               for c, levels in self.levels.items() for i, v in enumerate(levels)}
        d = df.withColumns(hot) if hot else df
        d = self._filled(d)
        if self.linear:
            d = standardize(d, self.scaling, self.design.numeric + list(self.design.indicators), self.by)
        return d

    def assemble(self, prepared: DataFrame, variables: Sequence[str] | None = None) -> DataFrame:
        return VectorAssembler(inputCols=self.columns(variables), outputCol="features").transform(prepared)

    def transform(self, df: DataFrame) -> DataFrame:
        return self.assemble(self.prepared(df))

    def save(self, path: str) -> None:
        """Medians and scaling as tables, the rest as one JSON line."""
        spark = self.imputer.by_group.sparkSession
        self.imputer.by_group.write.mode("overwrite").parquet(f"{path}/medianas_grupo")
        self.imputer.overall.write.mode("overwrite").parquet(f"{path}/medianas")
        if self.linear:
            if self.train is not None and self.design.numeric:      # the scaling reads the stored medians, and doesn't find them again
                self.imputer.by_group = spark.read.parquet(f"{path}/medianas_grupo")
                self.imputer.overall = spark.read.parquet(f"{path}/medianas")
                self.scaling = self._scaling()
            self.scaling.write.mode("overwrite").parquet(f"{path}/escala")
        recipe = {"numeric": self.design.numeric, "categorical": self.design.categorical,
                  "indicators": self.design.indicators, "logged": self.design.logged,
                  "linear": self.linear, "by": self.by, "group": self.group, "levels": self.levels}
        spark.createDataFrame([(json.dumps(recipe, ensure_ascii=False),)], "value string") \
            .coalesce(1).write.mode("overwrite").text(f"{path}/receita")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Preparation":
        r = json.loads(spark.read.text(f"{path}/receita").head()[0])
        out = cls(Design(r["numeric"], r["categorical"], r["indicators"], r["logged"]), r["linear"],
                  r["by"], r["group"])
        out.levels = r["levels"]
        out.imputer.by_group = spark.read.parquet(f"{path}/medianas_grupo")
        out.imputer.overall = spark.read.parquet(f"{path}/medianas")
        out.scaling = spark.read.parquet(f"{path}/escala") if out.linear else None
        return out

    def settled(self, spark: SparkSession, path: str) -> "Preparation":
        """Store what was learned and go on from the stored tables: the plans that use it stay
        short, and a lost executor does not mean learning it again."""
        self.save(path)
        return Preparation.load(spark, path)
