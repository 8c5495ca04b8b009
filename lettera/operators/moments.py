"""Sums of products and what follows from them: correlations, inflation factors, fits.

Every statistic of a set of columns comes from one pass that leaves sums per column pair. The
sums form a table as large as the variable list squared, whatever the number of rows.
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAIR_SUMS = ["n", "sx", "sy", "sxx", "syy", "sxy"]


def pair_sums(df: DataFrame, columns: Sequence[str], weight: str | None = None) -> DataFrame:
    """Weighted sums over the rows where both columns are present, one row per ordered pair.

    A task turns its rows into p x p matrices with a few matrix products and emits those
    only; the matrices are then added up by pair.
    """
    names = list(columns)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    d = df.select(*[F.col(c).cast("double").alias(c) for c in names], w.alias("__w"))
    schema = "a string, b string, " + ", ".join(f"{s} double" for s in PAIR_SUMS)

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = len(names)
        acc = {s: np.zeros((p, p)) for s in PAIR_SUMS}
        for frame in frames:
            x = frame[names].to_numpy(dtype="float64")
            weights = frame["__w"].to_numpy(dtype="float64")[:, None]
            there = (~np.isnan(x)).astype("float64")
            x = np.nan_to_num(x, nan=0.0)
            acc["n"] += (there * weights).T @ there
            acc["sx"] += (x * weights).T @ there
            acc["sy"] += (there * weights).T @ x
            acc["sxx"] += (x * x * weights).T @ there
            acc["syy"] += (there * weights).T @ (x * x)
            acc["sxy"] += (x * weights).T @ x
        a, b = np.meshgrid(names, names, indexing="ij")
        yield pd.DataFrame({"a": a.ravel(), "b": b.ravel(),
                            **{s: m.ravel() for s, m in acc.items()}})

    return (d.mapInPandas(partial, schema).groupBy("a", "b")
            .agg(*[F.sum(s).alias(s) for s in PAIR_SUMS]))


def correlation_of(n="n", sx="sx", sy="sy", sxx="sxx", syy="syy", sxy="sxy") -> Column:
    """Pearson correlation from sums; null for a constant column."""
    c = F.col
    vx = c(sxx) - c(sx) * c(sx) / c(n)
    vy = c(syy) - c(sy) * c(sy) / c(n)
    scale = F.sqrt(F.greatest(vx, F.lit(0.0))) * F.sqrt(F.greatest(vy, F.lit(0.0)))
    flat = (vx <= F.abs(c(sxx)) * 1e-12) | (vy <= F.abs(c(syy)) * 1e-12) | (c(n) < 2)
    return F.when(~flat, F.try_divide(c(sxy) - c(sx) * c(sy) / c(n), scale))


def correlation_pairs(df: DataFrame, columns: Sequence[str], weight: str | None = None) -> DataFrame:
    return (pair_sums(df, columns, weight).where("n > 0")
            .select("a", "b", "n", correlation_of().alias("rho")))


def matrix_of(pairs: DataFrame, columns: Sequence[str], value: str = "rho") -> np.ndarray:
    """The p x p matrix on the driver; its size depends on the variable list alone."""
    place = {c: i for i, c in enumerate(columns)}
    out = np.full((len(columns), len(columns)), np.nan)
    for r in pairs.select("a", "b", value).collect():
        if r[0] in place and r[1] in place and r[2] is not None:
            out[place[r[0]], place[r[1]]] = r[2]
    return out


def response_moments(df: DataFrame, columns: Sequence[str], target: str, weight: str) -> DataFrame:
    """Correlation of each column with a response, over unit rows standing for `weight` pupils
    of whom `target` have the response 1. One JVM aggregation for all columns."""
    aggs = []
    for c in columns:
        x, w = F.col(c).cast("double"), F.when(F.col(c).isNotNull(), F.col(weight).cast("double"))
        y = F.when(F.col(c).isNotNull(), F.col(target).cast("double"))
        aggs.append(F.struct(
            F.lit(c).alias("variavel"), F.sum(w).alias("n"), F.sum(w * x).alias("sx"),
            F.sum(y).alias("sy"), F.sum(w * x * x).alias("sxx"), F.sum(y).alias("syy"),
            F.sum(y * x).alias("sxy")))
    one = df.agg(F.array(*aggs).alias("all"))
    d = one.select(F.explode("all").alias("m")).select("m.*").where("n > 0")
    return d.select("variavel", correlation_of().alias("correlacao"))
