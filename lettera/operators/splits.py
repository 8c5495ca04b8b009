"""Seeded splits by group. A group never lands in two parts, and the same key, seed and set of
groups always give the same answer, whatever the partitioning of the data."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import TEST, TRAIN, VALID
from ..functions.exprs import hash_text
from .ordering import hash_positions, whole_div


def split_by_group(df: DataFrame, key: str, seed: int) -> DataFrame:
    """One row per group with its part: 60% of the groups train, half of the rest validation."""
    pos = hash_positions(df, key, seed)
    total = F.col("cum_total")
    train = whole_div(total * F.lit(6), F.lit(10))
    valid = whole_div(total - train, F.lit(2))
    part = (F.when(F.col("pos") <= train, TRAIN).when(F.col("pos") <= train + valid, VALID)
            .otherwise(TEST))
    return pos.select(key, part.alias("particao"))


def group_folds(df: DataFrame, key: str, seed: int, folds: int) -> DataFrame:
    """One row per group with its fold (0-based); fold sizes differ by at most one group."""
    return hash_positions(df, key, f"fold{seed}").select(
        key, ((F.col("pos") - 1) % folds).cast("int").alias("fold"))


PREFIX = 4      # hexadecimal digits: at most 65,536 buckets


def sample_rows(df: DataFrame, key: str, seed: int, n: int) -> DataFrame:
    """Exactly `n` rows (all, if there are fewer), those with the smallest seeded hash of `key`, which names a row.

    The hash threshold comes from row counts by hash prefix. Rows below it are taken where they lie; only the rows
    of the one prefix that the threshold cuts are put in order.
    """
    d = df.withColumn("__h", F.coalesce(hash_text(key, f"amostra{seed}"), F.lit(""))) \
          .withColumn("__b", F.substring("__h", 1, PREFIX))
    counts = d.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))
    ahead = Window.partitionBy(F.lit(0)).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    wanted = counts.withColumn("__left", F.lit(n) - F.coalesce(F.sum("__n").over(ahead), F.lit(0))).where("__left > 0")
    d = d.join(F.broadcast(wanted), "__b")      # at most 65,536 rows
    place = F.row_number().over(Window.partitionBy("__b").orderBy("__h", key))
    cut = d.where("__n > __left").withColumn("__place", place).where("__place <= __left")
    return d.where("__n <= __left").select(*df.columns).unionByName(cut.select(*df.columns))
