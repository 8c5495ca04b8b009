"""Column expressions with the exact semantics the analysis needs.

All of them are plain JVM expressions, so they stay inside whole-stage code generation.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS_PER_OCTAVE = 2048


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num, den) -> Column:
    """num / den, null when the denominator is zero or null."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def pct(num, den) -> Column:
    return F.try_divide(F.lit(100.0) * col(num), col(den).cast("double"))


def clip_upper(c, top) -> Column:
    """Cap at `top`; a null stays null (two-argument `least` would return `top`)."""
    c = col(c)
    return F.when(c > top, F.lit(float(top))).otherwise(c)


def clip(c, low, high) -> Column:
    c = col(c)
    return F.when(c < low, F.lit(float(low))).when(c > high, F.lit(float(high))).otherwise(c)


def nan_to_null(c) -> Column:
    c = col(c)
    return F.when(~F.isnan(c), c)


def recode(c, mapping: dict) -> Column:
    """Code to label; a code outside the mapping becomes null."""
    out = None
    for code, label in mapping.items():
        test = col(c) == F.lit(code)
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out


def hash_number(c, salt) -> Column:
    """32-bit number from md5(`key|salt`): the same on every run, machine and engine."""
    text = F.concat(col(c).cast("string"), F.lit(f"|{salt}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_text(c, salt) -> Column:
    return F.md5(F.concat(col(c).cast("string"), F.lit(f"|{salt}")))


def band(c, edges, labels) -> Column:
    """Right-closed bands, the lowest edge included in the first one."""
    c = col(c)
    out = F.when(c < edges[0], F.lit(None))
    for high, label in zip(edges[1:], labels):
        out = out.when(c <= high, F.lit(label))
    return out


def histogram_bin(c, low, width, bins: int) -> Column:
    """Left-closed bins numbered from 0; the last bin also holds the upper edge."""
    c = col(c)
    k = F.floor((c - low) / width).cast("int")
    return F.when(c.isNull(), F.lit(None)).when(k >= bins, F.lit(bins - 1)).otherwise(k)


def value_bucket(c) -> Column:
    """A bucket number that never decreases as the value grows.

    Logarithmic buckets, `BUCKETS_PER_OCTAVE` per doubling, mirrored for negative values.
    The number depends on the value alone, so any two branches of a plan, and any recomputed
    task, agree on it; that is what lets ranks be computed bucket by bucket.
    """
    c = col(c).cast("double")
    scale, shift = BUCKETS_PER_OCTAVE / 0.6931471805599453, BUCKETS_PER_OCTAVE * 1100
    size = F.floor(F.log(F.abs(c)) * scale) + shift
    return F.when(c > 0, size).when(c < 0, -size).otherwise(F.lit(0)).cast("bigint")


def clean_key(c) -> Column:
    """A code kept as text; one that passed through a floating column loses its `.0`."""
    return F.regexp_replace(col(c).cast("string"), r"\.0$", "")


def is_label_one(c) -> Column:
    """1 when the textual label is '1', else 0; a missing label counts as 0."""
    return F.coalesce((col(c).cast("string") == "1"), F.lit(False)).cast("int")


def sign(c) -> Column:
    return F.signum(col(c)).cast("int")


def with_totals(df: DataFrame, totals: DataFrame) -> DataFrame:
    """Add the columns of a table that has exactly one row (an aggregate without groups) to
    every row: Spark ships the single row to the tasks, nothing is paired or shuffled."""
    return df.crossJoin(F.broadcast(totals))
