"""Order statistics without a global sort in one task.

Ranks, exact percentiles, running totals and equal-frequency bins all come from one building
block, `cumulate`: rows are cut into buckets that follow the order, every bucket is summed
where it lies, and only the bucket totals (a bounded table) are put in sequence. A hot value
is one pre-aggregated row, and a hot group is spread over its buckets.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import hash_text, value_bucket

BEFORE, TOTAL = "cum_before", "cum_total"


def sorted_side(df: DataFrame) -> DataFrame:
    """Marks a side of an equi-join that grows with the rows: both sides are sorted, none is collected to be broadcast.

    Spark's first estimate of a table in long form leaves out how often `inline` and `explode` repeat a row, so a table of
    gigabytes may pass for one below the broadcast threshold, and is then sent through the driver.
    """
    return df.hint("merge")


def cumulate_many(df: DataFrame, amounts: dict[str, tuple[str, str]], bucket: Sequence[Column],
                  order: Sequence[Column], partition: Sequence[str] = ()) -> DataFrame:
    """For each amount column add the sum of the rows ahead of it and the sum of its partition,
    under the two given names, along `order` inside each `partition`.

    `bucket` must be a coarsening of `order`: sorting by bucket first and by `order` inside it
    has to give the same sequence. Partition columns must not be null.
    """
    names = [f"__b{i}" for i in range(len(bucket))]
    keys = [*partition, *names]
    d = df.select("*", *[b.alias(n) for b, n in zip(bucket, names)])
    totals = d.groupBy(*keys).agg(*[F.sum(a).alias(f"__s_{a}") for a in amounts])
    group = Window.partitionBy(*(partition or [F.lit(0)]))
    ahead = group.orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, *[F.coalesce(F.sum(f"__s_{a}").over(ahead), F.lit(0)).alias(f"__o_{a}") for a in amounts],
        *[F.sum(f"__s_{a}").over(group).alias(total) for a, (_, total) in amounts.items()])
    inside = (Window.partitionBy(*keys).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    run = d.withColumns({f"__r_{a}": F.sum(a).over(inside) - F.col(a) for a in amounts})
    return (run.join(sorted_side(offsets), keys)
            .withColumns({before: F.col(f"__o_{a}") + F.col(f"__r_{a}")
                          for a, (before, _) in amounts.items()})
            .drop(*names, *[f"__{k}_{a}" for a in amounts for k in "or"]))


def cumulate(df: DataFrame, amount: str, bucket: Sequence[Column], order: Sequence[Column],
             partition: Sequence[str] = ()) -> DataFrame:
    """Add `cum_before` and `cum_total` of one amount; see `cumulate_many`."""
    return cumulate_many(df, {amount: (BEFORE, TOTAL)}, bucket, order, partition)


def value_counts(df: DataFrame, value: str, partition: Sequence[str] = (),
                 weight: str | None = None) -> DataFrame:
    """Distinct values, neither null nor NaN, with their (weighted) row count `n`, per partition."""
    w = F.sum(weight) if weight else F.count(F.lit(1))
    there = F.col(value).isNotNull()
    if dict(df.dtypes)[value] in ("double", "float"):
        there = there & ~F.isnan(value)
    return df.where(there).groupBy(*partition, value).agg(w.alias("n"))


CROWDED, PIECE, MOST = 2048, 512, 1 << 16


def split_crowded(counts: DataFrame, value: str, partition: Sequence[str] = (), levels: int = 0) -> tuple[DataFrame, list[str]]:
    """`counts` with bucket columns that follow the values, and their names.

    The first is `value_bucket`. A bucket with more than `CROWDED` distinct values, such as one that holds all
    timestamps of a day, is cut evenly between its least and greatest value into pieces of `PIECE` values on average, and
    so again at each further level. The results are the same at any level; a level costs one more sum and join, which takes
    about a fifth of the time on small tables, so columns that fill their octaves (rates, shares, counts) go without.
    """
    number = F.col(value).cast("double")
    names, d = ["__k0"], counts.withColumn("__k0", value_bucket(value))
    for level in range(1, levels + 1):
        keys = [*partition, *names]
        crowded = (d.groupBy(*keys).agg(F.count(F.lit(1)).alias("__m"), F.min(number).alias("__low"), F.max(number).alias("__high"))
                   .where((F.col("__m") > CROWDED) & (F.col("__low") < F.col("__high"))))
        piece = F.floor((number - F.col("__low")) / (F.col("__high") - F.col("__low"))
                        * F.least(F.ceil(F.col("__m") / PIECE), F.lit(MOST)))
        names = [*names, f"__k{level}"]
        d = (d.join(sorted_side(crowded), keys, "left").withColumn(names[-1], F.coalesce(piece, F.lit(0)))
             .drop("__m", "__low", "__high"))
    return d, names


def cumulated_counts(df: DataFrame, value: str, partition: Sequence[str] = (),
                     weight: str | None = None, levels: int = 0) -> DataFrame:
    """Distinct values with their count and the rows before them. `levels` (1 or 2) is for values in a narrow range far
    from zero, such as timestamps or running keys; see `split_crowded`."""
    counts, names = split_crowded(value_counts(df, value, partition, weight), value, partition, levels)
    return cumulate(counts, "n", [F.col(k) for k in names], [F.col(value)], partition).drop(*names)


def quantile_columns(value: str, probs: dict[str, float], n: str = "n") -> list[Column]:
    """Aggregates that pick exact, linearly interpolated percentiles from cumulated counts."""
    out = []
    for name, p in probs.items():
        place = F.lit(float(p)) * (F.col(TOTAL) - 1)
        low, high = F.floor(place), F.ceil(place)
        first, last = F.col(BEFORE), F.col(BEFORE) + F.col(n) - 1
        at = lambda k: F.max(F.when((first <= k) & (k <= last), F.col(value).cast("double")))
        frac = F.max(place - low)
        out.append((at(low) + (at(high) - at(low)) * frac).alias(name))
    return out


def quantiles(df: DataFrame, value: str, probs: dict[str, float],
              partition: Sequence[str] = (), weight: str | None = None,
              extra: Sequence[Column] = (), levels: int = 0) -> DataFrame:
    """Exact percentiles of `value` per partition, one row each.

    Unlike the built-in exact percentile, whose buffer keeps every distinct value of a group in
    one task, this spreads the distinct values over buckets. `extra` aggregates run on the
    cumulated counts (`n`, `cum_before`, `cum_total`).
    """
    cum = cumulated_counts(df, value, partition, weight, levels)
    return cum.groupBy(*partition).agg(*quantile_columns(value, probs), *extra)


def average_ranks(df: DataFrame, value: str, partition: Sequence[str] = (),
                  weight: str | None = None, levels: int = 0) -> DataFrame:
    """Distinct values with their mean rank (ties share it), centred and scaled by N.

    Correlation does not depend on centre or scale, and a rank in [-0.5, 0.5] keeps the sums
    of squares exact enough for billions of rows.
    """
    cum = cumulated_counts(df, value, partition, weight, levels)
    rank = F.col(BEFORE) + (F.col("n") + 1) / F.lit(2.0)
    centred = (rank - (F.col(TOTAL) + 1) / F.lit(2.0)) / F.col(TOTAL)
    return cum.select(*partition, value, rank.alias("rank"), centred.alias("rank_c"))


def hash_positions(keys: DataFrame, key: str, salt, name: str = "pos") -> DataFrame:
    """Distinct keys with a 1-based position in hash order and the number of keys (`cum_total`)."""
    h = keys.select(key).distinct().withColumn("__h", hash_text(key, salt)) \
            .withColumn("__one", F.lit(1).cast("bigint"))
    out = cumulate(h, "__one", [F.substring("__h", 1, 3)], [F.col("__h"), F.col(key)])
    return out.select(key, (F.col(BEFORE) + 1).alias(name), TOTAL)


def tied_positions(df: DataFrame, value: str, tie: str, amount: str,
                   partition: Sequence[str] = (), levels: int = 0) -> DataFrame:
    """Positions along (`value`, hash of `tie`, `tie`) with rows standing for `amount` units.

    Done in two steps, because one value may be shared by a large part of the rows: first where
    each distinct value starts, then the place among its ties, spread by hash prefix.
    """
    starts = cumulated_counts(df, value, partition, amount, levels).select(
        *partition, value, F.col(BEFORE).alias("__start"), F.col(TOTAL).alias("__total"))
    d = df.where(F.col(value).isNotNull()).withColumn("__h", F.md5(F.col(tie)))
    d = cumulate(d, amount, [F.substring("__h", 1, 2)], [F.col("__h"), F.col(tie)],
                 [*partition, value]).drop(TOTAL)
    return (d.join(sorted_side(starts), [*partition, value])
            .withColumn(BEFORE, F.col(BEFORE) + F.col("__start"))
            .withColumnRenamed("__total", TOTAL).drop("__start", "__h"))


def whole_div(a, b) -> Column:
    """Whole-number division."""
    return F.call_function("div", a, b)


def equal_frequency_bins(df: DataFrame, value: str, tie: str, amount: str, n: int,
                         partition: Sequence[str] = (), levels: int = 0) -> DataFrame:
    """Split rows over `n` equal-frequency bins; adds `faixa` (1..n) and `in_bin` units.

    A row that stands for several identical units and crosses an edge is shared out exactly, so
    the result equals binning every unit on its own.
    """
    return binned_positions(tied_positions(df, value, tie, amount, partition, levels), amount, F.lit(n))


def binned_positions(pos: DataFrame, amount: str, n: Column) -> DataFrame:
    """The rows of `tied_positions` in `n` bins, as `equal_frequency_bins` gives them; `n` may differ from row to row."""
    first, last = F.col(BEFORE), F.col(BEFORE) + F.col(amount) - 1
    span = F.col(TOTAL) - 1
    # bin of a zero-based position: ceil(pos * n / (N - 1)), at least 1, in whole numbers
    safe, size = F.greatest(span, F.lit(1)), n.cast("bigint")
    at = lambda p: F.greatest(F.lit(1).cast("bigint"), whole_div(p * size + safe - 1, safe))
    d = pos.withColumn("faixa", F.explode(F.sequence(at(first), at(last))))
    upper = whole_div(span * F.col("faixa"), size)
    lower = F.when(F.col("faixa") == 1, F.lit(0)).otherwise(
        whole_div(span * (F.col("faixa") - 1), size) + 1)
    units = F.least(last, upper) - F.greatest(first, lower) + 1
    return d.withColumn("in_bin", units).where("in_bin > 0")


def with_enough_values(df: DataFrame, value: str, n: int, partition: Sequence[str]) -> DataFrame:
    """Only the partitions with at least `n` distinct values: fewer cannot fill `n` bins."""
    distinct = value_counts(df, value, partition).groupBy(*partition).agg(
        F.count(F.lit(1)).alias("__values")).where(F.col("__values") >= n)
    return df.join(distinct.drop("__values"), list(partition), "left_semi")


def running_total(df: DataFrame, value: str, tie: str) -> DataFrame:
    """Running total of `value`, largest first; adds `cum_before` and `cum_total`."""
    d = tied_positions(df.withColumn("__k", -F.col(value)), "__k", tie, value)
    return d.drop("__k")
