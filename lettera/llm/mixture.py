"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repeats."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, aside, positions, restored, stored

#: The order of a source is cut into parts by the first hex digits of the order key: three of them, more once a part of
#: a source with all rows would hold more than `PART_ROWS`.
PARTS_HEX, PART_ROWS = 3, 1 << 16


def part_digits(rows: int) -> int:
    digits = PARTS_HEX
    while rows > PART_ROWS * 16 ** digits:
        digits += 1
    return digits


def words_of(text: str = "text") -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weights(sources: DataFrame, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Adds `weight`: sources in code point order, null last, get the weights of `cycle` in turn."""
    order = [F.col("source").isNull(), F.col("source")]
    placed = positions(sources, order, "_place", 8)
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), (F.col("_place") % len(cycle) + 1).cast("int"))
    return placed.withColumn("weight", turn).drop("_place")


def water_fill(sources: DataFrame, epochs: float) -> DataFrame:
    """Targets of sources (source, source_size, weight) that share the sum of all sizes.

    Each round hands what the capped sources leave to the others by weight and caps those that
    would pass `epochs` times their size, until none does. A round is one sum over the sources; the
    driver sees two numbers. Sources of size 0 get 0, and so do all if the sum is 0.
    """
    cap = F.lit(float(epochs)) * F.col("source_size")
    d = stored(sources, "sources")
    total = float(d.agg(F.sum("source_size")).first()[0] or 0)
    level, closed = None, -1
    while True:
        full = F.lit(False) if level is None else F.col("weight") * F.lit(level) > cap
        taken, weight, n = d.agg(F.sum(F.when(full, cap).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))),
                                 F.sum(F.when(full, 1).otherwise(0))).first()
        if not weight or n == closed:
            break
        level, closed = (total - taken) / weight, n
    target = cap if level is None else F.least(cap, F.col("weight") * F.lit(level))
    return d.withColumn("target", target.cast("double"))


def _not_null(source: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))


def order_key(seed: str) -> Column:
    """Rows without doc_id are spread by size and text, as they may be many."""
    nobody = F.concat_ws(":", F.lit("null"), F.col("_size").cast("string"), F.col("_tie").cast("string"))
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), nobody)))


#: Columns that `_mixed` works with beside the caller's.
_OWN = ["_size", "_source", "_key", "_part", "_before", "_inside", "_rate", "_source_size", "_target", "_repeats", "_copy", "_given", "_tie"]


def _mixed(docs: DataFrame, cycle: tuple[int, ...], epochs: float, seed: str, size: str | None) -> DataFrame:
    """`docs` with _size, _source_size, _target and _repeats."""
    names = [c for c in docs.columns if c != "_given"]
    # rows of one id and size are told apart by their text, as far as it is there, so that reruns take the same
    tie = F.xxhash64("text") if "text" in docs.columns else F.lit(None).cast("long")
    d = docs.select(*names, (F.col(size) if size else words_of()).alias("_size"), tie.alias("_tie"))
    lean = stored(d.select("doc_id", "source", "_size", "_tie"), "sizes")
    digits = part_digits(lean.count())
    totals = lean.groupBy("source").agg(F.sum("_size").alias("source_size"))
    fill = water_fill(cyclic_weights(totals, cycle), epochs).withColumn(
        "_rate", F.when(F.col("source_size") > 0, F.least(F.lit(float(epochs)), F.col("target") / F.col("source_size")))
        .otherwise(0.0))
    keys = lambda x: (x.withColumn("_source", _not_null("source"))
                      .withColumn("_key", order_key(seed)).withColumn("_part", F.substring("_key", 1, digits)))
    parts = keys(lean).groupBy("_source", "_part").agg(F.sum("_size").alias("_n"))
    parts = parts.withColumn("_before", F.sum("_n").over(Window.partitionBy("_source").orderBy("_part")) - F.col("_n"))
    parts = parts.drop("_n").join(fill.select(_not_null("source").alias("_source"), F.col("source_size").alias("_source_size"),
                                              F.col("target").alias("_target"), "_rate"), "_source")
    d = keys(lean if set(names) <= {"doc_id", "source"} else d)
    inside = F.sum("_size").over(Window.partitionBy("_source", "_part").orderBy("_key", "_size", "_tie")
                                 .rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("_inside", F.coalesce(inside, F.lit(0))).join(parts, ["_source", "_part"], "left")
    whole = F.floor("_rate")
    middle = F.col("_before") + F.col("_inside") + F.col("_size") / 2.0
    again = middle < (F.col("_rate") - whole) * F.col("_source_size")
    return d.select(*names, "_size", "_source_size", "_target",
                    (whole + F.when(again, 1).otherwise(0)).cast("int").alias("_repeats"))


def mix(docs: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), epochs: float = 3.0, seed: str = "mix",
        size: str | None = None) -> DataFrame:
    """`docs` with size, source_size, target and `repeats`, the times the mix takes the row.

    `size` is the words of `text`, unless the parameter names a column that holds it. Columns of `docs`
    with the names of the four are replaced.

    A source with target/size = e takes every row floor(e) times, and once more those rows that come
    first in a seeded order, up to the fraction that is left: a row is taken if its middle lies
    within it, so a source misses its target by half a document at most. The running sum is cut by
    the order key into parts, each summed first, so a source with a third of all rows is spread over
    thousands of groups. Rows with equal keys (same doc_id) are ordered by size and text; rows without
    doc_id are spread by size and text. Null texts have size
    0; null sources are one source, after the others; an empty table gives an empty one.
    """
    own = ["size", "source_size", "target", "repeats"]
    names = [c for c in docs.columns if c not in own]
    given = docs.select(*names, *([F.col(size).alias("_given ")] if size else []))
    given, moved = aside(given, _OWN)
    names = [moved.get(c, c) for c in names]
    d = _mixed(given.withColumnRenamed("_given ", "_given"), cycle, epochs, seed, size and "_given")
    return restored(d.select(*names, *[F.col(f"_{c}").alias(c) for c in own]), moved)


def repeated(mixed: DataFrame, columns: list[str], repeats: str = "repeats") -> DataFrame:
    """Each row as often as the mix takes it."""
    return (mixed.filter(F.col(repeats) > 0)
            .select(*columns, F.explode(F.sequence(F.lit(1), F.col(repeats))).alias("_copy")).drop("_copy"))


def take(docs: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), epochs: float = 3.0, seed: str = "mix") -> DataFrame:
    """Each row of `docs`, with all its columns as they are, as often as the mix by words takes it."""
    docs, moved = aside(docs, _OWN)
    return restored(repeated(_mixed(docs, cycle, epochs, seed, None), docs.columns, "_repeats"), moved)
