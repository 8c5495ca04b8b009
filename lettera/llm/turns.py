"""The order of turns in conversations."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import NO_ID

#: Turn numbers that are counted in one group.
SPAN_BITS = 10


def signature(role: Column, text: Column) -> Column:
    """The SHA-256 of role and text."""
    return F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256))


def numbered(rows: DataFrame) -> DataFrame:
    """`rows` (conv_id, turn, sig, ...) with `place`: from 1 in each conversation, by turn, null first, then by `sig`.

    Rows are counted in spans of turn numbers, and the spans before are summed, so that a very long conversation is
    spread over tasks; rows of one and the same turn number stay together. Equal rows get places next to each other.
    conv_id has no nulls.
    """
    d = rows.withColumn("span", F.coalesce(F.shiftright(F.col("turn").cast("long"), SPAN_BITS), F.lit(NO_ID)))
    spans = d.groupBy("conv_id", "span").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("span")) - F.col("n")
    inside = F.row_number().over(Window.partitionBy("conv_id", "span").orderBy(F.col("turn").asc_nulls_first(), "sig"))
    d = d.join(spans.select("conv_id", "span", before.alias("before")), ["conv_id", "span"])
    return d.select(*rows.columns, (F.col("before") + inside).alias("place"))
