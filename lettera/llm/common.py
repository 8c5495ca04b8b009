"""Shared helpers: word pattern, stored tables, blocks of rows with a position in a global order."""
from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What a word is, everywhere in this subpackage (Java, RE2 and Python read it alike).
WORD = r"[^\x20\x09-\x0D]+"
#: Stands for a missing doc_id in joins; a null doc_id counts as one id of its own, before all others.
NO_ID = -(2 ** 63)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: `spark.checkpoint.dir`; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="lettera-llm-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared folder and read back: one run, and no lineage to redo it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def bounded_batches(spark: SparkSession, rows: int = 512, size: int = 4_000_000) -> None:
    """Arrow batches of this session hold so many rows and bytes at most: rows carry whole texts."""
    for name, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        key = f"spark.sql.execution.arrow.{name}"
        if not 0 < int(re.sub(r"\D", "", spark.conf.get(key))) <= most:
            spark.conf.set(key, str(most))


def aside(docs: DataFrame, own: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """`docs` with those columns renamed that have a name of `own`, which an operator uses inside; and old to new names.

    `restored` gives them their names back.
    """
    taken = {c.lower() for c in (*docs.columns, *own)}
    moved: dict[str, str] = {}
    for c in docs.columns:
        if c.lower() in {o.lower() for o in own}:
            new = f"_{c}"
            while new.lower() in taken:
                new = f"_{new}"
            taken.add(new.lower())
            moved[c] = new
    return docs.withColumnsRenamed(moved) if moved else docs, moved


def restored(result: DataFrame, moved: dict[str, str]) -> DataFrame:
    return result.withColumnsRenamed({new: c for c, new in moved.items()}) if moved else result


def let(value, body):
    """`body(value)` with `value` worked out once per row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def positions(df: DataFrame, order: list, name: str, partitions: int) -> DataFrame:
    """`df` with a column `name`: the place (from 0) of each row in the global order.

    Rows are range-partitioned and stored with their range; places are counted inside a range and
    shifted by the rows of the ranges before, a table as long as the number of ranges. Ties get
    distinct places in no fixed order.
    """
    ranged = stored(df.repartitionByRange(partitions, *order).withColumn("_range", F.spark_partition_id()), name)
    before = (ranged.groupBy("_range").agg(F.count("*").alias("_n"))
              .withColumn("_before", F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).drop("_n"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return (ranged.join(F.broadcast(before), "_range").withColumn(name, F.col("_before") + inside)
            .drop("_range", "_before"))
