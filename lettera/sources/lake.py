"""Snapshots, materialised results, report files and registers on a shared file system."""
from __future__ import annotations

import json
import tempfile
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import nan_to_null

PARTITION = "data_processamento"
STAMP = "_processing_timestamp"


class StopRun(RuntimeError):
    """A guard failed; nothing after it may run."""


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by `spark.checkpoint.dir`.

    Where the session names none, a local session gets a temporary one and a cluster is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise StopRun("spark.checkpoint.dir must name a folder that all executors share")
        current = spark.sparkContext.getCheckpointDir()
        if current:
            return current
        folder = tempfile.mkdtemp(prefix="lettera-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def run_folder(spark: SparkSession, *parts: str) -> str:
    """A path of this application's own in the shared folder."""
    return "/".join([shared_folder(spark).rstrip("/"),
                     f"lettera-{spark.sparkContext.applicationId}", *parts])


def _listing(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _listing(spark, path)
    return fs.exists(p)


def snapshots(spark: SparkSession, root: str) -> list[str]:
    """Partition values under `root`, oldest first; a listing of directories, no data read."""
    fs, p = _listing(spark, root)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(PARTITION + "="))


def read_latest(spark: SparkSession, root: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Newest snapshot of a table; only its own directory is read."""
    found = snapshots(spark, root)
    if not found:
        raise StopRun(f"no snapshot under {root}")
    df = read_clean(spark.read.option("basePath", root).parquet(f"{root}/{PARTITION}={found[-1]}"))
    return df.select(*columns) if columns else df


def read_clean(df: DataFrame) -> DataFrame:
    """Turn NaN into null in every floating column: the analysis knows one kind of missing."""
    return df.select(*[nan_to_null(c).alias(c) if t in ("double", "float") else F.col(c)
                       for c, t in df.dtypes])


def materialize_if_stale(spark: SparkSession, path: str, build: Callable[[], DataFrame],
                         required: Sequence[str] = (), refresh: bool = False) -> tuple[DataFrame, str]:
    """Reuse a stored result when it is complete and has the required columns, else build it."""
    if not refresh and path_exists(spark, f"{path}/_SUCCESS"):
        stored = read_clean(spark.read.parquet(path))
        if not set(required) - set(stored.columns):
            return stored, "cache"
    build().write.mode("overwrite").parquet(path)
    return read_clean(spark.read.parquet(path)), "consultada"


def bucketed_if_absent(spark: SparkSession, path: str, table: str, build: Callable[[], DataFrame],
                       keys: Sequence[str], buckets: int) -> DataFrame:
    """A result kept as files in `buckets` hash buckets of `keys`, so that joins and groupings on just these keys
    read it without a shuffle. `table` is its entry in the session's catalog; the files lie under `path`.

    Rows are dealt by the same hash before the write, one task a bucket: n files, not n per task. A write that
    ended early has no `_SUCCESS` and is done again.
    """
    if not (spark.catalog.tableExists(table) and path_exists(spark, f"{path}/_SUCCESS")):
        (build().repartition(buckets, *keys).write.mode("overwrite").option("path", path)
         .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
    return read_clean(spark.table(table))


def write_snapshot(df: DataFrame, root: str, day: str | None = None) -> dict:
    """Write one snapshot, replacing only that day's partition.

    The planned row count is a plan of its own that needs no column, so it prunes the scan and
    skips the sort and encoding of the write; an independent count is what the reconciliation
    compares with. (An observed metric would be cheaper, but once a session has used one,
    Spark 4.1 cannot ship fitted models that keep a training summary to the tasks.)
    """
    when = F.lit(day) if day else F.date_format(F.current_timestamp(), "yyyy-MM-dd")
    (df.withColumn(STAMP, F.current_timestamp()).withColumn(PARTITION, when)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(PARTITION).parquet(root))
    return {"root": root, "rows": df.count()}


def reconcile(spark: SparkSession, written: dict, day: str | None = None) -> DataFrame:
    """Rows planned against rows read back."""
    back = read_latest(spark, written["root"]) if day is None else \
        spark.read.parquet(f"{written['root']}/{PARTITION}={day}")
    return back.agg(F.count(F.lit(1)).alias("linhas_relidas")).select(
        F.lit(written["rows"]).cast("bigint").alias("linhas_gravadas"), "linhas_relidas",
        (F.col("linhas_relidas") == F.lit(written["rows"])).alias("confere"))


def write_report(df: DataFrame, path: str, decimals: int) -> DataFrame:
    """Rounded CSV report (half to even); returns it as read back with the same schema."""
    rounded = df.select(*[F.bround(c, decimals).alias(c) if t == "double" else F.col(c)
                          for c, t in df.dtypes])
    rounded.write.mode("overwrite").option("header", True).csv(path)
    return df.sparkSession.read.schema(rounded.schema).option("header", True).csv(path)


CONTROL_SCHEMA = ("variavel string, hipotese string, tipo string, situacao string, motivo string, "
                  "imputacao string, indicador_ausencia string, transformacao string, "
                  "codificacao string")


def read_control(spark: SparkSession, path: str) -> DataFrame:
    """Variable decision list with its declared schema."""
    return spark.read.schema(CONTROL_SCHEMA).option("header", True).csv(path)


def design_of(control: DataFrame) -> dict:
    """Column lists that drive the models; as long as the variable list, never as the data."""
    rows = control.where(F.col("situacao") == "entra").collect()
    numeric = [r.variavel for r in rows if r.tipo == "numérica"]
    categorical = [r.variavel for r in rows if r.tipo == "categórica"]
    return {"numericas": numeric, "categoricas": categorical,
            "indicadores": {r.indicador_ausencia: r.variavel for r in rows if r.indicador_ausencia},
            "com_log": [r.variavel for r in rows if r.transformacao],
            "variaveis": numeric + categorical}


def write_register(spark: SparkSession, path: str, recipe: dict) -> None:
    """Model recipe as one JSON line."""
    spark.createDataFrame([(json.dumps(recipe, ensure_ascii=False, sort_keys=True),)],
                          "value string").coalesce(1).write.mode("overwrite").text(path)


REGISTER_SCHEMA = ("familia string, parametros map<string,double>, parametros_texto string, desenho string, resposta string, "
                   "peso string, criterio string, validacao_cruzada map<string,double>, validacao map<string,double>, "
                   "metricas map<string,double>, semente int, variaveis array<string>")


def read_register(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REGISTER_SCHEMA).json(path)
