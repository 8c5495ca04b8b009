"""Reference geometry: GeoJSON features to the outer ring of every polygon."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# coordinates differ in depth between the two geometry types, so each is parsed on its own
POLYGON = "array<array<array<double>>>"
MULTI = f"array<{POLYGON}>"


def feature(kind: str) -> str:
    return ("type string, properties struct<codarea:string>, "
            f"geometry struct<type:string, coordinates:{kind}>")


def read_features(spark: SparkSession, path: str, one_per_line: bool = True) -> DataFrame:
    """Feature texts in a column `value`. One feature per line splits over tasks; a single
    document (FeatureCollection) is one file per task, then exploded."""
    if one_per_line:
        return spark.read.text(path)
    whole = spark.read.text(path, wholetext=True)
    parsed = F.from_json("value", "features array<string>")
    return whole.select(F.explode(parsed["features"]).alias("value"))


def rings(features: DataFrame) -> DataFrame:
    """One row per outer ring: area code, polygon number, ring, number of points."""
    d = features.withColumn("kind", F.get_json_object("value", "$.geometry.type"))
    as_multi = F.when(F.col("kind") == "Polygon",
                      F.array(F.from_json("value", feature(POLYGON))["geometry"]["coordinates"])) \
        .otherwise(F.from_json("value", feature(MULTI))["geometry"]["coordinates"])
    d = d.select(F.get_json_object("value", "$.properties.codarea").alias("codarea"),
                 F.posexplode(as_multi).alias("poligono", "aneis"))
    ring = F.element_at("aneis", 1)
    return d.select("codarea", "poligono", ring.alias("contorno"), F.size(ring).alias("pontos"))
