"""All queries by name. One workspace per session and folder, so base tables are built once."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import base_queries, model_queries, profile_queries, report_queries
from .workspace import Workspace

_spaces: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _spaces:
        _spaces[key] = Workspace(spark, sf_dir)
    return _spaces[key]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {}
    for module in (base_queries, profile_queries, report_queries, model_queries):
        for name, build in module.QUERIES.items():
            found[name] = lambda spark, sf_dir, b=build: b(workspace(spark, sf_dir))
    return found
