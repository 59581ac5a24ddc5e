"""The model registry: an append-only table (name, version, path, tags, properties)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gramline.sources.tables import claim

REGISTRY = "name string, version int, path string, tags map<string,string>, properties map<string,string>"


def read_registry(spark: SparkSession, registry: str) -> DataFrame:
    try:
        return spark.read.schema(REGISTRY).parquet(registry)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], REGISTRY)


def next_version(spark: SparkSession, registry: str, name: str) -> int:
    newest = read_registry(spark, registry).filter(F.col("name") == name).agg(F.max("version")).first()[0]
    return (newest or 0) + 1


def register_model(
    spark: SparkSession,
    registry: str,
    name: str,
    path: str,
    tags: dict[str, str] | None = None,
    properties: dict[str, str] | None = None,
) -> int:
    """Appends the next version of a model and returns that version, which is claimed first: no two writers get the same."""
    version = claim(spark, f"{registry.rstrip('/')}-claims/{name}", next_version(spark, registry, name))
    row = [(name, version, path, tags or {}, properties or {})]
    spark.createDataFrame(row, REGISTRY).coalesce(1).write.mode("append").parquet(registry)
    return version


def latest_models(registry: DataFrame) -> DataFrame:
    """The newest version of every name. A partial maximum per name, so a name with many versions is no hot spot."""
    newest = F.max_by(F.struct(*registry.columns), F.struct("version", "path"))
    return registry.groupBy(F.col("name").alias("_name")).agg(newest.alias("row")).select("row.*")


def latest_model(registry: DataFrame, name: str) -> DataFrame:
    """The newest version of a name; no row if there is none."""
    return latest_models(registry.filter(F.col("name") == name))
