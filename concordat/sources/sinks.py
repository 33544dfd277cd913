"""Sinks: partitioned Parquet, CSV, JSON, reports, keep-last tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.curation import upsert


def partitioned(df: DataFrame, path: str, key: str, sort: str | None = None) -> None:
    """Hive partitions, ZSTD. Rows are dealt by key and a salt, so a hot code is written by several tasks."""
    salted = df.repartition(F.col(key), F.pmod(F.xxhash64(*df.columns[:1]), F.lit(4)))
    (salted.sortWithinPartitions(key, *([sort] if sort else [])).write.mode("overwrite").partitionBy(key).option("compression", "zstd").parquet(path))


def csv(df: DataFrame, path: str, sep: str = ";", order: list | None = None) -> None:
    (df.orderBy(*order) if order else df).write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def export(crm: DataFrame, results: DataFrame, path: str, key: str = "crm_id") -> DataFrame:
    """CRM rows with their results, by the path's extension; returns result rows without a CRM row."""
    out = crm.join(results, key, "left")
    json_lines(out, path) if path.endswith(".json") else csv(out, path)
    return results.join(crm.select(key), key, "left_anti")


def replace_rows(df: DataFrame, path: str, key: list[str]) -> None:
    """Insert or replace by key: the new table is written beside the old one, then takes its place as a version."""
    spark = df.sparkSession
    version = spark.read.parquet(path) if path else None
    upsert(version, df, key).write.mode("overwrite").parquet(f"{path}.next")
