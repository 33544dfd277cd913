"""Sources: partitioned candidates, CSV with aliases, JSON records, and providers for remote services."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Headers that mean the same column.
CRM_ALIASES = {"crm_id": ["N° Service", "SERVICE ID", "id"], "crm_name": ["Client final", "SITE", "name"], "crm_address": ["Adresse", "SITE_CLI_ADRESSE", "address"], "crm_city": ["Commune", "COMMUNE", "city"], "postcode": ["Code Postal", "CODE_POSTAL", "cp"], "insee": ["Code INSEE", "CODE_INSEE", "insee_code"], "siret": ["SIRET", "siret_gt", "gt_siret", "label"]}


def partitioned(spark: SparkSession, path: str, codes: DataFrame | None = None, key: str = "insee", columns: list[str] | None = None) -> DataFrame:
    """A Hive-partitioned candidate table with string codes; only the partitions of `codes`, only columns that exist.

    Codes are joined, not listed: dynamic partition pruning reads the partitions that are left.
    """
    kept = spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled")
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    try:
        df = spark.read.parquet(path)
    finally:
        spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", kept)
    if columns:
        df = df.select(*[c for c in columns if c in df.columns])
    return df.join(codes.select(key).distinct(), key, "left_semi") if codes is not None else df


def sniff_delimiter(spark: SparkSession, path: str) -> str:
    """The delimiter of a CSV's first line: semicolon, comma or tab, the most frequent."""
    head = spark.read.text(path).limit(1).collect()
    line = head[0][0] if head else ""
    return max(";,\t", key=lambda d: (line.count(d), -";,\t".index(d)))


def csv(spark: SparkSession, path: str, aliases: dict[str, list[str]] = CRM_ALIASES, encoding: str = "UTF-8") -> DataFrame:
    """All columns as strings, headers renamed by their aliases, missing ones null."""
    sep = sniff_delimiter(spark, path)
    df = spark.read.option("header", True).option("sep", sep).option("encoding", encoding).option("inferSchema", False).csv(path)
    lower = {c.lower(): c for c in df.columns}
    out, used = [], set()
    for name, others in aliases.items():
        found = next((lower[a.lower()] for a in [name, *others] if a.lower() in lower), None)
        used.add(found)
        out.append((F.col(f"`{found}`") if found else F.lit(None).cast("string")).alias(name))
    return df.select(*out, *[F.col(f"`{c}`") for c in df.columns if c not in used])


def establishments(records: DataFrame, column: str = "record") -> DataFrame:
    """Nested establishment records as flat rows; the current period is the open one, else the latest."""
    schema = "siret string, siren string, adresse struct<numero:string,voie:string,codePostal:string,commune:string>, periodes array<struct<dateFin:string,dateDebut:string,etat:string,enseigne:string>>"
    r = records.select(F.from_json(column, schema).alias("r"))
    now = F.array_max(F.transform("r.periodes", lambda p: F.struct(p["dateFin"].isNull().alias("open"), p["dateDebut"].alias("from"), p["etat"].alias("etat"), p["enseigne"].alias("enseigne"))))
    return r.select("r.siret", "r.siren", "r.adresse.*", now["etat"].alias("etat"), now["enseigne"].alias("enseigne"))


def provider(keys: DataFrame, fetch: Callable[[Iterable[dict]], Iterable[dict]], schema: str) -> DataFrame:
    """Rows that an injected client returns for rows of `keys`, a partition at a time; the client is made on the
    executor. Services that aren't reachable are replaced by a file-backed client."""
    names = [f.name for f in StructType.fromDDL(schema).fields]

    def run(parts):
        import pandas as pd

        for part in parts:
            yield pd.DataFrame(list(fetch(part.to_dict("records"))), columns=names)

    return keys.mapInPandas(run, schema)


def read_through(keys: DataFrame, cache: DataFrame, key: str, now, ttl_days: int) -> tuple[DataFrame, DataFrame]:
    """(hits, misses): cached rows that haven't expired, and the keys that have to be fetched."""
    fresh = cache.where(F.col("fetched_at") > now - F.expr(f"interval {ttl_days} days"))
    return keys.join(fresh, key), keys.join(fresh.select(key), key, "left_anti")


def all_strings(names: list[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])
