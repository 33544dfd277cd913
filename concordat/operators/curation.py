"""Curating the registry: joins, filters, deduplication, indexes, audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .blocking import keep_first, ranked

#: Sources of a name in order of precedence, as the bag is built.
NAME_SOURCES = ["ETAB_ENSEIGNE", "ETAB_ENSEIGNE_X", "ETAB_DENOM", "PM_DIRIGEANT", "UL_SIGLE", "UL_DENOM_USUELLE", "UL_DENOM", "PERSON_NAME"]


def enrich(sites: DataFrame, entities: DataFrame, key: str, officers: DataFrame | None = None, officer_name: str = "denomination") -> DataFrame:
    """Sites with their legal unit, one row each even if the unit table repeats a key, and the officers' names."""
    units = keep_first(entities, [key], sorted(c for c in entities.columns if c != key) or [key])
    out = sites.join(units, key, "left")
    if officers is not None:
        names = officers.where(F.lower("type_dirigeant") == "personne morale").groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(officer_name)), "|").alias("pm_dirigeant_names"))
        out = out.join(names, key, "left")
    return out


def in_scope(sites: DataFrame, codes: DataFrame, key: str) -> DataFrame:
    return sites.join(codes.select(key).distinct(), key, "left_semi")


def open_only(sites: DataFrame, state: str, closed: str = "F", closed_since: Column | None = None) -> DataFrame:
    """Null states stay; closed rows stay only from a date on, if one is given."""
    stay = F.col(state).isNull() | (F.col(state) != closed)
    return sites.where(stay | F.coalesce(closed_since, F.lit(False)) if closed_since is not None else stay)


def valid_keys(sites: DataFrame, siret: str, partition: str) -> DataFrame:
    return sites.where((F.length(siret) == 14) & (F.trim(F.coalesce(F.col(partition), F.lit(""))) != ""))


def bag_of_names(fields: list[tuple[Column, str]], is_person: Column) -> Column:
    """Distinct normalised names with their sources; no numbers, nothing of 2 characters; persons only if allowed."""
    def one(value: Column, source: str) -> Column:
        t = T.normalize_name(value)
        ok = (F.length(t) > 2) & ~t.rlike(r"^[\d ]+$") & (is_person if source == "PERSON_NAME" else F.lit(True))
        return F.when(ok, F.struct(t.alias("text"), F.lit(source).alias("source"), F.lit(source.startswith("UL_")).alias("is_ul"), F.lit(source == "UL_SIGLE").alias("is_sigle")))

    return F.filter(F.array(*[one(v, s) for v, s in fields]), lambda x: x.isNotNull())


def primary_name(bag: Column) -> Column:
    """The first name by precedence of its source."""
    place = F.array(*[F.lit(s) for s in NAME_SOURCES])
    best = F.array_min(F.transform(bag, lambda x, i: F.struct(F.array_position(place, x["source"]).alias("p"), i.alias("i"), x["text"].alias("t"))))
    return F.coalesce(best["t"], F.lit(""))


def bag_text(bag: Column) -> Column:
    return F.array_join(F.array_distinct(F.transform(bag, lambda x: x["text"])), " ")


def entity_names(rows: DataFrame, entity: str, names: list[str]) -> DataFrame:
    """Distinct values of each name column, sorted, joined by spaces; null counts as ''."""
    aggs = [F.array_join(F.array_sort(F.collect_set(F.coalesce(F.col(n), F.lit("")))), " ").alias(f"_{n}") for n in names]
    return rows.groupBy(entity).agg(*aggs).select(entity, T.index_name(F.concat_ws(" ", *[f"_{n}" for n in names])).alias("names"))


def entity_places(rows: DataFrame, entity: str, insee: str, postcode: str) -> DataFrame:
    return rows.groupBy(entity, insee, postcode).agg(F.count("*").alias("site_count"))


def places_in_order(places: DataFrame, entity: str, query_insee: Column, query_postcode: Column, insee: str, postcode: str, most: int) -> DataFrame:
    """An entity's places: the query's commune first, then its postcode, then by number of sites; whole places are
    taken until those before reach `most` sites."""
    order = [F.coalesce(F.col(insee) != query_insee, F.lit(True)), F.coalesce(F.col(postcode) != query_postcode, F.lit(True)), F.desc("site_count"), insee, postcode]
    w = Window.partitionBy(entity).orderBy(*order)
    before = F.coalesce(F.sum("site_count").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return places.withColumn("place", F.row_number().over(w).cast("int")).withColumn("before", before).where(F.col("before") < most)


def most_frequent(rows: DataFrame, by: list[str], values: list[str], ordinal: str) -> DataFrame:
    """The most frequent combination of each key; of equals the one seen first."""
    g = rows.groupBy(*by, *values).agg(F.count("*").alias("n"), F.min(ordinal).alias("_first"))
    return keep_first(g, by, [F.desc("n"), "_first"]).drop("_first")


def group_sources(rows: DataFrame, key: Column, source: str, label: str, ordinal: str) -> DataFrame:
    """One row a key: sources in the order seen, the smallest place of each source, number of rows; keyless rows go."""
    r = rows.withColumn("_key", key).where("_key is not null")
    first = r.groupBy("_key", source).agg(F.min(ordinal).alias("_o"), F.count("*").alias("_n"))
    return first.groupBy(F.col("_key").alias("key")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_o", source))), lambda x: x[source]), "|").alias("sources"), F.min("_o").alias("first_seen"), F.sum("_n").alias("n_rows"))


def cap_per_source(rows: DataFrame, by: list[str], source: str, order: list, most: int) -> DataFrame:
    return ranked(rows, [*by, source], order, "place").where(F.col("place") <= most)


def partition_issues(rows: DataFrame, *, code: str, key: str, expected: Column) -> DataFrame:
    """Per code: rows, null keys, duplicate keys, rows that belong elsewhere."""
    per = rows.groupBy(code, key).agg(F.count("*").alias("n"), F.count_if(~F.coalesce(expected, F.lit(False))).alias("mixed"))
    return per.groupBy(code).agg(F.sum("n").alias("n_rows"), F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("null_keys"), F.sum(F.when(F.col(key).isNotNull(), F.col("n") - 1).otherwise(0)).alias("duplicates"), F.sum("mixed").alias("mixed"))


def audit(left: DataFrame, right: DataFrame, key: str, agrees: Column) -> DataFrame:
    """Each left row with a status: missing on the right, ok, or bad."""
    r = right.withColumn("_there", F.lit(True))
    return left.join(r, key, "left").withColumn("status", F.when(F.col("_there").isNull(), "missing").when(F.coalesce(agrees, F.lit(False)), "ok").otherwise("bad")).drop("_there")


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """`new` replaces rows of `old` with the same key; of several new rows the last by `_seq` counts, if there is one."""
    if "_seq" in new.columns:
        new = keep_first(new, key, [F.desc("_seq")]).drop("_seq")
    return old.join(new.select(*key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def raw_named(columns: list[str]) -> Column:
    """Whether any raw name column holds something."""
    return F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in columns]).isNotNull()


def diffusible(status: str) -> Column:
    return F.coalesce(F.col(status) == "O", F.lit(False))


def unique_codes(rows: DataFrame, code: str) -> DataFrame:
    """Distinct trimmed codes in order; empty ones go."""
    return rows.select(F.trim(code).alias(code)).where(F.col(code) != "").distinct().orderBy(code)


def codes_by_section(codes: DataFrame, code: str) -> DataFrame:
    from ..functions.codes import naf_section

    return codes.withColumn("section", naf_section(F.col(code))).where("section is not null").groupBy("section").agg(F.array_sort(F.collect_list(code)).alias("codes"))


def partition_codes(sites: DataFrame, code: str) -> DataFrame:
    """The codes of a partitioned table, with their rows."""
    return sites.where(F.col(code).isNotNull()).groupBy(code).agg(F.count("*").alias("row_count"))
