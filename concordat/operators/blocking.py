"""Blocking: which candidates a query row is compared with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked(df: DataFrame, by: list, order: list, name: str = "rank") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("int"))


def keep_first(df: DataFrame, by: list, order: list) -> DataFrame:
    """One row of each key: the first in a declared order. Catalyst limits each group before the shuffle."""
    return ranked(df, by, order, "_rank").where("_rank = 1").drop("_rank")


def block_with_fallback(queries: DataFrame, candidates: DataFrame, *, query_id: str, first: tuple[str, str], second: tuple[str, str]) -> DataFrame:
    """Candidates of the query's first code; of its second code only if the first has none. `via` says which.

    Whether a code has candidates is a semi join against its distinct values, so no query is multiplied for the test.
    """
    q1, c1 = first
    q2, c2 = second
    known = candidates.select(F.col(c1).alias(q1)).where(F.col(q1).isNotNull()).distinct()
    has = queries.join(known, q1, "left_semi")
    rest = queries.join(known, q1, "left_anti")
    a = has.join(candidates, F.col(q1) == F.col(c1)).withColumn("via", F.lit("first"))
    b = rest.join(candidates, F.col(q2) == F.col(c2)).withColumn("via", F.lit("second"))
    return a.unionByName(b)


def block_either(queries: DataFrame, candidates: DataFrame, keys: list[tuple[str, str]], *, query_id: str, candidate_id: str) -> DataFrame:
    """Candidates that share any of the codes, each pair once: two equi joins, not one join on OR."""
    parts = [queries.join(candidates, F.col(q) == F.col(c)).withColumn("_via", F.lit(i)) for i, (q, c) in enumerate(keys)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return keep_first(out, [query_id, candidate_id], ["_via"]).drop("_via")


def manifest(candidates: DataFrame, code: str, mega: int) -> DataFrame:
    return candidates.groupBy(code).agg(F.count("*").alias("row_count")).withColumn("is_mega", F.col("row_count") >= mega)


def mega_policy(queries: DataFrame, candidates: DataFrame, counts: DataFrame, *, block: str, narrow: str) -> DataFrame:
    """Blocks over the limit also need equality of `narrow`; others don't. Both sides have these columns."""
    big = counts.where("is_mega").select(block)
    q = queries.join(big.withColumn("_mega", F.lit(True)), block, "left")
    c = candidates.withColumnRenamed(narrow, "_narrow")
    return q.join(c, block).where(F.col("_mega").isNull() | (F.col(narrow) == F.col("_narrow"))).drop("_mega")


def token_rescue(queries: DataFrame, candidates: DataFrame, query_tokens: Column, candidate_tokens: Column, *, query_id: str, candidate_id: str, rarest: int | None = None) -> DataFrame:
    """Pairs with a token in common, and how many. Only tokens on both sides are counted; `rarest` bounds a token's candidates."""
    q = queries.select(query_id, F.explode(query_tokens).alias("token"))
    c = candidates.select(candidate_id, F.explode(candidate_tokens).alias("token"))
    if rarest:
        c = c.join(c.groupBy("token").agg(F.count("*").alias("_n")).where(F.col("_n") <= rarest).select("token"), "token", "left_semi")
    return q.join(c, "token").groupBy(query_id, candidate_id).agg(F.count("*").alias("shared"))


def hash_rescue(queries: DataFrame, candidates: DataFrame, query_hash: Column, candidate_hash: Column) -> DataFrame:
    return queries.withColumn("_h", query_hash).join(candidates.withColumn("_g", candidate_hash), F.col("_h") == F.col("_g")).drop("_g").withColumnRenamed("_h", "address_hash")


def sibling_bag(candidates: DataFrame, *, pool: list[str], entity: str, name: Column, out: str = "names") -> DataFrame:
    """Distinct names of all rows of the same entity in the pool, sorted, aggregated map-side and joined back."""
    bags = candidates.groupBy(*pool, entity).agg(F.array_join(F.array_sort(F.collect_set(name)), " ").alias(out))
    return candidates.join(bags, [*pool, entity])


def expand_entities(found: DataFrame, candidates: DataFrame, *, query_id: str, entity: str, candidate_id: str, bucket: Column, order: list, per_entity: int, cap: int) -> DataFrame:
    """Other rows of the entities found, not found yet; at most `per_entity` an entity, then `cap` a query.

    Order: bucket (0 same commune, 1 same postcode, 2 elsewhere), then `order`, then the id.
    """
    seeds = found.select(query_id, entity, *[c for c in found.columns if c.startswith("q_")]).distinct()
    more = seeds.join(candidates, entity).join(found.select(query_id, candidate_id), [query_id, candidate_id], "left_anti").withColumn("bucket", bucket)
    more = ranked(more, [query_id, entity], ["bucket", *order, candidate_id], "_n").where(F.col("_n") <= per_entity).drop("_n")
    return ranked(more, [query_id], ["bucket", *order, candidate_id], "rank").where(F.col("rank") <= cap)


def address_density(pool: DataFrame, *, by: list[str], address: str) -> DataFrame:
    """How many candidates of a pool share the address; 1 for an empty one."""
    counts = pool.where(F.col(address) != "").groupBy(*by, address).agg(F.count("*").alias("density"))
    return pool.join(counts, [*by, address], "left").withColumn("density", F.coalesce("density", F.lit(1)))


def category_filter(pool: DataFrame, *, query_id: str, match: Column, order: list, cap: int) -> DataFrame:
    """Matching candidates, or all of a query that has none; at most `cap`, in order."""
    any_ = F.max(F.coalesce(match, F.lit(False)).cast("int")).over(Window.partitionBy(query_id))
    kept = pool.withColumn("_any", any_).where(F.coalesce(match, F.lit(False)) | (F.col("_any") == 0)).drop("_any")
    return ranked(kept, [query_id], order, "place").where(F.col("place") <= cap)


def loss_reason(*, found: Column, in_partition: Column, closed: Column, unnamed: Column, prefiltered: Column, pruned: Column) -> Column:
    return F.when(found, F.lit(None).cast("string")).when(~in_partition, "NOT_IN_PARTITION").when(closed, "FILTERED_CLOSED").when(unnamed, "FILTERED_UNNAMED").when(prefiltered, "PRUNED_BY_PREFILTER").when(pruned, "PRUNED_BY_TFIDF").otherwise("FILTERED_OTHER")
