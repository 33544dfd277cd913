"""Looking candidates up by number, enriching raw candidates, and deciding on outside evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fields as R
from ..functions import similarity as S
from ..functions import text as T
from .blocking import keep_first, ranked


def truth(rows: DataFrame) -> DataFrame:
    """(crm_id, siret_gt) of a table in any of the known layouts: labelled candidates, of which those labelled 1 count,
    or one truth a row under one of several names."""
    c = set(rows.columns)
    id_ = F.col("crm_id" if "crm_id" in c else "query_id").cast("string").alias("crm_id")
    if {"label", "siret"} <= c:
        return rows.where(F.col("label").cast("string") == "1").select(id_, F.col("siret").alias("siret_gt"))
    name = next((n for n in ("siret_gt", "siret", "ground_truth_siret", "gt_siret") if n in c), None)
    if name is None:
        raise ValueError("no truth in columns " + ", ".join(rows.columns))
    return rows.select(id_, F.col(name).alias("siret_gt"))


def truth_sets(rows: DataFrame, query: str, siret: str) -> DataFrame:
    """The valid numbers of each query and their first nine digits, sorted; null numbers don't count."""
    return rows.groupBy(query).agg(F.array_sort(F.collect_set(siret)).alias("valid_sirets"), F.array_sort(F.collect_set(F.substring(siret, 1, 9))).alias("valid_sirens"))


def judged(routed: DataFrame, sets: DataFrame, query: str, chosen: str) -> DataFrame:
    """Routed rows with strict and same-entity correctness, and whether there is a truth."""
    j = routed.join(sets, query, "left")
    inside = lambda a, x: F.coalesce(F.array_contains(a, x), F.lit(False))
    return j.withColumns({"strict": inside("valid_sirets", F.col(chosen)), "same": inside("valid_sirens", F.substring(chosen, 1, 9)), "has_truth": F.col("valid_sirets").isNotNull()}).drop("valid_sirets", "valid_sirens")


def with_suffix(left: DataFrame, right: DataFrame, key: str, suffix: str) -> DataFrame:
    """Left rows with the columns of `right`, of which those that clash get a suffix."""
    clash = {c: f"{c}{suffix}" for c in right.columns if c != key and c in left.columns}
    return left.join(right.withColumnsRenamed(clash), key, "left")


def by_number(keys: DataFrame, sites: DataFrame, *, key: str, state: str, order: str, most: int = 20) -> DataFrame:
    """Sites of each key: the open ones, all if none is open; at most `most`, in order of the site number."""
    j = keys.select(key).distinct().join(sites, key)
    j = ranked(j, [key], [F.when(F.col(state) == "A", 0).otherwise(1), order], "_place")
    first = keep_first(j, [key], ["_place"]).select(key, (F.col(state) == "A").alias("_open"))
    return j.join(first, key).where((F.col("_place") <= most) & (~F.coalesce("_open", F.lit(False)) | (F.col(state) == "A"))).drop("_place", "_open")


def enriched(groups: DataFrame, sites: DataFrame, *, siret: str = "siret", siren: str = "siren", state: str = "state", most: int = 20) -> DataFrame:
    """Grouped raw candidates (key_type, value, label, sources) as site rows, with how each was found.

    A site number finds its site or stays as a bare row; an entity number finds its open sites, else closed ones; an
    entity that has none is dropped.
    """
    g = groups.where("key_type = 'siret'").join(sites.withColumnRenamed(siret, "value"), "value", "left").select("value", F.col("value").alias(siret), F.coalesce(siren, F.lit("INCONNU")).alias(siren), F.when(F.col(state).isNull(), F.coalesce("label", F.lit("NOM_INCONNU"))).otherwise(F.col("name")).alias("name"), "sources", F.when(F.col(state).isNull(), "fallback").otherwise("exact").alias("found"))
    units = groups.where("key_type = 'siren'").select(F.col("value").alias(siren), "value", "sources")
    found = by_number(units, sites, key=siren, state=state, order=siret, most=most)
    more = units.join(found, siren).select("value", siret, siren, "name", "sources", F.when(F.col(state) == "A", "open").otherwise("closed").alias("found"))
    return g.unionByName(more)


def best_web_rank(raw: DataFrame, by: list[str], source: str, rank: str) -> DataFrame:
    """Per key, for each web source its best rank, as a map."""
    m = raw.where(F.col(source).startswith("WEB_") & F.col(rank).isNotNull()).groupBy(*by, source).agg(F.min(rank).alias("_r"))
    return m.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(source, "_r")))).alias("web_ranks"))


def entity_sources(raw: DataFrame, entity: str, source: str) -> DataFrame:
    return raw.where(F.col(source).startswith("WEB_") & F.col(entity).isNotNull()).groupBy(entity).agg(F.array_sort(F.collect_set(source)).alias("entity_sources"))


def web_evidence(pairs: DataFrame) -> DataFrame:
    """Evidence that a web candidate stands for a query row. Columns: crm_* and cand_* insee, postcode, city, address,
    and sources (array), web_rank."""
    c = F.col
    both = lambda x: R.agrees(c(f"crm_{x}"), c(f"cand_{x}"))
    a, b = T.normalize_text(c("crm_address")), T.normalize_text(c("cand_address"))
    p = pairs.withColumns({"_a": T.street_of_address(a), "_b": T.street_of_address(b)})
    p = p.withColumn("street_name_jaro", S.jaro_winkler(c("_a"), c("_b"))).drop("_a", "_b")
    n, m = T.street_number(a), T.street_number(b)
    p = p.withColumns({
        "geo_ok": both("insee") & both("postcode") & R.agrees(F.nullif(T.normalize_text(c("crm_city")), F.lit("")), F.nullif(T.normalize_text(c("cand_city")), F.lit(""))),
        "addr_overlap": S.jaccard(F.array_distinct(T.tokens(a)), F.array_distinct(T.tokens(b))),
        "num_diff": S.number_gap(n, m),
        "multi_site": F.size("sources") >= 2,
        "has_directory": F.array_contains("sources", "WEB_ANNUAIRE"),
    })
    known = c("num_diff") != 9999.0
    level = lambda jaro, overlap, gap: c("geo_ok") & (c("street_name_jaro") >= jaro) & (c("addr_overlap") >= overlap) & (~known | (c("num_diff") <= gap))
    score = c("street_name_jaro") + c("addr_overlap") + F.when(c("multi_site"), 0.5).otherwise(0.0) + F.when(c("has_directory"), 0.2).otherwise(0.0)
    score = score - F.when(known, F.least(c("num_diff"), F.lit(5.0)) * 0.05).otherwise(0.0) + F.coalesce(F.greatest(F.lit(0.0), 0.15 - c("web_rank") * 0.02), F.lit(0.0))
    return p.withColumns({"strict_addr": level(0.90, 0.50, 2), "very_strict_addr": level(0.95, 0.60, 1)}).withColumn("web_score", score)


def web_choice(evidence: DataFrame, *, query: str, candidate: str, strict: bool) -> DataFrame:
    """The eligible candidate of the highest score a query, its confidence, and how many were eligible."""
    c = F.col
    fine = c("multi_site") & c("very_strict_addr") if strict else (c("multi_site") & c("strict_addr")) | (c("has_directory") & c("very_strict_addr"))
    e = evidence.where(c("geo_ok") & fine & c(candidate).isNotNull())
    n = e.groupBy(query).agg(F.count("*").alias("n_eligible"))
    best = keep_first(e, [query], [F.desc("web_score"), candidate])
    ladder = F.when(c("multi_site") & c("very_strict_addr"), 0.95).when(c("multi_site"), 0.90).otherwise(F.lit(0.90) if strict else F.lit(0.88))
    return best.withColumn("confidence", ladder).join(n, query)


def match_decision(replies: DataFrame, valid: DataFrame, *, query: str, reply: str, siret: str) -> DataFrame:
    """Replies (JSON within text) as decision, chosen number, confidence within 0 to 1, and an error.

    A best match needs a number among the query's candidates; another number makes it no match."""
    r = replies.withColumn("_r", R.json_object(F.col(reply), "decision string, confidence string, chosen_siret string, reason string"))
    known = valid.select(query, F.col(siret).alias("_chosen")).distinct().withColumn("_known", F.lit(True))
    r = r.withColumn("_chosen", F.nullif(F.col("_r.chosen_siret"), F.lit(""))).join(known, [query, "_chosen"], "left")
    d, conf = F.col("_r.decision"), F.col("_r.confidence").try_cast("double")
    best = d == "BEST_MATCH"
    error = F.when(F.col("_r").isNull(), "NO_JSON").when(d.isNull(), "NO_DECISION").when(~d.isin("BEST_MATCH", "NO_MATCH"), "BAD_DECISION").when(F.col("_r.confidence").isNull(), "NO_CONFIDENCE").when(conf.isNull(), "BAD_CONFIDENCE").when(best & F.col("_chosen").isNull(), "NO_SIRET")
    unknown = best & F.col("_known").isNull()
    r = r.withColumn("error", error)
    ok = F.col("error").isNull()
    return r.select(query, "error", F.when(ok, F.when(unknown, "NO_MATCH").otherwise(d)).alias("decision"), F.when(ok & best & ~unknown, F.col("_chosen")).alias("chosen_siret"), F.when(ok, F.when(unknown, 0.0).otherwise(F.least(F.greatest(conf, F.lit(0.0)), F.lit(1.0)))).alias("confidence"))


def match_prompt(queries: DataFrame, candidates: DataFrame, *, query: str, title: Column, line: Column, order: str, most: int = 20) -> DataFrame:
    """One prompt a query: its title, then a numbered line for each of its candidates."""
    c = ranked(candidates, [query], [order], "_n").where(F.col("_n") <= most).select(query, F.struct("_n", F.concat(F.col("_n").cast("string"), F.lit(". "), line).alias("_line")).alias("_s"))
    lines = c.groupBy(query).agg(F.array_join(F.transform(F.array_sort(F.collect_list("_s")), lambda s: s["_line"]), "\n").alias("_lines"))
    return queries.join(lines, query, "left").select(query, F.concat_ws("\n", title, F.coalesce("_lines", F.lit("-"))).alias("prompt"))


def recovery_status(wanted: DataFrame, known: DataFrame, attempts: DataFrame, *, key: str, most: int = 3) -> DataFrame:
    """What is still to be fetched of `wanted`: status done, not_found, failed or open, and whether to try again."""
    done = known.select(key).distinct().withColumn("_done", F.lit(True))
    tried = attempts.groupBy(key).agg(F.count("*").alias("attempts"), F.max_by("status", "attempt").alias("last"))
    j = wanted.select(key).distinct().join(done, key, "left").join(tried, key, "left")
    status = F.when(F.col("_done"), "done").when(F.col("last") == "not_found", "not_found").when(F.col("last") == "failed", "failed").otherwise("open")
    j = j.withColumn("status", status).withColumn("attempts", F.coalesce("attempts", F.lit(0)))
    return j.select(key, "status", "attempts", (F.col("status").isin("open", "failed") & (F.col("attempts") < most)).alias("retry"))


def dense_scopes(scopes: DataFrame) -> DataFrame:
    """Scopes too large to page through that were not split further yet."""
    return scopes.where("total_results >= 10000 AND pages_fetched = 0 AND scope_key LIKE '%EA:%' AND scope_key NOT LIKE '%NAF:%'")


def communes(rows: DataFrame, representatives: DataFrame, *, insee: str, postcode: str, city: Column, ordinal: str) -> DataFrame:
    """Distinct places in the order seen: by commune code with its most frequent postcode and city, else by postcode, else by city."""
    r = rows.select(F.col(ordinal).alias("_o"), R.present(F.col(insee)).alias("_i"), R.present(F.col(postcode)).alias("_p"), city.alias("_c"))
    kind = F.when(F.col("_i").isNotNull(), "insee").when(F.col("_p").isNotNull(), "postcode").when(F.col("_c").isNotNull(), "city")
    code = F.coalesce("_i", "_p", "_c")
    first = r.withColumns({"kind": kind, "code": code}).where("kind is not null").groupBy("kind", "code").agg(F.min("_o").alias("first_seen"))
    reps = representatives.select(F.lit("insee").alias("kind"), F.col(insee).alias("code"), F.col(postcode).alias("_rp"), F.col("city").alias("_rc"))
    out = first.join(reps, ["kind", "code"], "left")
    pick = lambda k, other: F.when(F.col("kind") == k, F.col("code")).when(F.col("kind") == "insee", F.col(other))
    return out.select("first_seen", "kind", F.when(F.col("kind") == "insee", F.col("code")).alias("insee"), pick("postcode", "_rp").alias("postcode"), pick("city", "_rc").alias("city"))


def ordered_codes(codes: DataFrame, *, code: str = "code", count: str = "row_count", by_size: bool = False, mega_first: bool = False, mega: int = 100_000, least: int = 0) -> DataFrame:
    """Partition codes with the place in which they are worked on; codes without a count go where counts matter."""
    c = codes.where(F.col(count).isNotNull() & (F.col(count) >= least))
    order = ([F.col(count) < mega] if mega_first else []) + ([F.desc(count)] if by_size else [])
    return ranked(c.withColumn("_all", F.lit(0)), ["_all"], [*order, code], "place").drop("_all")
