"""Evaluation: retrieval, ranking, calibration, routing and cost measures. Each is one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hit_at_k(ranked: DataFrame, *, query: str, label: str, ks: list[int]) -> DataFrame:
    per = ranked.groupBy(query).agg(F.min(F.when(F.col(label) == 1, F.col("rank"))).alias("first"))
    return per.agg(F.count("*").alias("queries"), *[F.round(F.avg((F.coalesce("first", F.lit(1 << 30)) <= k).cast("double")), 6).alias(f"hit_{k}") for k in ks], F.round(F.avg(F.coalesce(1 / F.col("first"), F.lit(0.0))), 6).alias("mrr"))


def bins(score: Column, n: int) -> Column:
    """Left-open bins of equal width; 0 and less are in the first."""
    return F.least(F.greatest(F.ceil(score * n) - 1, F.lit(0)), F.lit(n - 1)).cast("int")


def calibration_bins(rows: DataFrame, *, score: str, label: str, n: int = 10) -> DataFrame:
    """Every bin, empty ones as 0."""
    g = rows.groupBy(bins(F.col(score), n).alias("bin")).agg(F.count("*").alias("n"), F.avg(score).alias("mean_score"), F.avg(F.col(label).cast("double")).alias("rate"))
    every = rows.sparkSession.range(n).select(F.col("id").cast("int").alias("bin"))
    return every.join(g, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"), *[F.round(F.coalesce(c, F.lit(0.0)), 6).alias(c) for c in ("mean_score", "rate")])


def probability_errors(rows: DataFrame, *, score: str, label: str, n: int = 10) -> DataFrame:
    """Brier score, log loss and expected calibration error."""
    s, y = F.col(score), F.col(label).cast("double")
    p = F.least(F.greatest(s, F.lit(1e-15)), F.lit(1 - 1e-15))
    per = rows.groupBy(bins(s, n).alias("bin")).agg(F.count("*").alias("n"), F.sum(s).alias("s"), F.sum(y).alias("y"), F.sum((s - y) ** 2).alias("b"), F.sum(-(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("l"))
    return per.agg(F.round(F.sum("b") / F.sum("n"), 6).alias("brier"), F.round(F.sum("l") / F.sum("n"), 6).alias("log_loss"), F.round(F.sum(F.abs(F.col("s") - F.col("y"))) / F.sum("n"), 6).alias("ece"))


def area_under_curve(rows: DataFrame, *, score: str, label: str) -> DataFrame:
    """Exact, from counts per distinct score: ties count half. No task sees all scores."""
    per = prefix_counts(rows, score=score, label=label)
    return per.agg(F.round(F.sum(F.col("p") * (F.col("n_before") + F.col("n") / 2)) / (F.sum("p") * F.sum("n")), 6).alias("auc"))


def threshold_sweep(rows: DataFrame, *, score: str, correct: Column, thresholds: list[float], target: float) -> DataFrame:
    """For each threshold: accepted, wrong, rates; `best` marks the highest rate whose errors stay within the target.

    The grid is a short list of literals, exploded row-side and aggregated map-side.
    """
    grid = F.array(*[F.lit(t) for t in thresholds])
    one = rows.select(F.col(score).alias("s"), correct.alias("ok"), F.explode(grid).alias("threshold"))
    g = one.groupBy("threshold").agg(F.count("*").alias("total"), F.count_if(F.col("s") >= F.col("threshold")).alias("accepted"), F.count_if((F.col("s") >= F.col("threshold")) & ~F.col("ok")).alias("wrong"))
    g = g.withColumns({"auto_rate": F.round(F.col("accepted") / F.col("total"), 6), "fp_rate": F.round(F.coalesce(F.col("wrong") / F.nullif(F.col("accepted"), F.lit(0)), F.lit(0.0)), 6)})
    place = F.row_number().over(Window.orderBy((F.col("fp_rate") > target).cast("int"), F.when(F.col("fp_rate") > target, F.col("fp_rate")).otherwise(0.0), F.desc("auto_rate"), "threshold"))
    return g.withColumn("best", place == 1)


def cost_grid(top1: DataFrame, *, score: str, gap: str, thresholds: list[float], gaps: list[float], daily: int, free: int = 2500, per_call: float = 0.001, other: float = 0.017) -> DataFrame:
    grid = F.array(*[F.struct(F.lit(t).alias("threshold"), F.lit(g).alias("gap_min")) for t in thresholds for g in gaps])
    one = top1.select(F.col(score).alias("s"), F.coalesce(F.col(gap), F.lit(0.0)).alias("g"), F.explode(grid).alias("c"))
    g = one.groupBy("c.threshold", "c.gap_min").agg(F.count("*").alias("total"), F.count_if((F.col("s") >= F.col("c.threshold")) & (F.col("g") >= F.col("c.gap_min"))).alias("auto_count"))
    g = g.withColumn("review_count", F.col("total") - F.col("auto_count")).withColumn("monthly_calls", F.floor(F.col("review_count") * F.lit(daily) * 30 / F.col("total")))
    return g.withColumns({"auto_rate": F.round(F.col("auto_count") / F.col("total"), 6), "monthly_cost": F.round(F.greatest(F.col("monthly_calls") - free, F.lit(0)) * per_call, 6), "monthly_cost_other": F.round(F.col("monthly_calls") * other, 6)})


def routing_measures(routed: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Of rows (status, strict, same): counts, rates, precision, errors; over segments too if `by` is given."""
    auto, right = F.col("status") == "AUTO", F.coalesce(F.col("strict"), F.lit(False))
    same = F.coalesce(F.col("same"), F.lit(False))
    measures = [F.count("*").alias("total"), F.count_if(auto).alias("auto"), F.count_if(auto & right).alias("auto_right"), F.count_if(auto & same).alias("auto_same"), F.count_if(~auto & right).alias("review_right"), F.count_if(right).alias("right")]
    g = routed.rollup(*by).agg(*measures, *[F.grouping(b).alias(f"all_{b}") for b in by]) if by else routed.agg(*measures)
    rate = lambda a, b: F.round(F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0)), 6)
    return g.withColumns({"auto_rate": rate("auto", "total"), "precision": rate("auto_right", "auto"), "precision_same": rate("auto_same", "auto"), "fp_rate": F.round(F.when(F.col("auto") > 0, 1 - F.col("auto_right") / F.col("auto")).otherwise(0.0), 6), "fn_rate": rate("review_right", "right")})


def timer_percentiles(rows: DataFrame, *, by: str, value: str) -> DataFrame:
    p = F.expr(f"percentile({value}, array(0.5, 0.95, 0.99))")
    g = rows.groupBy(by).agg(F.count(value).alias("n"), F.sum(value).alias("total"), p.alias("p"))
    return g.select(by, "n", F.round("total", 4).alias("total"), F.round(F.col("total") / F.col("n"), 6).alias("mean"), *[F.round(F.col("p")[i], 6).alias(c) for i, c in enumerate(("p50", "p95", "p99"))])


def promoted_hit_at_k(scored: DataFrame, *, query: str, candidate: str, entity: str, closed: Column, label: str, ks: list[int]) -> DataFrame:
    """Hits after open rows have taken the place of closed ones of their entity."""
    from .scoring import promote_open, top_k

    return hit_at_k(promote_open(top_k(scored, query=query, candidate=candidate, k=1 << 30), query=query, entity=entity, closed=closed), query=query, label=label, ks=ks)


def average_precision(rows: DataFrame, *, score: str, label: str, cells: int = 256) -> DataFrame:
    """The sum of precision at each distinct score times the recall it adds. Counts run in two levels, cells of scores and
    scores within a cell, so no task sees all scores."""
    per = prefix_counts(rows, score=score, label=label, cells=cells, ascending=False)
    seen = F.col("p_before") + F.col("p") + F.col("n_before") + F.col("n")
    return per.agg(F.round(F.sum(F.col("p") * (F.col("p_before") + F.col("p")) / seen) / F.sum("p"), 6).alias("average_precision"))


def prefix_counts(rows: DataFrame, *, score: str, label: str, cells: int = 256, ascending: bool = True) -> DataFrame:
    """Per distinct score: rows labelled 1 and not, and how many of each come before it. Scores fall into ranges of equal
    width over their extent: one window runs within a range, one over the ranges."""
    s = F.col(score).cast("double")
    per = rows.groupBy(s.alias("s")).agg(F.sum((F.col(label) == 1).cast("long")).alias("p"), F.sum((F.col(label) != 1).cast("long")).alias("n"))
    ends = per.agg(F.min("s").alias("low"), F.max("s").alias("high"))
    cell = F.when(F.col("high") > F.col("low"), F.floor((F.col("s") - F.col("low")) / (F.col("high") - F.col("low")) * cells)).otherwise(F.lit(0)).cast("int")
    per = per.join(F.broadcast(ends)).withColumn("cell", cell).drop("low", "high")
    order = (lambda c: F.col(c).asc()) if ascending else (lambda c: F.col(c).desc())
    before = lambda c, w: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    over = Window.partitionBy(F.lit(0)).orderBy(order("cell"))  # one row a cell
    sums = per.groupBy("cell").agg(F.sum("p").alias("cp"), F.sum("n").alias("cn"))
    sums = sums.select("cell", before("cp", over).alias("cp"), before("cn", over).alias("cn"))
    inner = Window.partitionBy("cell").orderBy(order("s"))
    per = per.withColumns({"_p": before("p", inner), "_n": before("n", inner)}).join(F.broadcast(sums), "cell")
    return per.select("s", "p", "n", (F.col("_p") + F.col("cp")).alias("p_before"), (F.col("_n") + F.col("cn")).alias("n_before"))


def uneven_calibration(rows: DataFrame, *, score: str, label: str, edges: list[float]) -> DataFrame:
    """Expected calibration error over left-open bins between the edges; scores beyond them fall out, but are counted."""
    s = F.col(score).cast("double")
    place = F.lit(None).cast("int")
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        place = F.when((s > low) & (s <= high), i).otherwise(place)
    per = rows.groupBy(place.alias("bin")).agg(F.count("*").alias("n"), F.avg(s).alias("s"), F.avg(F.col(label).cast("double")).alias("y"))
    return per.agg(F.round(F.sum(F.when(F.col("bin").isNotNull(), F.col("n") * F.abs(F.col("s") - F.col("y")))) / F.sum("n"), 6).alias("ece"))


def paired_recall(ranked_rows: DataFrame, queries: DataFrame, *, query: str, found: str, own: str, ks: list[int]) -> DataFrame:
    """Recall at k and mean reciprocal rank of each query's own positive among its ranked rows (query, found, rank)."""
    hit = queries.select(query, own).join(ranked_rows.select(query, F.col(found).alias(own), "rank"), [query, own], "left")
    return hit.agg(F.count("*").alias("queries"), *[F.round(F.avg((F.coalesce("rank", F.lit(1 << 30)) <= k).cast("double")), 6).alias(f"recall_{k}") for k in ks], F.round(F.avg(F.when(F.col("rank") <= max(ks), 1 / F.col("rank")).otherwise(0.0)), 6).alias("mrr"))


def places_measures(rows: DataFrame, cost_per_call: float) -> DataFrame:
    """Of rows (segment, status, final_status, places_status, correct) that have a truth: matches by places, precision, what
    the address guard held back, calls and cost; per segment and over all."""
    c = F.col
    match, ok = c("final_status") == "MATCH_PLACES", F.coalesce(c("correct"), F.lit(False))
    held = (c("places_status") == "MATCH_PLACES") & (c("final_status") == "NO_MATCH")
    g = rows.rollup("segment").agg(F.count("*").alias("total"), F.count_if(match).alias("matched"), F.count_if(match & ok).alias("matched_right"), F.count_if(c("final_status") == "NO_MATCH").alias("no_match"), F.count_if(held).alias("held"), F.count_if(held & ~ok).alias("held_rightly"), F.count_if(c("status").startswith("REVIEW")).alias("calls"))
    return g.withColumns({"precision": F.round(F.coalesce(c("matched_right") / F.nullif(c("matched"), F.lit(0)), F.lit(0.0)), 6), "cost": F.round(c("calls") * cost_per_call, 6)})


def table_counts(named: dict[str, DataFrame]) -> DataFrame:
    """One row with the number of rows of each table: counts of a row each, set side by side."""
    out = None
    for name, df in named.items():
        n = df.agg(F.count("*").alias(f"n_{name}"))
        out = n if out is None else out.crossJoin(n)
    return out
