"""Mixing sources to target weights with a time-varying curriculum. DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import WORD

#: Knots (time, weight) of the schedules that sources take in turn: fading, steady, rising.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 0.75), (1.0, 2.0)))


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def invert(u: Column, knots) -> Column:
    """The time at which a source with this weight schedule has used the share `u` of its tokens.

    The weight is linear between knots, so its integral is quadratic there and has a closed inverse.
    """
    areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:])]
    total, done, out = sum(areas), 0.0, F.lit(float(knots[-1][0]))
    steps = []
    for ((t0, w0), (t1, w1)), area in zip(zip(knots, knots[1:]), areas):
        rest, slope = u * total - done, (w1 - w0) / (t1 - t0)
        inside = (F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * rest, F.lit(0.0))) - w0) / slope if slope else rest / w0
        done += area
        steps.append((done / total, t0 + inside))
    for end, value in reversed(steps):
        out = F.when(u <= end, value).otherwise(out)
    return out


def targets(sizes: DataFrame, weights=(1, 2, 3), cap: int = 3) -> DataFrame:
    """Per source: weight by code-point order (null last), and the water-filled target, at most `cap` times its size.

    `sizes` has (source, source_size), a row per source, so the window without a key sees one row per source.
    """
    every = Window.partitionBy(F.lit(0))
    place = F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())) - 1
    s = sizes.withColumn("place", place).withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")))
    s = s.withColumn("limit", (F.col("source_size") * cap).cast("double"))
    order = every.orderBy(F.col("limit") / F.col("weight"), "place")
    s = s.withColumn("before", F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    s = s.withColumn("rest", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    s = s.withColumn("level", (F.sum(F.col("source_size").cast("double")).over(every) - F.col("before")) / F.col("rest"))
    s = s.withColumn("open", F.col("limit") / F.col("weight") > F.col("level"))
    s = s.withColumn("share", F.min(F.when(F.col("open"), F.struct(F.col("limit") / F.col("weight"), "place", "level"))).over(every)["level"])
    return s.select("source", "place", "source_size", F.when(F.col("open"), F.col("share") * F.col("weight")).otherwise(F.col("limit")).alias("target"))


def _part(p: int) -> Column:
    """Words that pass `p` of the source's stream takes of a document."""
    m = lambda c: F.col(f"mix.{c}")
    return F.greatest(F.lit(0), F.least(m("size"), m("total") - m("source_size") * p - m("before"))).cast("long")


def _time(p: Column | int, part: Column, schedules) -> Column:
    """Training position of the middle of what a pass takes: the inverse of the source's integrated schedule."""
    u = (F.col("mix.before") + F.col("mix.source_size") * p + part / 2) / F.col("mix.target")
    out = F.lit(None).cast("double")
    for i, knots in enumerate(schedules):
        out = F.when((part > 0) & (F.col("mix.place") % len(schedules) == i), invert(u, knots)).otherwise(out)
    return out


def mix(docs: DataFrame, *, text: str = "text", size: str | None = None, source: str = "source", key: str = "doc_id", weights=(1, 2, 3), cap: int = 3, schedules=SCHEDULES) -> DataFrame:
    """Every row of `docs` plus a struct `mix`: size, source_size, place, target, before, total, taken, position.

    A source's documents form a stream ordered by the md5 of their key; the mix takes the stream from its start,
    again and again, until `target` words are taken: `taken` counts a document's words over all passes, at most
    `cap` times its size, and at most one document of a source is cut. A document's `position` in training, 0 to 1,
    is the inverse of its source's integrated weight schedule at the middle of its first pass, null if nothing of
    it is taken. `size` names a column that holds the words already, where `docs` has one.

    Prefix sums run in two levels: per (source, leading digits of the md5) and within these; the digits follow the
    number of rows, so a source with a third of all rows is dealt over many tasks.

    Null texts and texts without words have size 0 and are taken 0 times; a null source is a source of its own,
    the last; null keys count as the empty string; rows with equal keys are ordered by size, and equal rows are
    interchangeable; an empty table gives an empty result. Columns of `docs` named like ours stay untouched, since
    ours are inside the struct; `docs` may not have a column `mix`.
    """
    digits = max(1, math.ceil(math.log(max(docs.count(), 2), 256)))
    words = F.col(f"`{size}`").cast("long") if size else size_of(F.col(f"`{text}`"))
    h = F.md5(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).cast("binary"))
    slim = docs.select(F.col(f"`{source}`").alias("source"), words.alias("size"), F.substring(h, 1, digits).alias("bin"))
    bins = slim.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"))
    goals = targets(bins.groupBy("source").agg(F.sum("bin_size").alias("source_size")), weights, cap)
    ahead = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("bin_before", F.coalesce(F.sum("bin_size").over(ahead), F.lit(0))).drop("bin_size")
    bins = bins.join(goals, bins["source"].eqNullSafe(goals["source"])).select(bins["source"].alias("bin_source"), bins["bin"].alias("bin_bin"), "bin_before", "place", "source_size", "target")

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    base = docs.select(row.alias("row"), F.col(f"`{source}`").alias("source"), words.alias("size"), h.alias("h"), F.substring(h, 1, digits).alias("bin"))
    inner = Window.partitionBy("source", "bin").orderBy("h", "size").rowsBetween(Window.unboundedPreceding, -1)
    base = base.withColumn("inner", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    both = base.join(bins, base["source"].eqNullSafe(bins["bin_source"]) & (F.col("bin") == F.col("bin_bin")))
    both = both.select("row", F.struct("size", "source_size", "place", "target", (F.col("inner") + F.col("bin_before")).alias("before"), F.round("target").cast("long").alias("total")).alias("mix"))
    taken = sum((_part(p) for p in range(1, cap)), _part(0))
    return both.select("row", F.col("mix").withField("taken", taken).withField("position", _time(0, _part(0), schedules)).alias("mix")).select("row.*", "mix")


def leading_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word, as it is written."""
    return F.array_join(F.slice(F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"), F.lit(1), F.greatest(n, F.lit(1)).cast("int")), "")


def mixed_documents(docs: DataFrame, *, text: str = "text", key: str = "doc_id", cap: int = 3, schedules=SCHEDULES, **options) -> DataFrame:
    """The training stream: `docs`, each row once for every pass that takes it, range-sorted by training position.

    The one document of a source that the end of its stream cuts keeps its leading words. Columns as in `docs`;
    odd inputs as in `mix`, so documents without words don't occur.
    """
    m = mix(docs, text=text, key=key, cap=cap, schedules=schedules, **options)
    passes = F.filter(F.array(*[F.struct(F.lit(p).alias("p"), _part(p).alias("n")) for p in range(cap)]), lambda x: x["n"] > 0)
    m = m.withColumn("mix_pass", F.explode(passes)).withColumn("mix_time", _time(F.col("mix_pass.p"), F.col("mix_pass.n"), schedules))
    whole = F.col(f"`{text}`")
    cut_text = F.when(F.col("mix_pass.n") < F.col("mix.size"), leading_words(whole, F.col("mix_pass.n"))).otherwise(whole)
    m = m.repartitionByRange("mix_time", f"`{key}`").sortWithinPartitions("mix_time", f"`{key}`")
    return m.select(*[cut_text.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
