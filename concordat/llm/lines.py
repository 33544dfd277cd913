"""Line dedup over overlapping three-line windows. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def line_dedup(docs: DataFrame, *, text: str = "text", key: str = "doc_id", window: int = 3) -> DataFrame:
    """Every row of `docs` plus a struct `dedup`: text (what stays), n_lines, n_removed.

    Lines are what stands between newlines. Every `window` consecutive lines, not all blank, are hashed to 128 bits;
    a window's first occurrence is the one with the smallest (key, hash of the text, line), null keys first. Lines
    covered by any later occurrence of a window go, in the same document too; overlapping windows cover the union.
    Windows are judged on the input, not on what is left. So a copy of a whole document of `window` lines or more
    loses all its lines: its text becomes the empty string and the row stays.

    Null texts have 0 lines and stay null; the empty text has one line; texts of fewer lines than `window` stay as
    they are; rows that share key and text count as one document and get one result; an empty table gives an empty
    result. `docs` may have columns of any names but `dedup`.
    """
    t, id_ = F.col(f"`{text}`"), F.col(f"`{key}`")
    lines = F.split(t, "\n", -1)
    starts = F.when(F.size(lines) >= window, F.sequence(F.lit(0), F.size(lines) - window)).otherwise(F.array().cast("array<int>"))

    def hashed(i):
        w = [F.element_at("lines", i + 1 + k) for k in range(window)]
        blank = F.lit(True)
        for x in w:
            blank &= F.trim(x) == ""
        return F.when(~blank, F.struct(i.alias("i"), F.xxhash64(*w).alias("h1"), F.xxhash64(F.lit(window), *w[::-1]).alias("h2")))

    d = docs.where(t.isNotNull() & t.contains("\n")).select(id_.alias("id"), F.xxhash64(t).alias("th"), lines.alias("lines"), starts.alias("starts"))
    found = d.select("id", "th", F.explode(F.filter(F.transform("starts", hashed), lambda x: x.isNotNull())).alias("w")).select("id", "th", F.col("w.i").alias("i"), F.col("w.h1").alias("h1"), F.col("w.h2").alias("h2"))
    place = F.struct("id", "th", "i")
    first = found.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").drop("last")
    later = found.join(first, ["h1", "h2"]).where(place > F.col("first"))
    covered = later.groupBy("id", "th").agg(F.collect_set("i").alias("starts"))
    covered = covered.select(F.col("id").alias("c_id"), F.col("th").alias("c_th"), F.array_distinct(F.flatten(F.transform("starts", lambda i: F.sequence(i, i + window - 1)))).alias("gone"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    both = docs.select(row.alias("row"), id_.alias("id"), F.xxhash64(t).alias("th"), t.alias("t")).join(covered, F.col("id").eqNullSafe(F.col("c_id")) & (F.col("th") == F.col("c_th")), "left")
    parts = F.split("t", "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("gone"))
    left = F.when(F.col("gone").isNull(), F.col("t")).otherwise(F.array_join(F.transform(stay, lambda i: F.element_at(parts, i + 1)), "\n"))
    n = F.when(F.col("t").isNull(), 0).otherwise(F.size(parts)).cast("long")
    # The struct first, the row's columns after: names inside lambdas would find columns of the row.
    return both.select("row", F.struct(left.alias("text"), n.alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed")).alias("dedup")).select("row.*", "dedup")
