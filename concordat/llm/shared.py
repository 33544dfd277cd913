"""What several operators share: connected components, and a sieve of keys."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..staging import cut, work_folder  # noqa: F401

#: A word: a run of anything but space, tab, newline, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def is_empty(df: DataFrame) -> bool:
    return not df.limit(1).count()


def held_out(key: Column) -> Column:
    """True for the fifth of the rows whose labels no classifier sees; a null key is in the other part."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of `edges` (a, b): component is the smallest node reachable.

    Contraction: each node takes the smallest node next to it, edges move to these, loops go. Every round at least
    halves the nodes that are left, so the number of rounds is logarithmic. Minima are aggregated map-side, so a
    node with very many edges isn't gathered in one task. Then the maps are followed from first to last.
    """
    spark = edges.sparkSession
    edges = cut(edges.select("a", "b").where("a <> b").distinct())
    maps = []
    while not is_empty(edges):
        if len(maps) == rounds:
            raise RuntimeError("components: no end after %d rounds" % rounds)
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("next")).union(edges.select("b", "a"))
        step = cut(both.groupBy("node").agg(F.least(F.col("node"), F.min("next")).alias("to")))
        # A node whose neighbours all moved on points at one that points further: follow one more step.
        step = cut(step.alias("s").join(step.alias("t"), F.col("s.to") == F.col("t.node")).select("s.node", F.col("t.to").alias("to")))
        maps.append(step)
        a = step.select(F.col("node").alias("a"), F.col("to").alias("ta"))
        b = step.select(F.col("node").alias("b"), F.col("to").alias("tb"))
        edges = cut(edges.join(a, "a").join(b, "b").where("ta <> tb").select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct())
    if not maps:
        kind = edges.schema["a"].dataType.simpleString()
        return spark.createDataFrame([], f"node {kind}, component {kind}")
    out = maps[0].select("node", F.col("to").alias("component"))
    for step in maps[1:]:
        nxt = step.select(F.col("node").alias("component"), "to")
        out = out.join(nxt, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return cut(out) if len(maps) > 1 else out


def merged(groups: DataFrame, more: DataFrame) -> DataFrame:
    """The components (node, component) after further links (a, b): only the components that these join are worked on."""
    a = groups.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    b = groups.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    tops = components(more.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    old = groups.join(tops.select(F.col("node").alias("component"), F.col("component").alias("top")), "component", "left").select("node", F.coalesce("top", "component").alias("component"))
    return old.unionByName(tops.join(groups.select("node"), "node", "left_anti"))


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node of its component over the links (a, b)."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        low = np.minimum(la, lb)
        before = label.copy()
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def sieve(keys: DataFrame, columns: list[str], words: int = 1 << 20):
    """A test of rows against the keys in `columns` of `keys`: a function of (rows, their columns) that adds a boolean
    `may`, false only for rows whose key is not among them.

    It is a bitmap of 64 bits a word, so what is broadcast has at most `words` rows however many keys there are. Beyond
    that fill it lets more rows through, which costs a shuffle of these but changes no result."""
    place = lambda cols: F.pmod(F.xxhash64(*cols), F.lit(64 * words))
    bits = keys.select(place([F.col(f"`{c}`") for c in columns]).alias("place"))
    bits = bits.groupBy(F.shiftright("place", 6).alias("sieve_word")).agg(F.expr("bit_or(shiftleft(1L, cast(place & 63 as int)))").alias("sieve_bits"))
    bits = cut(bits)

    def test(rows: DataFrame, cols: list) -> DataFrame:
        known = rows.withColumn("sieve_place", place(cols)).join(F.broadcast(bits), F.shiftright("sieve_place", 6) == F.col("sieve_word"), "left")
        may = F.coalesce(F.expr("getbit(sieve_bits, cast(sieve_place & 63 as int)) = 1"), F.lit(False))
        return known.withColumn("may", may).drop("sieve_place", "sieve_word", "sieve_bits")

    return test
