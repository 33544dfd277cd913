"""Embedding near-dedup: spherical k-means cells, blocked cosine products, one representative per group."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import components, cut, spanning
from .topk import usable


def unit(v: np.ndarray) -> np.ndarray:
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """k unit centres of unit vectors. A cell that runs empty is given the vector that fits its own cell worst."""
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        sims = x @ centres.T
        cell = sims.argmax(1)
        fit, sums = sims[np.arange(len(x)), cell], np.zeros_like(centres)
        np.add.at(sums, cell, x)
        empty = np.flatnonzero((sums * sums).sum(1) < 1e-18)
        sums[empty] = x[np.argsort(fit)[: len(empty)]]
        centres = unit(sums)
    return centres


def probes_for(k: int) -> int:
    """How many cells a vector is sent to among k: pairs near the threshold lie further apart in rank as cells shrink."""
    return max(4, math.ceil(2 * math.log2(max(1, k))))


def nearest(x: np.ndarray, centres: np.ndarray, probes: int | None = None) -> np.ndarray:
    """The cells that each unit vector is sent to, its home first."""
    return np.argsort(-(x @ centres.T), axis=1, kind="stable")[:, : probes or probes_for(len(centres))]


#: A cell's number is that of its first level times this, plus that of its second.
_SUB = 1 << 20


def _second_level(seen: DataFrame, kind: str, *, cell_rows: int, sample_rows: int, max_cells: int, probes: int | None) -> DataFrame:
    """The same rows over smaller cells: each cell with more than twice `cell_rows` residents gets cells of its own, from
    k-means on at most `sample_rows` of its residents, and all its members are assigned to them, with the same rule for
    guests. Members are dealt over tasks in chunks; centres are sent to each chunk of their cell."""
    at = ["width", "cell"]
    lives = F.col("cell") == F.col("home")
    big = cut(seen.groupBy(*at).agg(F.count_if(lives).alias("residents"), F.count("*").alias("members")).where(F.col("residents") > 2 * cell_rows))
    place = F.row_number().over(Window.partitionBy(*at).orderBy(F.xxhash64("rep"), "rep"))
    sample = seen.where(lives).join(big, at).withColumn("place", place).where(F.col("place") <= sample_rows)

    def fit(p: pd.DataFrame) -> pd.DataFrame:
        k = int(min(max_cells, math.ceil(p["residents"].iloc[0] / cell_rows)))
        centres = spherical_kmeans(np.array(p["u"].tolist()), k)
        return pd.DataFrame({"width": p["width"].iloc[:1], "cell": p["cell"].iloc[:1], "centres": [centres.ravel().tolist()]})

    centres = cut(sample.select(*at, "residents", "u").groupBy(*at).applyInPandas(fit, "width int, cell long, centres array<double>"))
    chunks = F.ceil(F.col("members") / 20_000).cast("int")
    dealt = seen.join(big, at).withColumn("chunk", F.pmod(F.xxhash64("rep"), chunks).cast("int"))
    sent = centres.join(big, at).withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1)))

    def assign(key, p: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(p):
            return pd.DataFrame(columns=["width", "rep", "copies", "u", "ids", "own"])
        x = np.array(p["u"].tolist())
        ids = nearest(x, np.array(c["centres"].iloc[0]).reshape(-1, x.shape[1]), probes).astype(np.int64) + int(key[1])
        own = np.where((p["cell"] == p["home"]).to_numpy(), ids[:, 0], -1)
        return p[["width", "rep", "copies", "u"]].assign(ids=ids.tolist(), own=own)

    schema = f"width int, rep {kind}, copies long, u array<double>, ids array<long>, own long"
    parts = dealt.select(*at, "chunk", "home", "rep", "copies", "u").groupBy(*at, "chunk").cogroup(sent.select(*at, "chunk", "centres").groupBy(*at, "chunk")).applyInPandas(assign, schema)
    rest = seen.join(big, at, "left_anti").select("width", "rep", "copies", "u", F.array("cell").alias("ids"), F.when(lives, F.col("cell")).otherwise(F.lit(-1)).alias("own"))
    whole = parts.unionByName(rest).withColumn("uh", F.xxhash64("u")).groupBy("width", "rep", "uh").agg(F.first("copies").alias("copies"), F.first("u").alias("u"), F.flatten(F.collect_list("ids")).alias("cells"), F.max("own").alias("home"))
    return whole.select("width", F.explode("cells").alias("cell"), "home", "rep", "copies", "u", "cells")


def embedding_dedup(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.9, cell_rows: int = 512, sample_rows: int = 20_000, max_cells: int = 2048, probes: int | None = None, block_rows: int = 1024) -> DataFrame:
    """Per row: key, n_links, component_id, kept.

    Equal vectors form a class and are handled once, with their number. Cells come from spherical k-means on at most
    `sample_rows` classes (the first by a hash); beyond twice `max_cells` * `cell_rows` classes, large cells get a second
    level of their own (`_second_level`), so cells stay small at any size. Every class is assigned: it lives in its nearest cell and is a
    guest in the next `probes` - 1, by default a number that grows with the cells (`probes_for`). Within a cell, residents meet residents and guests in blocks of about
    `block_rows`, so a cell of any size is dealt over many tasks; cosines are products of unit vectors in double
    precision, and pairs at or over the threshold link, none below. No list of pairs is made: a block returns the
    number of links of each class, and one link that ties it to its group. A pair whose classes see each other in two
    cells is counted in the smaller one. Pairs whose cells are far apart can be missed: recall is measured in tests.

    component_id is the smallest key reachable, kept marks it. Null vectors, zero vectors, vectors with null or
    non-finite components and rows with a null key link with nothing (component_id is the own key; a null key is
    kept); vectors of different lengths don't link; rows that share a key are one node, whose links add up; an empty
    table gives an empty result.
    """
    spark = vectors.sparkSession
    v = F.col(f"`{vector}`")
    good = usable(v) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(f"`{key}`").alias("id"), F.when(good, F.transform(v, lambda x: x.cast("double"))).alias("v"))
    rows = rows.select("id", "v", F.xxhash64("v").alias("vh"))
    classes = cut(rows.where("id is not null and v is not null").groupBy("vh", "v").agg(F.min("id").alias("rep"), F.count("*").alias("copies")).withColumn("width", F.size("v")))
    count, widths = classes.count(), [r["width"] for r in classes.select("width").distinct().collect()]
    per = {}
    for w in widths:
        sample = classes.where(F.col("width") == w).orderBy("vh", "rep").limit(sample_rows).select("v").toPandas()["v"]
        per[w] = spherical_kmeans(unit(np.array(sample.tolist())), int(min(max_cells, max(1, math.ceil(count / cell_rows)))))

    def assign(parts):
        for part in parts:
            out = []
            for w, p in part.groupby("width"):
                x, centres = unit(np.array(p["v"].tolist()).reshape(len(p), w)), per[w]
                near = nearest(x, centres, probes)
                for rep, copies, u, c in zip(p["rep"], p["copies"], x, near):
                    ids = (c.astype(np.int64) * _SUB).tolist()
                    out += [(w, cell, ids[0], rep, copies, u, ids) for cell in ids]
            yield pd.DataFrame(out, columns=["width", "cell", "home", "rep", "copies", "u", "cells"])

    kind = vectors.schema[key].dataType.simpleString()
    seen = cut(classes.select("width", "rep", "copies", "v").mapInPandas(assign, f"width int, cell long, home long, rep {kind}, copies long, u array<double>, cells array<long>"))
    if count > 2 * max_cells * cell_rows:
        seen = cut(_second_level(seen, kind, cell_rows=cell_rows, sample_rows=sample_rows, max_cells=max_cells, probes=probes))
    sizes = seen.groupBy("width", "cell").agg(F.count_if(F.col("cell") == F.col("home")).alias("residents"), F.count_if(F.col("cell") != F.col("home")).alias("guests"))
    sizes = sizes.select("width", "cell", F.ceil(F.col("residents") / block_rows).cast("int").alias("nr"), F.ceil(F.col("guests") / block_rows).cast("int").alias("ng")).where("nr > 0")
    seen = seen.join(sizes, ["width", "cell"])
    lives = F.col("cell") == F.col("home")
    mine = F.when(lives, F.pmod(F.xxhash64("rep"), "nr")).otherwise(F.pmod(F.xxhash64("rep"), "ng")).cast("int")
    seen = seen.withColumn("own", mine)
    # Residents of block i meet those of blocks j >= i, as (i, j), and guests of block g, as (i, -1 - g).
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    meet = F.when(lives, F.concat(F.transform(upto(F.col("nr")), lambda j: F.struct(F.least("own", j).alias("i"), F.greatest("own", j).alias("j"))), F.when(F.col("ng") > 0, F.transform(upto(F.col("ng")), lambda g: F.struct(F.col("own").alias("i"), (-1 - g).alias("j")))).otherwise(F.array().cast("array<struct<i:int,j:int>>"))))
    meet = meet.otherwise(F.transform(upto(F.col("nr")), lambda i: F.struct(i.alias("i"), (-1 - F.col("own")).alias("j"))))
    met = seen.withColumn("at", F.explode(meet)).select("width", "cell", F.col("at.i").alias("i"), F.col("at.j").alias("j"), "home", "own", "rep", "copies", "u", "cells")

    def block(name: tuple, p: pd.DataFrame) -> pd.DataFrame:
        _, cell, i, j = name
        lives = (p["home"] == cell).to_numpy()
        first = lives & (p["own"] == i).to_numpy()
        second = ~lives if j < 0 else lives & (p["own"] == j).to_numpy()
        p = p.reset_index(drop=True)
        a, b = np.flatnonzero(first), np.flatnonzero(second)
        x = np.array(p["u"].tolist()).reshape(len(p), -1)
        links, pa_, pb_ = np.zeros(len(p)), [], []
        copies, home = p["copies"].to_numpy(), p["home"].to_numpy()
        for s in range(0, len(a), 256):
            hit = np.argwhere(x[a[s : s + 256]] @ x[b].T >= threshold)
            m, n = a[s + hit[:, 0]], b[hit[:, 1]]
            if j == i:
                m, n = m[m < n], n[m < n]
            if j < 0:  # a guest that receives the resident in a smaller cell of its own counts the pair there
                n_home = home[n]
                twice = np.array([h < cell and h in c for h, c in zip(n_home, p["cells"].to_numpy()[m])], bool)
                m, n = m[~twice], n[~twice]
            np.add.at(links, m, copies[n])
            np.add.at(links, n, copies[m])
            pa_.append(m)
            pb_.append(n)
        if not pa_ or not sum(map(len, pa_)):
            return pd.DataFrame({"rep": p["rep"][:0], "n": links[:0].astype("int64"), "to": p["rep"][:0]})
        group = spanning(len(p), np.concatenate(pa_), np.concatenate(pb_))
        k = links > 0
        return pd.DataFrame({"rep": p["rep"][k], "n": links[k].astype("int64"), "to": p["rep"].to_numpy()[group[k]]})

    found = cut(met.groupBy("width", "cell", "i", "j").applyInPandas(block, f"rep {kind}, n long, to {kind}"))
    links = found.groupBy("rep").agg(F.sum("n").alias("n"))
    groups = components(found.select(F.col("rep").alias("a"), F.col("to").alias("b")))
    known = classes.join(links, "rep", "left").join(groups.withColumnRenamed("node", "rep"), "rep", "left")
    known = known.select("vh", "v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "rep").alias("component"))
    all_ = rows.join(known.withColumnRenamed("v", "v2").withColumnRenamed("vh", "vh2"), (F.col("vh") == F.col("vh2")) & (F.col("v") == F.col("v2")) & F.col("id").isNotNull(), "left")
    component = F.coalesce("component", "id")
    return all_.select(F.col("id").alias(key), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
