"""Exact top-k inner-product search over an impact-ordered, score-at-a-time index."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


class ImpactIndex:
    """Postings of one shard of integer vectors, cut into segments by quantised impact, higher impacts first.

    A posting's impact is the size of its component, its quantised impact that shifted right. A segment holds the
    postings (row, dimension, component) of one impact, or of neighbouring ones until it has a `parts`-th of all; the
    components are exact, so once a segment is processed its share of a score is exact.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, shift: int = 2, parts: int = 16):
        self.ids, self.vectors, self.processed, self.whole = ids, vectors, 0, 0
        rows, dims = np.nonzero(vectors)
        impact = np.abs(vectors[rows, dims]).astype(np.int64) >> shift
        order = np.argsort(-impact, kind="stable")
        rows, dims, impact = rows[order], dims[order], impact[order]
        ends, cuts = np.append(np.flatnonzero(np.diff(impact)) + 1, len(impact)), [0]
        for e in ends.tolist():
            if e - cuts[-1] >= len(rows) / parts or e == len(rows) > cuts[-1]:
                cuts.append(e)
        self.segments = [(rows[a:b], dims[a:b], vectors[rows[a:b], dims[a:b]]) for a, b in zip(cuts, cuts[1:])]

    def search(self, queries: np.ndarray, own: np.ndarray, k: int):
        """(query row, id, score) of a set that holds each query's k best by (score, smaller id), itself excluded.

        The components of a candidate that are not processed have norm c, those of the query in the same dimensions
        norm q, so the score lies within c * q of what is summed up. After every segment a candidate whose upper bound
        is under the k-th best lower bound is out: that is the proof on which a query stops, as soon as few candidates
        are left, and these are scored exactly from whole vectors. `processed` of `whole` counts postings times
        queries.
        """
        n, width = self.vectors.shape
        squares = (queries * queries).T
        some = (self.vectors != 0).astype(float)
        acc, left, rest = np.zeros((n, len(queries))), some @ squares, (self.vectors * self.vectors).sum(1)
        alive, out = np.arange(len(queries)), []
        # Vectors of zeros only have no segment: one without postings stands in, so that they are scored too.
        for i, (rows, dims, values) in enumerate(self.segments or [(np.empty(0, int),) * 2 + (np.empty(0),)], 1):
            part = np.zeros((n, width))
            part[rows, dims] = values
            acc += part @ queries[alive].T
            rest -= (part * part).sum(1)
            left -= (part != 0).astype(float) @ squares[:, alive]
            self.processed += len(rows) * len(alive)
            self.whole += len(rows) * len(queries)
            slack = np.sqrt(np.maximum(rest, 0)[:, None] * np.maximum(left, 0)) * (1 + 1e-9)
            low = acc - slack
            np.copyto(low, -np.inf, where=self.ids[:, None] == own[alive])
            bar = np.partition(low, n - k, axis=0)[n - k] if n >= k else np.full(len(alive), -np.inf)
            member = (acc + slack >= bar) & (low > -np.inf)
            done = (member.sum(0) <= max(8 * k, n // 64)) | (i >= len(self.segments))
            for j in np.flatnonzero(done):
                c = np.flatnonzero(member[:, j])
                s = self.vectors[c] @ queries[alive[j]]
                best = np.lexsort((self.ids[c], -s))[:k]
                out += [(int(alive[j]), int(self.ids[c[b]]), int(s[b])) for b in best]
            if done.any():
                acc, left, alive = acc[:, ~done], left[:, ~done], alive[~done]
            if not len(alive):
                self.whole += sum(len(r) for r, *_ in self.segments[i:]) * len(queries)
                break
        return out


def usable(v):
    """Neither null nor holding a null or non-finite component."""
    return v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def top_k(vectors: DataFrame, queries: DataFrame, *, key: str = "vec_id", vector: str = "embedding", k: int = 5, scale: int = 256, shard_rows: int = 4096, block_rows: int = 4096) -> DataFrame:
    """(query_id, rank, key, score): the k best rows of `vectors` for each row of `queries`, but itself.

    Components become floor(scale * x), x as double; the score is the integer inner product; ties go to the smaller
    id. Vectors are dealt into shards of about `shard_rows` rows by a hash of the id, queries into blocks of about
    `block_rows`; every shard is indexed for every block in a task of its own, and what it can contribute, k rows a
    query at most, is ranked. So a task holds one shard and one block, however many rows and queries there are.

    Rows with a null id or an unusable vector take no part on either side; vectors of another length than the
    query's have no inner product and aren't its candidates; of rows with equal ids the smallest vector counts; with
    fewer than k candidates all are returned; empty tables give an empty result; other columns, of any names, are not
    looked at.
    """
    def ready(df, side):
        v = F.col(f"`{vector}`")
        d = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.transform(v, lambda x: F.floor(scale * x.cast("double"))).alias("v")).where(F.col("id").isNotNull() & usable(v) & (F.size(v) > 0))
        return d.select("id", "v", F.size("v").alias("width"), *side)

    rows, asked = vectors.count(), queries.count()
    shards, blocks = max(1, math.ceil(rows / shard_rows)), max(1, math.ceil(asked / block_rows))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    cand = ready(vectors, [F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), every(blocks).alias("block")])
    ask = ready(queries, [every(shards).alias("shard"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int").alias("block")])

    def run(_, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(b):
            a = a.assign(t=a["v"].map(tuple)).sort_values(["id", "t"]).drop_duplicates("id")
            b = b.assign(t=b["v"].map(tuple)).sort_values(["id", "t"]).drop_duplicates("id")
            index, x, ids = ImpactIndex(a["id"].to_numpy(), np.array(a["v"].tolist(), float)), np.array(b["v"].tolist(), float), b["id"].to_numpy()
            for at in range(0, len(x), 256):
                out += [(int(ids[at + i]), v, s) for i, v, s in index.search(x[at : at + 256], ids[at : at + 256], k)]
        return pd.DataFrame(out, columns=["query_id", "found", "score"]).astype("int64")

    parts = cand.groupBy("shard", "block", "width").cogroup(ask.groupBy("shard", "block", "width")).applyInPandas(run, "query_id long, found long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "found")
    return parts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", F.col("found").alias(key), "score")
