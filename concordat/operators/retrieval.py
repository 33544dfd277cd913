"""Retrieval channels over postings, dense vectors, and their union."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..staging import cut, together
from .blocking import ranked
from .blocks import best_by_postings


def word_ngrams(text: Column, most: int = 2) -> Column:
    """Words and runs of up to `most` words, repeated as they occur."""
    w = F.regexp_extract_all(text, F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))
    parts = [w]
    for n in range(2, most + 1):
        starts = F.when(F.size(w) >= n, F.sequence(F.lit(1), F.size(w) - n + 1)).otherwise(F.array().cast("array<int>"))
        parts.append(F.transform(starts, _run(w, n)))
    return F.concat(*parts)


def _run(w: Column, n: int):
    return lambda i: F.array_join(F.slice(w, i, F.lit(n)), " ")


def char_ngrams(text: Column, least: int = 3, most: int = 5) -> Column:
    """N-grams of each word between spaces; a word shorter than n gives itself once."""
    padded = F.transform(F.filter(F.split(text, " "), lambda w: w != ""), lambda w: F.concat(F.lit(" "), w, F.lit(" ")))

    def grams(w, n):
        return F.when(F.length(w) > n, F.transform(F.sequence(F.lit(1), F.length(w) - n + 1), lambda i: F.substr(w, i, F.lit(n)))).otherwise(F.when((F.length(w) == n) | (F.lit(n) == least), F.array(w)).otherwise(F.array().cast("array<string>")))

    return F.flatten(F.transform(padded, lambda w: F.concat(*[grams(w, n) for n in range(least, most + 1)])))


def postings(docs: DataFrame, by: list[str], doc: str, terms: Column) -> DataFrame:
    return docs.select(*by, doc, F.explode(terms).alias("term")).groupBy(*by, doc, "term").agg(F.count("*").alias("tf"))


def smooth_idf(post: DataFrame, docs: DataFrame, by: list[str], *, min_df: int = 1, max_df: float = 1.0, times: str | None = None) -> DataFrame:
    """ln((1 + n) / (1 + df)) + 1 per pool and term. Pools are counted, not collected. A posting counts once, or `times`."""
    df = post.groupBy(*by, "term").agg((F.sum(times) if times else F.count("*")).alias("df"))
    both = df.join(docs.groupBy(*by).agg(F.count("*").alias("n_docs")), by) if by else df.withColumn("n_docs", F.lit(docs.count()))
    both = both.where((F.col("df") >= min_df) & (F.col("df") <= max_df * F.col("n_docs")))
    return both.select(*by, "term", (F.log((1 + F.col("n_docs")) / (1 + F.col("df"))) + 1).alias("idf"))


def weighted(post: DataFrame, idf: DataFrame, by: list[str], doc: str, norm: bool) -> DataFrame:
    w = post.join(idf, [*by, "term"]).withColumn("w", F.col("tf") * F.col("idf"))
    if norm:
        length = w.groupBy(*by, doc).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
        w = w.join(length, [*by, doc]).withColumn("w", F.col("w") / F.col("length"))
    return w.select(*by, doc, "term", "w")


def term_classes(rows: DataFrame, by: list[str], key: str, terms: Column) -> DataFrame:
    """(by, key, _class): keys of the same terms, repeats counted, share a class, named after its smallest key. Keys
    without terms are left out."""
    sign = F.sha2(F.array_join(F.transform(F.sort_array(terms), lambda t: F.concat(F.length(t).cast("string"), F.lit(":"), t)), ""), 256)
    signs = F.array_join(F.sort_array(F.collect_list(F.nullif("_sign", F.sha2(F.lit(""), 256)))), "")
    own = rows.select(*by, key, sign.alias("_sign")).groupBy(*by, key).agg(signs.alias("_sign")).where("_sign <> ''")
    return own.join(own.groupBy(*by, "_sign").agg(F.min(key).alias("_class")), [*by, "_sign"]).select(*by, key, "_class")


def _one_a_class(rows: DataFrame, known: DataFrame, by: list[str], key: str) -> DataFrame:
    """The rows a class is named after, with its size `_n`."""
    return rows.join(known.groupBy(*by, F.col("_class").alias(key)).agg(F.count("*").alias("_n")), [*by, key])


def tfidf_top_k(queries: DataFrame, docs: DataFrame, *, by: list[str], query_id: str, doc_id: str, query_terms: Column, doc_terms: Column, k: int, norm: bool = False, min_df: int = 1, max_df: float = 1.0) -> DataFrame:
    """(by, query, doc, score, rank): the k best documents of each query by the dot product of TF-IDF weights.

    The index's idf weighs both sides. Scores are summed block by block, no pair is listed; ties go to the smaller id. Queries and
    documents of the same terms are scored once, as classes: of a class only the k smallest ids can be among the best.
    """
    mine, known = together(lambda: cut(term_classes(queries, by, query_id, query_terms)), lambda: cut(term_classes(docs, by, doc_id, doc_terms)))
    post = cut(postings(_one_a_class(docs, known, by, doc_id), [*by, "_n"], doc_id, doc_terms))  # three uses
    idf = smooth_idf(post, docs, by, min_df=min_df, max_df=max_df, times="_n")
    d = weighted(post, idf, by, doc_id, norm)
    q = weighted(postings(_one_a_class(queries, mine, by, query_id), by, query_id, query_terms), idf, by, query_id, norm).withColumnRenamed("w", "qw")
    scores = best_by_postings(q, d, by=by, query_id=query_id, doc_id=doc_id, k=k)
    best = lambda rows, query: ranked(rows, [*by, query], [F.desc("score"), doc_id]).where(F.col("rank") <= k)
    first = ranked(known, [*by, "_class"], [doc_id]).where(F.col("rank") <= k).select(*by, "_class", doc_id)
    top = best(scores, query_id).select(*by, F.col(query_id).alias("_query"), F.col(doc_id).alias("_class"), "score").join(first, [*by, "_class"])
    top = best(top.drop("_class"), "_query").withColumnRenamed("_query", "_class")
    return mine.join(top, [*by, "_class"]).select(*by, query_id, doc_id, "score", "rank")


def merge_channels(word: DataFrame, char: DataFrame, *, query_id: str, doc_id: str, k: int, char_weight: float = 0.8) -> DataFrame:
    """Cosine of the words, else the weighted cosine of the characters; the k best of each query."""
    w = word.select(query_id, doc_id, F.col("score").alias("word"))
    c = char.select(query_id, doc_id, (F.col("score") * char_weight).alias("char"))
    both = w.join(c, [query_id, doc_id], "full").select(query_id, doc_id, F.round(F.coalesce("word", "char"), 6).alias("score"))
    return ranked(both, [query_id], [F.desc("score"), doc_id]).where(F.col("rank") <= k)


def union_channels(channels: list[tuple[str, DataFrame]], *, query_id: str, doc_id: str, cap: int) -> DataFrame:
    """Candidates of several channels in order of channel, then rank, each once; at most `cap` a query."""
    parts = [df.select(query_id, doc_id, F.col("rank").cast("int").alias("_rank"), F.lit(i).alias("_channel")) for i, (_, df) in enumerate(channels)]
    all_ = parts[0]
    for p in parts[1:]:
        all_ = all_.unionByName(p)
    first = all_.groupBy(query_id, doc_id).agg(F.min(F.struct("_channel", "_rank")).alias("best"))
    names = F.element_at(F.array(*[F.lit(n) for n, _ in channels]), F.col("best._channel") + 1)
    out = first.select(query_id, doc_id, names.alias("channel"), F.col("best._channel").alias("_c"), F.col("best._rank").alias("_r"))
    return ranked(out, [query_id], ["_c", "_r", doc_id], "place").where(F.col("place") <= cap).drop("_c", "_r")


def pad_pool(pool: DataFrame, everything: DataFrame, *, query_id: str, doc_id: str, least: int, seed: str) -> DataFrame:
    """Queries with fewer than `least` candidates get more of their block, in the order of a hash of seed and id."""
    n = pool.groupBy(query_id).agg(F.count("*").alias("_n"))
    rest = everything.join(pool, [query_id, doc_id], "left_anti").join(n, query_id, "left").where(F.coalesce("_n", F.lit(0)) < least)
    order = F.md5(F.concat_ws("|", F.lit(seed), F.col(query_id).cast("string"), F.col(doc_id).cast("string")).cast("binary"))
    rest = ranked(rest.withColumn("_h", order), [query_id], ["_h", doc_id], "_r").where(F.col("_r") <= least - F.coalesce("_n", F.lit(0)))
    return pool.select(query_id, doc_id).unionByName(rest.select(query_id, doc_id))


def _best_in_block(query_id: str, doc_id: str, k: int, round_to: int, by: list[str]):
    def run(key, q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        names = [*by, query_id, doc_id, "score"]
        if not len(q) or not len(d):
            return pd.DataFrame(columns=names)
        d = d.sort_values(doc_id)
        x, y = np.array(q["v"].tolist(), float), np.array(d["v"].tolist(), float)
        ids, own = d[doc_id].to_numpy(), q[query_id].to_numpy()
        parts = []
        for at in range(0, len(x), 512):
            s = np.round(x[at : at + 512] @ y.T, round_to)
            s[own[at : at + 512, None] == ids[None, :]] = -np.inf
            best = np.argsort(-s, axis=1, kind="stable")[:, :k]
            rows = np.repeat(np.arange(len(s)), best.shape[1])
            parts.append(pd.DataFrame({query_id: own[at : at + 512][rows], doc_id: ids[best.ravel()], "score": s[rows, best.ravel()]}))
        out = pd.concat(parts)
        out = out[np.isfinite(out["score"])]
        for name, value in zip(by, key):
            out[name] = value
        return out[names]

    return run


def dense_top_k(queries: DataFrame, docs: DataFrame, *, by: list[str], query_id: str, doc_id: str, vector: str, k: int, round_to: int = 6, block_rows: int = 4096) -> DataFrame:
    """The k best inner products within a group, the row itself left out; ties go to the smaller id.

    Groups are cut into blocks on both sides; a task holds one block of queries and one of documents and gives `k` rows
    a query, so no pairs are listed and a group of any size is dealt over many tasks.
    """
    some = F.col(vector).isNotNull()
    mine = [f"q_{b}" for b in by]
    q = queries.where(some).select(*[F.col(b).alias(m) for b, m in zip(by, mine)], F.col(doc_id).alias(query_id), F.col(vector).alias("v"))
    d = docs.where(some).select(*by, doc_id, F.col(vector).alias("v"))
    nq = q.groupBy(*mine).agg(F.ceil(F.count("*") / block_rows).cast("int").alias("nq"))
    nd = d.groupBy(*by).agg(F.ceil(F.count("*") / block_rows).cast("int").alias("nd"))
    same = [F.col(m) == F.col(b) for b, m in zip(by, mine)]
    sizes = cut(nq.join(nd, same) if by else nq.crossJoin(nd))  # without groups one row
    own = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    meet = lambda df, names: df.join(sizes.select(*names, "nq", "nd"), names) if by else df.crossJoin(F.broadcast(sizes))
    q = meet(q, mine).select(*mine, query_id, "v", own(query_id, "nq").alias("i"), every("nd").alias("j"))
    d = meet(d, by).select(*by, doc_id, "v", every("nq").alias("i"), own(doc_id, "nd").alias("j"))
    kinds = [f"`{c}` {t}" for c, t in [*((b, queries.schema[b].dataType.simpleString()) for b in by), (query_id, queries.schema[doc_id].dataType.simpleString()), (doc_id, docs.schema[doc_id].dataType.simpleString())]]
    found = q.groupBy(*mine, "i", "j").cogroup(d.groupBy(*by, "i", "j")).applyInPandas(_best_in_block(query_id, doc_id, k, round_to, by), ", ".join([*kinds, "score double"]))
    return ranked(found, [*by, query_id], [F.desc("score"), doc_id]).where(F.col("rank") <= k)


def top_two_gap(ranked_rows: DataFrame, *, query: list[str]) -> DataFrame:
    """Best, second (0 without one) and their gap, by conditional aggregation of ranks 1 and 2."""
    g = ranked_rows.where("rank <= 2").groupBy(*query).agg(F.max(F.when(F.col("rank") == 1, F.col("score"))).alias("best"), F.coalesce(F.max(F.when(F.col("rank") == 2, F.col("score"))), F.lit(0.0)).alias("second"))
    return g.withColumn("gap", F.round(F.col("best") - F.col("second"), 6))


def inverted_lists(n: int) -> tuple[int, int]:
    """Lists and probes of an approximate index of n vectors; under 10 000 an exact one is used."""
    lists = max(16, int(math.sqrt(n)))
    return lists, min(16, lists)


def fit_lists(sample: np.ndarray, lists: int, rounds: int = 10, seed: int = 3) -> np.ndarray:
    """Unit centres of the lists, by k-means on unit vectors."""
    rng = np.random.default_rng(seed)
    x = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    centres = x[rng.choice(len(x), min(lists, len(x)), replace=False)]
    for _ in range(rounds):
        home = (x @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, x)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 0, sums / np.maximum(length, 1e-300), centres)
    return centres


def _nearest_lists(rows: DataFrame, centres: np.ndarray, key: str, vector: str, probes: int) -> DataFrame:
    def run(parts):
        for p in parts:
            near = np.argsort(-(np.array(p["v"].tolist(), float).reshape(len(p), -1) @ centres.T), axis=1, kind="stable")[:, :probes]
            yield pd.DataFrame({key: np.repeat(p[key].to_numpy(), near.shape[1]), "v": [v for v in p["v"] for _ in range(near.shape[1])], "list": near.ravel().astype("int32")})

    return rows.select(key, F.col(vector).alias("v")).where("v is not null").mapInPandas(run, f"{key} {rows.schema[key].dataType.simpleString()}, v array<float>, list int")


def build_dense_index(docs: DataFrame, path: str, *, doc_id: str, vector: str, sample_rows: int = 20_000) -> None:
    """Write the vectors by list, and the centres; an index of under 10 000 vectors has one list. Centres are fitted on at
    most `sample_rows` vectors, the first by a hash; every vector is indexed."""
    n = docs.where(F.col(vector).isNotNull()).count()
    lists = inverted_lists(n)[0] if n >= 10_000 else 1
    sample = docs.where(F.col(vector).isNotNull()).select(doc_id, vector).orderBy(F.xxhash64(doc_id), doc_id).limit(sample_rows).toPandas()[vector]
    centres = fit_lists(np.array(sample.tolist(), float), lists) if n else np.zeros((1, 1))
    _nearest_lists(docs, centres, doc_id, vector, 1).write.mode("overwrite").partitionBy("list").parquet(f"{path}/vectors")
    docs.sparkSession.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "list int, centre array<double>").write.mode("overwrite").parquet(f"{path}/centres")


def search_dense_index(queries: DataFrame, path: str, *, query_id: str, doc_id: str, vector: str, k: int, probes: int | None = None, round_to: int = 6) -> DataFrame:
    """(query, doc, score, rank): the k best inner products among the vectors of the lists next to each query."""
    spark = queries.sparkSession
    centres = np.array([r["centre"] for r in spark.read.parquet(f"{path}/centres").orderBy("list").collect()])  # sqrt(n) rows
    near = _nearest_lists(queries.withColumnRenamed(doc_id, query_id), centres, query_id, vector, probes or min(16, len(centres)))
    vectors = spark.read.parquet(f"{path}/vectors")
    found = dense_top_k(near.withColumnRenamed(query_id, doc_id).withColumnRenamed("v", vector), vectors.withColumnRenamed("v", vector), by=["list"], query_id=query_id, doc_id=doc_id, vector=vector, k=k, round_to=round_to)
    return ranked(found.drop("rank", "list"), [query_id], [F.desc("score"), doc_id]).where(F.col("rank") <= k)


def build_term_index(docs: DataFrame, path: str, *, by: list[str], doc_id: str, terms: Column, min_df: int = 1, max_df: float = 1.0, norm: bool = False) -> None:
    """Write the weights of all postings and of all terms: what a process loads instead of building anew."""
    post = postings(docs, by, doc_id, terms)
    idf = smooth_idf(post, docs, by, min_df=min_df, max_df=max_df)
    idf.write.mode("overwrite").parquet(f"{path}/idf")
    weighted(post, docs.sparkSession.read.parquet(f"{path}/idf"), by, doc_id, norm).write.mode("overwrite").parquet(f"{path}/postings")


def search_term_index(queries: DataFrame, path: str, *, by: list[str], query_id: str, doc_id: str, terms: Column, k: int, norm: bool = False) -> DataFrame:
    """As `tfidf_top_k`, on an index that `build_term_index` wrote."""
    read = queries.sparkSession.read
    q = weighted(postings(queries, by, query_id, terms), read.parquet(f"{path}/idf"), by, query_id, norm).withColumnRenamed("w", "qw")
    scores = q.join(read.parquet(f"{path}/postings"), [*by, "term"]).groupBy(*by, query_id, doc_id).agg(F.round(F.sum(F.col("qw") * F.col("w")), 6).alias("score"))
    return ranked(scores, [*by, query_id], [F.desc("score"), doc_id]).where(F.col("rank") <= k)


def encoded(texts: DataFrame, encoder: Callable[[], Callable[[list[str]], list]], *, text: str, vector: str = "vector") -> DataFrame:
    """Texts with sentence vectors of an injected encoder, which is made once a task; equal texts of a batch are encoded once."""
    from pyspark.sql.types import ArrayType, FloatType, StructField, StructType

    def run(parts):
        model = encoder()
        for p in parts:
            known = p[text].fillna("").drop_duplicates()
            vectors = dict(zip(known, model(known.tolist())))
            yield p.assign(**{vector: [[float(x) for x in vectors[t]] for t in p[text].fillna("")]})

    return texts.mapInPandas(run, StructType([*texts.schema.fields, StructField(vector, ArrayType(FloatType()))]))
