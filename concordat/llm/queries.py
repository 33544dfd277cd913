"""The registered queries opN_<name>: thin calls of the operators over whole tables, and their SQL."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cells, licences, lines, minhash, mixing, pieces, quality, shared, suffixes, topk, toxicity

TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(~shared.held_out(F.col("doc_id"))))
    out = toxicity.score(docs, model)
    return out.select("doc_id", shared.held_out(F.col("doc_id")).alias("held_out"), "toxicity.score", "toxicity.predicted")


def op2_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"))


def op3_minhash(spark, sf_dir):
    return minhash.near_dedup(table(spark, sf_dir, "documents"), width=3, percent=85)


def op4_suffixes(spark, sf_dir):
    out = suffixes.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "repeats.n_bytes", "repeats.n_removed", F.size("repeats.spans").cast("long").alias("n_spans"), F.sha2("repeats.kept", 256).alias("kept_sha256"), F.make_valid_utf8(F.col("repeats.kept").cast("string")).alias("text"))


def op5_lines(spark, sf_dir):
    out = lines.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("dedup.text").alias("text"), "dedup.n_lines", "dedup.n_removed")


def op6_quality(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    model = quality.train(docs, labels.where(~shared.held_out(F.col("doc_id"))))
    out = quality.score(docs, model)
    return out.select("doc_id", shared.held_out(F.col("doc_id")).alias("held_out"), "quality.score", "quality.predicted")


def op7_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.size_of(F.col("text")).alias("words"))
    out = mixing.mix(docs, size="words").select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken", F.round("mix.position", 9).alias("position"))
    return out.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")


def op8_licences(spark, sf_dir):
    out = licences.license_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    every = lambda field: F.concat(F.transform("licences", lambda m: m[field]), F.transform("licence_passages", lambda m: m[field]))
    return out.select("doc_id", F.size(every("template")).cast("long").alias("n_matches"), F.concat_ws(",", F.array_sort(F.array_distinct(every("template")))).alias("found"), F.round(F.array_max(every("dice")), 6).alias("best_dice"))


def op9_pieces(spark, sf_dir):
    out = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), f"{TOKENIZERS}/piece_bpe_32k.model", keep=["doc_id"])
    return out.select("doc_id", "pieces.n_ids", "pieces.exact", "pieces.ids")


def op10_cells(spark, sf_dir):
    return cells.embedding_dedup(table(spark, sf_dir, "embeddings"))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_topk, op3_minhash, op4_suffixes, op5_lines, op6_quality, op7_mixing, op8_licences, op9_pieces, op10_cells, pipeline)}
