"""A training-data pipeline: toxicity, line dedup, MinHash near-dedup, mixing, SentencePiece encoding."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.llm import lines, minhash, mixing, pieces, shared, toxicity

MODEL = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers") + "/piece_bpe_32k.model"


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go. Learnt from the labels of this corpus but the held-out fifth; without usable
    labels every score is the base rate. Null and empty texts stay. Columns as in `docs`."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~shared.held_out(F.col("doc_id")))
    model = toxicity.train(docs, labels)
    if not len(model.hashes):
        return docs
    return toxicity.score(docs, model).where("toxicity.predicted = 0 or text is null or text = ''").select(*[f"`{c}`" for c in docs.columns])


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows go; a document of which no word is left by that goes.

    Documents that had no words before stay. n_chars follows the new text. Columns as in `docs`."""
    out = lines.line_dedup(docs)
    out = out.where(F.col("dedup.n_removed").eqNullSafe(0) | F.col("dedup.text").rlike(r"[^\x20\x09-\x0D]"))
    new = {"text": F.col("dedup.text"), "n_chars": F.when(F.col("dedup.n_removed") > 0, F.length("dedup.text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")) if "n_chars" in docs.columns else None}
    return out.select(*[new[c].alias(c) if new.get(c) is not None else F.col(f"`{c}`") for c in docs.columns])


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: five-word shingles, similarity 0.8.

    A document is a doc_id and a text: different texts under one doc_id are documents of their own, only rows that
    repeat both come back once. Of a group the smallest doc_id stays. Rows with a null doc_id stay. Columns as in
    `docs`; `one_of_each_key` may not be one of them."""
    bits = F.col("doc_id").cast("long")  # the sign turned round, so that bytes sort as numbers do
    order = F.unhex(F.lpad(F.hex(bits.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0"))
    name = F.when(F.col("doc_id").isNotNull(), F.concat(order, F.unhex(F.lpad(F.hex(F.xxhash64("text")), 16, "0"))))
    keyed = docs.withColumn("one_of_each_key", name)
    kept = minhash.near_dedup(keyed, key="one_of_each_key").where("kept and one_of_each_key is not null").select("one_of_each_key").distinct()
    once = keyed.where("doc_id is not null").join(kept, "one_of_each_key", "left_semi").dropDuplicates(["one_of_each_key"])
    return once.select(*[f"`{c}`" for c in docs.columns]).unionByName(docs.where("doc_id is null"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training stream under target weights: documents repeated by pass, in order of training position."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_ids, exact, ids of every document of the stream."""
    return pieces.encode(docs, MODEL, keep=["doc_id", "source"]).select("doc_id", "source", "pieces.n_ids", "pieces.exact", "pieces.ids")


STAGES = [("toxicity", remove_toxic), ("line_dedup", remove_repeated_lines), ("minhash", one_of_each), ("mixing", mix_sources), ("sentencepiece", encode)]

#: Trained weights and piece scores have no SQL twin; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = shared.cut(docs)
    return docs
