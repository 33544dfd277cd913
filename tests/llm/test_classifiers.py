import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from concordat.llm import quality, queries, shared, toxicity

from . import odd

SF = "/root/testdata/sf0.1"


def accuracy(spark, rows, label):
    truth = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [(r["predicted"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 300
    return np.mean([a == b for a, b in held]), held


def test_toxicity_held_out(spark):
    rows = queries.op1_toxicity(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    acc, held = accuracy(spark, rows, "toxic")
    found = sum(a for a, b in held if b) / sum(b for _, b in held)
    # A few documents of this table are marked without any of the words that mark the others.
    assert acc > 0.98 and found > 0.85
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)


def test_quality_held_out(spark):
    rows = queries.op6_quality(spark, SF).collect()
    acc, held = accuracy(spark, rows, "quality")
    assert acc > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_scores_against_plain_sum():
    texts = ["you are an idiot", "a fine day", "idiot idiot", "the sun is up"] * 5
    m = toxicity.fit(texts, [1, 0, 1, 0] * 5, features=64)
    weights = dict(zip(m.hashes.tolist(), m.weights))
    for t in [*texts[:4], None, "", "x" * 5000 + " idiot"]:
        have = toxicity._distinct(t).tolist() if t else []
        z = m.bias + sum(weights.get(h, 0) for h in have)
        assert m.scores([t])[0] == pytest.approx(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def test_tables_against_plain_sum():
    rng = np.random.default_rng(3)
    x = rng.random((400, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # only a pair of features tells
    m = quality.fit(x, y, rounds=30, pair_count=2)
    assert ((m.raw(x) > 0) == y).mean() > 0.9
    assert any(set(p) == {0, 1} for p in m.pairs)


@pytest.mark.parametrize("op, name", [(toxicity, "toxicity"), (quality, "quality")])
def test_odd_rows(spark, op, name):
    docs = odd.documents(spark, odd.odd_rows())
    labels = spark.createDataFrame([(7, 1, 1), (8, 1, 0), (4, 0, 0), (None, 1, 1), (5, None, None)], "doc_id long, toxic int, quality int")
    model = op.train(docs, labels, label=name if name == "quality" else "toxic")
    out = op.score(docs, model)
    rows = out.collect()
    assert len(rows) == 9 and all(0 <= r[name]["score"] <= 1 for r in rows) and odd.kept(out)
    by = {}
    for r in rows:
        by.setdefault(r["text"] or "", set()).add(r[name]["score"])
    assert all(len(s) == 1 for s in by.values())
    none = op.train(docs, labels.limit(0), label="toxic")
    assert op.score(docs.limit(0), none).count() == 0
    assert op.score(docs, none).select(f"{name}.score").distinct().count() == 1


def test_held_out_of_null(spark):
    assert spark.range(1).select(shared.held_out(F.lit(None).cast("long")).alias("h")).first()["h"] is False
