"""Toxicity: a character n-gram linear classifier on naive Bayes log-count ratios."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIZES = (4, 5, 6)
_TABLE = 20


def _buffer(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased UTF-8 bytes of all texts, each between spaces and ended by a zero, and where each text starts."""
    parts = [b" " + t.lower().encode("utf-8", "replace").replace(b"\0", b" ") + b" \0" if t else b"\0" for t in texts]
    starts = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=starts[1:])
    return np.frombuffer(b"".join(parts), np.uint8), starts


def ngram_hashes(buf: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A 32-bit hash of the n-gram at each position, and whether it lies within one text."""
    n = len(buf) - size + 1
    if n <= 0:
        return np.empty(0, np.uint32), np.empty(0, bool)
    h, ok = np.full(n, 2166136261 + size, np.uint32), np.ones(n, bool)
    for k in range(size):
        part = buf[k : k + n]
        h = (h ^ part) * np.uint32(16777619)
        ok &= part != 0
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return h ^ (h >> np.uint32(13)), ok


def _distinct(text: str) -> np.ndarray:
    buf, _ = _buffer([text])
    return np.unique(np.concatenate([h[ok] for h, ok in (ngram_hashes(buf, s) for s in SIZES)]))


class ToxicityModel:
    """Weights of chosen n-grams (by 32-bit hash) and a bias; a text's features are which n-grams occur in it."""

    def __init__(self, hashes: np.ndarray, weights: np.ndarray, bias: float):
        self.hashes, self.weights, self.bias = hashes.astype(np.uint32), weights, bias
        self._slots = None

    def __getstate__(self):
        return self.__dict__ | {"_slots": None}

    @property
    def slots(self) -> np.ndarray:
        if self._slots is None:
            self._slots = np.full(1 << _TABLE, -1, np.int16)
            self._slots[self.hashes & np.uint32((1 << _TABLE) - 1)] = np.arange(len(self.hashes), dtype=np.int16)
        return self._slots

    def scores(self, texts: list[str | None]) -> np.ndarray:
        buf, starts = _buffer(texts)
        keys, m = [], max(1, len(self.hashes))
        for size in SIZES:
            h, ok = ngram_hashes(buf, size)
            slot = self.slots[h & np.uint32((1 << _TABLE) - 1)]
            at = np.flatnonzero((slot >= 0) & ok)
            if len(at):
                at = at[self.hashes[slot[at]] == h[at]]
                keys.append((np.searchsorted(starts, at, "right") - 1) * m + slot[at])
        z = np.full(len(texts), self.bias)
        if keys:
            found = np.unique(np.concatenate(keys))
            np.add.at(z, found // m, self.weights[found % m])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(texts: list[str], labels: list[int], *, features: int = 2048, alpha: float = 1.0, l2: float = 0.05, steps: int = 200) -> ToxicityModel:
    """Naive Bayes log-count ratios of n-gram presence scale the features of a logistic regression.

    The n-grams kept are those with the largest ratio times square root of frequency. With one class only, or no
    rows, the model is the smoothed base rate.
    """
    y = np.asarray(labels, float)
    bias = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    if not len(y) or y.min() == y.max():
        return ToxicityModel(np.empty(0), np.empty(0), bias)
    bits = np.uint32(10)  # counts go by the leading 22 bits, the hash of a kept n-gram is whole
    df = np.zeros((2, 1 << 22), np.float32)
    for t, label in zip(texts, y):
        np.add.at(df[int(label)], _distinct(t or "") >> bits, 1)
    r = np.log((df[1] + alpha) / (y.sum() + 2 * alpha)) - np.log((df[0] + alpha) / (len(y) - y.sum() + 2 * alpha))
    rank = np.abs(r) * np.sqrt(df[0] + df[1])
    del df
    top = np.argpartition(-rank, features)[:features]
    chosen = np.zeros(1 << 22, bool)
    chosen[top[rank[top] > 0]] = True
    del rank
    # All n-grams of all texts at once would be the driver's largest array, so they are worked out again.
    docs = [d[chosen[d >> bits]] for d in (_distinct(t or "") for t in texts)]
    whole = np.concatenate(docs)
    seen, n = np.unique(whole, return_counts=True)
    order = np.lexsort((seen, -n, seen >> bits))
    seen = seen[order]
    seen = seen[np.unique(seen >> bits, return_index=True)[1]]  # the most frequent of each bucket
    seen = seen[np.unique(seen & np.uint32((1 << _TABLE) - 1), return_index=True)[1]]  # one for each slot
    seen = np.sort(seen)
    ratio = r[seen >> bits].astype(float)
    x = np.zeros((len(docs), len(seen)), np.float32)
    for row, d in zip(x, docs):
        row[np.searchsorted(seen, d[np.isin(d, seen)])] = 1
    x *= ratio.astype(np.float32)
    scale = 1 / np.sqrt((x * x).sum(1).mean())
    x *= np.float32(scale)
    w, b = np.zeros(len(seen)), bias
    mw, mb, vw, vb = np.zeros_like(w), 0.0, np.zeros_like(w), 0.0
    for step in range(1, steps + 1):  # Adam on the logistic loss, classes weighted alike
        z = x @ w.astype(np.float32) + b
        e = (1 / (1 + np.exp(-z)) - y) * np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
        gw, gb = x.T @ e.astype(np.float32) / len(y) + l2 * w / len(y), e.mean()
        mw, vw = 0.9 * mw + 0.1 * gw, 0.999 * vw + 0.001 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        c, k = 1 - 0.9**step, 1 - 0.999**step
        w, b = w - 0.1 * (mw / c) / (np.sqrt(vw / k) + 1e-8), b - 0.1 * (mb / c) / (np.sqrt(vb / k) + 1e-8)
    return ToxicityModel(seen, w * ratio * scale, float(b))


def train(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", text: str = "text", key: str = "doc_id", sample_rows: int = 4000) -> ToxicityModel:
    """Fit on at most `sample_rows` labelled rows, the first by a hash of the key.

    Which rows may be learnt from is up to the caller, who filters `labels`. Rows with a null key, text or label
    don't count; of several labels of a key the largest counts. No labelled rows: every score is 0.5.
    """
    rows = labelled_sample(docs, labels, label, text, key, sample_rows).collect()
    return fit([r["text"] for r in rows], [r["label"] for r in rows])


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, text: str, key: str, rows: int) -> DataFrame:
    """(id, text, label) of a sample of bounded size. The ids are few and bounded, so they are broadcast."""
    y = labels.select(F.col(f"`{key}`").alias("id"), F.col(f"`{label}`").alias("label")).dropna()
    y = y.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(rows)
    d = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text")).dropna()
    return d.join(F.broadcast(y), "id").orderBy(F.xxhash64("id"), F.xxhash64("text")).limit(rows)


def batches(column: pa.Array, most: int = 1_000_000):
    """Slices (start, texts) of a column of texts, of about `most` bytes each; a longer text stands alone."""
    sizes, start, size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and size + n > most:
            yield start, column.slice(start, i - start).to_pylist()
            start, size = i, 0
        size += n
    if len(sizes):
        yield start, column.slice(start).to_pylist()


def score(docs: DataFrame, model: ToxicityModel, *, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """Every row of `docs` plus a struct `toxicity`: score (0 to 1), predicted (1 if score >= threshold).

    Whole texts are scored. Null and empty texts have no n-grams and get the score of the bias alone; repeated rows
    get equal scores; an empty table gives an empty result. `docs` may have columns of any names but `toxicity`.
    """
    from pyspark.sql.types import StructType

    schema = StructType([*docs.schema.fields, *StructType.fromDDL("toxicity struct<score:double,predicted:int>").fields])

    def run(parts):
        for part in parts:
            z = np.concatenate([model.scores(t) for _, t in batches(part.column(part.schema.get_field_index(text)))] or [np.empty(0)])
            out = pa.StructArray.from_arrays([pa.array(z, pa.float64()), pa.array((z >= threshold).astype(np.int32))], ["score", "predicted"])
            yield pa.RecordBatch.from_arrays([*part.columns, out], names=[*part.schema.names, "toxicity"])

    return docs.mapInArrow(run, schema)
