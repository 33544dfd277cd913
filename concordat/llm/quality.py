"""Quality: a generalised additive model with pairwise interactions, learnt by cyclic boosting."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .toxicity import batches, labelled_sample

FEATURES = ("words", "word_length", "upper", "exclamation", "symbol", "bar", "digit", "space", "line", "distinct", "top_word", "distinct_line", "stop", "wide", "short", "repeated_pair")


def features(texts: list[str | None]) -> np.ndarray:
    """A row of whole-text statistics for each text; null counts as empty."""
    out = np.zeros((len(texts), len(FEATURES)))
    for row, t in zip(out, texts):
        if not t:
            continue
        words, n = t.split(), len(t)
        m = max(1, len(words))
        b = np.bincount(np.frombuffer(t.encode("utf-8", "replace"), np.uint8), minlength=256)
        ids = Counter(words)
        lines = [x for x in t.split("\n") if x]
        row[:] = (
            np.log1p(len(words)), (n - b[9:14].sum() - b[32]) / m, b[65:91].sum() / n, b[33] / n, b[[35, 36, 37, 38, 42, 43, 61, 64, 94, 95, 126]].sum() / n, b[124] / n, b[48:58].sum() / n, (b[9:14].sum() + b[32]) / n,
            b[10] / m, len(ids) / m, max(ids.values(), default=0) / m, len(set(lines)) / max(1, len(lines)), (b[46] + b[63]) / m, b[192:].sum() / n, sum(c for w, c in ids.items() if len(w) <= 3) / m, 1 - len(set(zip(words, words[1:]))) / max(1, len(words) - 1),
        )
    return out


class AdditiveModel:
    """A lookup table per feature, and one per chosen pair of features; a score is a sum of looked-up values."""

    def __init__(self, edges, coarse, tables, pairs, bias):
        self.edges, self.coarse, self.tables, self.pairs, self.bias = edges, coarse, tables, pairs, bias

    def raw(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for j, (e, t) in enumerate(zip(self.edges, self.tables)):
            z += t[np.searchsorted(e, x[:, j], "right")]
        for (i, j), t in self.pairs.items():
            z += t[np.searchsorted(self.coarse[i], x[:, i], "right"), np.searchsorted(self.coarse[j], x[:, j], "right")]
        return z

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(features(texts)), -30, 30)))


def _tree(g: np.ndarray, h: np.ndarray, leaves: int = 3, least: float = 2.0) -> np.ndarray:
    """Values per bin of a shallow tree on one binned feature: the best splits of gradient sums, one at a time."""
    cuts, gc, hc = [0, len(g)], np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    for _ in range(leaves - 1):
        best = (1e-9, None)
        for a, b in zip(cuts, cuts[1:]):
            k = np.arange(a + 1, b)
            if not len(k):
                continue
            gl, hl, gr, hr = gc[k] - gc[a], hc[k] - hc[a], gc[b] - gc[k], hc[b] - hc[k]
            gain = np.where((hl >= least) & (hr >= least), gl**2 / (hl + 1) + gr**2 / (hr + 1) - (gc[b] - gc[a]) ** 2 / (hc[b] - hc[a] + 1), -1)
            i = int(gain.argmax())
            if gain[i] > best[0]:
                best = (gain[i], int(k[i]))
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(g))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = -(gc[b] - gc[a]) / (hc[b] - hc[a] + 1)
    return out


def _quad(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cross of one cut on each axis of a grid of gradient sums: its gain, and its four values."""
    gc, hc = (np.pad(m, ((1, 0), (1, 0))).cumsum(0).cumsum(1) for m in (g, h))
    G, H = gc[-1, -1], hc[-1, -1]
    a, b = gc[1:-1, 1:-1], hc[1:-1, 1:-1]
    parts = [(a, b), (gc[1:-1, -1:] - a, hc[1:-1, -1:] - b), (gc[-1:, 1:-1] - a, hc[-1:, 1:-1] - b)]
    parts.append((G - sum(p for p, _ in parts), H - sum(q for _, q in parts)))
    gain = sum(p**2 / (q + 1) for p, q in parts) - G**2 / (H + 1)
    if not gain.size:
        return 0.0, np.zeros_like(g)
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    v = [-(np.broadcast_to(p, gain.shape)[i, j]) / (np.broadcast_to(q, gain.shape)[i, j] + 1) for p, q in parts]
    out = np.empty_like(g)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = v
    return float(gain[i, j]), out


def fit(x: np.ndarray, y: np.ndarray, *, bins: int = 32, coarse_bins: int = 8, rounds: int = 150, pair_count: int = 8, pair_rounds: int = 60, rate: float = 0.15) -> AdditiveModel:
    """Cyclic boosting: each round visits every feature in turn and adds a small tree to its table; then pairs.

    The pairs are those whose best cross of cuts explains most of what the single features leave. One class only,
    or no rows: the model is the smoothed base rate.
    """
    n, width = len(y), x.shape[1]
    bias = float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5)))
    grid = lambda k: [np.unique(np.quantile(x[:, j], np.linspace(0, 1, k + 1)[1:-1])) if n else np.empty(0) for j in range(width)]
    edges, coarse = grid(bins), grid(coarse_bins)
    tables = [np.zeros(len(e) + 1) for e in edges]
    if not n or y.min() == y.max():
        return AdditiveModel(edges, coarse, tables, {}, bias)
    at = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)]
    cell = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(coarse)]
    z = np.full(n, bias)

    def slopes():
        p = 1 / (1 + np.exp(-z))
        return p - y, p * (1 - p)

    for _ in range(rounds):
        for j in range(width):
            g, h = slopes()
            v = rate * _tree(np.bincount(at[j], g, len(tables[j])), np.bincount(at[j], h, len(tables[j])))
            tables[j] += v
            z += v[at[j]]

    def quad(i, j):
        g, h = slopes()
        shape = len(coarse[i]) + 1, len(coarse[j]) + 1
        flat = cell[i] * shape[1] + cell[j]
        return _quad(np.bincount(flat, g, shape[0] * shape[1]).reshape(shape), np.bincount(flat, h, shape[0] * shape[1]).reshape(shape))

    ranked = sorted(((-quad(i, j)[0], i, j) for i in range(width) for j in range(i)))[:pair_count]
    pairs = {(i, j): np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1)) for _, i, j in ranked}
    for _ in range(pair_rounds):
        for (i, j), table in pairs.items():
            v = rate * quad(i, j)[1]
            table += v
            z += v[cell[i], cell[j]]
    return AdditiveModel(edges, coarse, tables, pairs, bias)


def train(docs: DataFrame, labels: DataFrame, *, label: str = "quality", text: str = "text", key: str = "doc_id", sample_rows: int = 8000) -> AdditiveModel:
    """Fit on at most `sample_rows` labelled rows, the first by a hash of the key; only their features reach the driver.

    Which rows may be learnt from is up to the caller, who filters `labels`. Rows with a null key, text or label
    don't count; of several labels of a key the largest counts. No labelled rows: every score is 0.5.
    """
    def run(parts):
        for part in parts:
            x = np.concatenate([features(t) for _, t in batches(part.column(0))] or [np.empty((0, len(FEATURES)))])
            yield pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(x.ravel(), len(FEATURES)).cast(pa.list_(pa.float64())), part.column(1)], names=["x", "label"])

    rows = labelled_sample(docs, labels, label, text, key, sample_rows).select("text", "label").mapInArrow(run, "x array<double>, label int").toPandas()
    x = np.array(rows["x"].tolist()).reshape(-1, len(FEATURES))
    return fit(x, rows["label"].to_numpy(float))


def score(docs: DataFrame, model: AdditiveModel, *, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """Every row of `docs` plus a struct `quality`: score (0 to 1), predicted (1 if score >= threshold).

    Whole texts are scored. Null and empty texts have features of zero and get the score of these; repeated rows
    get equal scores; an empty table gives an empty result. `docs` may have columns of any names but `quality`.
    """
    from pyspark.sql.types import StructType

    schema = StructType([*docs.schema.fields, *StructType.fromDDL("quality struct<score:double,predicted:int>").fields])

    def run(parts):
        for part in parts:
            z = np.concatenate([model.scores(t) for _, t in batches(part.column(part.schema.get_field_index(text)))] or [np.empty(0)])
            out = pa.StructArray.from_arrays([pa.array(z, pa.float64()), pa.array((z >= threshold).astype(np.int32))], ["score", "predicted"])
            yield pa.RecordBatch.from_arrays([*part.columns, out], names=[*part.schema.names, "quality"])

    return docs.mapInArrow(run, schema)
