"""Similarity of strings, token sets and vectors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType


def jaro_winkler_of(a: str, b: str) -> float:
    """1 if both are empty, 0 if one is; Jaro, raised by a common prefix of up to 4 when over 0.7."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used, taken = [False] * len(b), []
    for i, x in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == x:
                used[j] = True
                taken.append(x)
                break
    m = len(taken)
    if not m:
        return 0.0
    moved = sum(x != y for x, y in zip(taken, (y for y, u in zip(b, used) if u))) // 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    if jaro <= 0.7:
        return jaro
    prefix = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4])) if x != y), min(4, len(a), len(b)))
    return jaro + prefix * 0.1 * (1 - jaro)


def _codes(values: list[str], width: int) -> np.ndarray:
    """Code points, a row for each string, zeros behind."""
    return np.array(values, f"<U{max(width, 1)}").view(np.uint32).reshape(len(values), -1)


def jaro_winkler_batch(a: list[str], b: list[str], longest: int = 64) -> np.ndarray:
    """The same for many pairs at once: one step for each position of the left strings, on all pairs.

    Pairs with a string over `longest`, or one that holds a zero character, go one by one.
    """
    out = np.zeros(len(a))
    la, lb = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
    odd = (la > longest) | (lb > longest) | np.fromiter(("\0" in x or "\0" in y for x, y in zip(a, b)), bool, len(a))
    for i in np.flatnonzero(odd):
        out[i] = jaro_winkler_of(a[i], b[i])
    for first in range(0, len(a), 8192):
        at = np.flatnonzero(~odd[first : first + 8192]) + first
        if not len(at):
            continue
        n, m = la[at], lb[at]
        x, y = _codes([a[i] for i in at], int(n.max())), _codes([b[i] for i in at], int(m.max()))
        reach = np.maximum(np.maximum(n, m) // 2 - 1, 0)
        column, rows = np.arange(y.shape[1]), np.arange(len(at))
        used, hit = column[None, :] >= m[:, None], np.zeros(x.shape, bool)
        for i in range(x.shape[1]):
            near = (y == x[:, i, None]) & ~used & (np.abs(column[None, :] - i) <= reach[:, None]) & (i < n)[:, None]
            j = near.argmax(1)
            found = near[rows, j]
            used[rows[found], j[found]] = True
            hit[:, i] = found
        used &= column[None, :] < m[:, None]
        matches = hit.sum(1)
        # The matched characters of both sides in order, side by side.
        r, c = np.nonzero(hit)
        r2, c2 = np.nonzero(used)
        moved = np.bincount(r, x[r, c] != y[r2, c2], len(at)).astype(int) // 2
        k = np.maximum(matches, 1)
        jaro = np.where(matches > 0, (matches / np.maximum(n, 1) + matches / np.maximum(m, 1) + (matches - moved) / k) / 3, 0.0)
        w = min(4, x.shape[1], y.shape[1])
        head = (x[:, :w] == y[:, :w]) & (np.arange(w) < np.minimum(n, m)[:, None])
        jaro = np.where(jaro > 0.7, jaro + np.cumprod(head, 1).sum(1) * 0.1 * (1 - jaro), jaro)
        out[at] = np.where((n == 0) & (m == 0), 1.0, jaro)
    return out


@F.pandas_udf(DoubleType())
def jaro_winkler_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(jaro_winkler_batch(a.fillna("").tolist(), b.fillna("").tolist()))


def jaro_winkler(a: Column, b: Column) -> Column:
    return jaro_winkler_udf(a, b)


@F.pandas_udf(ArrayType(DoubleType()))
def _jaro_winkler_many(a: pd.Series, b: pd.Series) -> pd.Series:
    n = b.map(len).to_numpy()
    flat = [x or "" for row in b for x in row]
    scores = jaro_winkler_batch([x for x, k in zip(a.fillna("").tolist(), n) for _ in range(k)], flat)
    return pd.Series([part.tolist() for part in np.split(scores, np.cumsum(n)[:-1])] if len(n) else [])


def jaro_winkler_many(a: Column, texts: Column) -> Column:
    """The similarity of a string to each string of an array: one Arrow pass, no row is multiplied."""
    return _jaro_winkler_many(a, F.coalesce(texts, F.array().cast("array<string>")))


def with_jaro_winkler(pairs: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """The similarity of two columns, null counting as '': one Arrow pass over the pairs, nothing is shuffled."""
    return pairs.withColumn(name, jaro_winkler_udf(F.col(a), F.col(b)))


def empties(a_empty: Column, b_empty: Column, value: Column) -> Column:
    return F.when(a_empty & b_empty, 1.0).when(a_empty | b_empty, 0.0).otherwise(value)


def levenshtein_ratio(a: Column, b: Column) -> Column:
    return empties(a == "", b == "", 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b)))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays of distinct tokens."""
    return empties(F.size(a) == 0, F.size(b) == 0, F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def numeric_match(a: Column, b: Column) -> Column:
    """Shared numbers over the larger number of numbers; 0 if a side has none."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(F.size(a), F.size(b)))


def number_gap(a: Column, b: Column) -> Column:
    return F.coalesce(F.abs(a.try_cast("int") - b.try_cast("int")).cast("double"), F.lit(9999.0))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))
