"""MinHash near-dedup with sequential Bayesian verification of banded candidates, and exact verification."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import components, cut, merged, spanning
from .toxicity import batches

_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
HASHES = 128


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of each word of A-Z-lowered UTF-8 bytes: polynomial sums between word boundaries."""
    b = np.frombuffer(data, np.uint8)
    if not len(b):
        return np.empty(0, np.uint64)
    blank = _SPACE[b]
    edge = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((b.astype(np.uint64) + np.uint64(1)) * _powers(_ODD, len(b)), dtype=np.uint64)])
    # Moved to exponent 0 by the inverse of the odd base, so equal words hash alike wherever they stand.
    back = _powers(_INVERSE, len(b))
    return mixed((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles; fewer words than `width` make one shingle."""
    w = word_hashes(text.encode("utf-8", "replace").lower()) if text else np.empty(0, np.uint64)
    if not len(w):
        return w
    n = max(1, len(w) - width + 1)
    h = np.full(n, min(width, len(w)), np.uint64)
    for k in range(min(width, len(w))):
        h = mixed(h * _ODD + w[k : k + n])
    return np.unique(h)


def band_rows(threshold: float, miss: float) -> int:
    """The most rows a band can have while a pair at the threshold is in no common band with probability <= miss."""
    return max(r for r in range(1, 17) if r == 1 or (1 - threshold**r) ** (HASHES // r) <= miss)


def needed_matches(threshold: float, miss: float, batch: int = 16) -> list[int]:
    """For each number of compared values (a batch, two, ...): the fewest matches with which a pair stays.

    With a flat prior on the similarity s, the posterior after m matches of n 8-bit values is proportional to
    p**m * (1-p)**(n-m), where p = s + (1-s)/256. A pair is pruned when the posterior probability that s reaches the
    threshold is under `miss`.
    """
    s = np.linspace(0, 1, 4001)[1:-1]
    p = s + (1 - s) / 256
    out = []
    for n in range(batch, HASHES + 1, batch):
        m = np.arange(n + 1)[:, None]
        w = m * np.log(p) + (n - m) * np.log1p(-p)
        w = np.exp(w - w.max(1, keepdims=True))
        tail = w[:, s >= threshold].sum(1) / w.sum(1)
        out.append(int(np.argmax(tail >= miss)))
    return out


def _seeds() -> tuple[np.ndarray, np.ndarray]:
    s = mixed(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * _ODD)
    return s[:HASHES] | np.uint64(1), s[HASHES:]


def signature_rows(texts: list[str | None], width: int, rows: int):
    """For each text: number of distinct shingles, 128-bit hash of the set, 8-bit signature, band keys."""
    mul, add = _seeds()
    for t in texts:
        h = shingles(t, width)
        if not len(h):
            yield 0, None, None, None
            continue
        low = np.full(HASHES, np.uint64(2**64 - 1))
        for i in range(0, len(h), 512):
            low = np.minimum(low, (h[i : i + 512, None] * mul + add).min(0))
        low = mixed(low)
        set_hash = np.array([mixed(h + _ODD).sum(dtype=np.uint64), mixed(h * _MIX + np.uint64(len(h))).sum(dtype=np.uint64)]).tobytes()
        n = HASHES // rows
        keys = np.arange(1, n + 1, dtype=np.uint64)
        for k in range(rows):
            keys = mixed(keys * _ODD + low[: n * rows].reshape(n, rows)[:, k])
        yield len(h), set_hash, low.astype(np.uint8).tobytes(), keys.view(np.int64)


def _described(docs: DataFrame, width: int, rows: int) -> DataFrame:
    def run(parts):
        for part in parts:
            for start, texts in batches(part.column(1)):
                found = list(signature_rows(texts, width, rows))
                bands = pa.array([f[3] for f in found], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0).slice(start, len(texts)), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.binary()), pa.array([f[2] for f in found], pa.binary()), bands], names=["id", "n", "set", "sig", "bands"])

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, n long, set binary, sig binary, bands array<long>")


def _bayes(pairs: DataFrame, threshold: float, miss: float) -> DataFrame:
    """Pairs (a, b, sig_a, sig_b) that stay, batch after batch of signature values."""
    need = needed_matches(threshold, miss)

    def run(parts):
        for part in parts:
            if not part.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint8).reshape(-1, HASHES) for c in (2, 3))
            at, matches = np.arange(len(x)), np.zeros(len(x), int)
            for k, least in enumerate(need):
                s = slice(k * HASHES // len(need), (k + 1) * HASHES // len(need))
                matches = matches + (x[at, s] == y[at, s]).sum(1)
                stay = matches >= least
                at, matches = at[stay], matches[stay]
            yield pa.RecordBatch.from_arrays([part.column(c).take(pa.array(at)) for c in (0, 1)], names=["a", "b"])

    kind = pairs.schema["a"].dataType.simpleString()
    return pairs.select("a", "b", "sig_a", "sig_b").mapInArrow(run, f"a {kind}, b {kind}")


def _exact(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs whose whole sets have 100 * intersection >= percent * union."""
    a = texts.select(F.col("id").alias("a"), F.col("t").alias("ta"))
    b = texts.select(F.col("id").alias("b"), F.col("t").alias("tb"))
    both = pairs.join(a, "a").join(b, "b").select("a", "b", "ta", "tb")

    def run(parts):
        last: dict = {}
        for part in parts:
            stay = []
            for i, (ia, ib, ta, tb) in enumerate(zip(*(part.column(c).to_pylist() for c in range(4)))):
                sets = []
                for id_, t in ((ia, ta), (ib, tb)):
                    if (id_, len(t)) not in last:
                        if len(last) > 256:
                            last.clear()
                        last[id_, len(t)] = shingles(t, width)
                    sets.append(last[id_, len(t)])
                common = len(np.intersect1d(*sets, assume_unique=True))
                if 100 * common >= percent * (len(sets[0]) + len(sets[1]) - common):
                    stay.append(i)
            yield pa.RecordBatch.from_arrays([part.column(c).take(pa.array(stay, pa.int64())) for c in (0, 1)], names=["a", "b"])

    kind = pairs.schema["a"].dataType.simpleString()
    return both.mapInArrow(run, f"a {kind}, b {kind}")


def _overlaps(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Size of the intersection of sets[a] and sets[b] for each pair of positions."""
    if not len(a):
        return np.empty(0, int)
    used = np.unique(np.concatenate([a, b]))
    values, which = np.concatenate([sets[i] for i in used]), np.repeat(used, [len(sets[i]) for i in used])
    order = np.argsort(values, kind="stable")
    values, which = values[order], which[order]
    run = np.cumsum(np.concatenate([[True], values[1:] != values[:-1]])) - 1
    shared = np.bincount(run)[run] > 1
    run, which = np.unique(run[shared], return_inverse=True)[1], which[shared]
    width = int(run.max()) + 1 if len(run) else 0
    if len(a) * 3e-5 < width * float(len(used)) ** 2 * 1e-10:
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(a, b)])
    place = np.zeros(len(sets), int)
    place[used] = np.arange(len(used))
    total = np.zeros((len(used), len(used)), np.float32)
    for first in range(0, width, 4096):  # shared shingles, some columns at a time
        inside = (run >= first) & (run < first + 4096)
        x = np.zeros((len(used), min(4096, width - first)), np.float32)
        x[place[which[inside]], run[inside] - first] = 1
        total += x @ x.T
    return total[place[a], place[b]].astype(int)


def _block_links(p, width: int, percent: int, need: list[int], same: bool):
    """Links between the two sides of a block of one family, of pairs in different components that share a band."""
    sides = p["side"].to_numpy()
    a, b = (np.arange(len(p)),) * 2 if same else (np.flatnonzero(sides == 0), np.flatnonzero(sides == 1))
    c, n = p["c"].to_numpy(), p["n"].to_numpy()
    sig = np.frombuffer(b"".join(p["sig"]), np.uint8).reshape(-1, HASHES)
    bands = np.stack(p["bands"].tolist())
    step = HASHES // len(need)
    left, right = [], []
    for i in a:
        o = b[b > i] if same else b
        o = o[(c[o] != c[i]) & (100 * np.minimum(n[o], n[i]) >= percent * np.maximum(n[o], n[i]))]
        o = o[(bands[o] == bands[i]).any(1)]
        matches = np.zeros(len(o), int)
        for k, least in enumerate(need):
            s = slice(k * step, (k + 1) * step)
            matches = matches + (sig[o, s] == sig[i, s]).sum(1)
            o, matches = o[matches >= least], matches[matches >= least]
        left.append(np.full(len(o), i))
        right.append(o)
    left, right = (np.concatenate(x).astype(int) if x else np.empty(0, int) for x in (left, right))
    sets: list = [None] * len(p)
    texts = p["t"].to_numpy()
    for i in np.unique(np.concatenate([left, right])):
        sets[i] = shingles(texts[i], width)
    common = _overlaps(sets, left, right)
    good = 100 * common >= percent * (n[left] + n[right] - common)
    group = spanning(len(p), left[good], right[good])
    linked = np.flatnonzero(group != np.arange(len(p)))
    ids = p["id"].to_numpy()
    return ids[linked], ids[group[linked]]


def _within_families(families: DataFrame, groups: DataFrame, reps: DataFrame, texts: DataFrame, width: int, percent: int, miss: float, block_rows: int) -> DataFrame:
    """Links between members of a family that aren't in one component yet.

    In each family with several components, members outside its largest one meet all members, in blocks: a family of
    any size is dealt over many tasks, its texts are sent once a block, and no pairs are listed.
    """
    import pandas as pd

    kind = families.schema["id"].dataType.simpleString()
    f = families.join(groups.withColumnRenamed("node", "id"), "id", "left").select("family", "id", F.coalesce("component", "id").alias("c"))
    f = cut(f)
    counts = f.groupBy("family", "c").agg(F.count("*").alias("k"))
    sizes = counts.groupBy("family").agg(F.max(F.struct("k", "c")).alias("top"), F.sum("k").alias("all"), F.count("*").alias("parts")).where("parts > 1")
    sizes = sizes.select("family", F.col("top.c").alias("top"), F.ceil((F.col("all") - F.col("top.k")) / block_rows).cast("int").alias("ns"), F.ceil(F.col("top.k") / block_rows).cast("int").alias("nm"))
    f = f.join(sizes, "family")
    rest = F.col("c") != F.col("top")
    f = f.withColumn("own", F.pmod(F.xxhash64("id"), F.when(rest, F.col("ns")).otherwise(F.col("nm"))).cast("int"))
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    place = lambda i, j, side: F.struct(i.alias("i"), j.alias("j"), side.cast("int").alias("side"))
    own = F.col("own")
    others = F.transform(upto(F.col("ns")), lambda j: place(F.least(own, j), F.greatest(own, j), own > j))
    home = F.transform(upto(F.col("nm")), lambda m: place(own, -1 - m, F.lit(0)))
    guest = F.transform(upto(F.col("ns")), lambda i: place(i, -1 - own, F.lit(1)))
    f = f.withColumn("at", F.explode(F.when(rest, F.concat(others, home)).otherwise(guest))).select("family", "id", "c", "at.*")
    ready = reps.join(f.select("id").distinct(), "id", "left_semi").join(texts, "id")
    ready = ready.groupBy("id").agg(F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("bands").alias("bands"), F.min("t").alias("t"))

    need = needed_matches(percent / 100, miss)

    def block(name: tuple, p: pd.DataFrame) -> pd.DataFrame:
        a, b = _block_links(p, width, percent, need, name[1] == name[2])
        return pd.DataFrame({"a": a, "b": b}).astype({"a": p["id"].dtype, "b": p["id"].dtype})

    return f.join(ready, "id").groupBy("family", "i", "j").applyInPandas(block, f"a {kind}, b {kind}")


def near_dedup(docs: DataFrame, *, text: str = "text", key: str = "doc_id", width: int = 5, percent: int = 80, miss: float = 1e-6, block_rows: int = 256) -> DataFrame:
    """Per row: key, n_shingles, component_id, kept.

    Words are runs of other characters than ASCII blanks, A-Z lowered; a text's set holds its distinct shingles of
    `width` words (of all its words, if fewer). Texts link if 100 * intersection >= percent * union. Shingles stand as hashes of 64 bits,
    and sets count as equal by a hash of 128 bits.

    Equal sets form a class, of which one text goes on. Signatures of 128 values are banded so that a pair at the
    threshold shares a bucket but with probability `miss`. Each member of a bucket is compared with the bucket's
    smallest: signatures in batches, and a pair is pruned once the posterior probability of a similarity over the
    threshold is under `miss`; survivors are confirmed on whole sets and their links merged into components. Members
    of shared buckets form families; in families that still hold several components, members outside the largest
    meet the others in blocks, by the same steps. So every candidate pair is compared, or is in one component
    already, and no list of all pairs of a group is made.

    Texts without words, null texts and rows with a null key link with nothing (n_shingles of the former is 0; the
    component of a row is its key; a null key is kept). Rows that share a key are one node. Long texts are handled
    whole; an empty table gives an empty result; `docs` may have further columns of any names.
    """
    plain = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("t"))
    rows = band_rows(percent / 100, miss)
    info = cut(_described(plain, width, rows))
    usable = info.where("id is not null and n > 0")
    classes = cut(usable.groupBy("set").agg(F.min("id").alias("rep")))  # a table, so that large classes can be split in the joins
    reps = cut(usable.join(classes, (usable["set"] == classes["set"]) & (usable["id"] == classes["rep"])).groupBy("id").agg(F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("bands").alias("bands")))
    members = reps.select("id", F.explode("bands").alias("band"))
    firsts = members.groupBy("band").agg(F.min("id").alias("pivot"), F.max("id").alias("last")).where("pivot <> last").drop("last")
    stars = cut(members.join(firsts, "band").where("id <> pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct())
    size = lambda x: reps.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("sig").alias(f"sig_{x}"))
    pairs = stars.join(size("a"), "a").join(size("b"), "b").where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    pairs = cut(_bayes(pairs, percent / 100, miss))
    families = cut(components(stars).select(F.col("component").alias("family"), F.col("node").alias("id")))
    texts = cut(plain.where("t is not null").join(families, "id", "left_semi"))
    links = cut(_exact(pairs, texts, width, percent))
    groups = components(links)
    more = cut(_within_families(families, groups, reps, texts, width, percent, miss, block_rows))
    groups = merged(groups, more)
    texts_ = info.where("n > 0").select("id", "n", "set").join(classes, "set", "left").join(groups.withColumnRenamed("node", "rep"), "rep", "left").select("id", "n", "rep", "component")
    node = texts_.unionByName(info.where("n = 0").select("id", "n"), allowMissingColumns=True)
    component = F.when(F.col("n") > 0, F.coalesce("component", "rep")).otherwise(F.col("id"))
    component = F.when(F.col("id").isNotNull(), F.coalesce(component, "id"))
    return node.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))
