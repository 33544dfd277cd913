import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from concordat.llm import induced, lines, minhash, queries, shared, suffixes

from . import odd


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def linked(texts, width, percent):
    sets = []
    for t in texts:
        w = words(t)
        sets.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    label = list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = root(i), root(j)
                label[max(x, y)] = min(x, y)
    return [len(s) for s in sets], [root(i) for i in range(len(texts))]


def family(rng, n, size, edits):
    base = [f"w{rng.randrange(500)}" for _ in range(size)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(size)] = f"v{rng.randrange(500)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_minhash_against_brute_force(spark, width, percent):
    rng = random.Random(width)
    texts = [t for k in range(6) for t in family(rng, 40, 60 + 20 * k, 6)] + [None, "", " \n", "one", "one", "ONE", "one two", "Ä ä"] + family(rng, 30, 4, 1)
    sizes, roots = linked(texts, width, percent)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in minhash.near_dedup(df, width=width, percent=percent, block_rows=16).collect()}
    assert [got[i]["n_shingles"] for i in range(len(texts))] == sizes
    assert [got[i]["component_id"] for i in range(len(texts))] == roots
    assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())


def test_minhash_odd_rows(spark):
    got = [tuple(r) for r in minhash.near_dedup(odd.documents(spark, odd.odd_rows())).collect()]
    assert len(got) == 9
    assert {g for g in got if g[0] in (1, 2, 6)} == {(1, 0, 1, True), (2, 0, 2, True), (6, 0, 6, True)}
    assert {g[2] for g in got if g[0] in (4, 5)} == {4} and {g[2] for g in got if g[0] in (7, 8)} == {7}
    assert [g[2:] for g in got if g[0] is None] == [(None, True)]
    assert minhash.near_dedup(odd.documents(spark, odd.odd_rows()).limit(0)).count() == 0


def test_pruning_bounds():
    need = minhash.needed_matches(0.85, 1e-6)
    assert need == sorted(need) and 0 < need[-1] < 0.85 * minhash.HASHES
    assert minhash.needed_matches(0.85, 1e-3)[-1] > need[-1]
    for t, miss in ((0.85, 1e-6), (0.8, 1e-6)):
        r = minhash.band_rows(t, miss)
        assert (1 - t**r) ** (minhash.HASHES // r) <= miss < (1 - t ** (r + 1)) ** (minhash.HASHES // (r + 1))


def test_overlaps_both_ways():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 300, 200).astype(np.uint64)) for _ in range(60)]
    a, b = (x.ravel() for x in np.meshgrid(np.arange(60), np.arange(60)))
    a, b = a[a != b], b[a != b]
    want = [len(np.intersect1d(sets[i], sets[j])) for i, j in zip(a, b)]
    assert minhash._overlaps(sets, a, b).tolist() == want
    assert minhash._overlaps(sets, a[:2], b[:2]).tolist() == want[:2]


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(50)] + [(7, 7)] + [(500, 500 + i) for i in range(1, 50)]
    label = {x: x for e in edges for x in e}
    for _ in range(len(label)):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {r["node"]: r["component"] for r in shared.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in label.items() if any(k in e and e[0] != e[1] for e in edges)}
    assert shared.components(spark.createDataFrame([], "a long, b long")).count() == 0


def sorted_suffixes(t):
    """(order, common prefixes) of all suffixes by brute force."""
    t = t.tolist()
    order = sorted(range(len(t)), key=lambda i: t[i:])
    return order, [0] + [next(k for k in range(len(t)) if t[a + k] != t[b + k]) for a, b in zip(order, order[1:])]


def induced_suffixes(t, symbols, depth, inner):
    return tuple(np.concatenate(x).tolist() for x in zip(*induced.suffix_blocks(t, symbols, depth, inner)))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=80), st.sampled_from([0, 10, 1000]))
def test_induced_order(symbols, inner):
    t = np.array([*symbols, 0], np.uint16)
    assert induced_suffixes(t, 6, len(t) + 1, inner) == sorted_suffixes(t)


@pytest.mark.parametrize("body", [[5] * 80, [1, 2] * 60, [1, 1, 2] * 40, [3, 2, 1] * 40, list(range(1, 100)), list(range(100, 0, -1))])
def test_induced_order_of_periodic_strings(body):
    t = np.array([*body, 0], np.uint16)
    assert induced_suffixes(t, 300, len(t) + 1, 0) == sorted_suffixes(t)


def test_induced_order_from_disk(monkeypatch):
    """Queues that spill all the time, short steps, recursion to the end, and symbols that share ranges."""
    kept = induced.DiskQueues.__init__
    monkeypatch.setattr(induced.DiskQueues, "__init__", lambda self, count: kept(self, count, 16, 4))
    monkeypatch.setattr(induced, "_STEP", 7)
    rng = np.random.default_rng(2)
    for most in (9, 700):
        t = np.append(np.tile(rng.integers(2, most, 150), 4), 0).astype(np.uint16)
        assert induced_suffixes(t, most + 1, len(t), 0) == sorted_suffixes(t)


def removed(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        left = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(b), sum(gone), runs, hashlib.sha256(left).hexdigest()))
    return out


def test_suffixes_against_brute_force(spark, tmp_path):
    rng = random.Random(9)
    passage = ["".join(rng.choice("abcdé \n") for _ in range(n)) for n in (150, 399, 400, 700, 1500)]
    texts = []
    for _ in range(60):
        parts = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(500)))]
        for _ in range(rng.randrange(4)):
            p = rng.choice(passage)
            a = rng.randrange(200)
            parts += [p[a:] if rng.random() < 0.5 else p, "".join(rng.choice("xyz") for _ in range(rng.randrange(30)))]
        texts.append("".join(parts))
    texts += [None, "", "z" * 1000, "z" * 399, "ab" * 600, texts[0], "q" * 5000]
    rows = list(enumerate(texts)) + [(3, texts[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(tuple(r)[:5] for r in queries.op4_suffixes(spark, str(tmp_path)).collect())
    assert got == sorted((i, *r) for (i, _), r in zip(rows, removed([t for _, t in rows], 400)))


def test_suffixes_odd_rows(spark):
    out = suffixes.remove_repeats(odd.documents(spark, odd.odd_rows(2000)), length=400)
    rows = {(r["doc_id"], r["text"]): r["repeats"] for r in out.collect()}
    assert out.count() == 9 and odd.kept(out)
    assert rows[1, None]["n_bytes"] == 0 and rows[1, None]["kept"] == b""
    long_ = odd.odd_rows(2000)[3][1]
    assert rows[4, long_]["n_removed"] == len(long_) and [tuple(s) for s in rows[4, long_]["spans"]] == [(0, len(long_))]
    assert suffixes.remove_repeats(odd.documents(spark, []), length=400).count() == 0


def left_lines(rows, window=3):
    """rows: (doc_id, text), doc ids unique."""
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        if t is None:
            out.append((i, None, 0, 0))
            continue
        ls, gone = t.split("\n"), set()
        for k in range(len(ls) - window + 1):
            w = tuple(ls[k : k + window])
            if any(x.strip(" ") for x in w):
                if w in seen:
                    gone |= set(range(k, k + window))
                seen.add(w)
        out.append((i, "\n".join(x for k, x in enumerate(ls) if k not in gone), len(ls), len(gone)))
    return sorted(out, key=str)


def test_lines_against_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, "\n".join(rng.choice(["a", "b", "c", "", " "]) + str(rng.randrange(3)) * (rng.random() < 0.7) for _ in range(rng.randrange(25)))) for i in range(80)] + [(None, "x\ny\nz"), (900, "x\ny\nz"), (901, None), (902, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["dedup"]["text"], r["dedup"]["n_lines"], r["dedup"]["n_removed"]) for r in lines.line_dedup(df).collect()), key=str)
    assert got == left_lines(rows)


def test_lines_odd_rows(spark):
    out = lines.line_dedup(odd.documents(spark, odd.odd_rows()))
    assert out.count() == 9 and odd.kept(out)
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert lines.line_dedup(odd.documents(spark, [])).count() == 0
    same = lines.line_dedup(odd.documents(spark, [(1, "a\nb\nc", "s"), (1, "a\nb\nc", "s"), (2, "a\nb\nc\nd", "s")])).collect()
    assert sorted((r["doc_id"], r["dedup"]["text"]) for r in same) == [(1, "a\nb\nc"), (1, "a\nb\nc"), (2, "d")]


def test_suffixes_hot_anchor(spark):
    """A passage between different words everywhere: its anchors have more segments than a group may have."""
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(900))
    texts = ["".join(rng.choice("ijklmnop ") for _ in range(300)) + passage[: rng.choice([650, 900])] + "".join(rng.choice("qrstuvwx ") for _ in range(300)) for _ in range(60)]
    texts += texts[:4]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = removed(texts, 400)
    for most in (8, 2048):
        got = suffixes.remove_repeats(df, hot_segments=most).orderBy("doc_id").select("repeats.*").collect()
        assert [(r["n_bytes"], r["n_removed"], len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()) for r in got] == want


def test_induction_spills_and_recurses_at_its_own_bounds(monkeypatch):
    """A shard of the production size, with nothing changed: tuples wait on disk, and names are sorted by recursion."""
    rng = np.random.default_rng(5)
    words = [rng.integers(97, 123, rng.integers(2, 9)).astype(np.uint8).tobytes() for _ in range(3000)]
    body = b" ".join(words[i] for i in np.minimum(rng.zipf(1.3, 900_000), 3000) - 1)[:4_000_000]
    t = np.append(np.frombuffer(body, np.uint8).astype(np.uint16) + np.uint16(2), np.uint16(0))
    levels, spills = [], []
    blocks, append = induced.suffix_blocks, induced.DiskQueues.append

    def counted(t, *a, **k):
        levels.append(len(t))
        return blocks(t, *a, **k)

    def watched(self, q, rows):
        before = self.n_held
        append(self, q, rows)
        spills.append(self.n_held < before)
        assert self.n_held <= induced.MOST

    monkeypatch.setattr(induced, "suffix_blocks", counted)
    monkeypatch.setattr(induced.DiskQueues, "append", watched)
    last, n = None, 0
    for position, common in counted(t, 258, 400):
        n += len(position)
        for p, c in zip(position[:: max(1, len(position) // 50)].tolist(), common.tolist()[:: max(1, len(position) // 50)]):
            if last is not None:
                assert bytes(t[last : last + 400].astype(">u2")) <= bytes(t[p : p + 400].astype(">u2"))
            last = p
    assert n == len(t) and len(levels) >= 2 and sum(spills) > 10


def test_what_segments_share_goes_to_the_sort():
    """Of the segments of an anchor, the widest stretch around it that another has alike; nothing where no string fits."""
    rng, length = random.Random(4), 130
    anchor = "".join(rng.choice("ab") for _ in range(64)).encode()
    sides = [("".join(rng.choice("cd") for _ in range(40)) * 2).encode() for _ in range(2)]
    rows = []
    for i in range(40):
        left, right = (bytes(rng.choice(b"xyz") if rng.random() < 0.02 else x for x in s[: rng.randrange(81)]) for s in sides)
        rows.append((i // 20, f"{i}".encode(), 1 + i % 2, len(left), left[::-1] + anchor + right))
    parts = [pa.RecordBatch.from_pylist([dict(zip("a c n off data".split(), r)) for r in rows[i : i + 7]]) for i in range(0, 40, 7)]
    got = {r["c"]: r for part in suffixes.shared_extents(parts + parts[-1:], length) for r in part.to_pylist()}
    some = 0
    for a, c, n, off, data in rows:
        alike = set()
        for b, e, _, o, other in rows:
            if b == a and e != c:
                at = [s for s in range(len(data) - length + 1) if 0 <= s - off + o and data[s : s + length] == other[s - off + o : s - off + o + length]]
                alike |= set(at)
        if c in got:
            r = got[c]
            assert (r["a"], r["n"], r["off"]) == (a, n, off - r["shift"]) and r["data"] == data[r["shift"] :][: r["starts"] + length - 1]
            assert alike <= set(range(r["shift"], r["shift"] + r["starts"]))
            some += len(r["data"]) < len(data)
        else:
            assert not alike
    assert some and 0 < len(got) < 40


def test_equal_segments_are_not_sorted(spark, monkeypatch):
    """What occurs as a whole more than once and meets nothing different needs no sort; all of it went there before."""

    def sort(parts, length):
        for part in parts:
            if part.num_rows:
                raise AssertionError("sorted")
            yield part

    monkeypatch.setattr(suffixes, "repeated_in_shard", sort)
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(3000)) for _ in range(4)]
    df = spark.createDataFrame(list(enumerate(texts + texts[:3])), "doc_id long, text string")
    got = suffixes.remove_repeats(df).orderBy("doc_id").select("repeats.*").collect()
    assert [(r["n_bytes"], r["n_removed"], len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()) for r in got] == removed(texts + texts[:3], 400)
