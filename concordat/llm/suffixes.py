"""Suffix-array dedup: removal of byte strings that occur more than once, by external induced sorting of shards."""

from __future__ import annotations

import math
import tempfile
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .induced import classes, only, suffix_blocks
from .shared import cut, is_empty, sieve

GRAM = 64
_PLACE = np.uint64((1 << 28) - 1)
_STRETCH = 1 << 20


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, where each text starts and the last one ends) of a column of strings; nulls are empty."""
    c = pc.fill_null(column.cast(pa.large_binary()), b"")
    ends = np.frombuffer(c.buffers()[1], np.int64)[c.offset : c.offset + len(c) + 1]
    return np.frombuffer(c.buffers()[2] or b"", np.uint8), ends


def anchor_runs(data: np.ndarray, ends: np.ndarray, length: int):
    """For texts that stand one after the other in `data`, arrays of (text, anchor hash, place of the anchor, first
    start, last start), places within the text: every start of a `length`-byte string belongs to the smallest-hash
    `GRAM` bytes in it, the left-most of equals. Equal strings have equal anchors at equal offsets."""
    width, odd, i = length - GRAM + 1, 0x9E3779B97F4A7C15, 0
    while i < len(ends) - 1:
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + _STRETCH, "right")) - 1)
        for base in range(int(ends[i]), int(ends[j]) - length + 1, _STRETCH):  # a long text goes in stretches of starts
            starts = min(_STRETCH, int(ends[j]) - length + 1 - base)
            inside = np.zeros(starts + 1, np.int8)
            low, high = np.maximum(ends[i:j] - base, 0), np.minimum(ends[i + 1 : j + 1] - length + 1 - base, starts)
            some = low < high
            inside[low[some]] += 1
            inside[high[some]] -= 1
            h, step, power = data[base : base + starts + length - 1].astype(np.uint64) + np.uint64(1), 1, odd
            while step < GRAM:
                h = h[:-step] * np.uint64(power) + h[step:]
                power, step = power * power % (1 << 64), step * 2
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(32)
            n = len(h)
            rows = -(-n // width)
            key = np.full(rows * width, np.uint64(2**64 - 1))
            key[:n] = (h & ~_PLACE) | np.arange(n, dtype=np.uint64)
            grid = key.reshape(rows, width)
            ahead = np.minimum.accumulate(grid, axis=1).ravel()
            back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
            at = (np.minimum(back[:starts], ahead[width - 1 : width - 1 + starts]) & _PLACE).astype(np.int64)
            at[np.cumsum(inside[:-1]) == 0] = -1
            cuts = np.flatnonzero(np.diff(at)) + 1
            first, last = np.concatenate([[0], cuts]), np.concatenate([cuts - 1, [starts - 1]])
            got = at[first] >= 0
            first, last = first[got], last[got]
            p = at[first]
            text = np.searchsorted(ends, base + first, "right") - 1
            move = base - ends[text]
            yield text, h[p].view(np.int64), p + move, first + move, last + move
        i = j


def _lists(counts: np.ndarray, values: pa.Array) -> pa.Array:
    ends = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)


def anchor_lists(parts, length: int):
    """For batches of (id, th, text): id, th and the anchors of the text, as often as they occur."""
    for part in parts:
        data, ends = _buffers(part.column(2))
        runs = [(t, a) for t, a, *_ in anchor_runs(data, ends, length)]
        text, anchor = (np.concatenate(x) for x in zip(*runs)) if runs else (np.empty(0, np.int64),) * 2
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), _lists(np.bincount(text, minlength=part.num_rows), pa.array(anchor))], names=["id", "th", "anchors"])


def _digest(data: bytes, off: int) -> bytes:
    return blake2b(data, digest_size=16, salt=off.to_bytes(4, "little")).digest()


def segment_rows(parts, length: int):
    """For batches of (id, th, text, anchors): rows (id, th, a, c, off, first, last) of the text's segments at these
    anchors; c is a digest of the segment, all bytes of the strings from start `first` to start `last`."""
    for part in parts:
        data, ends = _buffers(part.column(2))
        lists = part.column(3)
        mark = np.arange(part.num_rows, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
        wanted = mark.repeat(pc.list_value_length(lists).to_numpy(zero_copy_only=False)) ^ lists.flatten().to_numpy().view(np.uint64)
        for text, anchor, place, first, last in anchor_runs(data, ends, length):
            k = np.isin(mark[text] ^ anchor.view(np.uint64), wanted)
            text, anchor, off, first, last = text[k], anchor[k], (place - first)[k], first[k], last[k]
            begin = ends[text] + first
            digests = [_digest(data[b:e].tobytes(), o) for b, e, o in zip(begin.tolist(), (begin + last - first + length).tolist(), off.tolist())]
            rows = pa.array(text)
            yield pa.RecordBatch.from_arrays([part.column(0).take(rows), part.column(1).take(rows), pa.array(anchor), pa.array(digests, pa.binary()), *(pa.array(x.astype(np.int32)) for x in (off, first, last))], names=["id", "th", "a", "c", "off", "first", "last"])


def single_starts(parts, length: int):
    """For batches of (id, th, text, segments): a row (a, c, n, at, string) for every start of the segments, `at` its
    place in the segment and `string` the digest of the string that starts there."""
    for part in parts:
        for text, segments in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
            data = text.encode("utf-8", "replace")
            for r in segments:
                at = np.arange(r["last"] - r["first"] + 1, dtype=np.int64)
                digests = [_digest(data[f : f + length], 0) for f in (at + r["first"]).tolist()]
                same = lambda v, kind: pa.array([v] * len(at), kind)
                yield pa.RecordBatch.from_arrays([same(r["a"], pa.int64()), same(r["c"], pa.binary()), same(r["n"], pa.int64()), pa.array(at), pa.array(digests, pa.binary())], names=["a", "c", "n", "at", "string"])


def _agree(x: bytes, y: bytes) -> int:
    """How many bytes two strings have in common at the start."""
    low, high = 0, min(len(x), len(y))
    if x[:high] == y[:high]:
        return high
    while low < high:
        k = (low + high + 1) // 2
        low, high = (k, high) if x[low:k] == y[low:k] else (low, k - 1)
    return low


def _widest(sides: list[bytes]) -> list[int]:
    """For each of these strings the longest start that it shares with another: with a neighbour in order."""
    order, out = sorted(range(len(sides)), key=sides.__getitem__), [0] * len(sides)
    for i, j in zip(order, order[1:]):
        k = _agree(sides[i], sides[j])
        out[i], out[j] = max(out[i], k), max(out[j], k)
    return out


def shared_extents(parts, length: int):
    """For batches of (a, c, n, off, data) in the order of a: rows (a, c, n, off, starts, shift, data) of the segments
    that may share a string with another of their anchor, without their first `shift` bytes and those at the end that no
    other has alike. Equal strings of two segments stand alike to the anchor at `off`, so they lie within what the two have
    in common to its left and to its right."""
    names = ["a", "c", "n", "off", "starts", "shift", "data"]

    def of_group(a: int, group: dict) -> list:
        if len(group) < 2:
            return []
        rows = list(group.items())
        right, left = _widest([data[off:] for _, (_, off, data) in rows]), _widest([data[:off][::-1] for _, (_, off, data) in rows])
        return [(a, c, n, k, k + r - length + 1, off - k, data[off - k : off + r]) for (c, (n, off, data)), r, k in zip(rows, right, left) if k + r >= length]

    def batch(out: list) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names=names)

    at, group, out = None, {}, []
    for part in parts:
        for a, c, n, off, data in zip(*(part.column(k).to_pylist() for k in ("a", "c", "n", "off", "data"))):
            if a != at:
                out += of_group(at, group)
                at, group = a, {}
            group[c] = (n, off, data)
        if len(out) >= 4096:
            yield batch(out)
            out = []
    out += of_group(at, group)
    if out:
        yield batch(out)


def repeated_in_shard(parts, length: int):
    """Rows (a, c, low, high) for the segments of a shard that occur once: bytes low to high of segment c are in
    repeated strings. A segment that occurs more often is repeated as a whole; it is here for what others share with it.

    Segments go to a file as they come; its suffixes are sorted externally, and the common prefixes that come with
    the order say which neighbours share `length` bytes. Starts whose strings are equal, and stand alike to the same anchor,
    are occurrences of one string; every segment counts as often as it occurs.
    """
    seen, groups, names, counts, offs, sizes, shifts, heads = set(), [], [], [], [], [], [], []
    with tempfile.TemporaryFile(prefix="shard-") as file:
        total = 0
        for part in parts:
            for a, c, n, off, starts, shift, data in zip(*(part.column(k).to_pylist() for k in ("a", "c", "n", "off", "starts", "shift", "data"))):
                if (a, c) in seen:
                    continue
                seen.add((a, c))
                (np.frombuffer(data, np.uint8).astype(np.uint16) + np.uint16(2)).tofile(file)
                np.ones(1, np.uint16).tofile(file)
                for to, x in ((groups, a), (names, c), (counts, n), (offs, off), (sizes, starts), (shifts, shift), (heads, total)):
                    to.append(x)
                total += len(data) + 1
        if not total:
            return
        np.zeros(1, np.uint16).tofile(file)
        file.flush()
        text = np.asarray(np.memmap(file, np.uint16, "r", shape=(total + 1,)))
        heads_, sizes_, counts_, offs_ = np.array(heads, np.int64), np.array(sizes, np.int64), np.array(counts, np.int64), np.array(offs, np.int64)
        _, group = np.unique(np.array(groups, np.int64), return_inverse=True)
        wanted = np.zeros(total + 1, bool)
        step = np.zeros(total + 2, np.int8)
        np.add.at(step, heads_, 1)
        np.add.at(step, heads_ + sizes_, -1)
        np.cumsum(step[:-1], out=wanted.view(np.int8))
        low, high = np.full(len(heads_), 1 << 40), np.full(len(heads_), -1)
        owner = np.repeat(np.arange(len(heads_), dtype=np.int32), np.diff(heads_, append=total + 1))
        for x, common in classes(only(suffix_blocks(text, 258, length), wanted), length):
            seg = owner[x]
            offset = x - heads_[seg]
            key = (np.cumsum(common < length) << 32) | (group[seg].astype(np.int64) << 10) | (offset - offs_[seg] + 512)
            order = np.argsort(key)
            run = np.cumsum(np.concatenate([[True], np.diff(key[order]) != 0])) - 1
            often = np.bincount(run, counts_[seg[order]]) >= 2
            hit = order[often[run]]
            np.minimum.at(low, seg[hit], offset[hit])
            np.maximum.at(high, seg[hit], offset[hit])
        got, ahead = np.flatnonzero((high >= 0) & (counts_ == 1)), np.array(shifts, np.int64)
        # Starts of a segment lie less than `length` apart, so what they cover is one stretch.
        yield pa.RecordBatch.from_arrays([pa.array([groups[i] for i in got], pa.int64()), pa.array([names[i] for i in got], pa.binary()), pa.array(low[got] + ahead[got], pa.int64()), pa.array(high[got] + ahead[got] + length, pa.int64())], names=["a", "c", "low", "high"])


def remove_repeats(docs: DataFrame, *, text: str = "text", key: str = "doc_id", length: int = 400, shard_bytes: int = 4_000_000, hot_segments: int = 2048) -> DataFrame:
    """Every row of `docs` plus a struct `repeats`: n_bytes, n_removed, spans (start, end), kept (the bytes left).

    Texts are UTF-8 bytes. Each byte goes that is covered by a string of `length` bytes that also starts anywhere
    else; strings don't cross documents and are judged on the input. Spans are the maximal runs that go.

    Starts are dealt by the anchor of their string, so equal strings meet; anchors that occur once are out, by a count
    of hashes alone. Of equal segments around an anchor one goes on, with their number; for an anchor with more than
    `hot_segments` different segments, each start goes under the digest of its whole string, so that no task is handed
    a group that grows with the corpus. A segment that occurs more than once is repeated as a whole. Of the others, and of those
    these may share a string with, what no other segment of the anchor has alike around it is left out (`shared_extents`).
    The rest is dealt into shards of about `shard_bytes`, and each shard is sorted by external
    induction: tuples beyond 2 MB wait on disk, and names beyond `induced.INNER` are sorted by recursion. Then spans
    go back to all occurrences. Texts are only moved where a sieve says that they may hold what is looked for.
    `length` is 128 to 575.

    Null texts count as empty; texts shorter than `length` stay whole; null keys are allowed; rows that share key and
    text are separate documents with equal texts, so all they hold is repeated; texts of any length are handled whole;
    an empty table gives an empty result. `docs` may have columns of any names but `repeats`.
    """
    if not 2 * GRAM <= length <= 511 + GRAM:
        raise ValueError("length must be 128 to 575")
    kind = docs.schema[key].dataType.simpleString()
    plain = docs.select(F.col(f"`{key}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("th"), F.col(f"`{text}`").alias("t")).where(F.octet_length("t") >= length)
    own = [F.col("id"), F.col("th")]

    def texts_of(wanted: DataFrame, column: str) -> DataFrame:
        """(id, th, t, column) of the texts that `wanted` (id, th, column) names."""
        w = wanted.select(F.col("id").alias("w_id"), F.col("th").alias("w_th"), column)
        may = sieve(w, ["w_id", "w_th"])(plain, own).where("may").drop("may")
        return may.join(w, F.col("id").eqNullSafe(F.col("w_id")) & (F.col("th") == F.col("w_th"))).select("id", "th", "t", column)

    rows = f"id {kind}, th long, a long, c binary, off int, first int, last int"
    lists = cut(plain.mapInArrow(lambda parts: anchor_lists(parts, length), f"id {kind}, th long, anchors array<long>"))
    each = lists.select("id", "th", F.explode("anchors").alias("a"))
    often = cut(each.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a"))  # a table: the join can split hot anchors
    wanted = cut(each.join(often, "a").groupBy("id", "th").agg(F.collect_set("a").alias("anchors")))
    found = cut(texts_of(wanted, "anchors").mapInArrow(lambda parts: segment_rows(parts, length), rows))

    def grouped(found: DataFrame) -> DataFrame:
        return found.groupBy("a", "c").agg(F.count("*").alias("n"), F.min(F.struct("id", "th", "first", "last", "off")).alias("at")).select("a", "c", "n", "at.*")

    segments = cut(grouped(found))
    sizes = cut(segments.groupBy("a").agg(F.count("*").alias("k")).where("k > 1"))
    hot, few = sizes.where(F.col("k") > hot_segments).select("a"), sizes.where(F.col("k") <= hot_segments).select("a")
    apart = None
    if not is_empty(hot):
        chosen = cut(segments.join(hot, "a").groupBy("id", "th").agg(F.collect_list(F.struct("a", "c", "n", "first", "last")).alias("segments")))
        starts = cut(texts_of(chosen, "segments").mapInArrow(lambda parts: single_starts(parts, length), "a long, c binary, n long, at long, string binary"))
        again = cut(starts.groupBy("string").agg(F.sum("n").alias("all")).where("all > 1").select("string"))
        apart = starts.join(again, "string").groupBy("a", "c").agg(F.min("at").alias("low"), (F.max("at") + length).alias("high"))
        segments = cut(segments.join(hot, "a", "left_anti"))
    whole = segments.where("n > 1").select("a", "c", F.lit(0).cast("long").alias("low"), (F.col("last") - F.col("first") + length).cast("long").alias("high"))
    wanted = cut(segments.join(few, "a", "left_semi").groupBy("id", "th").agg(F.collect_list(F.struct("a", "c", "n", "first", "last", "off")).alias("segments")))

    def fetch(parts):
        for part in parts:
            for t, found_in in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                data = t.encode("utf-8", "replace")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["a"] for r in found_in], pa.int64()), pa.array([r["c"] for r in found_in], pa.binary()), pa.array([r["n"] for r in found_in], pa.int64()), pa.array([r["off"] for r in found_in], pa.int32()),
                     pa.array([data[r["first"] : r["last"] + length] for r in found_in], pa.binary())], names=["a", "c", "n", "off", "data"])

    groups = texts_of(wanted, "segments").select("t", "segments").mapInArrow(fetch, "a long, c binary, n long, off int, data binary").repartition("a").sortWithinPartitions("a")
    extents = cut(groups.mapInArrow(lambda parts: shared_extents(parts, length), "a long, c binary, n long, off int, starts int, shift int, data binary"))
    size = extents.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    shards = extents.repartition(max(1, math.ceil(size / shard_bytes)), "a")
    spans = shards.mapInArrow(lambda parts: repeated_in_shard(parts, length), "a long, c binary, low long, high long").unionByName(whole)
    spans = cut(spans.unionByName(apart) if apart is not None else spans)
    back = found.join(spans, ["a", "c"]).groupBy("id", "th").agg(F.collect_set(F.struct((F.col("first") + F.col("low")).alias("start"), (F.col("first") + F.col("high")).alias("end"))).alias("spans"))
    back = cut(back.select(F.col("id").alias("b_id"), F.col("th").alias("b_th"), "spans"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    whole = docs.select(row.alias("row"), F.col(f"`{key}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("th"), F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("data"))
    whole = sieve(back, ["b_id", "b_th"])(whole, own)
    some = whole.where("may").join(back, F.col("id").eqNullSafe(F.col("b_id")) & (F.col("th") == F.col("b_th")), "left").select("row", "data", "spans")
    whole = some.unionByName(whole.where("not may").select("row", "data").withColumn("spans", F.lit(None).cast(back.schema["spans"].dataType)))
    # Spans in order, merged where they touch: each that starts beyond all before it opens a run.
    span = "array<struct<start:bigint,end:bigint>>"
    merged = F.aggregate(F.array_sort("spans"), F.array().cast(span), lambda acc, x: F.when((F.size(acc) > 0) & (x["start"] <= F.element_at(acc, -1)["end"]), F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end"))))).otherwise(F.concat(acc, F.array(x))))
    whole = whole.select("row", "data", F.coalesce(F.when(F.col("spans").isNotNull(), merged), F.array().cast(span)).alias("spans"))
    n, runs = F.octet_length("data").cast("long"), F.col("spans")
    edges = F.concat(F.array(F.lit(0).cast("long")), F.transform(runs, lambda s: s["end"]))
    keep = F.transform(edges, lambda e, i: F.substring(F.col("data"), (e + 1).cast("int"), F.when(i < F.size(runs), F.element_at(runs, F.least(i + 1, F.size(runs)))["start"] - e).otherwise(n - e).cast("int")))
    kept = F.when(F.size(runs) == 0, F.col("data")).otherwise(F.aggregate(keep, F.lit(b""), lambda acc, x: F.concat(acc, x)))
    removed = F.aggregate(runs, F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    # The struct first, the row's columns after: names inside lambdas would find columns of the row.
    return whole.select("row", F.struct(n.alias("n_bytes"), removed.alias("n_removed"), runs.alias("spans"), kept.alias("kept")).alias("repeats")).select("row.*", "repeats")
