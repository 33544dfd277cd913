"""External induced sorting of the suffixes of a byte shard, with common-prefix values, over disk-backed queues.

A suffix tuple is (position, length of the common prefix with the tuple before it in the same bucket). Sweeps pop tuples
in order and push the suffix one to the left; minima of what was popped between two pushes carry the prefixes along.
"""

from __future__ import annotations

import math
import tempfile

import numpy as np

_STEP = 1 << 17
#: Tuples that the queues of one sweep hold in memory, and names that are sorted in memory. Both lie well under what a shard has.
MOST, INNER = 1 << 18, 1 << 20


def _order(keys: np.ndarray, most: int) -> np.ndarray:
    """The stable order of keys up to `most`; short keys are sorted by radix."""
    return np.argsort(keys.astype(np.uint16) if most < 1 << 16 else keys, kind="stable")


def _sorted(at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if (at[1:] >= at[:-1]).all():
        return at, rows
    order = _order(at, int(at.max()))
    return at[order], rows[order]


class DiskQueues:
    """Queues of tuples, one for each range of symbols, first in first out. As the ranges are taken in order and tuples
    are only pushed to the current range or later ones, together they are a monotone priority queue. Tuples wait in a
    short list, are dealt to their ranges, and beyond `most` (2 MB of tuples) go to one file as runs of their ranges."""

    def __init__(self, count: int, most: int = MOST, wait: int = 1 << 13):
        self.held, self.runs = [[] for _ in range(count)], [[] for _ in range(count)]
        self.n_held, self.most, self.file = 0, most, None
        self.waiting, self.n_waiting, self.wait = [], 0, wait

    def push(self, at: np.ndarray, rows: np.ndarray) -> None:
        """Append tuples (two columns) to the queues `at`."""
        if len(at):
            self.waiting.append((at, rows))
            self.n_waiting += len(at)
            if self.n_waiting > self.wait:
                at, rows = self._waiting()
                self.waiting, self.n_waiting = [], 0
                at, rows = _sorted(at, rows)
                cuts = np.flatnonzero(np.diff(at)) + 1
                for q, part in zip(at[np.concatenate([[0], cuts])].tolist(), np.split(rows, cuts)):
                    self.append(q, part)

    def append(self, q: int, rows: np.ndarray) -> None:
        """Append tuples to queue `q`, past the waiting list: not to be mixed with `push` on one queue."""
        self.held[q].append(rows)
        self.n_held += len(rows)
        if self.n_held > self.most:
            if self.file is None:
                self.file = tempfile.TemporaryFile(prefix="queues-")
            self.file.seek(0, 2)
            for held, runs in zip(self.held, self.runs):
                if held:
                    part = np.concatenate(held)
                    runs.append((self.file.tell(), len(part)))
                    part.tofile(self.file)
                    held.clear()
            self.n_held = 0

    def _waiting(self):
        if len(self.waiting) == 1:
            return self.waiting[0]
        return np.concatenate([a for a, _ in self.waiting]), np.concatenate([r for _, r in self.waiting])

    def take(self, q: int, keep: bool = False) -> np.ndarray:
        """All of queue `q`, which is empty then unless `keep`."""
        parts = []
        if self.file is not None:
            self.file.flush()
        for place, n in self.runs[q]:
            self.file.seek(place)
            parts.append(np.fromfile(self.file, np.int32, 2 * n).reshape(n, 2))
        parts += self.held[q]
        if not keep:
            self.n_held -= sum(map(len, self.held[q]))
            self.runs[q], self.held[q] = [], []
        if self.waiting:
            at, rows = self._waiting()
            mine = at == q
            parts.append(rows[mine])
            self.waiting, self.n_waiting = [(at[~mine], rows[~mine])], int((~mine).sum())
        return np.concatenate(parts) if parts else np.empty((0, 2), np.int32)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def _tuples(positions: np.ndarray, common: np.ndarray) -> np.ndarray:
    out = np.empty((len(positions), 2), np.int32)
    out[:, 0], out[:, 1] = positions, common
    return out


def _turned(rows: np.ndarray) -> np.ndarray:
    """Tuples in the opposite order; each common prefix is again with the one before."""
    return _tuples(rows[::-1, 0], np.concatenate([[0], rows[:0:-1, 1]])) if len(rows) else rows


def _run(t: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """How often the symbol at each position follows on itself, from there on."""
    n, live, k = np.ones(len(positions), np.int32), np.arange(len(positions)), 1
    while len(live):
        live = live[positions[live] + k < len(t)]
        live = live[t[positions[live] + k] == t[positions[live]]]
        n[live] += 1
        k += 1
    return n


def _seams(t: np.ndarray, symbol: np.ndarray, kind: np.ndarray, position: np.ndarray, common: np.ndarray, before) -> None:
    """Set the common prefixes, in place, where another bucket (none) or the other kind in a bucket begins.

    A large and a small suffix of one bucket part where the shorter run of its symbol ends."""
    last_symbol, last_kind, last_position = before
    s, k = np.concatenate([[last_symbol], symbol[:-1]]), np.concatenate([[last_kind], kind[:-1]])
    common[s != symbol] = 0
    seam = np.flatnonzero((s == symbol) & (k != kind))
    if len(seam):
        p = np.concatenate([[last_position], position[:-1]])
        common[seam] = np.minimum(_run(t, p[seam]), _run(t, position[seam]))


def _least(x: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Minima of x over first to last, both included."""
    if not len(first):
        return np.empty(0, x.dtype)
    level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
    out, row = np.empty(len(first), x.dtype), x
    for k in range(int(level.max()) + 1):
        if k:
            half = 1 << (k - 1)
            row = np.minimum(row[:-half], row[half:])
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(row[first[at]], row[last[at] - (1 << k) + 1])
    return out


def _sweep(t: np.ndarray, takes: np.ndarray, seeds: DiskQueues, ranges: np.ndarray, count: int, symbols: int, down: bool, done: DiskQueues, carry: bool) -> None:
    """Pop suffixes in order (from the last if `down`) and push those to their left that `takes` marks.

    `seeds` holds, by range, the suffixes of the other kind in ascending order; in a bucket they come after the pushed ones. What
    was pushed ends in `done`, by range, as it was popped. A step commits the tuples up to the first bucket into whose
    past a push of the step would fall; so a step is as if one tuple were popped after the other. Common prefixes are
    left out unless `carry`.
    """
    queue = DiskQueues(count)
    shortest = np.zeros(symbols, np.int32)  # least common prefix popped since the last push to a bucket; 0: another bucket
    fresh = np.empty(0, np.int64)  # where it isn't 0
    before = (-1, False, 0)
    far = np.int32(np.iinfo(np.int32).max)

    alone = count == symbols
    # What a suffix pushes: the symbol to its left, -1 for nothing.
    pushes = np.full(len(t), -1, np.int16 if symbols < 1 << 15 else np.int32)
    np.copyto(pushes[1:], t[:-1], casting="unsafe", where=takes[:-1])

    def keyed(rows, seed):
        """Rows of key, position, common prefix, symbol pushed to and, for a push within the range, its key."""
        out = np.empty((5, len(rows)), np.int32)
        out[1], out[2] = rows[:, 0], rows[:, 1]
        to = out[3] = pushes[out[1]]
        if alone:
            own = symbols - 1 - q if down else q
            out[0], out[4] = own * 2 + seed, np.where(to == q, np.int32(own * 2), far)
            return out
        own, onward = t[out[1]].astype(np.int32), to.astype(np.int32)
        inside = (to >= 0) & (ranges[to] == q)
        if down:
            own, onward = symbols - 1 - own, symbols - 1 - onward
        out[0], out[4] = own * 2 + seed, np.where(inside, onward * 2, far)
        return out

    for q in range(count - 1, -1, -1) if down else range(count):
        pushed, given = queue.take(q), seeds.take(q, down)
        if down:
            given = _turned(given)
        if not len(pushed) and not len(given):
            continue
        work = np.concatenate([keyed(pushed, 0), keyed(given, 1)], axis=1)
        if (work[0, 1:] < work[0, :-1]).any():
            work = work[:, np.argsort(work[0], kind="stable")]
        while work.shape[1]:
            ahead = work[:, :_STEP]
            barrier = np.minimum.accumulate(ahead[4])
            late = ahead[0][1:] > barrier[:-1]
            k = int(late.argmax()) + 1 if late.any() else len(ahead[0])
            key, position, common, to, inner = ahead[:, :k]
            own, kind = key >> 1, (key & 1).astype(bool)
            if carry:
                common = common.copy()
                _seams(t, own, kind, position, common, before)
                before = (own[-1], kind[-1], position[-1])
            if not kind.all():
                done.append(q, _tuples(position[~kind], common[~kind]))
            at = np.flatnonzero(to >= 0)
            at = at[_order(to[at], symbols)]
            target = to[at]
            new = _tuples(position[at] - 1, 0)
            if carry:
                opens = np.ones(len(at), bool)
                opens[1:] = target[1:] != target[:-1]
                again, first = np.flatnonzero(~opens), np.flatnonzero(opens)
                new[again, 1] = _least(common, at[again - 1] + 1, at[again]) + 1
                new[first, 1] = np.minimum(shortest[target[first]], np.minimum.accumulate(common)[at[first]]) + 1
                shortest[fresh] = np.minimum(shortest[fresh], common.min())
                if len(at):
                    ends = np.append(first[1:] - 1, len(at) - 1)
                    rest = np.minimum.accumulate(np.append(common[1:], far - 1)[::-1])[::-1]
                    shortest[target[ends]] = rest[at[ends]]
                    fresh = np.union1d(fresh, target[ends])
                fresh = fresh[shortest[fresh] > 0]
            work = work[:, k:]
            if len(at):
                here = inner[at] != far
                queue.push(ranges[target[~here]], new[~here])
                if here.any():
                    extra = keyed(new[here], 0)
                    extra = extra[:, np.argsort(extra[0], kind="stable")]
                    place = np.searchsorted(work[0], extra[0], "right")
                    if place[0] == place[-1]:
                        work = np.concatenate([work[:, : place[0]], extra, work[:, place[0] :]], axis=1)
                    else:
                        work = np.insert(work, place, extra, axis=1)
    queue.close()


def _induce(t: np.ndarray, small: np.ndarray, seeds: np.ndarray, ranges: np.ndarray, count: int, symbols: int, carry: bool = True):
    """All suffixes in order as tuples, a range of symbols at a time, from ordered tuples of left-most small ones."""
    given, large, little = (DiskQueues(count) for _ in range(3))
    given.push(ranges[t[seeds[:, 0]]], seeds)
    _sweep(t, ~small, given, ranges, count, symbols, False, large, carry)
    given.close()
    _sweep(t, small, large, ranges, count, symbols, True, little, carry)
    before = (-1, False, 0)
    for q in range(count):
        a, b = large.take(q), _turned(little.take(q))
        if q == ranges[0]:  # no suffix hands over the sentinel
            b = np.concatenate([_tuples(np.array([len(t) - 1]), np.array([0])), b])
        rows = np.concatenate([a, b])
        if not len(rows):
            continue
        position, common, kind = rows[:, 0], rows[:, 1].copy(), np.repeat([False, True], [len(a), len(b)])
        if count == symbols:
            own = np.full(len(rows), q)
        else:
            own = t[position].astype(np.int64)
            order = _order((own - own.min()) * 2 + kind, int(own.max() - own.min()) * 2 + 1)
            own, kind, position, common = own[order], kind[order], position[order], common[order]
        if carry:
            _seams(t, own, kind, position, common, before)
        before = (own[-1], kind[-1], position[-1])
        yield position, common
    large.close()
    little.close()


def _small(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one to its right; the last one, the sentinel, is."""
    n = len(t)
    up, change = t[1:] > t[:-1], np.flatnonzero(t[1:] != t[:-1])
    out = np.ones(n, bool)
    # A run of equal symbols follows the first change after it.
    if len(change):
        out[:-1] = np.repeat(up[change], np.diff(change, prepend=-1))
    return out


def _ranges(t: np.ndarray, symbols: int) -> tuple[np.ndarray, int]:
    """The range of each symbol: a symbol of its own if they are few, else about as many positions as there are ranges."""
    if symbols <= 512:
        return np.arange(symbols), symbols
    counts = np.bincount(t, minlength=symbols)
    r = (np.cumsum(counts) - counts) * math.isqrt(len(t)) // len(t)
    _, r = np.unique(r, return_inverse=True)
    return r, int(r[-1]) + 1


def only(blocks, wanted: np.ndarray):
    """The wanted suffixes of a stream of blocks, block by block: minima of common prefixes carry over those left out."""
    least = np.iinfo(np.int32).max
    for position, common in blocks:
        at = np.flatnonzero(wanted[position])
        if not len(at):
            least = min(least, int(common.min()))
            continue
        c = common.copy()
        c[0] = min(c[0], least)
        # Each stretch ends with a wanted one; what follows the last one is carried on.
        low = np.minimum.reduceat(c[: at[-1] + 1], np.concatenate([[0], at[:-1] + 1]))
        yield position[at], low
        least = int(common[at[-1] + 1 :].min()) if at[-1] + 1 < len(common) else np.iinfo(np.int32).max


def classes(blocks, length: int):
    """The stream regrouped: no run of suffixes that share `length` symbols is cut between two parts."""
    held: list = []
    for position, common in blocks:
        opens = np.flatnonzero(common < length)
        if len(opens) and held:
            k = opens[-1]
            yield tuple(np.concatenate(x) for x in zip(*held, (position[:k], common[:k])))
            held = [(position[k:], common[k:])]
        else:
            held.append((position, common))
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held))


def _in_memory(names: np.ndarray, depth: int):
    """(order, common prefixes up to `depth`) of the suffixes of a string that fits in memory, by doubling.

    The ranks of every round are kept: halving the step again, they tell how far neighbours agree."""
    rank, span, rounds = names, 1, []
    while True:
        rounds.append((span, rank))
        if span >= depth or int(rank.max()) + 1 == len(rank):
            break
        key = rank.astype(np.int64) * (len(rank) + 1)
        key[:-span] += rank[span:] + 1
        at = np.argsort(key)
        key = key[at]
        rank = np.zeros_like(rank)
        rank[at[1:]] = np.cumsum(key[1:] != key[:-1])
        span *= 2
    order = np.argsort(rank).astype(np.int32)
    x, y, common = order[:-1].copy(), order[1:].copy(), np.zeros(len(order), np.int32)
    for span, known in reversed(rounds):
        known = np.append(known, [-1, -2]).astype(np.int32)
        agree = (known[np.minimum(x, len(names))] == known[np.minimum(y, len(names) + 1)]) & (np.maximum(x, y) < len(names))
        step = agree * np.int32(span)
        x, y = x + step, y + step
        common[1:] += step
    return order.astype(np.int64), common.astype(np.int64)


def suffix_blocks(t: np.ndarray, symbols: int, depth: int, inner: int = INNER):
    """All suffixes of `t`, symbols below `symbols`, in order by their first `depth` symbols at least: blocks of
    (positions, common prefixes with the one before; those of `depth` or more may be shorter than the whole).

    `t` ends with 0, which occurs nowhere else. Left-most small substrings are sorted by induction and named; the
    string of their names is sorted by this very function until all names differ or it fits in memory, at most
    `inner` names; the order and common prefixes of these suffixes induce those of all.
    """
    small = _small(t)
    lms = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(np.int64)
    ranges, count = _ranges(t, symbols)
    marked = np.zeros(len(t) + 1, bool)
    marked[lms] = True
    order = np.concatenate([p[marked[p]] for p, _ in _induce(t, small, _tuples(lms, 1), ranges, count, symbols, False)])
    which = np.empty(len(t), np.int32)  # the number of each left-most small suffix
    which[lms] = np.arange(len(lms))
    which = which[order]
    del marked
    # Equal neighbours get one name: as long, and equal up to and with the next left-most small position.
    size = (np.diff(lms, append=len(t) - 1) + 1).astype(np.int32)
    length = size[which]
    new, k = np.ones(len(order), bool), 0
    new[1:] = length[1:] != length[:-1]
    if t.dtype == np.uint16:  # the first eight symbols as two words
        ahead = np.append(t, np.zeros(8, np.uint16))
        for k in (4, 8):
            w = np.zeros(len(lms), np.uint64)
            for j in range(k - 4, k):
                w = (w << np.uint64(16)) | np.where(j < size, ahead[lms + j], 0).astype(np.uint64)
            w = w[which]
            new[1:] |= w[1:] != w[:-1]
        del ahead, w
    live = np.flatnonzero(~new)
    while len(live):
        live = live[length[live] > k]
        same = t[order[live - 1] + k] == t[order[live] + k]
        new[live[~same]] = True
        live, k = live[same], k + 1
    names = np.empty(len(lms), np.int32)
    names[which] = np.cumsum(new) - 1
    del size, length, which, order
    if new.all():
        at, shared = np.argsort(names), np.zeros(len(names), np.int64)
    elif len(names) <= inner:
        at, shared = _in_memory(names, (depth + 1) // 2)  # a name has two symbols or more
    else:
        blocks = list(suffix_blocks(names, int(names.max()) + 1, (depth + 1) // 2, inner))
        at, shared = (np.concatenate(x).astype(np.int64) for x in zip(*blocks))
        del blocks
    # From names to symbols: what whole equal names span, and what the first different ones have in common.
    common = np.zeros(len(at), np.int64)
    x, y = lms[at[:-1] + shared[1:]], lms[at[1:] + shared[1:]]
    common[1:] = y - lms[at[1:]]
    live = np.flatnonzero(common[1:] < depth)
    x, y, live = x[live], y[live], live + 1
    while len(live):
        go = np.flatnonzero(np.maximum(x, y) < len(t))
        go = go[t[x[go]] == t[y[go]]]
        x, y, live = x[go] + 1, y[go] + 1, live[go]
        common[live] += 1
    yield from _induce(t, small, _tuples(lms[at], common), ranges, count, symbols)
