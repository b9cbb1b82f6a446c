"""Suffix sorting by induction, with queues of suffix tuples that go to disk.

A suffix that starts with a larger symbol than the next one (L) takes its place from the suffix one to the right; so does one that starts with a smaller symbol (S),
from the other end. So only the suffixes that begin a climb (LMS) have to be sorted: their pieces are sorted by the same induction and named, and
the text of names is sorted by recursion. Tuples (suffix, common prefix with the one before) wait in a queue for their first symbol's turn.
"""

from __future__ import annotations

import tempfile
from typing import NamedTuple

import numpy as np

#: Bytes of waiting tuples that a queue holds in memory.
QUEUE_BYTES = 16 << 20
#: Tuples of a run of names that one turn takes.
TURN = 1 << 16


class DiskQueue:
    """Tuples (rows of longs) by turn, first in, first out within one. Beyond `limit` bytes all that wait are written to a file of the task's own, which has no name and goes with the task."""

    def __init__(self, width: int, limit: int = QUEUE_BYTES):
        self.width, self.limit, self.held, self.file = width, limit, 0, None
        self.waiting: dict[int, list[np.ndarray]] = {}
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def push(self, turn: int, tuples: np.ndarray) -> None:
        if len(tuples):
            self.waiting.setdefault(turn, []).append(tuples)
            self.held += tuples.nbytes
            if self.held > self.limit:
                self._spill()

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for turn, parts in sorted(self.waiting.items()):
            at = self.file.tell()
            for part in parts:
                self.file.write(np.ascontiguousarray(part, np.int64).tobytes())
            self.runs.setdefault(turn, []).append((at, self.file.tell() - at))
        self.waiting, self.held = {}, 0

    def pop(self, turn: int) -> np.ndarray:
        parts = []
        for at, size in self.runs.pop(turn, ()):
            self.file.seek(at)
            parts.append(np.frombuffer(self.file.read(size), np.int64).reshape(-1, self.width))
        own = self.waiting.pop(turn, [])
        self.held -= sum(x.nbytes for x in own)
        return np.concatenate([np.zeros((0, self.width), np.int64), *parts, *own])

    def close(self) -> None:
        if self.file:
            self.file.close()


class Sweep(NamedTuple):
    order: np.ndarray
    lcp: np.ndarray  # common prefix of each with the one before; 0 for the first of a symbol


def _is_s(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the last one is."""
    s = np.append(t[:-1] < t[1:], True)
    level = np.append(t[:-1] == t[1:], False)
    differs = np.flatnonzero(~level)
    at = np.flatnonzero(level)
    s[at] = s[differs[np.searchsorted(differs, at)]]
    return s


def _commons(t: np.ndarray, most: int):
    """A function for the common prefixes of suffixes a and b of 16-bit symbols, `most` at most; it compares four symbols at once."""
    wide = np.ndarray(len(t), "<u8", t.astype("<u2").tobytes() + bytes(8), strides=(2,))

    def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out, open_ = np.zeros(len(a), np.int64), np.arange(len(a))
        for k in range(0, most, 4):
            x, y = a[open_] + k, b[open_] + k
            inside = (x < len(t)) & (y < len(t))
            open_, x, y = open_[inside], x[inside], y[inside]
            differ = wide[x] ^ wide[y]
            low = differ & (~differ + np.uint64(1))
            same = np.where(differ == 0, 4, np.log2(np.maximum(low, np.uint64(1)).astype(np.float64)).astype(np.int64) // 16)
            out[open_] += same
            open_ = open_[same == 4]
        return np.minimum(out, most)

    return common


def by_symbols(t: np.ndarray, key: np.ndarray, wanted: np.ndarray, seeds: Sweep, limit: int = QUEUE_BYTES, edges=None) -> Sweep:
    """The `wanted` suffixes in order, induced from `seeds`, one symbol of a small alphabet a turn.

    `key` has the symbols in the order of turns. What a turn finds by itself (runs of one symbol) follows in waves: a suffix of the k-th wave starts with k more of
    the symbol, so the first of a wave shares just k + 1 with the one before. Two suffixes that wait for one symbol share one more than the two that they come from.
    `edges` gives the common prefix of the last found suffix of a symbol and its first seed; None means that common prefixes aren't wanted.
    """
    queue = DiskQueue(2, limit)
    many = np.bincount(key[seeds.order], minlength=int(key.max(initial=0)) + 1)
    upto = np.append(0, np.cumsum(many))
    found, shared = [], []
    for turn in np.flatnonzero(np.bincount(key)).tolist():
        waves = [queue.pop(turn)]
        while len(waves[-1]):
            own, lcp = waves[-1][:, 0], waves[-1][:, 1]
            before = own - 1
            into = np.flatnonzero((own > 0) & wanted[before] & (key[before] == turn))
            more = np.empty((len(into), 2), np.int64)
            more[:, 0] = before[into]
            if edges and len(into):
                more[1:, 1] = 1 + _between(lcp, into)
                more[0, 1] = len(waves)
            waves.append(more)
        own = np.concatenate(waves)
        if len(own):
            own[0, 1] = 0
        found.append(own[:, 0])
        shared.append(own[:, 1])
        mine = slice(upto[turn], upto[turn + 1])
        seed, seed_lcp = seeds.order[mine], seeds.lcp[mine].copy()
        if edges and len(own) and len(seed):
            seed_lcp[0] = edges(own[-1:, 0], seed[:1])[0]
        all_, lcp = np.concatenate([own[:, 0], seed]), np.concatenate([own[:, 1], seed_lcp])
        before = all_ - 1
        into = np.flatnonzero((all_ > 0) & wanted[before] & (key[before] != turn))
        target = key[before[into]]
        by_target = np.argsort(target, kind="stable")
        into, target = into[by_target], target[by_target]
        borders = np.append(np.flatnonzero(np.append(True, target[1:] != target[:-1])[: len(target)]), len(target))
        for a, b in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):
            out = np.empty((b - a, 2), np.int64)
            out[:, 0] = before[into[a:b]]
            out[0, 1] = 1
            out[1:, 1] = 1 + _between(lcp, into[a:b]) if edges else 0
            queue.push(int(target[a]), out)
    queue.close()
    return Sweep(np.concatenate([np.zeros(0, np.int64), *found]), np.concatenate([np.zeros(0, np.int64), *shared]))


def _between(lcp: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Least common prefix on the way from each place to the next."""
    if len(at) < 2:
        return np.zeros(0, np.int64)
    return np.minimum.reduceat(lcp[: at[-1] + 1], at[:-1] + 1)


def _settle(order: np.ndarray, group: np.ndarray, rank: np.ndarray, source: np.ndarray, first: int, base: int) -> None:
    """Put the tuples from `first` on, whose rank is the place of their source in this same order, and all that share a group with them, in their order.

    Groups keep their places. A group is done once all its sources are in groups that are done; what is left is sorted again until nothing moves.
    """
    n = len(order)
    sorted_group = group[order]
    number = np.empty(n, np.int64)
    number[order] = np.cumsum(np.append(True, sorted_group[1:] != sorted_group[:-1])[:n])
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    open_group = np.zeros(n + 1, bool)
    open_group[number[first:]] = True
    open_group &= np.bincount(number, minlength=n + 1) > 1
    waiting = np.flatnonzero(open_group[number])
    while len(waiting):
        own = waiting[waiting >= first]
        rank[own] = base + place[source[own - first]]
        line = waiting[np.argsort(group[waiting] + rank[waiting], kind="stable")]
        slots = np.sort(place[waiting])
        moved = (place[line] != slots).any()
        place[line] = slots
        still = np.zeros(n + 1, bool)
        still[number[own[open_group[number[source[own - first]]]]]] = True
        open_group = still
        if not moved:
            break
        waiting = waiting[open_group[number[waiting]]]
    order[place] = np.arange(n)


def by_names(key: np.ndarray, wanted: np.ndarray, seeds: np.ndarray, limit: int = QUEUE_BYTES) -> np.ndarray:
    """The `wanted` suffixes in order, induced from `seeds`, over a large alphabet: a turn takes a run of symbols, and sorts what belongs to it until places stand still."""
    many = np.bincount(key)
    turn_of = np.cumsum(many) // TURN
    queue = DiskQueue(2, limit)
    seed_turn = turn_of[key[seeds]]
    seed_upto = np.searchsorted(seed_turn, np.arange(int(turn_of[-1]) + 2))
    found, base = [], 0
    for turn in np.unique(turn_of).tolist():
        come = queue.pop(turn)
        seed = seeds[seed_upto[turn] : seed_upto[turn + 1]]
        waves = [np.concatenate([come[:, 0], seed])]  # the first one has come, the others are what the turn finds by itself
        sources, begin = [], 0
        while len(waves[-1]):
            own = np.flatnonzero(waves[-1] > 0)
            before = waves[-1][own] - 1
            inside = wanted[before] & (turn_of[key[before]] == turn)
            sources.append(begin + own[inside])
            begin += len(waves[-1])
            waves.append(before[inside])
        pos, source = np.concatenate(waves), np.concatenate([np.zeros(0, np.int64), *sources])
        first = len(pos) - len(source)
        rank = np.concatenate([come[:, 1], base + np.arange(len(seed)), np.full(len(source), base)])
        kind = np.zeros(len(pos), np.int64)
        kind[len(come) : first] = 1
        group = (key[pos].astype(np.int64) * 2 + kind) * (base + len(pos) + 1)
        order = np.argsort(group + rank)
        _settle(order, group, rank, source, first, base)
        line = pos[order]
        found.append(line[kind[order] == 0])
        before = line - 1
        into = np.flatnonzero((before >= 0) & wanted[before] & (turn_of[key[before]] != turn))
        target = turn_of[key[before[into]]]
        for other in np.unique(target).tolist():
            own = into[target == other]
            queue.push(other, np.stack([before[own], base + own], axis=1))
        base += len(line)
    queue.close()
    return np.concatenate([np.zeros(0, np.int64), *found])


def _sorted_lms(t: np.ndarray, s: np.ndarray, limit: int, small: bool) -> np.ndarray:
    """The suffixes that begin a climb, in order: pieces induced and named, names sorted by recursion."""
    n = len(t)
    lms = np.flatnonzero(s[1:] & ~s[:-1]) + 1
    if len(lms) < 2:
        return lms
    first = lms[np.argsort(t[lms], kind="stable")]
    _, order = _induced(t, s, first, limit, small)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = np.append(lms[-1:], order[is_lms[order]])
    size = np.empty(n, np.int64)
    size[lms] = np.append(np.diff(lms), 0) + 1
    a, b = order[:-1], order[1:]
    same = size[a] == size[b]
    x, y = a[same], b[same]
    sizes = size[x]
    if len(x):
        begin = np.cumsum(sizes) - sizes
        step = np.arange(int(sizes.sum())) - np.repeat(begin, sizes)
        same[same] = np.logical_and.reduceat(t[np.repeat(x, sizes) + step] == t[np.repeat(y, sizes) + step], begin)
    name = np.append(0, np.cumsum(~same))
    if name[-1] == len(lms) - 1:
        return order
    named = np.empty(n, np.int64)
    named[order] = name
    return lms[suffix_array(named[lms], limit)]


def _induced(t: np.ndarray, s: np.ndarray, lms: np.ndarray, limit: int, small: bool) -> tuple[np.ndarray, np.ndarray]:
    """L suffixes from LMS ones, then S suffixes (but the last one) from L ones."""
    top = int(t.max())
    down = (top - t).astype(t.dtype)
    wanted = s.copy()
    wanted[-1] = False
    if small:
        none = np.zeros(len(lms), np.int64)
        left = by_symbols(t, t, ~s, Sweep(lms, none), limit).order
        right = by_symbols(t, down, wanted, Sweep(left[::-1], np.zeros(len(left), np.int64)), limit).order
    else:
        left = by_names(t, ~s, lms, limit)
        right = by_names(down, wanted, left[::-1], limit)
    return left, right[::-1]


def suffix_array(t: np.ndarray, limit: int = QUEUE_BYTES) -> np.ndarray:
    """All suffixes of a text of names in order; its last symbol is 0 and stands nowhere else."""
    s = _is_s(t)
    left, right = _induced(t, s, _sorted_lms(t, s, limit, False), limit, False)
    all_ = np.concatenate([left, np.append(len(t) - 1, right)])
    return all_[np.argsort(t[all_] * 2 + s[all_], kind="stable")]


def equal_windows(t: np.ndarray, length: int, limit: int = QUEUE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """(suffix, group) of all suffixes that share at least `length` symbols with another one; those with the same group share them.

    `t` has symbols below 2^15; its last one is 0 and stands nowhere else. Common prefixes are counted up to `length` for LMS suffixes and carried through both
    inductions. An L and an S suffix can share that much only if it is one symbol again and again, so groups of both meet at one place of a symbol at most.
    """
    t = t.astype(np.int16)
    s = _is_s(t)
    lms = _sorted_lms(t, s, limit, True)
    common = _commons(t, length)
    lms_lcp = np.append(0, common(lms[:-1], lms[1:]))[: len(lms)]
    left = by_symbols(t, t, ~s, Sweep(lms, lms_lcp), limit, common)
    wanted = s.copy()
    wanted[-1] = False
    down = (int(t.max()) - t).astype(np.int16)
    right = by_symbols(t, down, wanted, Sweep(left.order[::-1], np.append(0, left.lcp[:0:-1])[: len(left.order)]), limit, common)
    suffix = np.concatenate([left.order, right.order])
    group = np.cumsum(np.concatenate([left.lcp, right.lcp]) < length)
    last = [np.flatnonzero(np.append(t[x.order[1:]] != t[x.order[:-1]], True)[: len(x.order)]) for x in (left, right)]  # the last of each symbol
    _, i, j = np.intersect1d(t[left.order[last[0]]], t[right.order[last[1]]], return_indices=True)
    x, y = last[0][i], last[1][j]
    meet = common(left.order[x], right.order[y]) >= length
    to = np.arange(int(group.max(initial=0)) + 1)
    to[group[len(left.order) + y[meet]]] = group[x[meet]]
    group = to[group]
    own = np.bincount(group, minlength=1)[group] > 1
    return suffix[own], group[own]
