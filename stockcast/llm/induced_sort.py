"""Suffix arrays with common-prefix lengths by external induced sorting.

Suffixes whose first character is smaller than the second (S) or larger (L) alternate in runs; the
leftmost of every S run (LMS) is sorted first, by induction over its substring, naming and recursion
on the string of names. All other suffixes are then induced from them in two scans. A scan takes
suffix tuples from a priority queue in the order of (first character, arrival), and each tuple puts
its predecessor into the queue with the common-prefix length to the tuple before it: one more than
the least length passed since. Arrivals under one character are already in order, so the queue is a
row of first-in-first-out buckets, whose contents go to disk beyond a bound of tuples. Tuples are
handled in numpy batches. Working arrays beyond the bound are files too (unnamed, gone with the task).
"""

from __future__ import annotations

import tempfile
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np

MEMORY = 1 << 22  # tuples, or names, that are held in memory at once


def scratch(n: int, dtype: object, memory: int) -> np.ndarray:
    """An array of n items: in memory up to the bound, else in an unnamed file."""
    if n <= memory:
        return np.empty(n, dtype)
    with tempfile.TemporaryFile() as f:
        return np.memmap(f, dtype, "w+", shape=(n,))


class BucketQueue:
    """A disk-backed priority queue of (position, common-prefix length) tuples.

    Priority is (character, arrival). Parts go to an unnamed file once more than ``memory`` tuples wait.
    """

    def __init__(self, memory: int):
        self.parts: dict[int, deque] = defaultdict(deque)
        self.memory, self.held, self.file = memory, 0, None

    def push(self, char: int, pos: np.ndarray, lcp: np.ndarray) -> None:
        self.parts[char].append((pos, lcp))
        self.held += len(pos)
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for waiting in self.parts.values():
            for i, part in enumerate(waiting):
                if isinstance(part, tuple):
                    at = self.file.tell()
                    self.file.write(part[0].astype("<i8").tobytes() + part[1].tobytes())
                    waiting[i] = [at, len(part[0])]
        self.held = 0

    def _load(self, part: tuple | list) -> tuple[np.ndarray, np.ndarray]:
        if isinstance(part, tuple):
            self.held -= len(part[0])
            return part
        at, n = part
        self.file.seek(at)
        raw = self.file.read(9 * n)
        return np.frombuffer(raw, "<i8", n), np.frombuffer(raw, np.uint8, n, 8 * n)

    def _take(self, waiting: deque, back: bool) -> tuple[np.ndarray, np.ndarray]:
        """What waits at one end, joined up to the bound."""
        taken, n = [], 0
        while waiting and (not taken or n < self.memory):
            taken.append(self._load(waiting.pop() if back else waiting.popleft()))
            n += len(taken[-1][0])
        if back:
            taken.reverse()
        return np.concatenate([t[0] for t in taken]), np.concatenate([t[1] for t in taken])

    def drain(self, char: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Tuples of one character in order of arrival, also those that arrive meanwhile."""
        waiting = self.parts.get(char)
        while waiting:
            yield self._take(waiting, back=False)

    def drain_back(self, char: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Tuples of one character from the last on."""
        waiting = self.parts.get(char)
        while waiting:
            pos, lcp = self._take(waiting, back=True)
            yield pos[::-1], lcp[::-1]

    def last(self, char: int) -> int | None:
        """Position of the tuple that came last."""
        if not self.parts.get(char):
            return None
        part = self.parts[char][-1]
        if isinstance(part, tuple):
            return int(part[0][-1])
        self.file.seek(part[0] + 8 * (part[1] - 1))
        return int(np.frombuffer(self.file.read(8), "<i8")[0])


def s_types(text: np.ndarray, memory: int) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last, a unique smallest character, counts as such."""
    n = len(text)
    out = scratch(n, np.bool_, memory)
    after, kind = None, True
    for low in range((n - 1) // memory * memory, -1, -memory):
        part = np.asarray(text[low:low + memory])
        follow = np.append(part[1:], part[-1] if after is None else after)
        rises, same = part < follow, part == follow
        if after is None:
            rises[-1], same[-1] = True, False
        # equal neighbours take the kind of the next unequal one
        at = np.where(same, len(part), np.arange(len(part)))
        at = np.minimum.accumulate(at[::-1])[::-1]
        out[low:low + memory] = np.where(at < len(part), rises[np.minimum(at, len(part) - 1)], kind)
        after, kind = part[0], bool(out[low])
    return out


class RangeMinimum:
    """Minima of ranges of a batch of lengths, by a table of powers of two."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        step = 1
        while 2 * step <= len(values):
            last = self.rows[-1]
            self.rows.append(np.minimum(last[:-step], last[step:]))
            step *= 2
        self.flat = np.concatenate(self.rows)
        self.starts = np.cumsum([0, *map(len, self.rows[:-1])])

    def __call__(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minimum over low..high, both included, low <= high."""
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        base = self.starts[level]
        return np.minimum(self.flat[base + low], self.flat[base + high + 1 - (1 << level)])


class Scan:
    """One inducing scan: what has been scanned puts predecessors of one kind into the queue."""

    def __init__(self, text: np.ndarray, kinds: np.ndarray, want: bool, sigma: int, cap: int, memory: int):
        self.cap, self.memory = cap, memory
        # the character before each position if its suffix is of the kind, else 0: no character but the last is 0
        self.before = scratch(len(text), text.dtype, memory)
        self.before[0] = 0
        for low in range(0, len(text) - 1, memory):
            high = min(low + memory, len(text) - 1)
            self.before[low + 1:high + 1] = text[low:high] * (kinds[low:high] == want)
        self.queue = BucketQueue(memory)
        self.least = np.full(sigma if cap else 0, 255, np.uint8)  # since the last arrival under each character
        self.begun = np.zeros(sigma if cap else 0, np.bool_)

    def pass_by(self, pos: np.ndarray, lcp: np.ndarray) -> None:
        """Scan tuples; ``lcp`` is what each has in common with the tuple scanned before it."""
        for low in range(0, len(pos), self.memory):
            self._batch(pos[low:low + self.memory], lcp[low:low + self.memory])

    def _batch(self, pos: np.ndarray, lcp: np.ndarray) -> None:
        chars = self.before[pos]
        picked = np.flatnonzero(chars)
        chars = chars[picked]
        order = np.argsort(chars, kind="stable")
        picked, chars = picked[order], chars[order]
        starts = np.flatnonzero(np.append(True, chars[1:] != chars[:-1])) if len(chars) else np.zeros(0, np.int64)
        made = pos[picked] - 1
        if self.cap:
            common = self._common(lcp, picked, chars, starts)
        else:
            common = np.zeros(len(made), np.uint8)
        for a, b in zip(starts, np.append(starts[1:], len(chars))):
            self.queue.push(int(chars[a]), made[a:b], common[a:b])

    def _common(self, lcp: np.ndarray, picked: np.ndarray, chars: np.ndarray, starts: np.ndarray) -> np.ndarray:
        if not len(picked):
            if len(lcp):
                np.minimum(self.least, lcp.min(), out=self.least)
            return np.zeros(0, np.uint8)
        minimum = RangeMinimum(lcp)
        low = np.append(0, picked[:-1] + 1)
        low[starts] = 0
        common = minimum(low, picked)
        heads = chars[starts]
        common[starts] = np.minimum(common[starts], self.least[heads])
        common = np.minimum(common, self.cap - 1) + np.uint8(1)
        common[starts] = np.where(self.begun[heads], common[starts], 0)
        ends = picked[np.append(starts[1:], len(chars)) - 1]
        rest = np.full(len(ends), 255, np.uint8)
        inner = ends < len(lcp) - 1
        rest[inner] = minimum(ends[inner] + 1, np.full(inner.sum(), len(lcp) - 1))
        np.minimum(self.least, lcp.min(), out=self.least)
        self.least[heads], self.begun[heads] = rest, True
        return common


def prefix_length(text: np.ndarray, a: int, b: int, cap: int) -> int:
    """Common-prefix length of two suffixes, up to ``cap``."""
    n = min(cap, len(text) - max(a, b))
    differ = np.flatnonzero(text[a:a + n] != text[b:b + n])
    return int(differ[0]) if len(differ) else n


def induce(
    text: np.ndarray, kinds: np.ndarray, sigma: int, seeds: np.ndarray, lcp: np.ndarray | None, cap: int, memory: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes in order, in parts of (positions, common-prefix lengths with the one before).

    ``seeds`` are the LMS positions, grouped by first character and in the order they shall have;
    ``lcp`` their common-prefix lengths. Without ``cap`` lengths are not carried.
    """
    first = text[seeds]
    chars = np.unique(first)
    spans = {int(c): (int(a), int(b)) for c, a, b in zip(
        chars, np.searchsorted(first, chars, "left"), np.searchsorted(first, chars, "right"))}
    small, large = Scan(text, kinds, False, sigma, cap, memory), BucketQueue(memory)
    zeros = np.zeros(len(seeds), np.uint8) if lcp is None else lcp
    for char in range(sigma):
        for pos, common in small.queue.drain(char):
            large.push(char, pos, common)
            small.pass_by(pos, common)
        if char in spans:
            a, b = spans[char]
            common = zeros[a:b].copy()
            end = large.last(char)
            common[0] = 0 if end is None or not cap else prefix_length(text, end, int(seeds[a]), cap)
            small.pass_by(seeds[a:b], common)
    back, kept, seams = Scan(text, kinds, True, sigma, cap, memory), BucketQueue(memory), {}
    done = BucketQueue(memory)  # the L tuples again, from the largest down
    for char in range(sigma - 1, -1, -1):
        if char == 0:
            back.queue.push(0, np.array([len(text) - 1]), np.zeros(1, np.uint8))
        for pos, common in back.queue.drain(char):
            kept.push(char, pos, common)
            back.pass_by(pos, common)
        smallest, largest = kept.last(char), large.last(char)
        seam = prefix_length(text, smallest, largest, cap) if cap and smallest is not None and largest is not None else 0
        seams[char], carried = seam, seam
        for pos, common in large.drain_back(char):
            done.push(char, pos, common)
            down = np.append(np.uint8(carried), common[:-1])  # with the larger neighbour instead of the smaller one
            carried = common[-1]
            back.pass_by(pos, down)
    for char in range(sigma):
        yield from done.drain_back(char)
        carried = seams[char]
        for pos, common in kept.drain_back(char):
            yield pos, np.append(np.uint8(carried), common[:-1])
            carried = common[-1]


def _words(text: np.ndarray) -> np.ndarray:
    """Eight bytes from every position on, as numbers; needs eight spare bytes at the end."""
    return np.ndarray((len(text) - 7,), "<u8", text, strides=(1,))


def neighbour_lengths(text: np.ndarray, order: np.ndarray, cap: int, memory: int) -> np.ndarray:
    """Common-prefix length of each suffix with the one before in ``order``, up to ``cap`` (bytes only)."""
    out = scratch(len(order), np.uint8, memory)
    padded = np.concatenate([text, np.zeros(cap + 8, np.uint8)])
    words = _words(padded)
    for low in range(0, len(order), memory):
        b = order[low:low + memory]
        a = np.append(order[low - 1] if low else b[0], b[:-1])
        length = np.full(len(b), cap, np.int64)
        open_ = np.arange(len(b))
        for step in range(0, cap, 8):
            x = words[a[open_] + step] ^ words[b[open_] + step]
            hit = x != 0
            bits = x[hit] & (~x[hit] + np.uint64(1))  # lowest differing bit
            length[open_[hit]] = step + np.bitwise_count(bits - np.uint64(1)) // 8
            open_ = open_[~hit]
            if not len(open_):
                break
        out[low:low + memory] = np.minimum(length, cap)
    if len(out):
        out[0] = 0
    return out


def double_prefixes(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of a string of names that fits memory; ``depth`` names decide (0: all).

    Ranks by k names become ranks by 3 k while three ranks fit a number, else by 2 k. Ties may stand in any order.
    """
    rank, k = names.astype(np.int64), 1
    while True:
        base = int(rank.max()) + 2
        joined = 3 if base < 1 << 21 else 2
        key = rank
        for ahead in range(k, joined * k, k):
            follow = np.zeros(len(rank), np.int64)
            if ahead < len(rank):
                follow[:-ahead] = rank[ahead:] + 1
            key = key * base + follow
        order = np.argsort(key)
        ranked = key[order]
        fresh = np.append(False, ranked[1:] != ranked[:-1]).cumsum()
        k *= joined
        if fresh[-1] == len(rank) - 1 or (depth and k >= depth) or k >= len(rank):
            return order
        rank = np.empty(len(rank), np.int64)
        rank[order] = fresh


def sorted_lms(text: np.ndarray, kinds: np.ndarray, sigma: int, cap: int, memory: int) -> np.ndarray:
    """LMS positions in the order of their suffixes (with ``cap``: of at least that many characters)."""
    n = len(text)
    lms = np.concatenate([
        np.flatnonzero(kinds[low + 1:low + 1 + memory] & ~kinds[low:low + memory][:len(kinds[low + 1:low + 1 + memory])]) + low + 1
        for low in range(0, n, memory)] or [np.zeros(0, np.int64)])
    if n < 1 << 31:
        lms = lms.astype(np.int32)
    if len(lms) <= 1:
        return lms
    seeds = lms[np.argsort(text[lms], kind="stable")]
    index = scratch(n, lms.dtype, memory)
    index[:] = -1
    index[lms] = np.arange(len(lms), dtype=lms.dtype)
    place = np.concatenate([index[pos] for pos, _ in induce(text, kinds, sigma, seeds, None, 0, memory)])
    place = place[place >= 0]
    order = lms[place]
    length = np.append(np.diff(lms), 0)[place]  # the last one, the end, is unique
    equal = np.append(False, length[1:] == length[:-1])
    step = 0
    if text.dtype == np.uint8 and n > 8:  # eight bytes at once, as far as they belong to the substring
        step = 8
        first = _words(text)[np.minimum(order, n - 8)]
        first >>= (8 * np.maximum(order - (n - 8), 0)).astype(np.uint64)
        first &= np.uint64(0xFFFFFFFFFFFFFFFF) >> (8 * np.maximum(7 - length, 0)).astype(np.uint64)
        equal[1:] &= first[1:] == first[:-1]
    at = np.flatnonzero(equal)
    at = at[length[at] >= step]
    while len(at):
        same = text[order[at] + step] == text[order[at - 1] + step]
        equal[at[~same]] = False
        at = at[same & (step < length[at])]
        step += 1
    names = np.empty(len(lms), np.int64)
    names[place] = (~equal).cumsum() - 1
    if not equal.any():
        return order
    if len(names) <= memory:
        return lms[double_prefixes(names, cap and cap // 2 + 1)]
    inner = np.concatenate([pos for pos, _ in suffixes(names, int(names.max()) + 1, 0, memory)])
    return lms[inner]


def leading(order: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Those of the sorted LMS positions from which a wanted suffix is induced: the first one behind it."""
    ascending = np.sort(order)
    asked = np.zeros(len(wanted), np.bool_)  # by LMS position
    asked[ascending[1:]] = np.logical_or.reduceat(wanted, ascending)[:-1]
    asked[ascending[0]] = wanted[:ascending[0]].any()
    return order[asked[order]]


def suffixes(
    text: np.ndarray, sigma: int, cap: int = 0, memory: int = MEMORY, wanted: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Suffix array of ``text`` in parts of (positions, common-prefix lengths up to ``cap``).

    The last character must be 0 and occur nowhere else; all are below ``sigma``. With ``cap`` the text
    must be of bytes, and suffixes that agree in ``cap`` characters may stand in any order. With ``wanted``,
    a mask, suffixes are induced only where it takes them to come to all wanted ones: each comes out once,
    others may be missing, and lengths are those in common with the suffix that comes out before.
    """
    kinds = s_types(text, memory)
    order = sorted_lms(text, kinds, sigma, cap, memory)
    if wanted is not None and len(order):
        order = leading(order, wanted)
    elif not len(order):  # no S run but the end: every suffix is larger than the next
        order = np.array([len(text) - 1])
    lcp = neighbour_lengths(text, order, cap, memory) if cap else None
    yield from induce(text, kinds, sigma, order, lcp, cap, memory)
