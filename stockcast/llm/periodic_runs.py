"""Maximal periodic runs of words, by descending-LCP Kruskal over suffix classes.

The suffixes of a text that share their first L words form classes; as L falls, classes unite. Each class keeps
its positions in order. Where two positions of different classes become neighbours as their classes unite at L, L is
exactly their common prefix, and if their distance d is at most L, the words from the first of them on repeat
with period d over d + L words. That is a run if the words before both positions differ (or there is none), and
no run has another such pair: within a longer run with smallest period q its start i and i + q are neighbours
when they unite, since a position between them would give the run a smaller period.

A run of ``min_words`` words or more and of ``min_repeats`` periods or more has a common prefix of at least
``floor``, so only positions whose first ``floor`` words occur again in their text are sorted and united; most texts have none.
Texts are sorted together, many at a time, by doubling the length by which suffixes are ordered.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

MIN_WORDS = 24
MIN_REPEATS = 3
WORDS_AT_ONCE = 200_000     # words of the texts that are sorted together


def least_prefix(min_words: int, min_repeats: int) -> int:
    """What two neighbouring repetitions of a run have in common at least: all of the run but one period."""
    return max(1, min_words - min_words // min_repeats)


class _Codes(dict):
    """Numbers of words, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = len(self)
        return self[word]


@dataclass(frozen=True)
class Ordered:
    """Positions whose prefix occurs again in their text, sorted by text and suffix, with the common prefix
    of each and the one before it (0 at the first of a class)."""

    positions: np.ndarray
    common: np.ndarray


def ordered_repeats(codes: np.ndarray, doc: np.ndarray, end: np.ndarray, floor: int) -> Ordered:
    """Sort the suffixes whose first ``floor`` words occur again in the same text.

    ``codes`` are word numbers, ``doc`` the text of each word and ``end`` the place behind that text.
    """
    n = len(codes)
    key = doc * (int(codes.max(initial=0)) + 1) + codes
    order = np.argsort(key, kind="stable")
    head = np.flatnonzero(np.append(True, np.diff(key[order]) != 0)) if n else np.zeros(0, np.int64)
    size = np.diff(np.append(head, n))
    rank = np.empty(n, np.int32)  # of a class: the place of its first suffix, so ranks of all lengths are in one order
    rank[order] = np.repeat(head, size)
    open_ = order[np.repeat(size > 1, size)]  # suffixes that share their first words with another
    levels, length, wanted = [(1, rank.copy())], 1, None
    while len(open_):
        if wanted is None and 2 * length > floor:
            # the first ``floor`` words are those of length ``length`` from here and from ``floor - length`` on
            far = open_ + (floor - length)
            inside = far < end[open_]
            here = open_[inside]
            pair = rank[here].astype(np.int64) * n + rank[far[inside]]
            _, back, count = np.unique(pair, return_inverse=True, return_counts=True)
            wanted = np.zeros(n, bool)
            wanted[here[count[back] > 1]] = True
            if not len(here):
                break
        second = open_ + length
        inside = second < end[open_]
        after = np.where(inside, rank[np.minimum(second, n - 1)] + 1, 0)
        order = np.lexsort((after, rank[open_]))
        at, first, after = open_[order], rank[open_][order], after[order]
        fresh = np.append(True, np.diff(first) != 0)
        parted = fresh | np.append(True, np.diff(after) != 0)
        heads = np.flatnonzero(parted)
        size = np.diff(np.append(heads, len(at)))
        group = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
        rank = rank.copy()
        rank[at] = first + np.repeat(heads, size) - group
        length *= 2
        levels.append((length, rank))
        open_ = at[np.repeat(size > 1, size)]
    if wanted is None or not wanted.any():
        return Ordered(np.zeros(0, np.int64), np.zeros(0, np.int64))
    chosen = np.flatnonzero(wanted)
    chosen = chosen[np.argsort(rank[chosen], kind="stable")]
    left, right, common = chosen[:-1].copy(), chosen[1:].copy(), np.zeros(len(chosen) - 1, np.int64)
    for length, known in reversed(levels):
        inside = (left < end[chosen[:-1]]) & (right < end[chosen[1:]])
        same = inside & (known[np.where(inside, left, 0)] == known[np.where(inside, right, 0)])
        for array in (left, right, common):
            array[same] += length
    return Ordered(chosen, np.append(0, np.where(common >= floor, common, 0)))


def unite(ordered: Ordered) -> Iterator[tuple[int, int, int]]:
    """(position, later position, common prefix) of positions that become neighbours as their classes unite."""
    edges = np.flatnonzero(ordered.common)
    edges = edges[np.argsort(-ordered.common[edges], kind="stable")]
    positions, common = ordered.positions.tolist(), ordered.common
    parent = list(range(len(positions)))
    members: dict[int, list[int]] = {}

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for edge, prefix in zip(edges.tolist(), common[edges].tolist()):
        a, b = find(edge - 1), find(edge)
        large, small = members.pop(a, None) or [positions[a]], members.pop(b, None) or [positions[b]]
        if len(large) < len(small):
            a, b, large, small = b, a, small, large
        parent[b] = a
        members[a] = large
        if len(small) == 1:
            p = small[0]
            k = bisect_left(large, p)
            if k:
                yield large[k - 1], p, prefix
            if k < len(large):
                yield p, large[k], prefix
            large.insert(k, p)
            continue
        last_gap, last = -1, 0
        for p in small:
            k = bisect_left(large, p)
            if k != last_gap:
                if last_gap >= 0 and last_gap < len(large):
                    yield last, large[last_gap], prefix
                if k:
                    yield large[k - 1], p, prefix
            last_gap, last = k, p
        if last_gap < len(large):
            yield last, large[last_gap], prefix
        if 32 * len(small) < len(large):
            for p in small:
                insort(large, p)
        else:
            large += small
            large.sort()


def runs_of(codes: np.ndarray, lengths: list[int], min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each text, by start and then period.

    ``codes`` holds the word numbers of all texts, one behind the other, ``lengths`` their numbers of words.
    """
    out: list[list[tuple[int, int, int]]] = [[] for _ in lengths]
    if not len(codes):
        return out
    begins = np.cumsum([0, *lengths])
    doc = np.repeat(np.arange(len(lengths)), lengths)
    end = begins[1:][doc]
    ordered = ordered_repeats(codes, doc, end, least_prefix(min_words, min_repeats))
    words, first = codes.tolist() if len(ordered.positions) else [], begins.tolist()
    for i, j, prefix in unite(ordered):
        period = j - i
        length = period + prefix
        if period <= prefix and length >= max(min_words, min_repeats * period):
            at = first[int(doc[i])]
            if i == at or words[i - 1] != words[j - 1]:
                out[int(doc[i])].append((i - at, length, period))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay: those that no run contains after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def find_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period by start and period) and collapsed text of every row.

    Words are what white space (blank, \\t to \\r) separates. A run is a stretch of words with smallest period q, of at least
    ``min_words`` words and ``min_repeats`` (2 or more) periods, that no neighbouring word extends. ``collapsed`` has the words that no
    run contains after its first q words, joined by one blank. Null and empty texts have no words and no runs; repeated
    rows are handled each on its own; only ``doc_id`` and ``text`` are read; an empty table gives an empty one.
    """
    if min_repeats < 2:
        raise ValueError("min_repeats must be 2 or more")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            low = 0
            while low < len(ids):
                codes, words, lengths, high = _Codes(), [], [], low
                while high < len(ids) and (high == low or len(words) < WORDS_AT_ONCE):
                    own = (texts[high] or b"").split()
                    words += own
                    lengths.append(len(own))
                    high += 1
                numbers = np.fromiter(map(codes.__getitem__, words), np.int64, len(words))
                found = runs_of(numbers, lengths, min_words, min_repeats)
                left, at = [], 0
                for n, runs in zip(lengths, found):
                    own = words[at:at + n]
                    left.append(b" ".join([own[i] for i in np.flatnonzero(collapsed(n, runs)).tolist()] if runs else own))
                    at += n
                flat = np.array([r for runs in found for r in runs], np.int64).reshape(-1, 3)
                items = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], ["start", "length", "period"])
                offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(ids[low:high], pa.int64()), "n_words": pa.array(lengths, pa.int64()),
                    "runs": pa.ListArray.from_arrays(pa.array(offsets), items),
                    "collapsed": pa.array(left, pa.binary()).cast(pa.string())})
                low = high

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(
        look, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
