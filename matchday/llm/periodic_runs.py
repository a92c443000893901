"""Runs of repeated words, found by maximal pairs.

A run is a stretch of words with period q that no neighbouring word extends. Its occurrences at the start and one period later are a
maximal pair: two equal stretches of words whose left neighbours differ and whose right neighbours differ. The other way round, a
maximal pair of ``size`` words at a ``distance`` covers ``size + distance`` words with that period, which no neighbour extends. So the
maximal pairs whose distance is small enough for their size are the runs, and nothing has to be extended.

The texts of a batch are sorted by suffix (ranks of 1, 2, 4, ... words, refined where they still tie). The intervals of common
prefixes are then visited bottom-up. An interval keeps the starts below it in one ascending list for each left word; when a child joins
it, only lists of different left words are paired, within the reach that the size allows. The smaller side is looked up in the larger.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from matchday.llm.common import map_texts, others

#: (start, length, period) in words.
Run = tuple[int, int, int]

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class _Codes(dict):
    """Word to a number, in order of first sight."""

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        return code


def word_codes(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of all texts, one text after the other, and where each text starts (and the last ends).

    Equal words of one text have one number; no number occurs in two texts.
    """
    table = _Codes()
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    codes = np.empty(int(starts[-1]), dtype=np.int64)
    for at, words in zip(starts.tolist(), texts):
        codes[at:at + len(words)] = np.fromiter(map(table.__getitem__, words), dtype=np.int64, count=len(words))
    return codes + np.repeat(np.arange(len(texts)), sizes) * len(table), starts


def repeated_suffixes(codes: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose next ``least`` words may occur twice, in suffix order, with the words shared with the one before.

    ``ends`` gives each position the end of its text. Positions left out share fewer than ``least`` words with any other.
    """
    n = len(codes)
    order = np.argsort(codes)
    heads = np.concatenate([[True], codes[order][1:] != codes[order][:-1]]) if n else np.zeros(0, dtype=bool)
    rank = np.empty(n + 1, dtype=np.int64)
    rank[n] = -1
    rank[order] = np.flatnonzero(heads)[np.cumsum(heads) - 1]
    levels, width = [rank.copy()], 1
    open_ = _tied(order, heads)
    members = open_ if width * 2 > least else None
    while len(open_):
        follow = open_ + width
        key = rank[open_] * (n + 2) + np.where(follow < ends[open_], rank[np.minimum(follow, n)] + 1, 0)
        order = np.argsort(key)
        key, open_ = key[order], open_[order]
        old = rank[open_]
        at = np.arange(len(open_))
        heads = np.concatenate([[True], key[1:] != key[:-1]])
        old_heads = np.concatenate([[True], old[1:] != old[:-1]])
        first, old_first = at[heads][np.cumsum(heads) - 1], at[old_heads][np.cumsum(old_heads) - 1]
        rank[open_] = old + first - old_first
        levels.append(rank.copy())
        width *= 2
        open_ = _tied(open_, heads)
        if members is None and width * 2 > least:
            members = open_
    if members is None or not len(members):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    members = members[np.argsort(rank[members])]
    before, after = members[:-1], members[1:]
    shared = np.zeros(len(before), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        level = levels[k]
        shared += (level[before + shared] == level[after + shared]).astype(np.int64) << k
    return members, np.concatenate([[0], shared])


def _tied(order: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """The members of groups of two or more, where ``heads`` marks the first of each group in ``order``."""
    last = np.concatenate([heads[1:], [True]]) if len(heads) else heads
    return order[~(heads & last)]


def maximal_pairs(members: list[int], shared: list[int], left: Callable[[int], int], least: int, times: int) -> dict[tuple[int, int], int]:
    """``(start, length) -> period`` of the maximal pairs that cover ``max(least, times * distance)`` words or more.

    A stretch found at several distances has its smallest.
    """
    found: dict[tuple[int, int], int] = {}
    where = {p: i for i, p in enumerate(members)}

    def pair(p: int, other: int, size: int) -> None:
        distance = abs(p - other)
        if distance + size >= least:
            place = (min(p, other), size + distance)
            if distance < found.get(place, distance + 1):
                found[place] = distance

    def join(size: int, one: list, two: list) -> list:
        """Two neighbouring children [first, last, count, lists] of an interval of ``size`` words, as one."""
        small, large = (one, two) if one[2] < two[2] else (two, one)
        reach = size // (times - 1)
        lists = large[3]
        for own, starts in small[3].items():
            if 2 * reach < len(lists):
                for p in starts:
                    for other in range(p - reach, p + reach + 1):
                        if large[0] <= where.get(other, -1) <= large[1] and left(other) != own:
                            pair(p, other, size)
            else:
                for word, near in lists.items():
                    if word != own:
                        for p in starts:
                            for other in near[bisect_left(near, p - reach):bisect_right(near, p + reach)]:
                                pair(p, other, size)
        for own, starts in small[3].items():
            held = lists.get(own)
            if held is None:
                lists[own] = starts
            elif held[-1] < starts[0]:
                held.extend(starts)
            elif len(starts) < 16:
                for p in starts:
                    insort(held, p)
            else:
                held.extend(starts)
                held.sort()
        return [one[0], two[1], one[2] + two[2], lists]

    lowest = smallest_size(least, times)
    open_: list[tuple[int, list]] = []
    for i, p in enumerate(members):
        follow = shared[i + 1] if i + 1 < len(members) else 0
        if follow < lowest and not open_:
            continue
        last = [i, i, 1, {left(p): [p]}]
        while open_ and open_[-1][0] > follow:
            size, node = open_.pop()
            last = join(size, node, last)
        if follow >= lowest:
            if open_ and open_[-1][0] == follow:
                open_[-1] = (follow, join(follow, open_[-1][1], last))
            else:
                open_.append((follow, last))
    return found


def smallest_size(least: int, times: int) -> int:
    """The fewest words a pair of a run shares: distance 1 or more, and ``least`` words in all."""
    return min(max(least - distance, (times - 1) * distance) for distance in range(1, least + 1))


def runs_of(texts: list[list[bytes]], least: int = 6, times: int = 4) -> list[list[Run]]:
    """The runs of each text, by start, then period."""
    codes, starts = word_codes(texts)
    ends = np.repeat(starts[1:], np.diff(starts))
    members, shared = repeated_suffixes(codes, ends, smallest_size(least, times))
    out: list[list[Run]] = [[] for _ in texts]
    if not len(members):
        return out
    firsts = set(starts.tolist())
    plain = codes.tolist()
    found = maximal_pairs(members.tolist(), shared.tolist(), lambda p: -1 if p in firsts else plain[p - 1], least, times)
    for (start, length), period in sorted(found.items(), key=lambda item: (item[0][0], item[1])):
        text = int(np.searchsorted(starts, start, side="right")) - 1
        out[text].append((start - int(starts[text]), length, period))
    return out


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


def find_runs(docs: DataFrame, column: str = "text", least: int = 6, times: int = 4, keep: list[str] | None = None,
              words_of=None, finish=None, fields: dict[str, pa.DataType] | None = None) -> DataFrame:
    """``keep`` columns (default: all) with ``runs``, an array of (start, length, period) by start, then period, and ``collapsed``, the
    text of the kept words joined by one space.

    Words are the stretches without ASCII white space. A run has ``max(least, times * period)`` words or more (``times`` 2 or more). NULL
    and empty texts have no run and collapse to an empty text; equal rows are treated alike; columns called runs or collapsed are
    replaced. ``words_of(text, row)`` may give other words, where ``row`` is the tuple of the kept columns; ``finish(words, runs,
    kept)`` may turn a document into the values of ``fields``. A text is handled whole, by one task.
    """
    if times < 2 or least < 2:
        raise ValueError("a run has two periods and two words at least")
    keep = others(docs, "runs", "collapsed") if keep is None else keep
    finish = finish or (lambda words, runs, kept: (
        [dict(zip(("start", "length", "period"), run)) for run in runs], b" ".join(kept).decode("utf-8")))
    fields = fields or {"runs": pa.list_(RUN), "collapsed": pa.string()}

    def function(texts: list[bytes], rows: pa.RecordBatch) -> list[tuple]:
        if words_of is None:
            words = [text.split() for text in texts]
        else:
            kept = zip(*(c.to_pylist() for c in rows.columns[:len(keep)]))
            words = [words_of(text, row) for text, row in zip(texts, kept)]
        return [finish(w, runs, collapsed(w, runs)) for w, runs in zip(words, runs_of(words, least, times))]

    return map_texts(docs, column, keep, fields, lambda: function)
