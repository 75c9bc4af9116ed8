"""Periodic runs of words, by internal pattern matching.

A run is a longest stretch of consecutive words with smallest period q whose length is at
least ``max(MIN_LENGTH, MIN_POWER * q)``.  A run of period q with ``L/2 < q <= L`` (L a power of
two) holds a dyadic block, an aligned stretch of L words, that occurs again q words later or earlier.
So every block asks for its occurrences in the window of L words before and after it: the
occurrences are an interval of the suffix array, and a wavelet tree over the suffix array
answers "the smallest position from x on inside this interval".  Inside such a window the
occurrences form an arithmetic progression, whose difference is the candidate period; the
candidate is then extended to both sides by the ranks that sorted the suffixes.

Blocks that hold a word without an equal word within L words cannot lie in such a run and ask
nothing; texts in which no block is left need no suffix array.

Documents are independent, so there is no shuffle: tasks work on stretches of about
``CHUNK_WORDS`` words of whole documents, whose words are numbered apart per document.  Memory is
proportional to the stretch (or to one document, if that is longer).

Defined cases: null and wordless texts have no runs; a null id is kept as it is; repeated rows
each give a row; empty tables give an empty result; columns named in ``keep`` pass through, others are not read,
and the names of the result win over equal names in ``keep``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructType

from weftline.llm.text import WORD, utf8_rows
from weftline.session import ship

MIN_LENGTH = 6
MIN_POWER = 4
CHUNK_WORDS = 400_000
SHORT_BLOCK = 4

_FAR = np.iinfo(np.int64).max // 4


class WaveletTree:
    """Positions of a suffix array by bits, highest first, with the number of zeros before each place."""

    def __init__(self, values: np.ndarray, bound: int):
        self.bits = max(1, int(bound).bit_length())
        self.zeros: list[np.ndarray] = []
        level = values
        for shift in range(self.bits - 1, -1, -1):
            one = ((level >> shift) & 1).astype(bool)
            self.zeros.append(np.concatenate(([0], np.cumsum(~one, dtype=np.int32))))
            level = np.concatenate((level[~one], level[one]))

    def below(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values in ``[low, high)`` are smaller than x."""
        low, high, found = low.copy(), high.copy(), np.zeros(len(x), np.int64)
        over = x >= (1 << self.bits)
        found[over] = (high - low)[over]
        for i, zeros in enumerate(self.zeros):
            one = ((x >> (self.bits - 1 - i)) & 1).astype(bool)
            zl, zh = zeros[low], zeros[high]
            found += np.where(one & ~over, zh - zl, 0)
            low = np.where(one, zeros[-1] + low - zl, zl)
            high = np.where(one, zeros[-1] + high - zh, zh)
        return found

    def smallest(self, low: np.ndarray, high: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The value number ``nth`` (from 0) of those in ``[low, high)``; it must exist."""
        low, high, nth, value = low.copy(), high.copy(), nth.copy(), np.zeros(len(nth), np.int64)
        for i, zeros in enumerate(self.zeros):
            zl, zh = zeros[low], zeros[high]
            one = nth >= zh - zl
            nth -= np.where(one, zh - zl, 0)
            value |= one.astype(np.int64) << (self.bits - 1 - i)
            low = np.where(one, zeros[-1] + low - zl, zl)
            high = np.where(one, zeros[-1] + high - zh, zh)
        return value

    def successor(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The smallest value from x on in ``[low, high)``, or a very large one."""
        before, out = self.below(low, high, x), np.full(len(x), _FAR)
        some = before < high - low
        out[some] = self.smallest(low[some], high[some], before[some])
        return out


class SuffixRanks:
    """Suffixes of a word sequence sorted by their first ``2 ** levels`` words, with the ranks of every step."""

    def __init__(self, words: np.ndarray, levels: int):
        n = len(words)
        self.order = np.argsort(words, kind="stable").astype(np.int64)
        self.ranks = [self._named(words[self.order])]
        self.sizes = [self._counts(self.ranks[0])]
        for k in range(levels):
            rank, size = self.ranks[-1], self.sizes[-1]
            after = np.full(n, -1, np.int64)
            if n > 1 << k:
                after[:n - (1 << k)] = rank[1 << k:]
            # Only suffixes that share their rank need sorting.
            open_ = np.flatnonzero(size[rank[self.order]] > 1)
            at = self.order[open_]
            self.order = self.order.copy()
            self.order[open_] = at[np.lexsort((after[at], rank[at]))]
            key, tail = rank[self.order], after[self.order]
            fresh = np.concatenate(([True], (key[1:] != key[:-1]) | (tail[1:] != tail[:-1])))
            head = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
            named = np.empty(n, np.int64)
            named[self.order] = head
            self.ranks.append(named)
            self.sizes.append(self._counts(named))

    def _named(self, ordered: np.ndarray) -> np.ndarray:
        n = len(ordered)
        fresh = np.concatenate(([True], ordered[1:] != ordered[:-1]))
        named = np.empty(n, np.int64)
        named[self.order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        return named

    @staticmethod
    def _counts(named: np.ndarray) -> np.ndarray:
        return np.bincount(named, minlength=len(named))

    def interval(self, level: int, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = self.ranks[level][starts]
        return low, low + self.sizes[level][low]

    def common(self, left: np.ndarray, right: np.ndarray, back: bool) -> np.ndarray:
        """How far equal words go on from two places (or, with ``back``, before them)."""
        left, right, total = left.copy(), right.copy(), np.zeros(len(left), np.int64)
        n = len(self.order)
        top = len(self.ranks) - 1
        level = top
        while level >= 0:
            step, rank = 1 << level, self.ranks[level]
            a, b = (left - step, right - step) if back else (left, right)
            fits = (a >= 0) & (b >= 0) & (a + step <= n) & (b + step <= n)
            same = np.zeros(len(a), bool)
            same[fits] = rank[a[fits]] == rank[b[fits]]
            move = np.where(same, -step if back else step, 0)
            left, right, total = left + move, right + move, total + np.where(same, step, 0)
            if level < top or not same.any():
                level -= 1
        return total


def _near(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distance from every word to the next and to the previous equal one."""
    order = np.argsort(words, kind="stable")
    gap, same = np.diff(order), words[order[1:]] == words[order[:-1]]
    after, before = np.full(len(words), _FAR), np.full(len(words), _FAR)
    after[order[:-1][same]] = gap[same]
    before[order[1:][same]] = gap[same]
    return after, before


def _in_long_stretch(flags: np.ndarray, least: int) -> np.ndarray:
    """Which flags belong to at least ``least`` raised ones in a row."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    long_ = end - start >= least
    change = np.zeros(len(flags) + 1, np.int8)
    change[start[long_]] += 1
    change[end[long_]] -= 1
    return np.cumsum(change[:-1]).astype(bool)


def _open_blocks(words: np.ndarray, longest: int) -> list[np.ndarray]:
    """Per level, the numbers of the blocks whose words all have an equal one within a block's length.

    Short blocks must also lie among as many such words as the shortest run has that asks for them.
    """
    after, before = _near(words)
    near = np.minimum(after, before)
    found, size = [], 1
    while size <= max(1, longest // MIN_POWER) * 2 - 1 and len(after):
        open_ = (after <= size) | (before <= size)
        if size <= SHORT_BLOCK:
            stretch = _in_long_stretch(near <= size, max(MIN_LENGTH, MIN_POWER * (size // 2 + 1)))
            open_ &= stretch[:len(open_) * size:size]
        found.append(np.flatnonzero(open_))
        half = len(after) // 2 * 2
        after, before = after[:half].reshape(-1, 2).max(1), before[:half].reshape(-1, 2).max(1)
        size *= 2
    return found


def runs_of(words: np.ndarray, longest: int) -> np.ndarray:
    """Rows ``start, end, period`` of all runs; ``longest`` bounds the length of one."""
    none = np.empty((0, 3), np.int64)
    if len(words) < MIN_LENGTH or longest < MIN_LENGTH:
        return none
    blocks = _open_blocks(words, longest)
    if not any(map(len, blocks)):
        return none
    ranks = SuffixRanks(words, max(i for i, b in enumerate(blocks) if len(b)))
    tree = WaveletTree(ranks.order, len(words))
    found = []
    for level, block in enumerate(blocks):
        size = 1 << level
        start = block * size
        low, high = ranks.interval(level, start) if len(start) else (start, start)
        often = high - low > 1
        start, low, high = start[often], low[often], high[often]
        if not len(start):
            continue
        right = tree.successor(low, high, start + 1)
        near = right <= start + size
        found.append(np.stack((start[near], right[near]), 1))
        first = tree.successor(low, high, np.maximum(start - size, 0))
        near = first < start
        second = tree.successor(low[near], high[near], first[near] + 1)
        found.append(np.stack((first[near], second), 1))
    pairs = np.unique(np.concatenate(found), axis=0) if found else none[:, :2]
    if not len(pairs):
        return none
    at, period = pairs[:, 0], pairs[:, 1] - pairs[:, 0]
    end = pairs[:, 1] + ranks.common(at, pairs[:, 1], False)
    start = at - ranks.common(at, pairs[:, 1], True)
    length = end - start
    good = (length >= MIN_LENGTH) & (length >= MIN_POWER * period)
    return np.unique(np.stack((start[good], end[good], period[good]), 1), axis=0)


def _chunk_runs(docs: list[list[bytes]]) -> list[np.ndarray]:
    """The runs of every document of a stretch, with places counted from its start."""
    codes, firsts, total = [], [], 0
    for words in docs:
        last = dict(zip(words, range(total, total + len(words))))
        codes.append(np.fromiter(map(last.__getitem__, words), np.int64, len(words)))
        firsts.append(total)
        total += len(words)
    bounds = np.array([*firsts, total])
    sizes = np.diff(bounds)
    text = np.concatenate(codes) if codes else np.empty(0, np.int64)
    longest = int(sizes.max(initial=0))
    # Documents that hold no open block are left out of the sorting.
    held = np.zeros(len(docs), bool)
    for level, block in enumerate(_open_blocks(text, longest)):
        held[np.searchsorted(bounds, block << level, "right") - 1] = True
    out = [np.empty((0, 3), np.int64)] * len(docs)
    some = np.flatnonzero(held)
    if len(some):
        starts = np.concatenate(([0], np.cumsum(sizes[some])))
        found = runs_of(np.concatenate([codes[i] for i in some]), int(sizes[some].max()))
        owner = np.searchsorted(starts, found[:, 0], "right") - 1
        cuts = np.searchsorted(owner, np.arange(len(some) + 1))
        for k, i in enumerate(some):
            mine = found[cuts[k]:cuts[k + 1]].copy()
            mine[:, :2] -= starts[k]
            out[i] = mine
    return out


def _described(words: list[bytes], runs: np.ndarray) -> tuple:
    collapsed, n = words, len(runs)
    best: tuple = (None, None, None)
    listed = b""
    if n:
        start, end, period = runs.T
        length = end - start
        listed = b"".join(b"%d,%d,%d\n" % (s, m, q) for s, m, q in sorted(zip(start.tolist(), length.tolist(), period.tolist()),
                                                                        key=lambda r: (r[0], r[2])))
        top = np.lexsort((period, start, -length))[0]
        best = int(start[top]), int(length[top]), int(period[top])
        change = np.bincount(start + period, minlength=len(words) + 1) - np.bincount(end, minlength=len(words) + 1)
        keep = np.cumsum(change[:len(words)]) == 0
        collapsed = [words[i] for i in np.flatnonzero(keep)]
    joined = b" ".join(collapsed)
    return (len(words), n, *best, hashlib.sha256(listed).hexdigest(), joined, hashlib.sha256(joined).hexdigest())


# Fixed names of the result.
_COLUMNS = {"n_words": LongType(), "n_runs": LongType(), "start": LongType(), "length": LongType(), "period": LongType(),
            "runs_sha256": StringType(), "collapsed": StringType(), "collapsed_sha256": StringType()}
_ARROW = {"collapsed": pa.string(), "runs_sha256": pa.string(), "collapsed_sha256": pa.string()}


def find_runs(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), collapsed: bool = True) -> DataFrame:
    """Columns ``keep`` and, per document, its number of words and runs, the longest run (ties: smallest start, then
    period), digests, and the text with every run cut to its first period (without ``collapsed``: only its digest)."""
    ship(docs.sparkSession)
    keep = [c for c in keep if c not in _COLUMNS]
    names = [c for c in _COLUMNS if collapsed or c != "collapsed"]
    # The text comes last under a name of its own, so that it may be among ``keep`` as well.
    taken = docs.select(*keep, F.col(text).alias("_words_of"))
    schema = StructType([*taken.select(*keep).schema.fields])
    for name in names:
        schema = schema.add(name, _COLUMNS[name])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[list[bytes]] = []
            first = size = 0
            rows = utf8_rows(batch.column(len(keep)))
            for i, raw in enumerate(rows):
                held.append((raw or b"").split())
                size += len(held[-1])
                if size >= CHUNK_WORDS or i + 1 == len(rows):
                    told = [dict(zip(_COLUMNS, _described(w, r))) for w, r in zip(held, _chunk_runs(held))]
                    kept = batch.slice(first, len(held))
                    yield pa.RecordBatch.from_arrays(
                        [kept.column(k) for k in range(len(keep))]
                        + [pa.array([t[c] for t in told], pa.binary() if c == "collapsed" else _ARROW.get(c, pa.int64())).cast(
                            _ARROW.get(c, pa.int64())) for c in names], schema.names)
                    first, held, size = i + 1, [], 0
    return taken.mapInArrow(run, schema)


def with_planted_runs(text: Column, key: Column, words: Column) -> Column:
    """``text``, in which one document in ten goes on periodically from some word on; ``words`` are its words.

    The place and the period come from the CRC-32 of ``key``; a null key leaves the text as it is.
    """
    n, h = F.size(words).cast("bigint"), F.crc32(key.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("bigint")
    start = g % n
    period = 1 + F.floor((n - start) / (3 + g % 8)).cast("bigint")
    again = F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda i: F.get(words, F.when(
        i >= start, start + (i - start) % period).otherwise(i).cast("int")))
    return F.when((h % 10 == 0) & (n > 0), F.array_join(again, " ")).otherwise(text)


def planted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, text`` with the periodic texts; words are taken apart only where they are needed."""
    chosen = F.when(F.crc32(F.col(key).cast("string").cast("binary")) % 10 == 0, F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0)))
    worded = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), chosen.alias("words"))
    return worded.select("doc_id", with_planted_runs(F.col("text"), F.col("doc_id"), F.col("words")).alias("text"))
