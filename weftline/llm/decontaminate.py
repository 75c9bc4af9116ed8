"""Benchmark passages inside documents, with a bounded number of edits.

A passage of m characters that occurs with at most k edits keeps at least
m + 1 - q (k + 1) of its q-grams, on diagonals (text position minus passage
position) at most 2 k apart (the q-gram lemma).  Per passage, k is a share of m and q
is at most ``Q`` and small enough for that bound to be positive.  Shared q-grams
are counted in bands of diagonals that overlap by half, so one band holds all of an
occurrence.  A band that meets the bound is checked by an alignment confined to
its diagonals.  The filter loses nothing, and the check is exact.

Both sides are lower-cased and runs of white space become one blank.

The passages are dealt into parts of at most ``part_chars`` characters, counted
before.  Only a part's index is sent to the tasks; a set that needs several parts is
matched in as many passes.  Documents are never shuffled.

Defined cases: passages without text match nothing; passages shorter than 1 / rate
characters must occur exactly; documents with null or empty text have no match; null ids pass
through; repeated document rows give repeated matches, repeated passage rows do
not; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weftline.session import ship

Q = 10
EDIT_RATE = 0.08
PART_CHARS = 4_000_000
CHUNK_CHARS = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_GAP = np.uint32(0x110000)  # beyond every code point: no passage holds it


def normalised(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def rolling(codes: np.ndarray, q: int) -> np.ndarray:
    """Polynomial hash of every window of ``q`` codes, by doubling widths."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    level, width, out, done = codes.astype(np.uint64) + np.uint64(1), 1, None, 0
    while True:
        if q & width:
            if out is None:
                out, done = level, width
            else:
                size = len(codes) - done - width + 1
                out = out[:size] * np.uint64(pow(_BASE, width, 1 << 64)) + level[done:done + size]
                done += width
        if done == q:
            return out[:n]
        size = len(level) - width
        level = level[:size] * np.uint64(pow(_BASE, width, 1 << 64)) + level[width:width + size]
        width *= 2


class Index:
    """The q-grams of a part of the passages, by q."""

    SLOTS = 22

    def __init__(self, passages: list[str], rate: float, most_q: int):
        self.passages = passages
        self.codes = [code_points(p) for p in passages]
        self.edits = np.array([int(rate * len(c)) for c in self.codes], np.int64)
        by_q: dict[int, list[int]] = {}
        for i, c in enumerate(self.codes):
            if len(c):
                by_q.setdefault(min(most_q, len(c) // (int(self.edits[i]) + 1)), []).append(i)
        self.grams = {}
        self.least = np.zeros(len(passages), np.int64)
        for q, members in by_q.items():
            hashes = [rolling(self.codes[i], q) for i in members]
            flat = np.concatenate(hashes)
            item = np.repeat(np.array(members, np.int64), [len(h) for h in hashes])
            offset = np.concatenate([np.arange(len(h)) for h in hashes])
            order = np.argsort(flat, kind="stable")
            keys, starts, counts = np.unique(flat[order], return_index=True, return_counts=True)
            seen = np.zeros(1 << self.SLOTS, bool)
            seen[self.slot(keys)] = True
            self.grams[q] = (seen, keys, starts, counts, item[order], offset[order])
            for i in members:
                self.least[i] = len(self.codes[i]) + 1 - q * (int(self.edits[i]) + 1)

    def slot(self, hashes: np.ndarray) -> np.ndarray:
        return hashes >> np.uint64(64 - self.SLOTS)

    def hits(self, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Positions in ``codes`` with the passage and offset of each shared q-gram."""
        for q, (seen, keys, starts, counts, item, offset) in self.grams.items():
            hashes = rolling(codes, q)
            at = np.flatnonzero(seen[self.slot(hashes)])
            found = np.searchsorted(keys, hashes[at])
            found[found == len(keys)] = 0
            same = keys[found] == hashes[at]
            at, found = at[same], found[same]
            n = counts[found]
            pick = np.repeat(starts[found], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield np.repeat(at, n), item[pick], offset[pick]


def best_in_band(passage: np.ndarray, text: np.ndarray, low: int, high: int, most: int) -> tuple[int, int] | None:
    """Fewest edits, and the end in ``text``, of an occurrence on diagonals low..high."""
    diagonals = np.arange(low, high + 1)
    far = most + len(diagonals) + 1
    # Row 0: an occurrence may start anywhere in the text.
    row = np.where((diagonals >= 0) & (diagonals <= len(text)), 0, far)
    steps = np.arange(len(diagonals))
    for i, code in enumerate(passage):
        at = diagonals + i
        inside = (at >= 0) & (at < len(text))
        letter = np.full(len(at), _GAP, np.uint32)
        letter[inside] = text[at[inside]]
        put = row + (letter != code)
        put[~inside] = far
        put[:-1] = np.minimum(put[:-1], row[1:] + 1)
        end = at + 1
        put[(end < 0) | (end > len(text))] = far
        # Extra text characters: walk along the row.
        row = np.minimum(np.minimum.accumulate(put - steps) + steps, far)
        row[(end < 0) | (end > len(text))] = far
        if row.min() > most:
            return None
    best = int(row.argmin())
    return int(row[best]), int(diagonals[best] + len(passage))


def _chunk_matches(index: Index, texts: list[str]) -> list[tuple[int, int, int, int]]:
    """(row, passage, edits, end) for a few documents laid end to end."""
    codes = [code_points(t) for t in texts]
    gap = np.array([_GAP], np.uint32)
    starts = np.cumsum([0, *[len(c) + 1 for c in codes]])
    laid = np.concatenate([x for c in codes for x in (c, gap)])
    wanted = {}
    for at, item, offset in index.hits(laid):
        row = np.searchsorted(starts, at, side="right") - 1
        step = 2 * index.edits[item] + 1
        band = (at - starts[row] - offset) // step
        rows, items = np.concatenate((row, row)), np.concatenate((item, item))
        bands, offsets = np.concatenate((band, band - 1)), np.concatenate((offset, offset))
        order = np.lexsort((offsets, bands, items, rows))
        r, i, b, o = rows[order], items[order], bands[order], offsets[order]
        fresh = np.ones(len(r), bool)  # one hit per passage position and band
        group = np.ones(len(r), bool)
        if len(r) > 1:
            group[1:] = (r[1:] != r[:-1]) | (i[1:] != i[:-1]) | (b[1:] != b[:-1])
            fresh[1:] = group[1:] | (o[1:] != o[:-1])
        first = np.flatnonzero(group)
        if len(first):
            shared = np.add.reduceat(fresh.astype(np.int64), first)
            for g in np.flatnonzero(shared >= index.least[i[first]]).tolist():
                wanted.setdefault((int(r[first[g]]), int(i[first[g]])), []).append(int(b[first[g]]))
    out = []
    for (row, item), bands in wanted.items():
        best = None
        passage, most = index.codes[item], int(index.edits[item])
        for band in sorted(bands):
            step = 2 * most + 1
            low, high = band * step - most, (band + 2) * step - 1 + most
            exact = texts[row].find(index.passages[item], max(0, low), high + len(passage) + 1)
            found = (0, exact + len(passage)) if exact >= 0 else best_in_band(passage, codes[row], low, high, most)
            if found is not None and (best is None or found < best):
                best = found
            if best is not None and best[0] == 0:
                break
        if best is not None:
            out.append((row, item, *best))
    return out


def _match_part(docs: DataFrame, part: list[tuple], id_col: str, text: str, schema: str, rate: float, q: int) -> DataFrame:
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(([i for i, _ in part], [normalised(t) for _, t in part]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, passages = shared.value
        index = Index(passages, rate, q)
        for batch in batches:
            texts, size, first, rows = [], 0, 0, []
            column = batch.column(1)
            for n in range(len(column)):
                t = normalised(column[n].as_py())
                texts.append(t)
                size += len(t) + 1
                if size >= CHUNK_CHARS or n == len(column) - 1:
                    rows += [(first + r, *rest) for r, *rest in _chunk_matches(index, texts)]
                    texts, size, first = [], 0, n + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array([r[0] for r in rows], pa.int64())).cast(pa.int64()),
                 pa.array([ids[r[1]] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int32()),
                 pa.array([r[3] for r in rows], pa.int64())], [id_col, "item_id", "edits", "ends_at"])
    return docs.select(F.col(id_col).cast("bigint").alias(id_col), F.col(text).alias("text")).mapInArrow(run, schema)


def find_passages(docs: DataFrame, passages: DataFrame, id_col: str = "doc_id", text: str = "text",
                  item: str = "item_id", passage: str = "text", rate: float = EDIT_RATE, q: int = Q,
                  part_chars: int = PART_CHARS) -> DataFrame:
    """``id, item_id, edits, ends_at``: every document and passage that occurs in it within its budget."""
    items = passages.select(F.col(item).cast("bigint").alias("i"), F.col(passage).alias("t")).where(
        F.length("t") > 0).distinct()
    total = items.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    parts = max(1, -(-2 * total // part_chars) if total > part_chars else 1)
    dealt = items.withColumn("part", F.pmod(F.xxhash64("i", "t"), F.lit(parts)))
    schema = f"{id_col} bigint, item_id bigint, edits int, ends_at bigint"
    out = None
    for n in range(parts):
        rows = [(r.i, r.t) for r in dealt.where(F.col("part") == n).collect()]
        found = _match_part(docs, rows, id_col, text, schema, rate, q)
        out = found if out is None else out.unionByName(found)
    return out


def without_passages(docs: DataFrame, passages: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents that hold none of the passages; one without an id cannot be named, and stays."""
    dirty = find_passages(docs, passages, id_col, **options).select(id_col).distinct()
    return docs.join(dirty, id_col, "left_anti").select(docs.columns)
