"""K-mer counts by minimiser partitions: a shuffle carries runs of bases instead of one row per window.

The minimiser of a window is the smallest (hashed, canonical) word of ``m`` bases in it.  Neighbouring windows share
theirs, so a text falls into runs of windows, about nine at k = 31, each of which goes to the bucket of its
minimiser.  A k-mer has one minimiser on either strand: all its windows meet in one bucket, and counts there are final.

A run of at most k windows is known by its first and last window, so it takes 17 bytes, and equal runs of a task's stretch of text
travel once with their number.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from weftline.operators.kmers import pack_kmers, reverse_codes
from weftline.session import cut, parallelism, ship

MINIMISER = 15
STRETCH = 1 << 21
BUCKET_WINDOWS = 1 << 22
STEP_RUNS = 1 << 17


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of a word, so that words of few letters are not the smallest ones."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[:len(out) - step], out[step:])
        done += step
    return out


def minimisers_of(codes: np.ndarray, k: int, m: int) -> np.ndarray:
    """The hashed minimiser of each packed window, as ``located_runs`` finds it in a text."""
    least = None
    for j in range(k - m + 1):
        word = (codes >> (2 * j)) & ((1 << (2 * m)) - 1)
        mixed = _mix(np.maximum(word, reverse_codes(word, m)))
        least = mixed if least is None else np.minimum(least, mixed)
    return least


def located_runs(text: np.ndarray, k: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Place, first and last window, number of windows and hashed minimiser of each run of a text's bytes."""
    codes, valid, _ = pack_kmers(text, k, False)
    if not len(codes):
        none = np.empty(0, np.int64)
        return none, none, none, none, none.astype(np.uint64)
    least = smallest(_mix(pack_kmers(text, m, True)[0]), k - m + 1)
    new = np.concatenate(([True], (least[1:] != least[:-1]) | ~valid[:-1])) & valid
    at = np.arange(len(codes))
    head = np.maximum.accumulate(np.where(new, at, 0))
    # A run longer than k windows goes on as another one.
    start = np.flatnonzero(valid & (new | ((at - head) % k == 0)))
    after = np.concatenate((start[1:], [len(codes)]))
    ends = np.flatnonzero(valid & np.concatenate((~valid[1:], [True])))
    last = np.minimum(after - 1, ends[np.searchsorted(ends, start)])
    return start, codes[start], codes[last], last - start + 1, least[start]


def runs_of(text: np.ndarray, k: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last window, number of windows and hashed minimiser of each run of a text's bytes."""
    return located_runs(text, k, m)[1:]


def windows_of(first: np.ndarray, last: np.ndarray, size: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The windows of runs, by their place in the run: codes, and which runs they come from."""
    whole = (1 << (2 * k)) - 1
    for j in range(int(size.max(initial=0))):
        held = np.flatnonzero(size > j)
        tail = (last[held] >> (2 * (size[held] - 1 - j))) & ((1 << (2 * j)) - 1)
        yield ((first[held] << (2 * j)) & whole) | tail, held


def _added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[new], np.add.reduceat(counts, new)


_FOURS = np.frombuffer("".join(a + b + c + d for a in "ACGT" for b in "ACGT" for c in "ACGT" for d in "ACGT").encode(), np.uint8).reshape(256, 4)


def letters(codes: np.ndarray, k: int) -> pa.Array:
    """The texts of packed k-mers."""
    fours = -(-k // 4)
    shifts = 8 * np.arange(fours - 1, -1, -1)
    raw = _FOURS[(codes[:, None] >> shifts) & 255].reshape(len(codes), 4 * fours)[:, 4 * fours - k:]
    ends = np.arange(len(codes) + 1, dtype=np.int32) * np.int32(k)
    return pa.StringArray.from_buffers(len(codes), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(raw)))


def super_kmers(seqs: DataFrame, by: Sequence[str], seq: str, k: int, m: int, buckets: int) -> DataFrame:
    """``by, bucket, first, last, size, n``: packed arrays of the different runs that a task's stretch of text has in a bucket."""
    ship(seqs.sparkSession)
    by = list(by)
    taken = seqs.select(*by, F.col(seq).alias("_seq"))
    schema = T.StructType([*taken.select(*by).schema.fields, T.StructField("bucket", T.IntegerType()), *[
        T.StructField(c, T.BinaryType()) for c in ("first", "last", "size", "n")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list[np.ndarray]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal size
            for group, texts in held.items():
                first, last, n, least = runs_of(np.concatenate(texts), k, m)
                if not len(first):
                    continue
                bucket = (least % np.uint64(buckets)).astype(np.int64)
                order = np.lexsort((n, last, first, bucket))
                first, last, n, bucket = first[order], last[order], n[order], bucket[order]
                new = np.flatnonzero(np.concatenate(([True], (first[1:] != first[:-1]) | (last[1:] != last[:-1])
                                                     | (n[1:] != n[:-1]) | (bucket[1:] != bucket[:-1]))))
                times = np.diff(np.concatenate((new, [len(first)])))
                first, last, n, bucket = first[new], last[new], n[new].astype(np.uint8), bucket[new]
                cut_at = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
                ends = np.concatenate((cut_at[1:], [len(first)]))
                packed = [[a[s:e].tobytes() for s, e in zip(cut_at, ends)] for a in (first, last, n, times.astype(np.int64))]
                own = [pa.array([v] * len(cut_at), f.type) for v, f in zip(group, kinds)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(bucket[cut_at].astype(np.int32)),
                                                  *[pa.array(p, pa.binary()) for p in packed]], schema.names)
            held.clear()
            size = 0
        gap = np.frombuffer(b"N", np.uint8)
        kinds: list[pa.Field] = []
        for batch in batches:
            kinds = [batch.schema.field(i) for i in range(len(by))]
            groups = list(zip(*[batch.column(i).to_pylist() for i in range(len(by))])) if by else [()] * batch.num_rows
            for group, text in zip(groups, batch.column(len(by)).to_pylist()):
                raw = np.frombuffer((text or "").encode("ascii", "replace"), np.uint8)
                # A long text is taken in stretches that share k - 1 bases, so every window lies in one of them.
                for at in range(0, max(len(raw) - k + 1, 0), STRETCH):
                    part = raw[at:at + STRETCH + k - 1]
                    held.setdefault(group, []).extend((part, gap))
                    size += len(part)
                    if size >= STRETCH:
                        yield from flush()
        yield from flush()
    return taken.mapInArrow(run, schema)


def dealt_runs(runs: DataFrame, by: Sequence[str], buckets: int) -> DataFrame:
    """Runs at their buckets: packed bytes are few beside the work on them, so tasks are not put together by size."""
    return runs.repartition(buckets, *by, "bucket")


def count_super_kmers(seqs: DataFrame, by: Sequence[str] = (), seq: str = "seq", k: int = 31, limit: int | None = 255,
                      m: int = MINIMISER, buckets: int | None = None, text: bool = False) -> DataFrame:
    """``by, kmer, cnt``: the canonical counts of ``kmers.count_kmers``, saturating at ``limit``; with ``text``, k-mers as letters.

    For groups ``by`` of many sequences; windows with anything but ACGT do not count.  A bucket holds about
    ``BUCKET_WINDOWS`` windows; its task adds runs up as they come, so it holds the different k-mers of one bucket.
    """
    if not 1 <= m <= k <= 31:
        raise ValueError("need 1 <= m <= k <= 31")
    by = list(by)
    if buckets is None:
        total = seqs.agg(F.sum(F.length(seq).cast("bigint"))).first()[0] or 0
        buckets = max(parallelism(seqs.sparkSession), total // BUCKET_WINDOWS + 1)
    runs = super_kmers(seqs, by, seq, k, m, buckets)
    schema = T.StructType([*runs.select(*by).schema.fields, T.StructField("kmer", T.StringType() if text else T.LongType()), T.StructField("cnt", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kmers, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        own: list[pa.Array] = []
        for batch in batches:
            own = own or [batch.column(c).slice(0, 1) for c in by]
            first, last, size, n = (np.frombuffer(b"".join(batch.column(c).to_pylist()), kind)
                                    for c, kind in (("first", np.int64), ("last", np.int64), ("size", np.uint8), ("n", np.int64)))
            # A crowded bucket is added up in steps, so that only its different k-mers are held.
            for lo in range(0, len(first), STEP_RUNS):
                part = slice(lo, lo + STEP_RUNS)
                found, times = [kmers], [counts]
                for codes, held in windows_of(first[part], last[part], size[part].astype(np.int64), k):
                    found.append(np.maximum(codes, reverse_codes(codes, k)))
                    times.append(n[part][held])
                kmers, counts = _added(np.concatenate(found), np.concatenate(times))
        for at in range(0, len(kmers), 1 << 18):
            part = kmers[at:at + (1 << 18)]
            take = pa.array(np.zeros(len(part), np.int64))
            yield pa.RecordBatch.from_arrays([*[c.take(take) for c in own], letters(part, k) if text else pa.array(part), pa.array(counts[at:at + (1 << 18)])], schema.names)
    counted = dealt_runs(runs, by, buckets).groupBy(*by, "bucket").applyInArrow(count, schema)
    return counted.withColumn("cnt", F.least("cnt", F.lit(limit)).cast("int")) if limit else counted


def exclusive_super_kmers(seqs: DataFrame, group: str = "grp", seq: str = "seq", k: int = 31, null_is_group: bool = True,
                          m: int = MINIMISER, buckets: int | None = None) -> DataFrame:
    """``kmer, group, n``: canonical k-mers found in exactly one group, and how often.

    All windows of a k-mer meet in one bucket, so a bucket's task decides.  A null group is a group like the others, or
    with ``null_is_group`` off one that does not count beside another.
    """
    if buckets is None:
        total = seqs.agg(F.sum(F.length(seq).cast("bigint"))).first()[0] or 0
        buckets = max(parallelism(seqs.sparkSession), total // BUCKET_WINDOWS + 1)
    runs = super_kmers(seqs, [group], seq, k, m, buckets)
    schema = T.StructType([T.StructField("kmer", T.LongType()), runs.schema[group], T.StructField("n", T.LongType())])
    none = np.iinfo(np.int32).max

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kmers, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        least, most = np.empty(0, np.int32), np.empty(0, np.int32)
        places: dict = {}
        kind = None
        for batch in batches:
            kind = batch.column(group).type
            own = np.array([none if v is None and not null_is_group else places.setdefault(v, len(places))
                            for v in batch.column(group).to_pylist()], np.int32)
            packed = batch.column("n").to_pylist()
            own = np.repeat(own, [len(p) // 8 for p in packed])
            times = np.frombuffer(b"".join(packed), np.int64)
            first, last, size = (np.frombuffer(b"".join(batch.column(c).to_pylist()), t)
                                 for c, t in (("first", np.int64), ("last", np.int64), ("size", np.uint8)))
            found, n, lo, hi = [kmers], [counts], [least], [most]
            for codes, held in windows_of(first, last, size.astype(np.int64), k):
                found.append(np.maximum(codes, reverse_codes(codes, k)))
                n.append(times[held])
                lo.append(own[held])
                hi.append(np.where(own[held] == none, np.int32(-1), own[held]))
            keys = np.concatenate(found)
            order = np.argsort(keys)
            keys = keys[order]
            new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            kmers, counts = keys[new], np.add.reduceat(np.concatenate(n)[order], new)
            least, most = np.minimum.reduceat(np.concatenate(lo)[order], new), np.maximum.reduceat(np.concatenate(hi)[order], new)
        kept = np.flatnonzero((least == most) | (most == -1))
        names = pa.array([*places, None], kind)
        for at in range(0, len(kept), 1 << 18):
            part = kept[at:at + (1 << 18)]
            place = pa.array(np.where(most[part] == -1, len(names) - 1, least[part]))
            yield pa.RecordBatch.from_arrays([pa.array(kmers[part]), names.take(place), pa.array(counts[part])], schema.names)
    return dealt_runs(runs, [], buckets).groupBy("bucket").applyInArrow(decide, schema)


def group_sizes(seqs: DataFrame, group: str = "grp", seq: str = "seq", k: int = 31, m: int = MINIMISER, buckets: int | None = None) -> DataFrame:
    """``group, size, shared, leads``: different canonical k-mers of each group, those that another group has as well, and
    those that no group before it has (in an order of each bucket's own), so ``leads`` adds up to all different k-mers.

    A null group is one like the others.  K-mers are told apart in their buckets and never shuffled.
    """
    buckets = buckets or buckets_for(seqs, seq)
    runs = super_kmers(seqs, [group], seq, k, m, buckets)
    schema = T.StructType([runs.schema[group], *[T.StructField(c, T.LongType()) for c in ("size", "shared", "leads")]])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, owner = np.empty(0, np.int64), np.empty(0, np.int32)
        places: dict = {}
        kind = None
        for batch in batches:
            kind = batch.column(group).type
            first, last = batch.column("first").to_pylist(), batch.column("last").to_pylist()
            sizes = batch.column("size").to_pylist()
            own = np.repeat(np.array([places.setdefault(v, len(places)) for v in batch.column(group).to_pylist()], np.int32), [len(p) for p in sizes])
            first, last, n = np.frombuffer(b"".join(first), np.int64), np.frombuffer(b"".join(last), np.int64), np.frombuffer(b"".join(sizes), np.uint8)
            for lo in range(0, len(first), STEP_RUNS):
                part = slice(lo, lo + STEP_RUNS)
                found, mine = [codes], [owner]
                for code, held in windows_of(first[part], last[part], n[part].astype(np.int64), k):
                    found.append(np.maximum(code, reverse_codes(code, k)))
                    mine.append(own[part][held])
                codes, owner = np.concatenate(found), np.concatenate(mine)
                order = np.lexsort((owner, codes))
                codes, owner = codes[order], owner[order]
                new = np.concatenate(([True], (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])))
                codes, owner = codes[new], owner[new]
        if not len(codes):
            return
        at = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
        many = np.diff(np.append(at, len(codes)))
        sums = [np.bincount(owner, minlength=len(places)), np.bincount(owner[np.repeat(many > 1, many)], minlength=len(places)),
                np.bincount(owner[at], minlength=len(places))]
        yield pa.RecordBatch.from_arrays([pa.array([*places], kind), *[pa.array(x.astype(np.int64)) for x in sums]], schema.names)
    parts = dealt_runs(runs, [], buckets).groupBy("bucket").applyInArrow(count, schema)
    return parts.groupBy(group).agg(*[F.sum(c).alias(c) for c in ("size", "shared", "leads")])


def placed_super_kmers(seqs: DataFrame, by: Sequence[str], marks: Sequence[str], seq: str, k: int, m: int, buckets: int) -> DataFrame:
    """``by, bucket, first, last, size, pos, marks``: packed arrays of the runs of each stretch of text in a bucket, with the
    place of each run in its sequence and the numbers (``marks``, whole and not null) of the sequence."""
    ship(seqs.sparkSession)
    by, marks = list(by), list(marks)
    taken = seqs.select(*by, *[F.col(c).cast("bigint").alias(c) for c in marks], F.col(seq).alias("_seq"))
    schema = T.StructType([*taken.select(*by).schema.fields, T.StructField("bucket", T.IntegerType()), *[
        T.StructField(c, T.BinaryType()) for c in ("first", "last", "size", "pos", *marks)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list[tuple]] = {}
        size = 0
        gap = np.frombuffer(b"N", np.uint8)
        kinds: list[pa.Field] = []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal size
            for group, parts in held.items():
                start, first, last, n, least = located_runs(np.concatenate([x for part, _, _ in parts for x in (part, gap)]), k, m)
                if not len(first):
                    continue
                opens = np.cumsum([0, *[len(part) + 1 for part, _, _ in parts[:-1]]])
                text = np.searchsorted(opens, start, "right") - 1
                pos = start - opens[text] + np.array([at for _, at, _ in parts])[text]
                own = np.array([marked for _, _, marked in parts], np.int64).reshape(len(parts), len(marks))[text]
                bucket = (least % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                bucket = bucket[order]
                columns = [first[order], last[order], n[order].astype(np.uint8), pos[order], *own[order].T]
                cut_at = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
                ends = np.concatenate((cut_at[1:], [len(bucket)]))
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array([v] * len(cut_at), f.type) for v, f in zip(group, kinds)], pa.array(bucket[cut_at]),
                     *[pa.array([a[s:e].tobytes() for s, e in zip(cut_at, ends)], pa.binary()) for a in columns]], schema.names)
            held.clear()
            size = 0
        for batch in batches:
            kinds = [batch.schema.field(i) for i in range(len(by))]
            groups = list(zip(*[batch.column(i).to_pylist() for i in range(len(by))])) if by else [()] * batch.num_rows
            numbers = zip(*[batch.column(c).to_pylist() for c in marks])
            for group, marked, text in zip(groups, numbers, batch.column("_seq").to_pylist()):
                raw = np.frombuffer((text or "").encode("ascii", "replace"), np.uint8)
                for at in range(0, max(len(raw) - k + 1, 0), STRETCH):
                    part = raw[at:at + STRETCH + k - 1]
                    held.setdefault(group, []).append((part, at, marked))
                    size += len(part)
                    if size >= STRETCH:
                        yield from flush()
        yield from flush()
    return taken.mapInArrow(run, schema)


def buckets_for(seqs: DataFrame, seq: str) -> int:
    total = seqs.agg(F.sum(F.length(seq).cast("bigint"))).first()[0] or 0
    return max(parallelism(seqs.sparkSession), total // BUCKET_WINDOWS + 1)


def _gathered(batches: Iterator[pa.RecordBatch], by: Sequence[str], names: Sequence[str]) -> tuple[list[pa.Array], list[np.ndarray]]:
    """The group of a bucket and its packed arrays, joined."""
    own: list[pa.Array] = []
    found: list[list[np.ndarray]] = [[] for _ in names]
    for batch in batches:
        own = own or [batch.column(c).slice(0, 1) for c in by]
        for held, c in zip(found, names):
            held.append(np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8 if c == "size" else np.int64))
    return own, [np.concatenate(held) for held in found]


def _shares(first: np.ndarray, last: np.ndarray, size: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """All canonical windows of a bucket, in shares of about ``BUCKET_WINDOWS`` that each hold all windows of their k-mers: codes, runs, places in the run."""
    shares = int(size.sum()) // BUCKET_WINDOWS + 1
    for share in range(shares):
        codes, runs, places = [], [], []
        for j, (code, held) in enumerate(windows_of(first, last, size, k)):
            code = np.maximum(code, reverse_codes(code, k))
            if shares > 1:
                mine = np.flatnonzero((_mix(code) >> np.uint64(20)) % np.uint64(shares) == np.uint64(share))
                code, held = code[mine], held[mine]
            codes.append(code)
            runs.append(held)
            places.append(np.full(len(held), j))
        if codes:
            yield np.concatenate(codes), np.concatenate(runs), np.concatenate(places)


def shared_colours(seqs: DataFrame, mark: str, by: Sequence[str] = (), seq: str = "seq", k: int = 31, m: int = MINIMISER,
                   buckets: int | None = None) -> DataFrame:
    """``by, kmer, mark, cnt, n, h1, h2, weight``: k-mers of two or more sequences, one for all that a bucket's same
    sequences carry the same number of times (``weight`` of them).

    ``mark`` numbers the sequences; ``n`` is how many carry the k-mer, ``h1, h2`` tell which and how often.
    """
    by = list(by)
    buckets = buckets or buckets_for(seqs, seq)
    runs = placed_super_kmers(seqs, by, [mark], seq, k, m, buckets).drop("pos")
    whole = [T.StructField(c, T.LongType()) for c in ("kmer", mark, "cnt", "n", "h1", "h2", "weight")]
    schema = T.StructType([*runs.select(*by).schema.fields, *whole])

    def colours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, (first, last, size, marks) = _gathered(batches, by, ("first", "last", "size", mark))
        size = size.astype(np.int64)
        for codes, held, _ in _shares(first, last, size, k):
            carrier = marks[held]
            order = np.lexsort((carrier, codes))
            codes, carrier = codes[order], carrier[order]
            new = np.flatnonzero(np.concatenate(([True], (codes[1:] != codes[:-1]) | (carrier[1:] != carrier[:-1]))))
            cnt = np.diff(np.concatenate((new, [len(codes)])))
            codes, carrier = codes[new], carrier[new]
            at = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
            n = np.diff(np.concatenate((at, [len(codes)])))
            # K-mers of one sequence are most; the others are kept with their rows.
            kept = np.repeat(n > 1, n)
            if not kept.any():
                continue
            codes, carrier, cnt, n = codes[kept], carrier[kept], cnt[kept], n[n > 1]
            at = np.cumsum(n) - n
            both = carrier.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + cnt.astype(np.uint64)
            h1 = np.bitwise_xor.reduceat(_mix(both), at)
            h2 = np.bitwise_xor.reduceat(_mix(_mix(both + np.uint64(0xD1B54A32D192ED03)) + cnt.astype(np.uint64)), at)
            order = np.lexsort((h2, h1, n))
            same = (n[order][1:] == n[order][:-1]) & (h1[order][1:] == h1[order][:-1]) & (h2[order][1:] == h2[order][:-1])
            lead = np.flatnonzero(np.concatenate(([True], ~same)))
            weight = np.diff(np.concatenate((lead, [len(order)])))
            chosen = order[lead]
            many = n[chosen]
            row = np.repeat(at[chosen] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            columns = [codes[row], carrier[row], cnt[row], *[np.repeat(c, many) for c in (
                many, h1[chosen].view(np.int64), h2[chosen].view(np.int64), weight)]]
            for lo in range(0, len(row), 1 << 18):
                part = [pa.array(c[lo:lo + (1 << 18)]) for c in columns]
                take = pa.array(np.zeros(len(part[0]), np.int64))
                yield pa.RecordBatch.from_arrays([*[c.take(take) for c in own], *part], schema.names)
    return dealt_runs(runs, by, buckets).groupBy(*by, "bucket").applyInArrow(colours, schema)


def exclusive_marked_kmers(seqs: DataFrame, mark: str, seq: str = "seq", k: int = 31, m: int = MINIMISER,
                           buckets: int | None = None) -> DataFrame:
    """``kmer, mark, n`` as ``exclusive_super_kmers`` has them, for many groups of few sequences, which ``mark`` numbers (not null)."""
    buckets = buckets or buckets_for(seqs, seq)
    runs = placed_super_kmers(seqs, [], [mark], seq, k, m, buckets).drop("pos")
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("kmer", mark, "n")])

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, (first, last, size, marks) = _gathered(batches, [], ("first", "last", "size", mark))
        for codes, held, _ in _shares(first, last, size.astype(np.int64), k):
            if not len(codes):
                continue
            order = np.argsort(codes)
            codes, own = codes[order], marks[held[order]]
            at = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
            least = np.minimum.reduceat(own, at)
            alone = least == np.maximum.reduceat(own, at)
            columns = [codes[at][alone], least[alone], np.diff(np.append(at, len(codes)))[alone]]
            for lo in range(0, len(columns[0]), 1 << 18):
                yield pa.RecordBatch.from_arrays([pa.array(c[lo:lo + (1 << 18)]) for c in columns], schema.names)
    return dealt_runs(runs, [], buckets).groupBy("bucket").applyInArrow(decide, schema)


def seen_stretches(seqs: DataFrame, group: str, own: str, first_own: str, seq: str = "seq", k: int = 31, m: int = MINIMISER,
                   buckets: int | None = None) -> DataFrame:
    """``group, own, start, end``: stretches of windows that a sequence of the group with a smaller number has as well.

    ``own`` numbers the sequences of a group; ``first_own`` is the number that other sequences compare with (at most ``own``).
    """
    buckets = buckets or buckets_for(seqs, seq)
    runs = placed_super_kmers(seqs, [group], [own, first_own], seq, k, m, buckets)
    schema = T.StructType([runs.schema[group], *[T.StructField(c, T.LongType()) for c in (own, "start", "end")]])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, (first, last, size, pos, mine, least) = _gathered(batches, [group], ("first", "last", "size", "pos", own, first_own))
        size = size.astype(np.int64)
        opens = np.cumsum(size) - size
        seen = np.zeros(int(size.sum()), bool)
        for codes, held, place in _shares(first, last, size, k):
            order = np.argsort(codes, kind="stable")
            held, place = held[order], place[order]
            at = np.flatnonzero(np.concatenate(([True], codes[order][1:] != codes[order][:-1])))
            lowest = np.repeat(np.minimum.reduceat(least[held], at), np.diff(np.concatenate((at, [len(order)]))))
            seen[(opens[held] + place)[lowest < mine[held]]] = True
        edge = np.zeros(len(seen) + 1, bool)
        edge[opens] = True
        edge[-1] = True
        start = np.flatnonzero(seen & (edge[:-1] | np.concatenate(([True], ~seen[:-1]))))
        end = np.flatnonzero(seen & (edge[1:] | np.concatenate((~seen[1:], [True])))) + 1
        run = np.searchsorted(opens, start, "right") - 1
        columns = [mine[run], pos[run] + start - opens[run], pos[run] + end - 1 - opens[run] + k]
        for lo in range(0, len(run), 1 << 18):
            part = [pa.array(c[lo:lo + (1 << 18)]) for c in columns]
            yield pa.RecordBatch.from_arrays([name[0].take(pa.array(np.zeros(len(part[0]), np.int64))), *part], schema.names)
    return dealt_runs(runs, [group], buckets).groupBy(group, "bucket").applyInArrow(search, schema)


def _dealt_list(kmers: DataFrame, schema: T.StructType, k: int, m: int, buckets: int) -> DataFrame:
    """Listed k-mers packed by bucket, in the columns of placed runs: ``first`` holds them, the others are empty."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            codes = np.unique(np.concatenate(held))
            held.clear()
            bucket = (minimisers_of(codes, k, m) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            codes, bucket = codes[order], bucket[order]
            cut_at = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
            packs = [codes[s:e].tobytes() for s, e in zip(cut_at, np.append(cut_at[1:], len(codes)))]
            columns = {"bucket": pa.array(bucket[cut_at]), "first": pa.array(packs, pa.binary())}
            none = pa.array([b""] * len(cut_at), pa.binary())
            yield pa.RecordBatch.from_arrays([columns.get(c, none) for c in schema.names], schema.names)
        for batch in batches:
            codes = batch.column(0).drop_null().to_numpy(zero_copy_only=False)
            if len(codes):
                held.append(codes)
            if sum(map(len, held)) >= STRETCH:
                yield from flush()
        if held:
            yield from flush()
    return kmers.select("kmer").mapInArrow(pack, schema)


def found_windows(seqs: DataFrame, kmers: DataFrame, stretches: bool = False, name: str = "name", seq: str = "seq", k: int = 31,
                  m: int = MINIMISER, buckets: int | None = None) -> DataFrame:
    """``name, pos, kmer`` of the windows whose canonical k-mer is listed, as ``kmers.found_kmers`` has them.

    With ``stretches``, ``name, start, end`` of runs of such windows (in pieces).  Runs of windows and the list meet in
    the buckets of minimisers, so windows that are not listed are never rows.  Sequences without a name are left out.
    """
    buckets = buckets or buckets_for(seqs, seq)
    named = seqs.where(F.col(name).isNotNull()).select(name, F.col(seq).alias("_text"))
    kind = named.schema[name].dataType
    numbers = None
    if isinstance(kind, T.IntegralType):
        marked = named.select(F.col(name).cast("bigint").alias("_mark"), "_text")
    else:
        numbers = cut(named.select(name).distinct().withColumn("_mark", F.monotonically_increasing_id()))
        marked = named.join(numbers, name).select("_mark", "_text")
    runs = placed_super_kmers(marked, [], ["_mark"], "_text", k, m, buckets)
    both = runs.unionByName(_dealt_list(kmers, runs.schema, k, m, buckets))
    schema = T.StructType([T.StructField(c, T.LongType()) for c in (["_mark", "start", "end"] if stretches else ["_mark", "pos", "kmer"])])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, held = [np.empty(0, np.int64)], []
        for batch in batches:
            packs = [batch.column(c).to_pylist() for c in ("first", "last", "size", "pos", "_mark")]
            for row in zip(*packs):
                if row[2]:
                    held.append(row)
                else:
                    listed.append(np.frombuffer(row[0], np.int64))
        wanted = np.unique(np.concatenate(listed))
        if not held or not len(wanted):
            return
        first, last, size, pos, mark = (np.frombuffer(b"".join(c), np.uint8 if i == 2 else np.int64) for i, c in enumerate(zip(*held)))
        held.clear()
        for lo in range(0, len(first), STEP_RUNS):
            part = slice(lo, lo + STEP_RUNS)
            n, at, own = size[part].astype(np.int64), pos[part], mark[part]
            opens = np.cumsum(n) - n
            seen = np.zeros(int(n.sum()), bool)
            codes_of = np.empty(0 if stretches else len(seen), np.int64)
            for j, (codes, run) in enumerate(windows_of(first[part], last[part], n, k)):
                codes = np.maximum(codes, reverse_codes(codes, k))
                place = np.minimum(np.searchsorted(wanted, codes), len(wanted) - 1)
                seen[opens[run] + j] = wanted[place] == codes
                if not stretches:
                    codes_of[opens[run] + j] = codes
            if stretches:
                edge = np.zeros(len(seen) + 1, bool)
                edge[opens] = True
                edge[-1] = True
                start = np.flatnonzero(seen & (edge[:-1] | np.concatenate(([True], ~seen[:-1]))))
                end = np.flatnonzero(seen & (edge[1:] | np.concatenate((~seen[1:], [True])))) + 1
                run = np.searchsorted(opens, start, "right") - 1
                columns = [own[run], at[run] + start - opens[run], at[run] + end - opens[run]]
            else:
                hit = np.flatnonzero(seen)
                run = np.searchsorted(opens, hit, "right") - 1
                columns = [own[run], at[run] + hit - opens[run], codes_of[hit]]
            for k0 in range(0, len(run), 1 << 18):
                yield pa.RecordBatch.from_arrays([pa.array(c[k0:k0 + (1 << 18)]) for c in columns], schema.names)
    found = dealt_runs(both, [], buckets).groupBy("bucket").applyInArrow(search, schema)
    if numbers is not None:
        found = found.join(numbers, "_mark")
    return found.select(F.col("_mark").cast(kind).alias(name) if numbers is None else F.col(name), *schema.names[1:])
