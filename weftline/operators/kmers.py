"""K-mer extraction, counting, set selection, comparison and filtering."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from weftline.operators.scan import prefix_scan
from weftline.session import cut, parallelism

TILE = 1 << 15
_KERNEL_BASES = 1 << 20
LONGEST = 1 << 20

_CODE = np.full(256, 4, dtype=np.uint8)
for _i, _pair in enumerate(("Aa", "Cc", "Gg", "Tt")):
    for _ch in _pair:
        _CODE[ord(_ch)] = _i


def pack_kmers(text: np.ndarray, k: int, canonical: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code, validity and forward flag of the k-mer starting at every byte of ``text``.

    Widths are doubled (1, 2, 4, ...) and joined to reach ``k``, so the work is
    a few array passes per base whatever ``k`` is.
    """
    size = len(text) - k + 1
    if size <= 0:
        return np.empty(0, np.int64), np.empty(0, bool), np.empty(0, bool)
    base = _CODE[text]
    bad = np.concatenate(([0], np.cumsum(base == 4)))
    valid = bad[k:] == bad[:size]
    fwd = (base & 3).astype(np.int64)
    rev = 3 - fwd
    out_f = out_r = None
    done, width = 0, 1
    while True:
        if k & width:
            if out_f is None:
                out_f, out_r, done = fwd, rev, width
            else:
                n = len(base) - done - width + 1
                tail_f, tail_r = fwd[done:done + n], rev[done:done + n]
                out_f = (out_f[:n] << (2 * width)) | tail_f
                out_r = (tail_r << (2 * done)) | out_r[:n]
                done += width
        if done == k:
            break
        n = len(fwd) - width
        fwd, rev = ((fwd[:n] << (2 * width)) | fwd[width:width + n],
                    (rev[width:width + n] << (2 * width)) | rev[:n])
        width *= 2
    return (np.maximum(out_f, out_r) if canonical else out_f), valid, out_f >= out_r


def reverse_codes(codes: np.ndarray, k: int) -> np.ndarray:
    """Codes of the reverse complements: two-bit letters swapped pairwise, in fours and so on, then complemented."""
    x = codes.astype(np.uint64)
    for width, mask in ((2, 0x3333333333333333), (4, 0x0F0F0F0F0F0F0F0F), (8, 0x00FF00FF00FF00FF), (16, 0x0000FFFF0000FFFF)):
        keep, step = np.uint64(mask), np.uint64(width)
        x = ((x >> step) & keep) | ((x & keep) << step)
    x = (x >> np.uint64(32)) | (x << np.uint64(32))
    return ((~x) >> np.uint64(64 - 2 * k)).astype(np.int64)


def tiles(df: DataFrame, ids: Sequence[str], seq: str, overlap: int,
          step: int = TILE, parts: int | None = None) -> DataFrame:
    """Cut sequences into overlapping tiles and spread the tiles over the tasks."""
    last = F.greatest(F.length(seq) - F.lit(overlap + 1), F.lit(0))
    cutup = (
        df.select(*ids, F.col(seq).alias("_seq"),
                  F.explode(F.sequence(F.lit(0), last, F.lit(step))).alias("offset"))
        .select(*ids, "offset",
                F.substring("_seq", F.col("offset") + 1, F.lit(step + overlap)).alias("tile"))
    )
    return cutup.repartition(parts or parallelism(df.sparkSession), *ids, "offset")


def kmer_hits(df: DataFrame, ids: Sequence[str] = ("name",), seq: str = "seq", k: int = 31,
              canonical: bool = True, step: int = TILE, strand: bool = False) -> DataFrame:
    """One row per valid window: ids, ``pos`` (0-based) and the packed ``kmer``.

    Windows holding anything but ACGT (either case) are skipped.  With
    ``strand``, ``fwd`` tells whether the text itself is the canonical side.
    """
    if not 1 <= k <= 31:
        raise ValueError("k must lie between 1 and 31")
    ids = list(ids)
    cut_up = tiles(df, ids, seq, k - 1, step)
    fields = [cut_up.schema[c] for c in ids]
    extra = [T.StructField("fwd", T.BooleanType())] if strand else []
    schema = T.StructType([*fields, T.StructField("pos", T.LongType()),
                           T.StructField("kmer", T.LongType()), *extra])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = max(1, _KERNEL_BASES // (step + k))
        for batch in batches:
            for lo in range(0, batch.num_rows, group):
                part = batch.slice(lo, group)
                texts = part.column("tile").to_pylist()
                lens = np.array([len(t) for t in texts], dtype=np.int64)
                joined = np.frombuffer("".join(texts).encode("ascii", "replace"), np.uint8)
                codes, valid, forward = pack_kmers(joined, k, canonical)
                starts = np.cumsum(lens) - lens
                row = np.repeat(np.arange(len(lens)), lens)[: len(codes)]
                inside = np.arange(len(codes)) - starts[row]
                keep = np.flatnonzero(valid & (inside + k <= lens[row]))
                row = row[keep]
                offset = part.column("offset").to_numpy(zero_copy_only=False).astype(np.int64)
                take = pa.array(row)
                columns = [part.column(c).take(take) for c in ids]
                columns += [pa.array(inside[keep] + offset[row]), pa.array(codes[keep])]
                if strand:
                    columns.append(pa.array(forward[keep]))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return cut_up.mapInArrow(scan, schema)


def apart(df: DataFrame, ids: Sequence[str], seq: str, longest: int) -> tuple[DataFrame, DataFrame]:
    """The sequences a kernel can take one by one (no null id, no id twice, at most ``longest`` bases) and the others."""
    ids = list(ids)
    known = F.coalesce(F.length(seq) <= longest, F.lit(True))
    for c in ids:
        known = known & F.col(c).isNotNull()
    twice = df.groupBy(*ids).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*ids)
    if twice.isEmpty():
        return df.where(known), df.where(~known)
    again = cut(twice.withColumn("_again", F.lit(True)))
    marked = df.join(again, ids, "left").withColumn("_one", known & F.col("_again").isNull())
    return marked.where("_one").select(df.columns), marked.where("NOT _one").select(df.columns)


def _each_sequence(df: DataFrame, ids: Sequence[str], seq: str, schema: T.StructType,
                   kernel: Callable[[np.ndarray], list[np.ndarray]]) -> DataFrame:
    """Rows of ``kernel`` (one array per column after the ids) for the bytes of every sequence, its ids before them."""
    ids = list(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, rows, size = [], [], 0
            for i, text in enumerate(batch.column("_seq").to_pylist()):
                columns = kernel(np.frombuffer((text or "").encode("ascii", "replace"), np.uint8))
                if len(columns[0]):
                    found.append(columns)
                    rows.append(np.full(len(columns[0]), i))
                    size += len(columns[0])
                if size >= _KERNEL_BASES:
                    take = pa.array(np.concatenate(rows))
                    yield pa.RecordBatch.from_arrays([batch.column(c).take(take) for c in ids]
                                                     + [pa.array(np.concatenate(c)) for c in zip(*found)], names=schema.names)
                    found, rows, size = [], [], 0
            if found:
                take = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays([batch.column(c).take(take) for c in ids]
                                                 + [pa.array(np.concatenate(c)) for c in zip(*found)], names=schema.names)
    spread = df.select(*ids, F.col(seq).alias("_seq")).repartition(parallelism(df.sparkSession), *ids)
    return spread.mapInArrow(run, schema)


def sequence_counts(df: DataFrame, ids: Sequence[str] = ("name",), seq: str = "seq", k: int = 31,
                    longest: int = LONGEST) -> DataFrame:
    """``ids, kmer, cnt``: occurrences of each canonical k-mer in each sequence, as ``count_kmers(hits, ids, None)`` has them.

    A sequence of at most ``longest`` bases is counted where it lies, so no windows are shuffled; longer ones, and
    sequences that share their ids, go by rows of windows.
    """
    ids = list(ids)
    if not 1 <= k <= 31:
        raise ValueError("k must lie between 1 and 31")

    def count(text: np.ndarray) -> list[np.ndarray]:
        codes, valid, _ = pack_kmers(text, k, True)
        found, times = np.unique(codes[valid], return_counts=True)
        return [found, times.astype(np.int64)]
    short, rest = apart(df.select(*ids, seq), ids, seq, longest)
    schema = T.StructType([*[df.schema[c] for c in ids], T.StructField("kmer", T.LongType()), T.StructField("cnt", T.LongType())])
    return _each_sequence(short, ids, seq, schema, count).unionByName(count_kmers(kmer_hits(rest, ids, seq, k), ids, None))


def window_numbers(seq: str = "seq", k: int = 31) -> Column:
    """How many valid windows a sequence has: the sum of its ``sequence_counts``."""
    clean = F.regexp_extract_all(F.col(seq), F.lit(f"[ACGTacgt]{{{k},}}"), F.lit(0))
    return F.aggregate(clean, F.lit(0).cast("bigint"), lambda a, x: a + F.length(x) - (k - 1))


def sequence_squares(df: DataFrame, ids: Sequence[str], seq: str = "seq", k: int = 31, longest: int = LONGEST) -> DataFrame:
    """``ids, square``: the summed squares of ``sequence_counts`` of each sequence."""
    ids = list(ids)

    def square(text: np.ndarray) -> list[np.ndarray]:
        codes, valid, _ = pack_kmers(text, k, True)
        times = np.unique(codes[valid], return_counts=True)[1].astype(np.int64)
        return [np.array([(times * times).sum()])] if len(times) else [times]
    short, rest = apart(df.select(*ids, seq), ids, seq, longest)
    schema = T.StructType([*[df.schema[c] for c in ids], T.StructField("square", T.LongType())])
    counted = count_kmers(kmer_hits(rest, ids, seq, k), ids, None)
    return _each_sequence(short, ids, seq, schema, square).unionByName(
        counted.groupBy(*ids).agg(F.sum(F.col("cnt") * F.col("cnt")).alias("square")))


def saturate(count: Column, limit: int = 255) -> Column:
    return F.least(count, F.lit(limit)).cast("int")


def count_kmers(hits: DataFrame, by: Sequence[str] = (), limit: int | None = 255) -> DataFrame:
    """Occurrences per (``by``, k-mer), saturating at ``limit``."""
    n = F.count(F.lit(1))
    return hits.groupBy(*by, "kmer").agg(
        (saturate(n, limit) if limit else n).alias("cnt"))


def target_set(hits: DataFrame, target: str = "target") -> DataFrame:
    """Distinct (target, k-mer) rows: a k-mer may belong to several targets."""
    return hits.select(target, "kmer").distinct()


def probe_targets(samples: DataFrame, targets: DataFrame, sample: str = "sample",
                  target: str = "target", limit: int = 255) -> DataFrame:
    """Saturating count of each target's k-mers in each sample.

    The stream is counted before the join, so a repeated k-mer crosses the
    shuffle once per sample and map task.
    """
    counted = samples.groupBy(sample, "kmer").agg(F.count(F.lit(1)).alias("_n"))
    return counted.join(targets, "kmer").select(
        target, sample, "kmer", saturate(F.col("_n"), limit).alias("cnt"))


def probe_sequences(seqs: DataFrame, targets: DataFrame, sample: str = "name", target: str = "target", limit: int = 255,
                    seq: str = "seq", k: int = 31) -> DataFrame:
    """``probe_targets`` of sequences that are counted where they lie.

    The targets are written first: where they are few they are sent to the counts, and only what they hold is shuffled.
    """
    counted = sequence_counts(seqs, (sample,), seq, k)
    return counted.join(cut(targets), "kmer").select(target, sample, "kmer", saturate(F.col("cnt"), limit).alias("cnt"))


def size_sketches(hits: DataFrame, keys: Sequence[str], bits: int = 14) -> DataFrame:
    """``keys, sketch``: a mergeable summary of the distinct k-mers of each key (a file, say), to be stored beside the counts."""
    return hits.groupBy(*keys).agg(F.hll_sketch_agg("kmer", bits).alias("sketch"))


def merged_sizes(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, size``: about how many distinct k-mers the sketches of each key hold together (1 % off at 14 bits)."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("size"))


def select_informative(gene: DataFrame, genome: DataFrame, limit: int = 255) -> DataFrame:
    """Full outer comparison of two saturating count tables.

    A k-mer whose two counts are equal and unsaturated occurs only inside the
    gene and is included; any other one is excluded with the difference.
    """
    g = gene.select("kmer", F.col("cnt").alias("g"))
    a = genome.select("kmer", F.col("cnt").alias("a"))
    both = g.join(a, "kmer", "full_outer").select(
        "kmer", F.coalesce("g", F.lit(0)).alias("g"), F.coalesce("a", F.lit(0)).alias("a"))
    return both.select(
        "kmer", ((F.col("g") == F.col("a")) & (F.col("g") < limit)).alias("include"),
        F.abs(F.col("g") - F.col("a")).alias("diff"))


def subtract_excluded(include: DataFrame, exclude: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Included k-mers that no exclusion list names, and those that one does."""
    return (include.join(exclude.select("kmer"), "kmer", "left_anti"),
            include.join(exclude.select("kmer"), "kmer", "left_semi"))


def compare_counts(first: DataFrame, second: DataFrame, limit: int = 255,
                   second_limit: int = 65535) -> DataFrame:
    """``kmer, c1, c2`` for first-set k-mers seen 1 to ``limit``-1 times."""
    c1 = first.select("kmer", F.col("cnt").alias("c1")).where(
        (F.col("c1") > 0) & (F.col("c1") < limit))
    c2 = second.select("kmer", F.least("cnt", F.lit(second_limit)).alias("c2"))
    return c1.join(c2, "kmer", "left").select("kmer", "c1",
                                               F.coalesce("c2", F.lit(0)).alias("c2"))


def exclusive_to_group(hits: DataFrame, group: str = "grp", groups: DataFrame | None = None) -> DataFrame:
    """K-mers found in exactly one group.

    Smallest and largest text cannot be kept in a hash aggregate.  When the
    distinct ``groups`` are given, their hashes are compared instead and the
    names joined back; the hashes are checked to be distinct first.
    """
    if groups is None:
        return hits.groupBy("kmer").agg(
            F.min(group).alias(group), F.max(group).alias("_last"),
        ).where(F.col(group).eqNullSafe(F.col("_last"))).drop("_last")
    names = cut(groups.select(group).distinct().withColumn("_h", F.xxhash64(group)))
    if names.select("_h").distinct().count() != names.count():
        return exclusive_to_group(hits, group)
    code = F.xxhash64(group)
    one = hits.groupBy("kmer").agg(F.min(code).alias("_h"), F.max(code).alias("_l")).where("_h = _l")
    return one.select("kmer", "_h").join(names, "_h").drop("_h")


def _repeats(codes: np.ndarray, k: int, size: int, limit: int) -> np.ndarray:
    """Rows whose commonest word of ``size`` bases occurs more than ``limit`` times."""
    shifts = 2 * np.arange(k - size, -1, -1)
    words = ((codes[:, None] >> shifts) & ((1 << (2 * size)) - 1)).astype(np.uint8)
    words.sort(axis=1)
    return (words[:, limit:] == words[:, : words.shape[1] - limit]).any(axis=1)


def gc_and_complexity_filter(kmers: DataFrame, k: int = 31, low: float = 0.3, high: float = 0.7,
                             max_di: int = 9, max_tri: int = 6) -> DataFrame:
    """Drop k-mers out of the GC range or of low complexity.

    The same tests as ``functions.sequence.gc_in_range`` and ``low_complexity``,
    made on the packed codes of a whole Arrow batch at once.
    """
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column("kmer").to_numpy(zero_copy_only=False)
            bases = (codes[:, None] >> (2 * np.arange(k))) & 3
            gc = ((bases == 1) | (bases == 2)).sum(axis=1)
            good = ((gc > low * k) & (gc < high * k) & ~_repeats(codes, k, 2, max_di)
                    & ~_repeats(codes, k, 3, max_tri))
            yield batch.filter(pa.array(good))

    return kmers.mapInArrow(keep, kmers.schema)


def window_gc(df: DataFrame, ids: Sequence[str], seq: str = "seq", window: int = 100,
              k: int = 31) -> DataFrame:
    """G or C bases in the ``window`` bases ending with each k-mer.

    A non-ACGT base restarts the window.  Tiles overlap by the window, so each
    one is complete in itself.
    """
    ids = list(ids)
    cut_up = tiles(df, ids, seq, window - 1)
    fields = [cut_up.schema[c] for c in ids]
    schema = T.StructType([*fields, T.StructField("pos", T.LongType()),
                           T.StructField("kmer", T.LongType()),
                           T.StructField("span", T.IntegerType()),
                           T.StructField("gc", T.IntegerType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c) for c in ids]
            offsets = batch.column("offset").to_pylist()
            for i, text in enumerate(batch.column("tile").to_pylist()):
                raw = np.frombuffer(text.encode("ascii", "replace"), np.uint8)
                codes, valid, _ = pack_kmers(raw, k, True)
                if not len(codes):
                    continue
                base = _CODE[raw]
                idx = np.arange(len(raw))
                clean_from = np.maximum.accumulate(np.where(base == 4, idx + 1, 0))
                total = np.concatenate(([0], np.cumsum((base == 1) | (base == 2))))
                end = np.arange(len(codes)) + k - 1
                first = np.maximum(clean_from[end], end - window + 1)
                owned = valid if offsets[i] == 0 else valid & (end >= window - 1)
                keep = np.flatnonzero(owned)
                row = pa.array(np.full(len(keep), i))
                yield pa.RecordBatch.from_arrays(
                    [c.take(row) for c in columns]
                    + [pa.array(keep + offsets[i]), pa.array(codes[keep]),
                       pa.array((end - first + 1)[keep].astype(np.int32)),
                       pa.array((total[end + 1] - total[first])[keep].astype(np.int32))],
                    names=[*ids, "pos", "kmer", "span", "gc"])

    return cut_up.mapInArrow(scan, schema)


def found_kmers(hits: DataFrame, kmers: DataFrame) -> DataFrame:
    """Hits whose k-mer is in the list (positions kept, repeats counted)."""
    return hits.join(kmers.select("kmer").distinct(), "kmer", "left_semi")


_SCALE = 1_000_000


def _walk(points: DataFrame, rcutoff: float, cutoff: int) -> DataFrame:
    """Trim offset from one side, from rows ``name, at, rank, last``.

    The score adds 1 on a hit, subtracts r/(1-r) elsewhere, restarts when it
    falls below 0 and stops at ``cutoff``.  Scaled to integers, the running sum
    just before a hit at ``at`` with ``rank`` earlier hits is known without
    visiting the misses; a restart is a new minimum of that sum, and the score
    is its height above the minimum.  One prefix minimum replaces the walk.
    """
    gain, loss = round((1 - rcutoff) * _SCALE), round(rcutoff * _SCALE)
    before = F.col("rank") * gain - (F.col("at") - F.col("rank")) * loss
    rows = points.withColumn("_s", before)
    scanned = prefix_scan(rows, ["name"], "at", F.floor(F.col("at") / TILE), F.col("_s"),
                          "min", "_low", inclusive=False)
    floor = F.least(F.col("_low"), F.lit(0).cast("bigint"))
    judged = scanned.select(
        "name", "at", (F.col("_s") < floor).alias("_restart"),
        (~F.col("last") & (F.col("_s") + gain - F.least(floor, F.col("_s")) >= cutoff * gain)).alias("_stop"))
    # Earliest stop and latest restart up to it, without a second pass per name.
    stops = judged.where("_stop").groupBy("name").agg(F.min("at").alias("_end"))
    return (judged.where("_restart").join(stops, "name", "left")
            .where(F.col("_end").isNull() | (F.col("at") <= F.col("_end")))
            .groupBy("name").agg((F.max("at") - 1).alias("trim")))


def trim_by_kmers(seqs: DataFrame, hits: DataFrame, kmers: DataFrame | None, k: int = 31,
                  anchor: int = 5000, cutoff: int = 500, rcutoff: float = 0.1) -> DataFrame:
    """Pass, trim or filter each sequence by its listed k-mers.

    Returns ``name, count, start, end, decision`` where start and end are the
    bases to remove on each side.  Without ``kmers``, ``hits`` holds listed k-mers only.
    """
    size = seqs.select("name", F.length("seq").cast("bigint").alias("len"))
    found = hits.select("name", "pos") if kmers is None else cut(found_kmers(hits, kmers).select("name", "pos"))
    counts = found.groupBy("name").agg(F.count(F.lit(1)).alias("_n"))
    base = size.join(counts, "name", "left").withColumn("count", F.coalesce("_n", F.lit(0))).drop("_n")
    enough = F.col("count") >= cutoff
    dense = F.col("count") >= (F.col("len") - 2 * anchor) * F.lit(rcutoff)
    base = cut(base.withColumn(
        "_state", F.when(~enough, "filter").when(dense, "pass").otherwise("trim")))
    todo = base.where("_state = 'trim'").select("name", (F.col("len") - k + 1).alias("_w"),
                                                F.col("count").alias("_all"))
    ranked = (prefix_scan(found.join(todo, "name"), ["name"], "pos", F.floor(F.col("pos") / TILE),
                             F.lit(1).cast("bigint"), "sum", "rank", inclusive=False))
    ends = todo.select("name", F.col("_w").alias("at"), F.col("_all").alias("rank"), F.lit(True).alias("last"))
    ahead = ranked.select("name", F.col("pos").alias("at"), "rank", F.lit(False).alias("last"))
    behind = ranked.select("name", (F.col("_w") - 1 - F.col("pos")).alias("at"),
                           (F.col("_all") - 1 - F.col("rank")).alias("rank"), F.lit(False).alias("last"))
    left = _walk(ahead.unionByName(ends), rcutoff, cutoff).withColumnRenamed("trim", "start")
    right = _walk(behind.unionByName(ends), rcutoff, cutoff).withColumnRenamed("trim", "end")
    sides = (base.join(left, "name", "left").join(right, "name", "left")
             .withColumn("start", F.coalesce("start", F.lit(0)))
             .withColumn("end", F.coalesce("end", F.lit(0))))
    lost = (
        found.join(sides.where("_state = 'trim'").select("name", "start", "end", "len"), "name")
        .groupBy("name").agg(
            F.sum(F.when(F.col("pos") < F.col("start"), 1).otherwise(0)
                  + F.when(F.col("pos") >= F.col("len") - k + 1 - F.col("end"), 1).otherwise(0))
            .alias("_lost"))
    )
    left_over = F.col("count") - F.coalesce("_lost", F.lit(0))
    trimmed = F.col("_state") == "trim"
    return (
        sides.join(lost, "name", "left")
        .withColumn("decision", F.when(~trimmed, F.col("_state"))
                    .when(left_over >= cutoff, "trim").otherwise("filter"))
        .withColumn("count", F.when(trimmed, left_over).otherwise(F.col("count")))
        .select("name", "len", "count",
                F.when(F.col("decision") == "trim", F.col("start")).otherwise(F.lit(0)).alias("start"),
                F.when(F.col("decision") == "trim", F.col("end")).otherwise(F.lit(0)).alias("end"),
                "decision")
    )


def surviving_kmers(kmers: DataFrame, hits: DataFrame, decisions: DataFrame, k: int = 31) -> DataFrame:
    """The list without k-mers of filtered sequences or of trimmed-off ends."""
    # Hits of other k-mers take nothing from the list.
    gone = (
        hits.join(decisions.where("decision <> 'pass'"), "name")
        .where((F.col("decision") == "filter") | (F.col("pos") < F.col("start"))
               | (F.col("pos") >= F.col("len") - k + 1 - F.col("end")))
        .select("kmer")
    )
    return kmers.select("kmer").distinct().join(gone, "kmer", "left_anti")


def mark_runs(seqs: DataFrame, runs: DataFrame, hard: bool = False, longest: int = LONGEST) -> DataFrame:
    """Sequences in lower case (or ``n`` when ``hard``) except for the given runs.

    ``runs`` is ``name, start, end``, disjoint.  A sequence of at most ``longest`` bases meets its own runs and is shuffled
    once; longer ones, and those that share a name, go tile by tile.
    """
    short, rest = apart(seqs, ["name"], "seq", longest)
    own = runs.where("end > start").groupBy("name").agg(F.array_sort(F.collect_list(
        F.struct(F.col("start").cast("bigint").alias("s"), F.col("end").cast("bigint").alias("e")))).alias("_r"))

    def mark(text: str, own: list[dict]) -> str:
        parts, done = [], 0
        for run in own:
            s, e = max(run["s"], 0), run["e"]
            parts += ["n" * len(text[done:s]) if hard else text[done:s].lower(), text[s:e].upper()]
            done = e
        return "".join([*parts, "n" * len(text[done:]) if hard else text[done:].lower()])

    at, names = seqs.columns.index("seq"), seqs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t if t is None else mark(t, r or []) for t, r in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist())]
            columns = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names)
    marked = short.join(own.hint("merge"), "name", "left").select(*names, "_r").mapInArrow(run, seqs.schema)
    return marked if rest.isEmpty() else marked.unionByName(_marked_tiles(rest, runs, hard))


def _marked_tiles(seqs: DataFrame, runs: DataFrame, hard: bool) -> DataFrame:
    """``mark_runs`` tile by tile: a tile gathers only the runs that touch it."""
    from weftline.operators.tiling import STEP, joined_tiles, tile_index

    origin = F.col("tile").cast("bigint") * STEP
    touched = runs.where("end > start").withColumn("tile", F.explode(F.sequence(
        F.floor(F.col("start") / STEP).cast("int"), F.floor((F.col("end") - 1) / STEP).cast("int"))))
    own = touched.groupBy("name", "tile").agg(F.array_sort(F.collect_list(F.struct(
        F.greatest(F.col("start") - origin, F.lit(0)).cast("int").alias("s"),
        F.least(F.col("end") - origin, F.lit(STEP)).cast("int").alias("e")))).alias("_r"))

    def outside(text: Column) -> Column:
        return F.repeat(F.lit("n"), F.length(text)) if hard else F.lower(text)

    def part(start: Column, end: Column) -> Column:
        return F.substring("bases", start + 1, end - start)

    before = F.transform("_r", lambda r, i: F.concat(
        outside(part(F.coalesce(F.get(F.col("_r"), i - 1)["e"], F.lit(0)), r["s"])), F.upper(part(r["s"], r["e"]))))
    tail = outside(part(F.coalesce(F.element_at("_r", -1)["e"], F.lit(0)), F.length("bases")))
    marked = tile_index(seqs).join(own, ["name", "tile"], "left").select(
        "name", F.col("tile").alias("at"), F.concat(F.coalesce(F.array_join(before, ""), F.lit("")), tail).alias("bases"))
    whole = joined_tiles(marked).withColumnRenamed("seq", "_marked")
    return seqs.join(whole, "name", "left").withColumn("seq", F.coalesce("_marked", "seq")).drop("_marked").select(seqs.columns)


def _found_stretches(seqs: DataFrame, hits: DataFrame | None, kmers: DataFrame, k: int) -> DataFrame:
    """``name, start, end``: windows whose k-mer is listed, from ``hits`` or, without them, from the sequences."""
    from weftline.operators.superkmers import found_windows

    if hits is None:
        return found_windows(seqs, kmers, True, k=k)
    return found_kmers(hits, kmers).select("name", F.col("pos").alias("start"), (F.col("pos") + 1).alias("end"))


def mask_by_kmers(seqs: DataFrame, hits: DataFrame | None, kmers: DataFrame, k: int = 31,
                  gap: int = 31, hard: bool = False) -> DataFrame:
    """Keep stretches of listed k-mers (hits at most ``gap`` apart) upper case.

    Without ``hits`` the listed k-mers are found in the sequences, and no other window is a row.
    """
    from weftline.operators.intervals import merge_intervals

    found = _found_stretches(seqs, hits, kmers, k)
    runs = merge_intervals(found, ["name"], gap - 1).select("name", "start", (F.col("end") + k - 1).alias("end"))
    return mark_runs(seqs, merge_intervals(runs, ["name"], 0), hard)


def mark_last_bases(seqs: DataFrame, hits: DataFrame | None, kmers: DataFrame, k: int = 31) -> DataFrame:
    """Lower-case sequences with the last base of every listed k-mer upper case; ``hits`` as in ``mask_by_kmers``."""
    from weftline.operators.intervals import merge_intervals

    ends = _found_stretches(seqs, hits, kmers, k).select(
        "name", (F.col("start") + k - 1).alias("start"), (F.col("end") + k - 1).alias("end"))
    return mark_runs(seqs, merge_intervals(ends, ["name"], 0))
