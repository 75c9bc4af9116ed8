"""Interval operators over (key, start, end) rows; ends are exclusive.

Two devices keep every task bounded.  Ordered work uses the chunked scans of
``operators.scan``.  Best-of-overlap questions use dyadic blocks: an interval
is the union of at most two power-of-two blocks per level, each block keeps
only its best row (a map-side aggregate), and a point looks its ancestors up
by equality, so no list of overlapping pairs is ever produced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from weftline.operators.scan import fresh, ordinal, prefix_scan
from weftline.session import cut, ship

CHUNK = 1 << 16
FEW = 1 << 16
SWEPT = 1 << 18


def _chunk(column: str, width: int) -> Column:
    return F.floor(F.col(column) / width)


def island_starts(df: DataFrame, keys: Sequence[str], gap: int = 0, start: str = "start",
                  end: str = "end", width: int = CHUNK) -> DataFrame:
    """Distinct (keys, start, largest end) rows with the ``island`` they belong to.

    A row opens an island when it starts more than ``gap`` past every earlier
    end.  The island is named by its first start.
    """
    keys = list(keys)
    points = df.groupBy(*keys, start).agg(F.max(end).alias(end), F.count(F.lit(1)).alias("n"))
    reach = prefix_scan(points, keys, start, _chunk(start, width), F.col(end), "max",
                        "_reach", inclusive=False)
    opens = F.col("_reach").isNull() | (F.col(start) - F.col("_reach") > gap)
    return prefix_scan(reach, keys, start, _chunk(start, width),
                       F.when(opens, F.col(start)), "max", "island").drop("_reach")


def merge_intervals(df: DataFrame, keys: Sequence[str], gap: int = 0, start: str = "start",
                    end: str = "end", pad: int = 0, width: int = CHUNK) -> DataFrame:
    """Union of intervals no more than ``gap`` apart, with the number merged.

    ``pad`` widens each result on both sides, clamped at 0 on the left.
    """
    keys = list(keys)
    merged = island_starts(df, keys, gap, start, end, width).groupBy(*keys, "island").agg(
        F.max(end).alias("_end"), F.sum("n").alias("n"))
    left = F.greatest(F.col("island") - pad, F.lit(0)) if pad else F.col("island")
    return merged.select(*keys, left.alias(start), (F.col("_end") + pad).alias(end), "n")


def assign_islands(df: DataFrame, keys: Sequence[str], gap: int = 0, start: str = "start",
                   end: str = "end", width: int = CHUNK) -> DataFrame:
    """Every input row with the ``island`` (first start) it falls into."""
    keys = list(keys)
    names = island_starts(df, keys, gap, start, end, width).select(*keys, start, "island")
    return df.join(names, [*keys, start])


def uncovered_gaps(df: DataFrame, keys: Sequence[str], longer_than: int = 30,
                   start: str = "start", end: str = "end", width: int = CHUNK) -> DataFrame:
    """Stretches between covered intervals longer than ``longer_than``."""
    keys = list(keys)
    points = df.groupBy(*keys, start).agg(F.max(end).alias(end))
    reach = prefix_scan(points, keys, start, _chunk(start, width), F.col(end), "max",
                        "_reach", inclusive=False)
    return reach.where(F.col(start) - F.col("_reach") > longer_than).select(
        *keys, F.col("_reach").alias("gap_start"), F.col(start).alias("gap_end"))


def hotspots(df: DataFrame, cutoff: int, span: int = 1000,
             keys: Sequence[str] = ("target", "contig"), pos: str = "pos") -> DataFrame:
    """Dense runs of hits: ``cutoff`` hits back lies less than ``span`` away.

    A hit closer than ``span`` to a chunk's left edge is also given to that
    chunk as context, so the look-back is complete inside the chunk.
    """
    keys = list(keys)
    width = max(CHUNK, span)
    home = F.floor(F.col(pos) / width)
    near_edge = (home + 1) * width - F.col(pos) < span
    spread = df.select(*keys, pos).distinct().select(
        *keys, pos, home.alias("_home"),
        F.explode(F.when(near_edge, F.array(home, home + 1)).otherwise(F.array(home))).alias("_chunk"))
    along = Window.partitionBy(*keys, "_chunk").orderBy(pos)
    looked = spread.withColumn("_from", F.lag(pos, cutoff).over(along))
    close = looked.where(
        (F.col("_home") == F.col("_chunk")) & (F.col(pos) - F.col("_from") < span)
    ).select(*keys, F.col("_from").alias("start"), F.col(pos).alias("end"))
    return merge_intervals(close, keys, gap=span - 1, width=width)


def range_join(left: DataFrame, right: DataFrame, keys: Sequence[str], width: int,
               left_range: tuple[str, str] = ("start", "end"),
               right_range: tuple[str, str] = ("r_start", "r_end"),
               touch: bool = False, hot: int = 200_000) -> DataFrame:
    """All overlapping pairs, as an equi-join on (keys, bin).

    A pair is kept in the one bin where the later of the two starts.  Bins
    holding more than ``hot`` rows of a side are split over salts of that side and the other
    side's rows of just those bins are repeated, so one crowded place is many tasks.  With
    ``touch`` a left row ending where a right row starts also matches.
    """
    keys = list(keys)
    ls, le = left_range
    rs, re_ = right_range
    reach = 0 if touch else 1
    bin_, ours, other, n, many_l, many_r = fresh([*left.columns, *right.columns], "_bin", "_ours", "_other", "_n", "_many_l", "_many_r")
    at = [*keys, bin_]
    lb = left.where(F.col(le) + F.lit(1 - reach) > F.col(ls)).withColumn(bin_, F.explode(F.sequence(
        F.floor(F.col(ls) / width), F.floor((F.col(le) - reach) / width))))
    rb = right.where(F.col(re_) > F.col(rs)).withColumn(bin_, F.explode(F.sequence(
        F.floor(F.col(rs) / width), F.floor((F.col(re_) - 1) / width))))

    def parts(rows: DataFrame, out: str) -> DataFrame:
        return (rows.groupBy(*at).agg(F.count(F.lit(1)).alias(n)).where(F.col(n) > hot)
                .select(*at, F.ceil(F.col(n) / hot).cast("int").alias(out)))

    # Written, so that the planner knows how few crowded bins there are before it joins both sides with them.
    crowded = cut(parts(lb, many_l).join(parts(rb, many_r), at, "full_outer"))

    def dealt(rows: DataFrame, own: str, across: str, mine: str, theirs: str) -> DataFrame:
        """Each row at one part of its side, repeated over the parts of the other side."""
        stamp = F.xxhash64(*[F.col(c) for c in rows.columns])
        return (rows.withColumn(mine, stamp).join(crowded, at, "left")
                .withColumn(mine, F.pmod(F.col(mine), F.coalesce(own, F.lit(1))).cast("int"))
                .withColumn(theirs, F.explode(F.sequence(F.lit(0), F.coalesce(across, F.lit(1)) - 1))).drop(many_l, many_r))
    lb, rb = dealt(lb, many_l, many_r, ours, other), dealt(rb, many_r, many_l, other, ours)
    overlap = (F.col(ls) < F.col(re_)) & (
        (F.col(rs) <= F.col(le)) if touch else (F.col(rs) < F.col(le)))
    owner = F.col(bin_) == F.floor(F.greatest(F.col(ls), F.col(rs)) / width)
    return lb.join(rb, [*at, ours, other]).where(overlap & owner).drop(bin_, ours, other)


def overlaps_any(left: DataFrame, right: DataFrame, keys: Sequence[str],
                 left_range: tuple[str, str] = ("start", "end"),
                 right_range: tuple[str, str] = ("r_start", "r_end"),
                 touch: bool = False, width: int = CHUNK, out: str = "overlaps") -> DataFrame:
    """Left rows flagged by whether any right interval overlaps them.

    Among right intervals starting before the left end, the furthest end
    decides, so one scan along the coordinate answers every row.
    """
    keys = list(keys)
    ls, le = left_range
    rs, re_ = right_range
    stops = left.select(*keys, F.col(le).alias("_at")).distinct().withColumn("_far", F.lit(None).cast("bigint"))
    ranges = right.groupBy(*keys, F.col(rs).alias("_at")).agg(F.max(re_).cast("bigint").alias("_far"))
    axis = stops.unionByName(ranges).groupBy(*keys, "_at").agg(F.max("_far").alias("_far"))
    scanned = prefix_scan(axis, keys, "_at", _chunk("_at", width), F.col("_far"), "max",
                          "_reach", inclusive=touch).select(*keys, F.col("_at").alias(le), "_reach")
    met = (F.col("_reach") >= F.col(ls)) if touch else (F.col("_reach") > F.col(ls))
    if not touch:
        met = met & (F.col(le) > F.col(ls))
    return left.join(scanned, [*keys, le], "left").withColumn(
        out, F.coalesce(met, F.lit(False))).drop("_reach")


def _cover(start: str, end: str, levels: int) -> Column:
    """Dyadic blocks (level, block) that tile ``[start, end)``.

    Below the last level a range takes at most one block at either side; the last level
    takes all blocks that are left, so ranges of any length are tiled.
    """
    low = f"-shiftright(-{start}, l)"
    high = f"shiftright({end}, l)"
    top_low, top_high = low.replace(", l)", f", {levels})"), high.replace(", l)", f", {levels})")
    return F.expr(
        f"concat(filter(flatten(transform(sequence(0, {levels - 1}), l -> array("
        f"struct(l AS level, CASE WHEN {low} < {high} AND ({low}) % 2 <> 0 THEN {low} END AS block),"
        f"struct(l AS level, CASE WHEN {low} < {high} AND ({high}) % 2 <> 0 THEN {high} - 1 END AS block)"
        f"))), b -> b.block IS NOT NULL),"
        f"CASE WHEN {top_low} < {top_high} THEN transform(sequence({top_low}, {top_high} - 1),"
        f" b -> struct({levels} AS level, b AS block)) ELSE array() END)")


def _levels_for(*ranges: tuple[DataFrame, str, str]) -> int:
    """Block levels that the longest of these ranges needs (one narrow aggregate); any number gives the same result."""
    longest = [df.agg(F.max(F.col(end) - F.col(start))).first()[0] or 1 for df, start, end in ranges]
    return max(1, int(max(longest)).bit_length())


def _ancestors(point: str, levels: int) -> Column:
    return F.expr(f"transform(sequence(0, {levels}), l -> struct(l AS level, shiftright({point}, l) AS block))")


def _blocks(df: DataFrame, keys: Sequence[str], blocks: Column, value: str) -> DataFrame:
    return (df.select(*keys, F.col(value).alias("_v"), F.explode(blocks).alias("_b"))
            .groupBy(*keys, F.col("_b.level").alias("_level"), F.col("_b.block").alias("_block"))
            .agg(F.min("_v").alias("_v")))


def _lookup(points: DataFrame, ids: Sequence[str], keys: Sequence[str], blocks: Column,
            tree: DataFrame) -> DataFrame:
    asked = points.select(*dict.fromkeys([*ids, *keys]), F.explode(blocks).alias("_b")).select(
        *dict.fromkeys([*ids, *keys]), F.col("_b.level").alias("_level"), F.col("_b.block").alias("_block"))
    return asked.join(tree, [*keys, "_level", "_block"]).select(*ids, "_v")


def stab_best(points: DataFrame, ranges: DataFrame, keys: Sequence[str], point: str,
              value: str, start: str = "start", end: str = "end",
              levels: int | None = None, out: str = "best") -> DataFrame:
    """Smallest ``value`` among the ranges covering each (keys, point)."""
    keys = list(keys)
    levels = min(levels or 64, _levels_for((ranges, start, end)))
    tree = _blocks(ranges, keys, _cover(start, end, levels), value)
    found = _lookup(points, [*keys, point], keys, _ancestors(point, levels), tree)
    return found.groupBy(*keys, point).agg(F.min("_v").alias(out))


def first_overlap(left: DataFrame, right: DataFrame, keys: Sequence[str], id_col: str,
                  value: str, left_range: tuple[str, str] = ("start", "end"),
                  right_range: tuple[str, str] = ("r_start", "r_end"),
                  levels: int | None = None, out: str = "match") -> DataFrame:
    """Smallest ``value`` among right intervals overlapping each left row, or NULL.

    An overlapping range either covers the left start or begins inside it; both
    cases are block lookups.
    """
    keys = list(keys)
    ls, le = left_range
    rs, re_ = right_range
    solid = right.where(F.col(re_) > F.col(rs))
    spans = left.where(F.col(le) > F.col(ls)).select(
        id_col, *keys, F.col(ls).alias("_s"), (F.col(ls) + 1).alias("_s1"), F.col(le).alias("_e"))
    levels = min(levels or 64, _levels_for((solid, rs, re_), (spans, "_s", "_e")))
    covering = _blocks(solid, keys, _cover(rs, re_, levels), value)
    begins = _blocks(solid, keys, _ancestors(rs, levels), value)
    found = _lookup(spans, [id_col], keys, _ancestors("_s", levels), covering).unionByName(
        _lookup(spans, [id_col], keys, _cover("_s1", "_e", levels), begins))
    best = found.groupBy(id_col).agg(F.min("_v").alias(out))
    return left.join(best, id_col, "left")


def best_score_envelope(df: DataFrame, keys: Sequence[str], id_col: str, score: str = "score",
                        start: str = "start", end: str = "end", longer_than: int = 50,
                        levels: int | None = None, width: int = CHUNK, few: int = FEW) -> DataFrame:
    """Which alignment scores best along each key: ``keys, id, start, end``.

    Ties go to the earlier start, then the smaller id.  Neighbouring stretches
    of one alignment join; stretches of ``longer_than`` or less are left out.
    The rows of a key with at most ``few`` meet in one shuffle; the others go by blocks and scans.
    """
    keys = list(keys)
    solid = df.where(F.col(end) > F.col(start)).select(*keys, id_col, start, end, F.struct(
        (-F.col(score)).alias("a"), F.col(start).alias("b"), F.col(id_col).alias("c")).alias("_rank"))
    plain = (T.IntegralType, T.StringType)
    if not (all(isinstance(solid.schema[c].dataType, plain) for c in (*keys, id_col))
            and all(isinstance(solid.schema[c].dataType, T.IntegralType) for c in (start, end))):
        return _scanned_envelope(solid, keys, id_col, start, end, longer_than, levels, width)
    for c in keys:
        solid = solid.where(F.col(c).isNotNull())
    crowded = cut(solid.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.max(F.col(id_col).isNull()).alias("_null"))
                  .where((F.col("_n") > few) | F.col("_null")).select(*keys))
    if crowded.isEmpty():
        return _swept_envelope(solid, keys, id_col, start, end, longer_than)
    return _swept_envelope(solid.join(crowded, keys, "left_anti"), keys, id_col, start, end, longer_than).unionByName(
        _scanned_envelope(solid.join(crowded, keys, "left_semi"), keys, id_col, start, end, longer_than, levels, width))


def _owners(lo: np.ndarray, hi: np.ndarray, size: int) -> np.ndarray:
    """The first of the ranges ``lo`` to ``hi`` over each of ``size`` places, or their number where there is none.

    A range is two overlapping blocks of a power of two; blocks are handed down halves.
    """
    level = np.frexp((hi - lo).astype(np.float64))[1] - 1
    best = np.full(size, len(lo))
    for at in range(int(level.max(initial=0)), -1, -1):
        mine = np.flatnonzero(level == at)
        if at < level.max(initial=0):
            halves = best.copy()
            halves[1 << at:] = np.minimum(halves[1 << at:], best[:size - (1 << at)])
            best = halves
        np.minimum.at(best, lo[mine], mine)
        np.minimum.at(best, hi[mine] - (1 << at), mine)
    return best


def _swept_envelope(solid: DataFrame, keys: list[str], id_col: str, start: str, end: str, longer_than: int) -> DataFrame:
    """The envelope of keys of few rows: each lies whole in a task, its rows ranked by Spark's sort."""
    ship(solid.sparkSession)
    kind = solid.select(F.array(start, end).alias("a")).schema["a"].dataType.elementType
    ranked = solid.repartition(*keys).sortWithinPartitions(*keys, "_rank").select(
        *keys, id_col, F.col(start).cast("bigint").alias(start), F.col(end).cast("bigint").alias(end))

    def codes(table: pa.Table, name: str) -> np.ndarray:
        return table.column(name).combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)

    def opens(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        new[:1] = True
        for c in keys:
            own = codes(table, c)
            new[1:] |= own[1:] != own[:-1]
        return new

    def solved(table: pa.Table) -> pa.RecordBatch:
        group = np.cumsum(opens(table)) - 1
        s, e = (table.column(c).to_numpy() for c in (start, end))
        both, at = np.concatenate((group, group)), np.concatenate((s, e))
        order = np.lexsort((at, both))
        new = np.concatenate(([True], (at[order][1:] != at[order][:-1]) | (both[order][1:] != both[order][:-1])))
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(new) - 1
        points = at[order][new]
        owner = _owners(place[:len(s)], place[len(s):], len(points))
        held = owner < len(s)
        name = np.where(held, np.append(codes(table, id_col), -1)[owner], -1)
        first = np.flatnonzero(held & np.concatenate(([True], name[1:] != name[:-1])))
        last = np.flatnonzero(held & np.concatenate((name[1:] != name[:-1], [True])))
        long = points[last + 1] - points[first] > longer_than
        first, last = first[long], last[long]
        rows = pa.array(owner[first])
        columns = [table.column(c).combine_chunks().take(rows) for c in (*keys, id_col)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(points[first]), pa.array(points[last + 1])], [*keys, id_col, start, end])

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= SWEPT:
                table = pa.Table.from_batches(held)
                whole = int(np.flatnonzero(opens(table))[-1])
                if whole:
                    yield solved(table.slice(0, whole))
                    held = table.slice(whole).to_batches()
        if held and sum(b.num_rows for b in held):
            yield solved(pa.Table.from_batches(held))
    return ranked.mapInArrow(sweep, ranked.schema).select(
        *keys, id_col, F.col(start).cast(kind).alias(start), F.col(end).cast(kind).alias(end))


def _scanned_envelope(solid: DataFrame, keys: list[str], id_col: str, start: str, end: str, longer_than: int,
                      levels: int | None, width: int) -> DataFrame:
    edges = solid.select(*keys, F.explode(F.array(start, end)).alias("_at")).distinct()
    segments = prefix_scan(edges, keys, "_at", _chunk("_at", width), F.col("_at"), "min",
                           "_next", inclusive=False, descending=True).where("_next IS NOT NULL")
    segments = cut(segments)
    best = stab_best(segments, solid, keys, "_at", "_rank", start, end, levels)
    owned = segments.join(best, [*keys, "_at"]).select(*keys, "_at", "_next", F.col("best.c").alias("_id"))
    prior = prefix_scan(owned, keys, "_at", _chunk("_at", width),
                        F.struct("_at", "_next", "_id"), "max", "_prior", inclusive=False)
    opens = (F.col("_prior").isNull() | (F.col("_prior._id") != F.col("_id"))
             | (F.col("_prior._next") != F.col("_at")))
    runs = prefix_scan(prior, keys, "_at", _chunk("_at", width), F.when(opens, F.col("_at")), "max", "_run")
    return (runs.groupBy(*keys, F.col("_id").alias(id_col), "_run").agg(F.max("_next").alias(end))
            .select(*keys, id_col, F.col("_run").alias(start), end)
            .where(F.col(end) - F.col(start) > longer_than))


def interval_hull(df: DataFrame, id_col: str, group: Sequence[str], order: str,
                  start: str = "start", end: str = "end") -> DataFrame:
    """Hull per (id, group); a second group under one id becomes ``id002`` and so on."""
    hull = df.groupBy(id_col, *group).agg(
        F.min(start).alias(start), F.max(end).alias(end), F.min(order).alias("_first"))
    numbered = ordinal(hull, ["_first"], "_rank", [id_col])
    name = F.when(F.col("_rank") == 1, F.col(id_col).cast("string")).otherwise(
        F.concat(F.col(id_col).cast("string"), F.lit("00"), F.col("_rank").cast("string")))
    return numbered.select(name.alias("name"), id_col, *group, start, end)


def cluster_loci(df: DataFrame, contig: str, haplo: str, dist: str, name: str,
                 start: str = "start", end: str = "end", width: int = CHUNK) -> DataFrame:
    """Locus (overlap island) of each row and its 0-based rank per haplotype by distance."""
    placed = assign_islands(df, [contig], -1, start, end, width)
    return ordinal(placed, [dist, name], "rank", [contig, "island", haplo], start=0)


def break_chunks(points: DataFrame, keys: Sequence[str], at: str = "at", gap: int = 500,
                 width: int = CHUNK) -> DataFrame:
    """Cluster break positions closer than ``gap``, take each cluster's mode and
    return the chunks between neighbouring modes."""
    keys = list(keys)
    weighted = points.groupBy(*keys, at).agg(F.count(F.lit(1)).alias("_w"))
    placed = assign_islands(weighted.withColumn("_stop", F.col(at)), keys, gap - 1, at, "_stop", width)
    best = F.max(F.struct(F.col("_w"), (-F.col(at)).alias("_neg")))
    modes = placed.groupBy(*keys, "island").agg(best.alias("_b")).select(
        *keys, (-F.col("_b._neg")).alias("chunk_start"))
    following = prefix_scan(modes, keys, "chunk_start", _chunk("chunk_start", width),
                            F.col("chunk_start"), "min", "chunk_end", inclusive=False, descending=True)
    return following.where("chunk_end IS NOT NULL")


def label_clusters(df: DataFrame, keys: Sequence[str], label: str, id_col: str,
                   gap: int = 10000, start: str = "start", end: str = "end",
                   width: int = CHUNK) -> DataFrame:
    """Islands more than ``gap`` apart are separate clusters only if the label
    also changes between the last interval of one and the first of the next."""
    keys = list(keys)
    placed = assign_islands(df, keys, 0, start, end, width)
    first = F.min(F.struct(start, id_col, F.col(label).alias("_l")))
    last = F.max(F.struct(end, id_col, F.col(label).alias("_l")))
    islands = placed.groupBy(*keys, "island").agg(
        first.alias("_f"), last.alias("_t"), F.count(F.lit(1)).alias("n"))
    prior = prefix_scan(islands, keys, "island", _chunk("island", width),
                        F.struct("island", F.col(f"_t.{end}").alias("_e"), F.col("_t._l").alias("_l")),
                        "max", "_prior", inclusive=False)
    opens = F.col("_prior").isNull() | (
        (F.col("island") - F.col("_prior._e") > gap) & (F.col("_prior._l") != F.col("_f._l")))
    runs = prefix_scan(prior, keys, "island", _chunk("island", width),
                       F.when(opens, F.col("island")), "max", "cluster")
    return runs.groupBy(*keys, F.col("cluster").alias(start)).agg(
        F.max(F.col(f"_t.{end}")).alias(end), F.sum("n").alias("n"))


def clamp_neighbours(df: DataFrame, keys: Sequence[str], anchor: int, start: str = "start",
                     end: str = "end", width: int = CHUNK) -> DataFrame:
    """Widen short loci to five anchors, then cut overlapping neighbours at the
    midpoint without entering either original locus."""
    keys = list(keys)
    loci = df.groupBy(*keys, start).agg(F.max(end).alias(end))
    lack = F.greatest(F.lit(5 * anchor) - (F.col(end) - F.col(start)), F.lit(0))
    half = F.floor(lack / 2)
    wide = loci.withColumn("_ws", F.when(lack > 0, F.greatest(F.col(start) - half, F.lit(0))).otherwise(F.col(start))
                           ).withColumn("_we", F.col(end) + half)
    row = F.struct(start, end, "_ws", "_we")
    before = prefix_scan(wide, keys, start, _chunk(start, width), row, "max", "_p", inclusive=False)
    both = prefix_scan(before, keys, start, _chunk(start, width), row, "min", "_q",
                       inclusive=False, descending=True)

    def cut_at(prev_end: Column, prev_wide: Column, cur_start: Column, cur_wide: Column) -> Column:
        middle = F.floor((cur_wide + prev_wide) / 2)
        return F.least(F.greatest(middle, prev_end), cur_start)

    left = F.when(F.col("_ws") < F.col("_p._we"),
                  cut_at(F.col(f"_p.{end}"), F.col("_p._we"), F.col(start), F.col("_ws"))).otherwise(F.col("_ws"))
    right = F.when(F.col("_q._ws") < F.col("_we"),
                   cut_at(F.col(end), F.col("_we"), F.col(f"_q.{start}"), F.col("_q._ws"))).otherwise(F.col("_we"))
    return both.select(*keys, start, end, left.alias("new_start"), right.alias("new_end"))


def split_overmerged(exons: DataFrame, keys: Sequence[str], gap: int = 10000,
                     start: str = "start", end: str = "end", width: int = CHUNK) -> DataFrame:
    """Cut regions at the midpoint of every stretch longer than ``gap`` without exons.

    Returns one row per part: its exon hull and the cut positions on each side
    (NULL at the outer ends).
    """
    keys = list(keys)
    parts = merge_intervals(exons, keys, gap, start, end, width=width)
    row = F.struct(start, end)
    before = prefix_scan(parts, keys, start, _chunk(start, width), row, "max", "_p", inclusive=False)
    both = prefix_scan(before, keys, start, _chunk(start, width), row, "min", "_q",
                       inclusive=False, descending=True)
    return both.select(*keys, start, end, "n",
                       F.floor((F.col(f"_p.{end}") + F.col(start)) / 2).alias("cut_left"),
                       F.floor((F.col(end) + F.col(f"_q.{start}")) / 2).alias("cut_right"))


def strand_majority(df: DataFrame, keys: Sequence[str], length: Column, strand: str = "strand") -> DataFrame:
    """``+`` unless the summed length on ``-`` is larger."""
    signed = F.sum(F.when(F.col(strand) == "+", length).otherwise(-length))
    return df.groupBy(*keys).agg(F.when(signed >= 0, "+").otherwise("-").alias("strand"))


def edge_filter(loci: DataFrame, sizes: DataFrame, errors: DataFrame, cutoff: int = 20000,
                missing_size: int = 1_000_000_000, contig: str = "contig") -> DataFrame:
    """Keep loci far enough from contig ends and outside error regions.

    Needs ``is_main`` (a main reference row, which also sets how close to an
    edge the locus may lie) and ``is_ref`` (no distance asked).
    """
    placed = loci.join(sizes.select(contig, F.col("length").alias("_size")), contig, "left")
    edge = F.least(F.col("start"), F.coalesce("_size", F.lit(missing_size)) - F.col("end"))
    placed = placed.withColumn("edge", edge)
    nearest = placed.agg(F.coalesce(F.min(F.when(F.col("is_main"), F.col("edge"))),
                                    F.lit(missing_size)).alias("_min_edge"))
    flagged = overlaps_any(placed, errors.select(contig, F.col("start").alias("r_start"), F.col("end").alias("r_end")),
                           [contig], touch=True, out="in_error")
    need = F.least(F.when(F.col("is_ref"), F.lit(0)).otherwise(F.lit(cutoff)).cast("double"),
                   F.col("_min_edge") / 2)
    # ``nearest`` is a single aggregate row.
    return (flagged.join(F.broadcast(nearest)).where((F.col("edge") >= need) & ~F.col("in_error"))
            .drop("_size", "_min_edge", "in_error"))

