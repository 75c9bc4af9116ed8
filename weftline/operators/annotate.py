"""Allele and type summaries: many-way joins and roll-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from weftline.operators.intervals import range_join
from weftline.operators.scan import mode_first_seen, ordinal
from weftline.session import cut

# Members of the largest squares that ``largest_within`` compares first.
OUTER = 64

def last_written(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the one latest along ``order``."""
    rest = [c for c in df.columns if c not in (key, order)]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(key, "_r.*")


def summarise_alleles(alleles: DataFrame, parts: Sequence[tuple[DataFrame, dict[str, object]]],
                      key: str = "name") -> DataFrame:
    """Left-join one-row-per-allele tables, filling given defaults."""
    out = alleles
    for part, defaults in parts:
        out = out.join(part, key, "left").fillna(defaults)
    return out


def two_hop(links: DataFrame, key: str = "name", to: str = "ref", value: str = "locus") -> DataFrame:
    """Follow ``key -> to`` twice; ``final`` is the second stop, or the first when
    that one leads nowhere, with the value found there."""
    one = links.select(F.col(key).alias(to), F.col(to).alias("_next"), F.col(value).alias("_v1"))
    two = links.select(F.col(key).alias("_next"), F.col(value).alias("_v2"))
    return links.join(one, to, "left").join(two, "_next", "left").select(
        key, to, F.coalesce("_next", to).alias("final"), F.coalesce("_v2", "_v1").alias("final_value"))


def positional_join(left: DataFrame, right: DataFrame, left_order: Sequence[str],
                    right_order: Sequence[str]) -> DataFrame:
    """Row n of one table beside row n of the other."""
    return ordinal(left, left_order).join(ordinal(right, right_order), "ordinal", "full_outer")


def sorted_names(df: DataFrame, key: str, name: str, out: str = "names", sep: str = ";") -> DataFrame:
    """All names per key, repeats kept, sorted and joined.

    Names are counted before they are gathered, so what reaches one task is one
    entry per distinct name and not one per row.
    """
    counted = df.groupBy(key, name).agg(F.count(F.lit(1)).cast("int").alias("_n"))
    runs = F.array_sort(F.collect_list(F.struct(F.col(name).alias("v"), F.col("_n").alias("n"))))
    text = F.array_join(F.flatten(F.transform(runs, lambda r: F.array_repeat(r["v"], r["n"]))), sep)
    return counted.groupBy(key).agg(text.alias(out))


def counted_names(df: DataFrame, key: str, name: str, order: str, out: str = "names",
                  sep: str = ";") -> DataFrame:
    """``name:count`` by falling count, first seen first on ties."""
    counted = df.groupBy(key, name).agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("_o"))
    runs = F.array_sort(F.collect_list(F.struct(
        (-F.col("_n")).alias("n"), F.col("_o").alias("o"), F.col(name).cast("string").alias("v"))))
    text = F.array_join(F.transform(runs, lambda r: F.concat(r["v"], F.lit(":"), (-r["n"]).cast("string"))), sep)
    return counted.groupBy(key).agg(text.alias(out))


def exon_class(value: Column) -> Column:
    """Exon if any member is, else Decoy if any, else Intron."""
    rank = F.max(F.when(value == "Exon", 2).when(value == "Decoy", 1).otherwise(0))
    return F.when(rank == 2, "Exon").when(rank == 1, "Decoy").otherwise("Intron")


def type_rollup(members: DataFrame, key: str = "type", order: str = "ord") -> DataFrame:
    """One row per type from ``tag, gene, ref, exon, kmers, note`` of its members.

    Texts take their most frequent value (first seen on ties), tags are listed by
    falling count, and k-mer support is the smallest.
    """
    base = members.groupBy(key).agg(
        exon_class(F.col("exon")).alias("exon"), F.min("kmers").alias("kmers"),
        F.count(F.lit(1)).alias("size"))
    for field in ("gene", "ref", "note"):
        base = base.join(mode_first_seen(members, [key], field, order, field).drop("n"), key)
    counted = members.groupBy(key, "tag").agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("_o"))
    runs = F.array_sort(F.collect_list(F.struct((-F.col("_n")).alias("n"), F.col("_o").alias("o"), "tag")))
    tags = counted.groupBy(key).agg(F.array_join(F.transform(runs, lambda r: r["tag"]), ";").alias("tags"))
    return base.join(tags, key)


def annotate_types(members: DataFrame, key: str = "type", order: str = "ord") -> DataFrame:
    """Tag ``Ref`` if any member is a reference, otherwise the commonest tag."""
    tags = mode_first_seen(members, [key], "tag", order, "common").drop("n")
    flags = members.groupBy(key).agg(F.max((F.col("tag") == "Ref").cast("int")).alias("_ref"),
                                     F.max((F.col("exon") == "Exon").cast("int")).alias("_exon"))
    return flags.join(tags, key).select(
        key, F.when(F.col("_ref") == 1, "Ref").otherwise(F.col("common")).alias("tag"),
        F.when(F.col("_exon") == 1, "Exon").otherwise("Intron").alias("exon"))


def without_shadowed(names: Column) -> Column:
    """Drop ``X-…`` names when ``X`` itself is listed."""
    return F.filter(names, lambda g: ~(g.contains("-") & F.array_contains(names, F.substring_index(g, "-", 1))))


def unshadowed(df: DataFrame, key: str, name: str) -> DataFrame:
    """Distinct ``key, name`` without the ``X-…`` names of keys that list ``X`` itself."""
    names = df.select(key, name).distinct()
    stems = names.select(key, F.col(name).alias("_stem"))
    marked = names.withColumn("_stem", F.when(F.col(name).contains("-"), F.substring_index(name, "-", 1)))
    return marked.join(stems, [key, "_stem"], "left_anti").select(key, name)


def top_names(df: DataFrame, key: str, name: str, prefix: str, limit: int = 3) -> DataFrame:
    """The first ``limit`` distinct names, those holding the prefix first.

    A report of the best three is the feature, so the limit is on the output; ranked
    rows beyond it are dropped before they are shuffled.
    """
    flagged = df.select(key, name, (~F.col(name).contains(F.col(prefix))).cast("int").alias("_late")).distinct()
    ranked = flagged.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy("_late", name))).where(
        F.col("_rank") <= limit)
    runs = F.array_sort(F.collect_list(F.struct(F.col("_rank").alias("r"), F.col(name).alias("v"))))
    return ranked.groupBy(key).agg(F.array_join(F.transform(runs, lambda r: r["v"]), "OOO").alias("tag"))


def partition_names(regions: DataFrame, genes: DataFrame, key: str, width: int = 1 << 14, limit: int = 3) -> DataFrame:
    """``key, tag``: names of the genes that a partition's regions overlap, those with its ``prefix`` first.

    ``regions`` is ``key, prefix, contig, start, end``, ``genes`` is ``contig, start, end, gene``.
    """
    placed = genes.select("contig", F.col("start").alias("r_start"), F.col("end").alias("r_end"), "gene")
    return top_names(range_join(regions, placed, ["contig"], width), key, "gene", "prefix", limit)


def signature_mode(svs: DataFrame, key: str, member: str, kind: str, size: str, order: str) -> DataFrame:
    """Commonest multiset of variant kinds per type and the mode of each size.

    A member's kinds are sorted, with sizes, into one signature; the types take
    the most frequent signature (first seen on ties) and, position by position,
    the most frequent size (smallest on ties).
    """
    one = svs.groupBy(key, member).agg(
        F.array_sort(F.collect_list(F.struct(F.col(kind).alias("k"), F.col(size).alias("s")))).alias("_v"),
        F.min(order).alias("_o")).withColumn("_sig", F.array_join(F.transform("_v", lambda v: v["k"]), ";"))
    best = mode_first_seen(one, [key], "_sig", "_o", "_sig").select(key, "_sig")
    held = one.join(best, [key, "_sig"]).select(key, "_sig", F.posexplode("_v").alias("_p", "_x"))
    sized = held.groupBy(key, "_sig", "_p", "_x.k", "_x.s").agg(F.count(F.lit(1)).alias("_n"))
    modes = sized.groupBy(key, "_p", "k").agg(F.min_by("s", F.struct((-F.col("_n")).alias("n"), "s")).alias("s"))
    runs = F.array_sort(F.collect_list(F.struct("_p", "k", "s")))
    text = F.transform(runs, lambda r: F.concat(r["k"], F.lit("("), r["s"].cast("string"), F.lit(")")))
    return modes.groupBy(key).agg(F.array_join(text, ";").alias("signature"))


def within_between(distances: DataFrame, labels: DataFrame, name: str = "name", group: str = "grp") -> DataFrame:
    """Mean and smallest distance inside each group and towards other groups.

    ``distances`` is ``i, j, d`` with each unordered pair once.
    """
    tagged = (distances.join(labels.select(F.col(name).alias("i"), F.col(group).alias("_a")), "i")
              .join(labels.select(F.col(name).alias("j"), F.col(group).alias("_b")), "j"))
    inside = tagged.where("_a = _b").groupBy(F.col("_a").alias(group)).agg(
        F.avg("d").alias("within_mean"), F.min("d").alias("within_min"))
    crossing = tagged.where("_a <> _b").select(F.explode(F.array("_a", "_b")).alias(group), "d")
    outside = crossing.groupBy(group).agg(F.avg("d").alias("between_mean"), F.min("d").alias("between_min"))
    return inside.join(outside, group, "full_outer")


def _farthest(members: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """``key, _exact``: the largest squared distance of two of the members (``key, _m, _own``)."""
    edge_rows = rows.join(members.select(key, "_m"), [key, "_m"], "left_semi")
    i, j = (edge_rows.select(key, "_a", F.col("_m").alias(n), F.col("_v").alias(w)) for n, w in (("_i", "_x"), ("_j", "_y")))
    dots = i.join(j, [key, "_a"]).where("_i < _j").groupBy(key, "_i", "_j").agg(F.sum(F.col("_x") * F.col("_y")).alias("_dot"))
    pairs = members.select(key, F.col("_m").alias("_i"), F.col("_own").alias("_oi")).join(
        members.select(key, F.col("_m").alias("_j"), F.col("_own").alias("_oj")), key).where("_i < _j")
    return pairs.join(dots, [key, "_i", "_j"], "left").groupBy(key).agg(
        F.max(F.col("_oi") + F.col("_oj") - 2 * F.coalesce("_dot", F.lit(0.0))).alias("_exact"))


def largest_within(vectors: DataFrame, key: str, member: str, axis: str, value: str,
                   floor: float = 300.0) -> DataFrame:
    """Largest squared distance between two member rows of each type, at least ``floor``.

    Rows are sparse (``key, member, axis, value``).  Equal rows are folded.  The
    distance r to the centre of the type is linear to compute, and so is the
    largest distance found from the outermost member, a lower bound B.  A pair
    further apart than B needs r_i + r_j > B, so only members with
    r > B - max(r) are compared with each other.  Nor can it be further apart than its squares tell, so a
    member whose square and the largest one stay below B is left out as well.
    """
    v = F.col(value).cast("double")
    rows = vectors.select(key, F.col(member).alias("_m"), F.col(axis).alias("_a"), v.alias("_v")).where("_v <> 0")
    shape = rows.groupBy(key, "_m").agg(
        F.sum(F.col("_v") * F.col("_v")).alias("_own"), F.bit_xor(F.xxhash64("_a", "_v")).alias("_h"),
        F.count(F.lit(1)).alias("_n"))
    reps = cut(shape.groupBy(key, "_own", "_h", "_n").agg(F.min("_m").alias("_m")).select(key, "_m", "_own"))
    rows = cut(rows.join(reps.select(key, "_m"), [key, "_m"], "left_semi"))
    size = reps.groupBy(key).agg(F.count(F.lit(1)).alias("_size"))
    centre = rows.groupBy(key, "_a").agg(F.sum("_v").alias("_s")).join(size, key).select(
        key, "_a", (F.col("_s") / F.col("_size")).alias("_c"))
    norm = centre.groupBy(key).agg(F.sum(F.col("_c") * F.col("_c")).alias("_cc"))
    to_centre = rows.join(centre, [key, "_a"]).groupBy(key, "_m").agg(F.sum(F.col("_v") * F.col("_c")).alias("_xc"))
    radius = cut(reps.join(to_centre, [key, "_m"]).join(norm, key).select(
        key, "_m", "_own", F.sqrt(F.greatest(F.col("_own") - 2 * F.col("_xc") + F.col("_cc"), F.lit(0.0))).alias("_r")))
    outer = radius.groupBy(key).agg(F.max_by(F.struct("_m", "_own"), F.struct("_r", "_m")).alias("_q"),
                                    F.max("_r").alias("_rmax"))
    probe = outer.select(key, F.col("_q._m").alias("_m")).join(rows, [key, "_m"]).select(key, "_a", F.col("_v").alias("_w"))
    seen = rows.join(probe, [key, "_a"]).groupBy(key, "_m").agg(F.sum(F.col("_v") * F.col("_w")).alias("_d"))
    bound = (radius.join(seen, [key, "_m"], "left").join(outer, key)
             .withColumn("_far", F.when(F.col("_m") == F.col("_q._m"), F.lit(0.0)).otherwise(
                 F.col("_own") + F.col("_q._own") - 2 * F.coalesce("_d", F.lit(0.0))))
             .groupBy(key).agg(F.max("_far").alias("_bound"), F.max("_rmax").alias("_rmax")))
    # Members with the largest squares are far apart if they have little in common: a better lower bound.
    salt = F.pmod(F.xxhash64("_m"), F.lit(OUTER))
    longest = [F.desc("_own"), "_m"]
    few = radius.withColumn("_s", salt).withColumn("_k", F.row_number().over(Window.partitionBy(key, "_s").orderBy(*longest))).where(F.col("_k") <= OUTER)
    top = cut(few.withColumn("_k", F.row_number().over(Window.partitionBy(key).orderBy(*longest))).where(F.col("_k") <= OUTER).select(key, "_m", "_own"))
    signs = rows.groupBy(key).agg(F.min("_v").alias("_least"))
    better = bound.join(_farthest(top, rows, key), key, "left").join(top.groupBy(key).agg(F.max("_own").alias("_most")), key).join(signs, key).select(
        key, F.greatest("_bound", F.coalesce("_exact", F.lit(0.0))).alias("_bound"), "_rmax", "_most", "_least")
    # Without negative values two rows are at most the sum of their squares apart.
    reach = F.when(F.col("_least") >= 0, F.col("_own") + F.col("_most")).otherwise(
        F.col("_own") + F.col("_most") + 2 * F.sqrt(F.col("_own") * F.col("_most")))
    rim = cut(radius.join(better, key).where(
        (F.col("_r") >= F.sqrt(F.greatest("_bound", F.lit(0.0))) - F.col("_rmax") - 1e-9)
        & (reach >= F.col("_bound") * (1 - 1e-12) - 1e-9)).select(key, "_m", "_own"))
    exact = _farthest(rim, rows, key)
    return size.select(key).join(exact, key, "left").select(
        key, F.greatest(F.coalesce("_exact", F.lit(floor)), F.lit(floor)).alias("largest"))
