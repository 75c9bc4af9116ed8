"""Operators on alignment rows: slicing, expansion, polishing, filtering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from weftline.functions import cigar as C
from weftline.operators.intervals import merge_intervals, range_join
from weftline.session import cut


def explode_ops(df: DataFrame, id_col: str, cigar: str = "cigar", *carry: str) -> DataFrame:
    """One row per operation with the query and reference offsets before it.

    The window spans the operations of one alignment, which one row held before.
    """
    ops = df.select(id_col, *carry, F.posexplode(C.parse(F.col(cigar))).alias("idx", "_op")).select(
        id_col, *carry, "idx", "_op.*")
    step_q = F.when(F.col("op").isin(*C.QUERY_OPS), F.col("len")).otherwise(0)
    step_r = F.when(F.col("op").isin(*C.REF_OPS), F.col("len")).otherwise(0)
    before = Window.partitionBy(id_col).orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
    return (ops.withColumn("_q", step_q).withColumn("_r", step_r)
            .withColumn("q", F.coalesce(F.sum("_q").over(before), F.lit(0)))
            .withColumn("r", F.coalesce(F.sum("_r").over(before), F.lit(0)))
            .withColumn("q_end", F.col("q") + F.col("_q")).withColumn("r_end", F.col("r") + F.col("_r"))
            .drop("_q", "_r"))


def slice_by_query(df: DataFrame, id_col: str, qstart: str = "qstart", qend: str = "qend",
                   cigar: str = "cigar") -> DataFrame:
    """Part of each alignment between two query offsets: ``id, rstart, rend, cigar``.

    A boundary inside an operation cuts it.  ``rend`` is -1 when the alignment
    stops short of ``qend``.
    """
    s, e = F.col(qstart), F.col(qend)
    ops = explode_ops(df, id_col, cigar, qstart, qend).where((F.col("q_end") > s) & (F.col("q") < e))
    both = F.col("op").isin("M", "=", "X", "S")
    piece = F.when(F.col("q_end") == F.col("q"), F.col("len").cast("bigint")).otherwise(
        F.least("q_end", e) - F.greatest("q", s))
    first = F.when(F.col("q") <= s, F.when(both, F.col("r") + s - F.col("q")).otherwise(F.col("r_end")))
    last = F.when(F.col("q_end") >= e, F.when(both, F.col("r_end") - (F.col("q_end") - e)).otherwise(F.col("r_end")))
    text = F.struct("idx", F.concat(piece.cast("string"), F.col("op")).alias("t"))
    return ops.groupBy(id_col).agg(
        F.coalesce(F.min(first), F.lit(-1)).cast("bigint").alias("rstart"),
        F.coalesce(F.max(last), F.lit(-1)).cast("bigint").alias("rend"),
        F.array_join(F.transform(F.array_sort(F.collect_list(text)), lambda t: t["t"]), "").alias("cigar"))


def polish_ends(df: DataFrame, id_col: str, more_than: int = 200, cigar: str = "cigar",
                insert_divisor: int = 2) -> DataFrame:
    """Drop operations at both ends until one side scores above ``more_than``.

    From each end the operations up to the first whose running score passes the
    threshold are examined, and the part before the lowest point of that score
    is dropped; an alignment that never passes is left out.
    """
    gain = C.score(F.array(F.struct("len", "op", "bases")), insert_divisor)
    ops = explode_ops(df, id_col, cigar).withColumn("_g", gain)
    for side, order in (("l", F.asc("idx")), ("r", F.desc("idx"))):
        w = Window.partitionBy(id_col).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        prior = Window.partitionBy(id_col).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        ops = ops.withColumn(f"_{side}", F.sum("_g").over(w))
        ops = ops.withColumn(f"_{side}b", F.coalesce(F.sum("_g").over(prior), F.lit(0)))
        low = F.min(F.least(F.col(f"_{side}b"), F.lit(0))).over(w)
        ops = ops.withColumn(f"_{side}p", F.col(f"_{side}") - low > more_than)
    bound = ops.groupBy(id_col).agg(F.min(F.when(F.col("_lp"), F.col("idx"))).alias("_lx"),
                                    F.max(F.when(F.col("_rp"), F.col("idx"))).alias("_rx"))
    held = ops.join(bound, id_col)
    low_l = F.min(F.when(F.col("idx") <= F.col("_lx"), F.struct("_lb", (-F.col("idx")).alias("i"))))
    low_r = F.min(F.when(F.col("idx") >= F.col("_rx"), F.struct("_rb", "idx")))
    cuts = held.groupBy(id_col).agg((-low_l["i"]).alias("_from"), low_r["idx"].alias("_to"))
    text = F.struct("idx", F.concat(F.col("len").cast("string"), F.col("op")).alias("t"))
    kept = held.join(cuts, id_col).where((F.col("idx") >= F.col("_from")) & (F.col("idx") <= F.col("_to")))
    return kept.groupBy(id_col).agg(
        F.min("q").cast("bigint").alias("qstart"), F.max("q_end").cast("bigint").alias("qend"),
        F.array_join(F.transform(F.array_sort(F.collect_list(text)), lambda t: t["t"]), "").alias("cigar"))


def strip_anchors(df: DataFrame, id_col: str, size: int = 100, cigar: str = "cigar", most: int = 512) -> DataFrame:
    """Remove ``size`` reference bases from both ends of each alignment.

    An alignment of at most ``most`` characters is cut where it lies; longer ones, and those that share an id, go by rows of operations.
    """
    rows = df.select(id_col, cigar).where(F.col(id_col).isNotNull())
    again = cut(rows.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(id_col))
    once = rows
    if not again.isEmpty():
        once = rows.join(again, id_col, "left_anti")
    # Made by a generator, so that each is evaluated once.
    ops = once.where(F.length(cigar) <= most).select(id_col, F.explode(F.array(_measured(C.tokens(F.col(cigar))))).alias("_ops"))
    own = ops.select(id_col, F.explode(F.filter(F.array(_stripped(F.col("_ops"), size)), lambda s: s["n"] > 0)).alias("_s")).select(
        id_col, F.col("_s.text").alias("cigar"))
    rest = once.where(F.length(cigar) > most)
    if not again.isEmpty():
        rest = rest.unionByName(rows.join(again, id_col, "left_semi").select(id_col, cigar))
    return own.unionByName(_stripped_rows(rest, id_col, size, cigar))


def _measured(ops: Column) -> Column:
    """Operations with ``ref``, the reference bases they take."""
    return F.transform(ops, lambda o: F.struct(o["len"].cast("bigint").alias("len"), o["op"].alias("op"), F.when(
        o["op"].isin(*C.REF_OPS), o["len"]).otherwise(0).cast("bigint").alias("ref")))


def _stripped(ops: Column, size: int) -> Column:
    """``r, hi, n, text``: the operations left and how many, from an array of ``len, op, ref``."""
    hi = F.aggregate(ops, F.lit(0).cast("bigint"), lambda a, o: a + o["ref"]) - size

    def add(a: Column, o: Column) -> Column:
        r, end = a["r"], a["r"] + o["ref"]
        still = o["ref"] == 0
        inside = F.when(still, r > size).otherwise(end > size) & (r < a["hi"])
        piece = F.when(still, o["len"]).otherwise(F.least(end, a["hi"]) - F.greatest(r, F.lit(size).cast("bigint")))
        return F.struct(end.alias("r"), a["hi"].alias("hi"), F.when(inside, a["n"] + 1).otherwise(a["n"]).alias("n"),
                        F.when(inside, F.concat(a["text"], piece.cast("string"), o["op"])).otherwise(a["text"]).alias("text"))
    return F.aggregate(ops, F.struct(F.lit(0).cast("bigint").alias("r"), hi.alias("hi"), F.lit(0).alias("n"), F.lit("").alias("text")), add)


def _stripped_rows(df: DataFrame, id_col: str, size: int, cigar: str) -> DataFrame:
    ops = explode_ops(df, id_col, cigar)
    ends = ops.groupBy(id_col).agg(F.max("r_end").alias("_all"))
    ranged = ops.join(ends, id_col)
    lo, hi = F.lit(size), F.col("_all") - size
    piece = F.when(F.col("r_end") == F.col("r"), F.col("len").cast("bigint")).otherwise(
        F.least("r_end", hi) - F.greatest("r", lo))
    inside = F.when(F.col("r_end") == F.col("r"), (F.col("r") > lo) & (F.col("r") < hi)).otherwise(
        (F.col("r_end") > lo) & (F.col("r") < hi))
    text = F.struct("idx", F.concat(piece.cast("string"), F.col("op")).alias("t"))
    return ranged.where(inside).groupBy(id_col).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(text)), lambda t: t["t"]), "").alias("cigar"))


def expand_matches(df: DataFrame, id_col: str, cigar: str = "cigar", query: str = "query",
                   ref: str = "ref") -> DataFrame:
    """Replace ``M`` by runs of ``=`` and ``X`` from the bases of both sides.

    A compared stretch becomes a string of equal and different marks whose runs
    are found by one regular expression.
    """
    ops = explode_ops(df, id_col, cigar, query, ref)
    a = F.split(F.substring(F.upper(query), F.col("q") + 1, F.col("len")), "")
    b = F.split(F.substring(F.upper(ref), F.col("r") + 1, F.col("len")), "")
    marks = F.array_join(F.zip_with(a, b, lambda x, y: F.when(x == y, "=").otherwise("X")), "")
    runs = F.regexp_extract_all(marks, F.lit(r"(=+|X+)"), F.lit(1))
    text = F.array_join(F.transform(runs, lambda t: F.concat(F.length(t).cast("string"), F.substring(t, 1, 1))), "")
    piece = F.when(F.col("op") == "M", text).otherwise(F.concat(F.col("len").cast("string"), F.col("op")))
    row = F.struct("idx", piece.alias("t"))
    return ops.groupBy(id_col).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(row)), lambda t: t["t"]), "").alias("cigar"))


def check_bases(df: DataFrame, id_col: str, cigar: str = "cigar", query: str = "query",
                ref: str = "ref") -> DataFrame:
    """Operations that contradict the bases: unequal ``=`` or a wholly equal ``X``."""
    ops = explode_ops(df, id_col, cigar, query, ref)
    a = F.substring(F.upper(query), F.col("q") + 1, F.col("len"))
    b = F.substring(F.upper(ref), F.col("r") + 1, F.col("len"))
    return ops.where(((F.col("op") == "=") & (a != b)) | ((F.col("op") == "X") & (a == b))).select(
        id_col, "idx", "op", "len")


def masked_bases(df: DataFrame, masks: DataFrame, id_col: str, key: str, start: str = "start",
                 end: str = "end", width: int = 1 << 14) -> DataFrame:
    """Bases of each interval covered by (merged) masked runs."""
    runs = merge_intervals(masks, [key]).select(key, F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    met = range_join(df.select(id_col, key, start, end), runs, [key], width, (start, end))
    size = F.least(F.col(end), F.col("r_end")) - F.greatest(F.col(start), F.col("r_start"))
    sums = met.groupBy(id_col).agg(F.sum(size).alias("_m"))
    return df.join(sums, id_col, "left").withColumn("masked", F.coalesce("_m", F.lit(0))).drop("_m")


def keep_alignment(unmasked: Column, identity: Column, match: Column, length: Column) -> Column:
    """Long enough outside masked runs, above 90 percent identity, enough matches."""
    return (identity > 90) & (((unmasked > 300) & (match > 150))
                              | ((match > 100) & (unmasked > length / 3)))


def mapped_locations(df: DataFrame, query: str = "query", size: str = "size",
                     coverage: float = 0.5, fraction: float = 0.95) -> DataFrame:
    """Locations covering half the query and scoring within 5 percent of its best;
    ``multi`` marks queries left with several."""
    good = df.where(F.col("covered") >= F.col(size) * F.lit(coverage))
    top = good.groupBy(query).agg(F.max("score").alias("_top"))
    near = good.join(top, query).where(F.col("score") >= F.lit(fraction) * F.col("_top")).drop("_top")
    many = near.groupBy(query).agg((F.count(F.lit(1)) > 1).alias("multi"))
    return near.join(many, query)


def signed_majority(df: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """Strand carrying the larger summed weight, ``+`` on equality."""
    signed = F.sum(F.when(F.col("strand") == "+", F.col(weight)).otherwise(-F.col(weight)))
    return df.groupBy(*keys).agg(F.when(signed >= 0, "+").otherwise("-").alias("strand"))
