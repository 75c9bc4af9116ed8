"""Row filters and small rules on hits, locations and gene tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from weftline.functions.locus import CHM13_MARK
from weftline.operators.annotate import counted_names


def hits_inside(hits: DataFrame, regions: DataFrame, key: str, share: float = 0.9) -> DataFrame:
    """Hits that match at least ``share`` of their size and overlap the key's region.

    ``hits`` has ``start, end, size, match``; ``regions`` is ``key, r_start, r_end``.
    """
    near = hits.join(regions, key)
    overlap = F.least("end", "r_end") - F.greatest("start", "r_start")
    return near.where((overlap > 0) & (F.col("match") >= F.lit(share) * F.col("size"))).select(hits.columns)


def coding_support(rows: DataFrame, key: str, order: str, kind: str = "kind", percent: str = "percent",
                   coding: str = "protein_coding", above: float = 90.0) -> DataFrame:
    """Rows of coding transcripts matched above ``above`` percent; keys without one keep their first row."""
    good = rows.where((F.col(percent) > above) & (F.col(kind) == coding))
    rest = rows.join(good.select(key).distinct(), key, "left_anti")
    others = [c for c in rows.columns if c != key]
    first = rest.groupBy(key).agg(F.min_by(F.struct(*others), order).alias("_r")).select(key, "_r.*")
    return good.unionByName(first.select(rows.columns))


def location_score(name: Column, contig: Column, score: Column, force_main: bool = False) -> Column:
    """Score of a location after weighting by its contig; NULL where the row does not count.

    Alternative contigs count only for names of a sample.  Names from an alternative or
    the second reference must go to the main reference; others may use the second one
    freely and an alternative contig at nine tenths.
    """
    second = contig.contains(CHM13_MARK)
    other = contig.contains("_") | contig.contains("v")
    skipped = contig.contains("_") & ~second & ~name.contains("_h")
    to_main = F.lit(force_main) | F.coalesce(F.get(F.split(name, "_"), F.lit(2)), F.lit("")).contains("v") | name.contains(CHM13_MARK)
    weight = (F.when(to_main, F.when(second, 0.000001).when(other, 0.0).otherwise(1.0))
              .otherwise(F.when(second, 1.0).when(other, 0.9).otherwise(1.0)))
    return F.when(~skipped & (score > 0), score * weight)


def partial_counts(rows: DataFrame, key: str, gene: str, percent: str, order: str, above: float = 90.0) -> DataFrame:
    """``gene:count`` lists in which genes matched no better than ``above`` percent carry ``(Partial)``."""
    marked = rows.withColumn("_gene", F.when(F.col(percent) > above, F.col(gene)).otherwise(F.concat(gene, F.lit("(Partial)"))))
    return counted_names(marked, key, "_gene", order, "genes")


def liftover_kind(found: Column, inserted: Column, size: Column) -> Column:
    """``Mutate``, ``Novel(insert)`` or ``Novel(trans)``; no row at all is ``Novel(unmap)``."""
    return (F.when(size.isNull(), "Novel(unmap)").when(found.isNull(), "Novel(trans)")
            .when(inserted < 0.5 * size, "Mutate").otherwise("Novel(insert)"))


def ordered_distinct(df: DataFrame, keys: Sequence[str], order: str, out: str = "first") -> DataFrame:
    """Distinct ``keys`` with the place where each was first seen."""
    return df.groupBy(*keys).agg(F.min(order).alias(out))


def gapped_position(text: Column, position: Column, end: bool = False) -> Column:
    """Place in the gapped ``text`` of a 0-based place among its letters; an ``end`` follows its last letter."""
    at = position - 1 if end else position
    runs = F.regexp_extract_all(text, F.lit("([^A-Za-z]*)([A-Za-z]+)"), F.lit(0))
    state = F.struct(F.lit(0).alias("letters"), F.lit(0).alias("gaps"), F.lit(False).alias("done"))

    def step(acc: Column, run: Column) -> Column:
        letters = F.length(F.regexp_extract(run, "([A-Za-z]+)$", 1))
        seen = acc["letters"] + letters
        return F.when(acc["done"], acc).otherwise(F.struct(
            seen.alias("letters"), (acc["gaps"] + F.length(run) - letters).alias("gaps"), (at < seen).alias("done")))
    found = at + F.aggregate(runs, state, step)["gaps"]
    return found + 1 if end else found


def symmetric(entries: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Both halves of a matrix stored as ``i <= j``."""
    return entries.unionByName(entries.where("i <> j").select(*keys, F.col("j").alias("i"), F.col("i").alias("j"), "v"))
