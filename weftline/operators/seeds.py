"""Local hits from shared k-mers: runs along a diagonal, and runs of neighbouring diagonals joined with gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from weftline.operators.intervals import assign_islands, merge_intervals
from weftline.session import cut


def diagonal_runs(hits: DataFrame, target_hits: DataFrame, name: str, target: str, k: int = 31, gap: int = 31) -> DataFrame:
    """``target, name, diag, start, end, n``: seeds on one diagonal no more than ``gap`` apart; ``n`` counts them.

    Both sides are ``name, pos, kmer``.  A k-mer that both sides hold often gives the product of its places, as
    every seed-and-extend search does; filter such k-mers before (``kmers.found_kmers``).
    """
    met = hits.select(name, "kmer", F.col("pos").alias("_p")).join(
        target_hits.select(target, "kmer", F.col("pos").alias("_s")), "kmer")
    rows = met.select(target, name, (F.col("_p") - F.col("_s")).alias("diag"), F.col("_p").alias("start"), (F.col("_p") + k).alias("end"))
    return merge_intervals(rows, [target, name, "diag"], gap)


def chains(runs: DataFrame, keys: Sequence[str], gap: int = 300, shift: int = 100) -> DataFrame:
    """``keys, start, end, t_start, t_end, gaps, n_runs``: runs whose places and diagonals lie close become one hit.

    Runs no more than ``gap`` apart along the sequence are one stretch, and within it those whose
    diagonals are no more than ``shift`` apart one band; a band that falls into several stretches is split once more.
    ``gaps`` is the width of the band, the inserted or deleted bases that it spans.
    """
    keys = list(keys)
    first = assign_islands(runs, keys, gap).withColumnRenamed("island", "_c1")
    wide = first.withColumn("_to", F.col("diag"))
    second = cut(assign_islands(wide, [*keys, "_c1"], shift, "diag", "_to").withColumnRenamed("island", "_c2").drop("_to"))
    third = assign_islands(second, [*keys, "_c1", "_c2"], gap)
    return third.groupBy(*keys, "_c1", "_c2", "island").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min(F.col("start") - F.col("diag")).alias("t_start"),
        F.max(F.col("end") - F.col("diag")).alias("t_end"), (F.max("diag") - F.min("diag")).alias("gaps"),
        F.count(F.lit(1)).alias("n_runs")).drop("_c1", "_c2", "island")
