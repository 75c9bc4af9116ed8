"""Find and extract copies of target sequences in assemblies."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weftline.functions import locus as L
from weftline.operators import intervals as I, kmers as K, tiling as TI
from weftline.operators.superkmers import count_super_kmers
from weftline.session import cut


def unique_enough(targets: DataFrame, genome: DataFrame, k: int = 31, limit: int = 255, few: int = 1_000_000) -> DataFrame:
    """Target k-mers seen fewer than ``limit`` times in a reference genome."""
    sets = cut(K.target_set(K.kmer_hits(targets, ("target",), "seq", k)))
    if sets.count() <= few:
        # Only what the targets hold leaves the sequences' counts.
        found = K.sequence_counts(genome.select("name", "seq"), ("name",), "seq", k).join(sets.select("kmer").distinct().hint("broadcast"), "kmer", "left_semi")
        seen = found.groupBy("kmer").agg(F.sum("cnt").alias("cnt")).where(F.col("cnt") >= limit)
    else:
        seen = count_super_kmers(genome, k=k, limit=limit).where(F.col("cnt") >= limit)
    return sets.join(seen.select("kmer"), "kmer", "left_anti")


def find_regions(contigs: DataFrame, targets: DataFrame, k: int = 31, cutoff: int = 50, span: int = 1000,
                 gap: int = 20000, pad: int = 10000, genome: DataFrame | None = None) -> DataFrame:
    """``target, contig, start, end``: dense hits merged over ``gap`` and widened.

    With a reference ``genome`` (``name, seq``) only k-mers that are rare in it count.
    """
    sets = K.target_set(K.kmer_hits(targets, ("target",), "seq", k)) if genome is None else unique_enough(targets, genome, k)
    placed = K.kmer_hits(contigs, ("name",), "seq", k).join(sets, "kmer").select(
        "target", F.col("name").alias("contig"), "pos")
    found = I.hotspots(placed, cutoff, span)
    return I.merge_intervals(found, ["target", "contig"], gap, pad=pad)


def extract(contigs: DataFrame, regions: DataFrame, strand: str = "+") -> DataFrame:
    """``target, contig, start, end, header, seq`` of each region, cut to its contig; only the tiles it touches are read."""
    index = TI.tile_index(contigs)
    sizes = TI.tiled_lengths(index).select(F.col("name").alias("contig"), "len")
    asked = regions.join(sizes, "contig").select("target", "contig", "start", F.least("end", "len").cast("bigint").alias("end"),
                                                 F.lit(strand).alias("strand"))
    found = TI.slice_regions(index.withColumnRenamed("name", "contig"), cut(asked), ["contig"], strand="strand", out="seq")
    return found.select("target", "contig", "start", "end",
                        L.locus_text(F.col("contig").cast("string"), F.col("start"), F.col("end"), F.col("strand")).alias("header"), "seq")


def search(contigs: DataFrame, targets: DataFrame, **options) -> DataFrame:
    return extract(contigs, find_regions(contigs, targets, **options))
