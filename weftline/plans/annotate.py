"""Annotate alleles: nearest reference, variants, types and summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weftline.operators import aligner as AN, matching as M, pairs as P
from weftline.session import cut


def match_references(seqs: DataFrame, k: int = 31, at_most: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """All reference matches of ``name, hap, is_ref, seq`` rows, and the nearest one."""
    chosen, members = P.fold_copies(seqs, by=("is_ref",))
    near = cut(P.pair_distances(None, at_most, P.sequence_colours(chosen, "seq", k)))
    classes = chosen.select("name", "is_ref")
    every = M.reference_matches(near, classes, members, seqs.select("name", "hap", "is_ref"))
    return every, M.nearest_reference(near, classes, members)


def call_variants(seqs: DataFrame, nearest: DataFrame, longer_than: int = 200, k: int = 31) -> tuple[DataFrame, DataFrame]:
    """Global alignments of alleles to their nearest reference and named variants."""
    text = seqs.select("name", F.upper("seq").alias("seq"))
    pairs = cut(
        nearest.join(text.withColumnRenamed("seq", "query"), "name")
        .join(text.select(F.col("name").alias("ref"), F.col("seq").alias("_r")), "ref")
        .select(F.col("name").alias("id"), F.col("ref").alias("ref_name"), "query", F.col("_r").alias("ref")))
    aligned = AN.global_align(pairs)
    return aligned, AN.classify_variants(AN.variants(aligned, pairs, longer_than=longer_than), pairs, k=k)


def missing_positions(liftover: DataFrame, inserted: str = "inserted", size: str = "size") -> DataFrame:
    """Name what a lifted allele is: mapped elsewhere, inserted, translocated or unmapped."""
    kind = (F.when(F.col("locus").isNull(), "Novel(unmap)")
            .when(F.col(inserted) * 2 >= F.col(size), "Novel(insert)")
            .when(F.col("match").isNull(), "Novel(trans)").otherwise("Mutate"))
    return liftover.withColumn("kind", kind)
