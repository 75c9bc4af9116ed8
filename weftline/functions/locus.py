"""Locus strings (``contig:start-end±``), contig naming and haplotypes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_LOCUS = r"^(.*):(-?\d+)-(-?\d+)([+-]?)$"

# Accession mark of one reference assembly and the two default haplotypes.
CHM13_MARK = "NC_0609"
CHM13_HAPLOTYPE = "CHM13_h1"
HG38_HAPLOTYPE = "HG38_h1"


def locus_struct(text: Column) -> Column:
    """Parse into ``contig, start, end, strand``; negative starts clamp to 0 and
    negative ends stay, so a locus before the contig is empty."""
    return F.struct(
        F.regexp_extract(text, _LOCUS, 1).alias("contig"),
        F.greatest(F.regexp_extract(text, _LOCUS, 2).cast("bigint"), F.lit(0)).alias("start"),
        F.regexp_extract(text, _LOCUS, 3).cast("bigint").alias("end"),
        F.regexp_extract(text, _LOCUS, 4).alias("strand"),
    )


def locus_text(contig: Column, start: Column, end: Column, strand: Column) -> Column:
    return F.concat(contig, F.lit(":"), start.cast("string"), F.lit("-"),
                    end.cast("string"), strand)


def trimmed_locus(start: Column, length: Column, strand: Column,
                  cut_left: Column, cut_right: Column) -> tuple[Column, Column]:
    """Coordinates left after cutting bases from both ends of a stranded record."""
    first = F.when(strand == "-", cut_right).otherwise(cut_left)
    last = F.when(strand == "-", cut_left).otherwise(cut_right)
    return start + first, start + length - last - 1


def haplotype(contig: Column) -> Column:
    """``sample#hap#contig`` gives ``sample_hhap``; plain contigs are references."""
    parts = F.split(contig, "#")
    return (
        F.when(F.size(parts) >= 2,
               F.concat(F.element_at(parts, 1), F.lit("_h"), F.element_at(parts, 2)))
        .when(contig.contains(CHM13_MARK), F.lit(CHM13_HAPLOTYPE))
        .otherwise(F.lit(HG38_HAPLOTYPE))
    )


def reference_class(name: Column) -> Column:
    """Main reference, second reference, alternative contig or ordinary allele."""
    return (
        F.when(name.contains(CHM13_MARK), F.lit("CHM13"))
        .when(name.contains("chr") & name.contains("v"), F.lit("Alt"))
        .when(name.contains("chr"), F.lit("HG38"))
        .otherwise(F.lit("Allele"))
    )


def overlap_size(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Shared length of two half-open ranges; 0 or less means they do not overlap."""
    return F.least(e1, e2) - F.greatest(s1, s2)
