"""Column layouts of the exchanged tables."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

_TYPES = {"string": StringType(), "long": LongType(), "int": IntegerType(), "double": DoubleType()}


def _columns(text: str) -> StructType:
    """Struct type from ``name type`` pairs, without needing a session."""
    pairs = (part.split() for part in text.split(","))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


PAF = _columns(
    "q string, qlen long, qs long, qe long, strand string, r string, rlen long, rs long, re long, "
    "match long, alen long, mapq int, identity double, cigar string")
GFF = _columns(
    "seqid string, source string, type string, start long, end long, score string, strand string, phase string, "
    "attributes string")
BED6 = _columns("chrom string, start long, end long, strand string, id string, gene string")
FAI = _columns("contig string, length long, offset long, bases int, width int")
HOTSPOT = _columns("contig string, start long, end long")
KMER_COMPARE = _columns("kmer string, c1 int, c2 int")
REFMATCH = _columns(
    "name string, ref string, locus string, ref_locus string, is_exon int, distance double, tag string")
VARIANT = _columns(
    "idx int, type string, qs string, qe string, rs string, re string, size long, matched long, cigar string")
GRAPH_ALIGN = _columns("query string, path string, cigar string, path_ranges string, query_ranges string")
TYPES = _columns("idx int, parent int, members string")
GENE_COUNT = _columns(
    "transcript string, gene_id string, gene string, kind string, match double, identity double, n_exon int, "
    "n_missing int, numbers string, contig string, start long, end long, starts string, ends string, strands string, "
    "exons string")
ALLELE_SUMMARY = _columns(
    "name string, type string, gene string, locus string, gene_counts string, category string, exon string, "
    "q_loc string, closest_ref string, similarity string, lift_locus string, lift_ref string, n_kmer string, "
    "note string, sv string, exons string, path string, path_cigar string, lift_cigar string")
