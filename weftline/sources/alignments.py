"""Readers and writers of alignment, annotation and interval text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weftline.functions import attrs as T, cigar as C, locus as L
from weftline.operators import tiling as TI
from weftline.schemas import FAI, GFF, PAF
from weftline.sources.tables import read_tabbed, write_report


def read_paf(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return read_tabbed(spark, paths, PAF)


def read_fai(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return read_tabbed(spark, paths, FAI).select("contig", "length")


def read_error_regions(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``contig, start, end``; lines starting with ``@ # =`` or white space are skipped."""
    lines = spark.read.text(paths).where(~F.col("value").rlike(r"^[@#=\t ]") & (F.col("value") != ""))
    part = F.split("value", r"\s+")
    return lines.select(part[0].alias("contig"), part[1].cast("long").alias("start"), part[2].cast("long").alias("end"))


def read_gff(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    rows = read_tabbed(spark, paths, GFF)
    return rows.where(~F.col("seqid").startswith("#")).withColumn("attrs", T.gff_attributes(F.col("attributes")))


def gff_genes(rows: DataFrame) -> DataFrame:
    """Gene rows that carry exactly one ``gene_name``."""
    name = T.single_attribute(F.col("attributes"), "gene_name")
    return rows.where("type = 'gene'").withColumn("gene", name).where("gene IS NOT NULL").select(
        F.col("seqid").alias("contig"), "start", "end", "strand", "gene")


def gff_exons(rows: DataFrame) -> DataFrame:
    """``exon, transcript, number, gene, gene_id, kind`` with version suffixes removed."""
    a = F.col("attrs")
    return rows.where("type = 'exon'").select(
        T.without_version(a["exon_id"]).alias("exon"), a["transcript_id"].alias("transcript"),
        a["exon_number"].cast("int").alias("number"), a["gene_name"].alias("gene"),
        T.without_version(a["gene_id"]).alias("gene_id"), a["transcript_type"].alias("kind"))


def gff_to_bed(rows: DataFrame, kind: str) -> DataFrame:
    """BED6 of one feature type: ``chrom, start, end, strand, id, gene``."""
    return rows.where(F.col("type") == kind).select(
        F.col("seqid").alias("chrom"), "start", "end", "strand",
        F.regexp_extract("attributes", rf"{kind}_id=([^;]+)", 1).alias("id"),
        F.regexp_extract("attributes", r"gene_id=([^;]+)", 1).alias("gene"))


# Names whose genes are told apart by more than the name itself.
GENE_REWRITES = {
    "C2": "C2[;-]",
    "C3": "C3[;-]",
    "C4": "C4[AB]",
    "CEL": "CEL;",
    "ETFB": "ETFB;",
    "GAL": "GAL;",
    "GGN": "GGN;",
    "GK": "GK;",
    "HBB": "HB[BD]",
    "HLA-D": "HLA-D[^a-zA-Z]*;",
    "LIX1": "LIX1;",
    "LPA": "LPA[^R]",
    "MPI": "MPI;",
    "PACS": "PACS[12]",
    "PC": "PC;",
    "PLEK": "PLEK;",
    "PPIA": "PPIA;",
    "PTPRC": "PTPRC;",
    "SRR": "SRR;",
    "TNF": "TNF;",
    "TNKS": "TNKS;",
}


def gene_name_pattern(names: list[str], rewrites: dict[str, str] | None = None) -> str:
    """Regular expression for gene names or prefixes.

    A name in ``rewrites`` (``GENE_REWRITES`` unless given) stands for its pattern; another one ending in a digit must be
    followed by a letter or a separator, so that it does not match longer numbers.
    """
    known = GENE_REWRITES if rewrites is None else rewrites

    def one(name: str) -> str:
        return known.get(name) or (name + "[A-Z;.,-]" if name[-1].isdigit() else name)

    return "gene_name=(?:" + "|".join(one(n) for n in names) + ")"


def genes_named(rows: DataFrame, names: list[str], rewrites: dict[str, str] | None = None) -> DataFrame:
    return rows.where(F.concat(F.col("attributes"), F.lit(";")).rlike(gene_name_pattern(names, rewrites)))


def read_blast_sam(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``rname, flag, qname, pos, mapq, cigar, score, identity`` of hit lines."""
    lines = spark.read.text(paths).where(~F.col("value").startswith("@") & (F.col("value") != ""))
    part = F.split("value", "\t")
    return lines.select(
        part[0].alias("rname"), part[1].cast("int").alias("flag"), part[2].alias("qname"),
        part[3].cast("long").alias("pos"), part[4].cast("int").alias("mapq"), part[5].alias("cigar"),
        T.sam_tag(F.col("value"), "AS").cast("double").alias("score"),
        T.sam_tag(F.col("value"), "PI", "f").cast("double").alias("identity"))


# The main chromosomes and the accession numbers of the second reference.
MAIN_CHROMOSOMES = [f"chr{n}" for n in [*range(1, 23), "X", "Y", "M"]]
SECOND_CHROMOSOMES = [f"NC_0609{n}.1" for n in range(25, 49)]


def valid_hits(hits: DataFrame, others: DataFrame | None = None, identity: float = 95.0) -> DataFrame:
    """Unmapped-quality hits (255) of enough identity on a known chromosome.

    ``others`` lists further contigs (``contig``), such as the alternative ones of a reference.
    """
    good = hits.where((F.col("identity") >= identity) & (F.col("mapq") == 255))
    main = F.col("rname").isin(MAIN_CHROMOSOMES + SECOND_CHROMOSOMES)
    if others is None:
        return good.where(main)
    listed = good.where(~main).join(others.select(F.col("contig").alias("rname")).distinct(), "rname", "left_semi")
    return good.where(main).unionByName(listed.select(good.columns))


def strong_hits(hits: DataFrame, score: float, identity: float = 95.0) -> DataFrame:
    return hits.where((F.col("score") > score) & (F.col("identity") > identity))


def restored_names(hits: DataFrame, names: DataFrame, column: str = "qname") -> DataFrame:
    """Replace ``Query_k`` by the k-th sequence name (``ordinal, name``)."""
    number = F.regexp_extract(column, r"^Query_(\d+)$", 1)
    keyed = hits.withColumn("ordinal", F.when(number != "", number.cast("long")))
    return keyed.join(names.select("ordinal", F.col("name").alias("_n")), "ordinal", "left").withColumn(
        column, F.coalesce("_n", column)).drop("_n", "ordinal")


def sam_to_paf(hits: DataFrame, query_sizes: DataFrame) -> DataFrame:
    """PAF columns from BLAST SAM hits; ``query_sizes`` is ``name, length``.

    The reference record sits in the read column of this SAM flavour, so sizes
    follow the swapped sides, and a reverse hit counts from the far end.
    """
    r_size, q_size, clip = C.hit_sizes(F.col("_ops"))
    matched = C.total(F.col("_ops"), C.MATCH_OPS)
    sized = hits.withColumn("_ops", C.parse(F.col("cigar"))).select(
        "*", r_size.alias("_r"), q_size.alias("_q"), clip.alias("_h"), matched.alias("_m"),
        F.regexp_extract("cigar", r"^(\d+)H", 1).alias("_lead"))
    lead = F.when(F.col("_lead") == "", 0).otherwise(F.col("_lead").cast("long"))
    whole = F.col("_r") + F.col("_h")
    back = F.col("flag") != 0
    first = F.when(back, whole - lead - F.col("_r")).otherwise(lead)
    joined = sized.join(query_sizes.select(F.col("name").alias("qname"), F.col("length").alias("_len")), "qname", "left")
    return joined.select(
        F.col("qname").alias("q"), F.col("_len").alias("qlen"), (F.col("pos") - 1).alias("qs"),
        (F.col("pos") - 1 + F.col("_q")).alias("qe"), F.when(back, "-").otherwise("+").alias("strand"),
        F.col("rname").alias("r"), whole.alias("rlen"), first.alias("rs"), (first + F.col("_r")).alias("re"),
        F.col("_m").alias("match"), F.greatest("_r", "_q").alias("alen"), F.lit(60).alias("mapq"), "identity", "cigar")


def region_fasta(sequences: DataFrame, regions: DataFrame, name: Column) -> DataFrame:
    """``name, header, seq`` cut from contigs by (contig, start, end, strand) rows; only the tiles a region touches are read."""
    index = TI.tile_index(sequences).withColumnRenamed("name", "contig")
    place = L.locus_text(F.col("contig").cast("string"), F.col("start"), F.col("end"), F.col("strand"))
    found = TI.slice_regions(index, regions.withColumn("name", name), ["contig"], strand="strand", out="seq")
    return found.select("name", F.concat_ws("\t", "name", place).alias("header"), "seq")


_LINE = r"^(\S+)[ ]+(?:\d+[ ]+)?([A-Za-z-]+)(?:[ ]+\d+)?[ ]*$"


def read_pair_alignments(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``path, score, query, ref`` gapped texts from pairwise alignment reports.

    Comment lines start with ``#``; the remaining sequence lines alternate
    between the two sides.  A report is one alignment, read as one value.
    """
    raw = spark.read.text(paths, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), "value")
    score = F.regexp_extract("value", r"(?m)^#\s*Score:\s*(-?[\d.]+)", 1).cast("double")
    kept = F.filter(F.split("value", "\n"), lambda t: ~t.startswith("#") & t.rlike(_LINE))
    rows = F.transform(kept, lambda t: F.regexp_extract(t, _LINE, 2))

    def side(which: int) -> Column:
        return F.array_join(F.filter(rows, lambda t, i: i % 2 == which), "")

    return raw.select("path", score.alias("score"), side(0).alias("query"), side(1).alias("ref"))


def write_paf(rows: DataFrame, path: str) -> None:
    write_report(rows.select(*[f.name for f in PAF]), path)
