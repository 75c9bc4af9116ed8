import gzip
import random

import pytest
from pyspark.sql import functions as F

from weftline.functions import locus as L
from weftline.sources import alignments as SA, records as SR, tables as ST
from weftline.functions.sequence import decode_kmer


def test_fasta_round_trip(spark, tmp_path):
    path = tmp_path / "in.fa"
    path.write_text(">a\tc#1#x:-20-80+\tg1,g2\nACGT\nacgN\n\n>b c2:5-9-\nGG\n>empty\n")
    df = SR.located(SR.read_fasta(spark, str(path)))
    got = {r.name: (r.seq, r.contig, r.start, r.end, r.strand, r.genes) for r in df.collect()}
    assert got["a"] == ("ACGTacgN", "c#1#x", 0, 80, "+", ["g1", "g2"])
    assert got["b"][:5] == ("GG", "c2", 5, 9, "-")
    out = str(tmp_path / "out")
    SR.write_fasta(SR.read_fasta(spark, str(path)).where("name <> 'empty'").withColumn("hap", L.haplotype(F.col("name"))), out, "hap", 4)
    back = {r.name: r.seq for r in SR.read_fasta(spark, out + "/*").collect()}
    assert back == {"a": "ACGTacgN", "b": "GG"}
    twins = {r.name: r.seq for r in SR.selected(SR.read_fasta(spark, str(path)), spark.createDataFrame([("a",)], "name string")).collect()}
    assert twins == {"a": "ACGTacgN", "a_r": "NcgtACGT"}


def test_fastq_gz(spark, tmp_path):
    path = tmp_path / "r.fastq.gz"
    with gzip.open(path, "wt") as out:
        out.write("@r1 x\nACGT\n+\n@@II\n@r2\nGGTT\n+\nIIII")
    lines = tmp_path / "w.fa"
    lines.write_text(">a\nACG\nTT\n>b\nGG\n")
    placed = SR.line_offsets(SR.read_fasta_lines(spark, str(lines)).where("line NOT LIKE '>%'"), ["path", "record"], "line_no", "line")
    assert sorted((r.record, r.line, r.offset) for r in placed.collect()) == [(0, "ACG", 0), (0, "TT", 3), (3, "GG", 0)]
    assert {r.name: r.seq for r in SR.read_fastq(spark, str(path)).collect()} == {"r1": "ACGT", "r2": "GGTT"}


def test_kmer_files(spark, tmp_path):
    path = tmp_path / "k.list"
    k = "ACGTACGTACGTACGTACGTACGTACGTACG"
    path.write_text(f">\n{k}\n>\n{k}\n")
    kmers = ST.read_kmer_list(spark, str(path))
    assert [r[0] for r in kmers.select(decode_kmer(F.col("kmer"))).collect()] == [k]
    ST.write_kmer_list(kmers, str(tmp_path / "o"))
    assert ST.read_kmer_list(spark, str(tmp_path / "o")).count() == 1
    table = tmp_path / "t.tsv"
    table.write_text(f"@targetsize\t7\n{k}\t3\n")
    assert ST.read_counts(spark, str(table)).first().cnt == 3
    assert ST.read_target_sizes(spark, str(table)).first().targetsize == 7


def test_annotation_files(spark, tmp_path):
    gff = tmp_path / "a.gff3"
    gff.write_text("##gff\nchr1\th\tgene\t1\t9\t.\t+\t.\tID=a;gene_id=G1.2;gene_name=SMN1\n"
                   "chr1\th\texon\t1\t9\t.\t+\t.\texon_id=E1.3;exon_number=2;transcript_id=T1;transcript_type=protein_coding;gene_id=G1.2;gene_name=SMN1\n"
                   "chr1\th\tgene\t1\t9\t.\t+\t.\tgene_id=G2;gene_name=SMN10\n")
    rows = SA.read_gff(spark, str(gff))
    assert [r.gene for r in SA.gff_genes(SA.genes_named(rows, ["SMN1"])).collect()] == ["SMN1"]
    exon = SA.gff_exons(rows).first()
    assert (exon.exon, exon.number, exon.gene_id) == ("E1", 2, "G1")
    assert SA.gff_to_bed(rows, "exon").first().id == "E1.3"
    bed = tmp_path / "e.bed"
    bed.write_text("# x\n\tskip\nc1 5 9\n")
    assert [tuple(r) for r in SA.read_error_regions(spark, str(bed)).collect()] == [("c1", 5, 9)]


def test_blast_sam(spark, tmp_path):
    sam = tmp_path / "h.sam"
    sam.write_text("@HD\nr1\t16\tQuery_2\t11\t255\t5H10M2I3M1D4H\t*\tAS:i:500\tPI:f:98.5\nr2\t0\tQuery_1\t1\t255\t4M\t*\tAS:i:5\tPI:f:99\n")
    names = spark.createDataFrame([(1, "a"), (2, "b")], "ordinal long, name string")
    hits = SA.restored_names(SA.strong_hits(SA.read_blast_sam(spark, str(sam)), 100), names)
    paf = SA.sam_to_paf(hits, spark.createDataFrame([("b", 100)], "name string, length long")).first()
    assert (paf.q, paf.qlen, paf.qs, paf.qe, paf.strand, paf.r, paf.rlen, paf.rs, paf.re, paf.match) == ("b", 100, 10, 24, "-", "r1", 24, 4, 19, 13)
    SA.write_paf(SA.sam_to_paf(hits, spark.createDataFrame([("b", 100)], "name string, length long")), str(tmp_path / "p"))
    assert SA.read_paf(spark, str(tmp_path / "p")).first().q == "b"


def test_matrix_newick_manifest_pairs(spark, tmp_path):
    m = tmp_path / "m.csv"
    m.write_text("1.0000,0.5000\n0.5000,2.0000\n")
    entries = ST.read_matrix(spark, str(m))
    assert {(r.i, r.j): r.v for r in entries.collect()} == {(0, 0): 1, (0, 1): .5, (1, 0): .5, (1, 1): 2}
    assert sorted((r.i, r.line) for r in ST.matrix_rows(entries, 2).collect()) == [(0, "1.0000,0.5000"), (1, "0.5000,2.0000")]
    t = tmp_path / "t.ph"
    t.write_text("((a:0.1,b:0.1):0.2,c:0.3);\n")
    assert {r.leaf for r in ST.read_newick(spark, str(t)).where("leaf IS NOT NULL").collect()} == {"a", "b", "c"}
    mf = tmp_path / "mf"
    mf.write_text("s1 /x\ns2\t/y\n")
    got = ST.with_source(spark.createDataFrame([("s1",), ("s9",)], "sample string"), ST.read_manifest(spark, str(mf)), default="-")
    assert {r.sample: r.source for r in got.collect()} == {"s1": "/x", "s9": "-"}
    p = tmp_path / "al.txt"
    p.write_text("# Score: 41\n#\n\nq1   ACG-T\n     ||| |\nr1   ACGGT\n\nq1   AA\n     ||\nr1   AA\n")
    row = SA.read_pair_alignments(spark, str(p)).first()
    assert (row.score, row.query, row.ref) == (41.0, "ACG-TAA", "ACGGTAA")


@pytest.mark.parametrize("size", ["9", "64", "128m"])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_fastq_splits_empty_reads_and_at_signs(spark, tmp_path, size, end):
    rng = random.Random(7)
    reads = [("r1", "ACGT", "IIII"), ("r2", "", ""), ("r3", "GGGG", "@@@@"), ("r4", "", ""), ("r5", "A", "@"), ("r6", "C", "+")]
    for i in range(60):
        n = rng.choice([0, 1, 5, 30])
        reads.append((f"x{i}", "".join(rng.choice("ACGTN") for _ in range(n)), "".join(rng.choice("@+I>") for _ in range(n))))
    text = "".join(f"@{n} about it{end}{s}{end}+{n if i % 3 == 0 else ''}{end}{q}{end}" for i, (n, s, q) in enumerate(reads))
    (tmp_path / "a.fastq").write_text(text, newline="")
    (tmp_path / "b.fastq").write_text(text.rstrip("\r\n"), newline="")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        got = [(r.path[-7:], r.name, r.seq) for r in SR.read_fastq(spark, str(tmp_path)).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(got) == sorted((f, n, s) for n, s, _ in reads for f in ("a.fastq", "b.fastq"))


@pytest.mark.parametrize("size", ["7", "50", "128m"])
def test_fasta_splits_and_line_ends(spark, tmp_path, size):
    rng = random.Random(8)
    records = [(f"s{i}", "".join(rng.choice("ACGT") for _ in range(rng.choice([0, 1, 60, 61, 200])))) for i in range(25)]
    for name, end in (("a.fa", "\n"), ("b.fa", "\r\n")):
        lines = [x for n, s in records for x in [f">{n} text > more", *[s[i:i + 60] for i in range(0, len(s), 60)], *([""] if rng.random() < .3 else [])]]
        (tmp_path / name).write_text(end.join(lines) + end, newline="")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        got = [(r.path[-4:], r.name, r.seq) for r in SR.read_fasta(spark, str(tmp_path)).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(got) == sorted((f, n, s) for n, s in records for f in ("a.fa", "b.fa"))
