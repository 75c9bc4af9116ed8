"""Round trips through every text format, and the rules on what they hold.

Each query writes a given table in the format, reads it back and is checked on the table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import query
from catalogue.fragments import SEQS
from weftline import adapters as A
from weftline.functions.sequence import encode_kmer
from weftline.operators import filters as FI, intervals as I
from weftline.sources import alignments as SA, records as SR, tables as ST
from weftline.session import scratch_path


def _written(lines, spark, **options) -> str:
    """Path of a text file folder with one column of lines."""
    path = scratch_path(spark)
    lines.write.options(**options).text(path)
    return path


@query(f"WITH {SEQS} SELECT name::VARCHAR AS name, length(seq) AS n, md5(seq) AS digest FROM seqs")
def fasta_round_trip(spark, sf):
    path = scratch_path(spark)
    SR.write_fasta(A.sequences(spark, sf).select(F.col("name").cast("string").alias("name"), "seq"), path, width=60)
    return SR.read_fasta(spark, path).select("name", F.length("seq").alias("n"), F.md5("seq").alias("digest"))


@query(f"""WITH {SEQS}, s AS (SELECT * FROM seqs WHERE grp = 'de'), r AS (SELECT name, seq FROM s UNION ALL SELECT name || '_r', reverse(translate(seq, 'ATCGatcg', 'TAGCtagc')) FROM s)
SELECT name::VARCHAR AS name, md5(seq) AS digest FROM r""")
def fasta_selected_twins(spark, sf):
    seqs = A.sequences(spark, sf).withColumn("name", F.col("name").cast("string"))
    path = scratch_path(spark)
    SR.write_fasta(seqs.select("name", "seq", "hap"), path, partition="hap")
    wanted = seqs.where("grp = 'de'").select("name")
    return SR.selected(SR.read_fasta(spark, path + "/*"), wanted).select("name", F.md5("seq").alias("digest"))


@query("""SELECT 'SUPP#1#o' || s_suppkey AS name, 'o' || s_suppkey AS original, 's' || s_suppkey AS contig, s_nationkey::BIGINT AS start,
(s_nationkey + 10)::BIGINT AS "end", '-' AS strand FROM supplier""")
def fasta_headers(spark, sf):
    supplier = A.table(spark, sf, "supplier")
    name = SR.renamed_header(F.col("s_name"), "SUPP_h1", F.concat(F.lit("o"), "s_suppkey"))
    header = F.concat(name, F.lit("\ts"), "s_suppkey", F.lit(":"), "s_nationkey", F.lit("-"), F.col("s_nationkey") + 10, F.lit("-\tg1,g2"))
    path = scratch_path(spark)
    SR.write_fasta(supplier.select(name.alias("name"), header.alias("header"), F.lit("ACGT").alias("seq")), path)
    found = SR.located(SR.read_fasta(spark, path))
    return found.select("name", F.element_at(F.split("name", "#"), 3).alias("original"), "contig", "start", "end", "strand")


@query("SELECT p_name AS name, p_partkey FROM part WHERE starts_with(p_name, (SELECT substr(min(p_name), 1, 3) FROM part)) ORDER BY p_partkey LIMIT 1")
def first_record_by_prefix(spark, sf):
    part = A.table(spark, sf, "part").select(F.col("p_name").alias("name"), "p_partkey")
    prefix = part.agg(F.substring(F.min("name"), 1, 3)).first()[0]
    return SR.first_with_prefix(part, prefix, "p_partkey")


@query("""SELECT 'r' || o_orderkey AS name, repeat(substr('ACGT', (o_orderkey % 4 + 1)::INT, 1), (o_custkey % 7 + 1)::INT) AS seq FROM orders""")
def fastq_round_trip(spark, sf):
    seq = F.expr("repeat(substr('ACGT', cast(o_orderkey % 4 as int) + 1, 1), cast(o_custkey % 7 as int) + 1)")
    lines = A.table(spark, sf, "orders").select(F.concat(F.lit("@r"), "o_orderkey", F.lit(" x\n"), seq, F.lit("\n+\n"), F.translate(seq, "ACGT", "@+>I")).alias("v"))
    return SR.read_fastq(spark, _written(lines, spark, compression="gzip")).select("name", "seq")


_GFF = """g AS (SELECT l_orderkey AS o, l_linenumber AS ln, 'chr' || (l_suppkey % 22 + 1) AS seqid, l_partkey AS s, l_partkey + l_quantity::BIGINT AS e,
CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand, CASE WHEN l_linenumber = 1 THEN 'gene' ELSE 'exon' END AS type,
'G' || l_partkey || '.' || l_linenumber AS gid, 'GENE' || (l_partkey % 40) AS gname FROM lineitem)"""


def _gff(spark, sf):
    fields = [
        F.concat(F.lit("chr"), F.col("l_suppkey") % 22 + 1), F.lit("h"), F.when(F.col("l_linenumber") == 1, "gene").otherwise("exon"),
        "l_partkey", F.col("l_partkey") + F.col("l_quantity").cast("bigint"), F.lit("."),
        F.when(F.col("l_linestatus") == "O", "+").otherwise("-"), F.lit("."),
        F.concat(F.lit("ID=x;gene_id=G"), "l_partkey", F.lit("."), "l_linenumber", F.lit(";transcript_id=T"), "l_orderkey", F.lit(";transcript_type=lncRNA;exon_id=E"),
                 "l_orderkey", F.lit("."), "l_linenumber", F.lit(";exon_number="), "l_linenumber", F.lit(";gene_name=GENE"), F.col("l_partkey") % 40)]
    lines = A.table(spark, sf, "lineitem").select(F.concat_ws("\t", *fields).alias("v")).unionByName(spark.range(1).select(F.lit("##gff-version 3").alias("v")))
    return SA.read_gff(spark, _written(lines, spark))


@query(f"WITH {_GFF} SELECT seqid AS contig, s AS start, e AS \"end\", strand, gname AS gene FROM g WHERE type = 'gene'")
def gff_genes(spark, sf):
    return SA.gff_genes(_gff(spark, sf))


@query(f"""WITH {_GFF} SELECT 'E' || o AS exon, 'T' || o AS transcript, ln AS number, gname AS gene, split_part(gid, '.', 1) AS gene_id, 'lncRNA' AS kind FROM g WHERE type = 'exon'""")
def gff_exons(spark, sf):
    return SA.gff_exons(_gff(spark, sf))


@query(f"""WITH {_GFF} SELECT seqid AS chrom, s AS start, e AS "end", strand, 'E' || o || '.' || ln AS id, gid AS gene FROM g WHERE type = 'exon'""")
def gff_to_bed(spark, sf):
    return SA.gff_to_bed(_gff(spark, sf), "exon")


@query(f"WITH {_GFF} SELECT seqid, s AS start, type FROM g WHERE gname IN ('GENE3', 'GENE11')")
def gff_genes_named(spark, sf):
    return SA.genes_named(_gff(spark, sf), ["GENE3", "GENE11"]).select("seqid", "start", "type")


@query("""SELECT 'q' || l_orderkey AS q, l_partkey AS qlen, 0::BIGINT AS qs, l_quantity::BIGINT AS qe, '+' AS strand, 'r' || l_suppkey AS r, 9::BIGINT AS rlen,
1::BIGINT AS rs, 8::BIGINT AS re, l_suppkey AS match, l_linenumber::BIGINT AS alen, 60 AS mapq, l_discount AS identity, l_linenumber || 'M' AS cigar FROM lineitem""")
def paf_round_trip(spark, sf):
    line = A.table(spark, sf, "lineitem")
    long = lambda n: F.lit(n).cast("bigint")
    rows = line.select(F.concat(F.lit("q"), "l_orderkey").alias("q"), F.col("l_partkey").alias("qlen"), long(0).alias("qs"), F.col("l_quantity").cast("bigint").alias("qe"),
                       F.lit("+").alias("strand"), F.concat(F.lit("r"), "l_suppkey").alias("r"), long(9).alias("rlen"), long(1).alias("rs"), long(8).alias("re"),
                       F.col("l_suppkey").alias("match"), F.col("l_linenumber").cast("bigint").alias("alen"), F.lit(60).alias("mapq"), F.col("l_discount").alias("identity"),
                       F.concat("l_linenumber", F.lit("M")).alias("cigar"))
    path = scratch_path(spark)
    SA.write_paf(rows, path)
    return SA.read_paf(spark, path)


@query("SELECT 'c' || c_custkey AS contig, (c_nationkey * 100)::BIGINT AS length FROM customer")
def fai_round_trip(spark, sf):
    rows = A.table(spark, sf, "customer").select(F.concat(F.lit("c"), "c_custkey"), F.col("c_nationkey") * 100, F.lit(5), F.lit(60), F.lit(61))
    return SA.read_fai(spark, _written(rows.select(F.concat_ws("\t", *rows.columns).alias("v")), spark))


@query("SELECT 's' || l_suppkey AS contig, l_partkey AS start, l_partkey + l_quantity::BIGINT AS \"end\" FROM lineitem WHERE l_linenumber < 5")
def error_bed_round_trip(spark, sf):
    lead = F.when(F.col("l_linenumber") < 5, "s").when(F.col("l_linenumber") == 5, "#").when(F.col("l_linenumber") == 6, "@").otherwise("\t")
    rows = A.table(spark, sf, "lineitem").select(F.concat(lead, "l_suppkey"), "l_partkey", F.col("l_partkey") + F.col("l_quantity").cast("bigint"))
    return SA.read_error_regions(spark, _written(rows.select(F.concat_ws("\t", *rows.columns).alias("v")), spark))


_WORD = "translate(lpad(l_partkey::VARCHAR, 31, '0'), '0123456789', 'ACGTACGTAC')"


def _kmers(spark, sf):
    word = F.translate(F.lpad(F.col("l_partkey").cast("string"), 31, "0"), "0123456789", "ACGTACGTAC")
    return A.table(spark, sf, "lineitem").groupBy(encode_kmer(word).alias("kmer"), word.alias("word")).agg(F.count(F.lit(1)).cast("int").alias("cnt"))


@query(f"SELECT DISTINCT {_WORD} AS word FROM lineitem")
def kmer_list_round_trip(spark, sf):
    from weftline.functions.sequence import decode_kmer

    path = scratch_path(spark)
    ST.write_kmer_list(_kmers(spark, sf).select("kmer"), path)
    return ST.read_kmer_list(spark, path).select(decode_kmer(F.col("kmer"), 31).alias("word"))


@query(f"""WITH c AS (SELECT {_WORD} AS word, count(*)::INT AS cnt FROM lineitem GROUP BY 1)
SELECT word, cnt FROM c UNION ALL SELECT '@targetsize', count(*)::INT FROM c""")
def count_table_round_trip(spark, sf):
    from weftline.functions.sequence import decode_kmer

    counts = _kmers(spark, sf).select("kmer", "cnt")
    path = scratch_path(spark)
    ST.write_counts(counts, path, target_size=counts.count())
    sizes = ST.read_target_sizes(spark, path).select(F.lit("@targetsize").alias("word"), F.col("targetsize").cast("int").alias("cnt"))
    return ST.read_counts(spark, path).select(decode_kmer(F.col("kmer"), 31).alias("word"), "cnt").unionByName(sizes)


# A hit per line item: reverse for 'F', clips at both ends, one of three kinds of contig.
_SAM = """h AS (SELECT l_orderkey * 8 + l_linenumber AS id, CASE WHEN l_linenumber < 5 THEN 'chr' || (l_suppkey % 25 + 1) WHEN l_linenumber = 5 THEN 'NC_0609' || (l_suppkey % 40 + 20) || '.1'
 ELSE 'chr1_ALT' || l_suppkey END AS rname, CASE WHEN l_linestatus = 'O' THEN 0 ELSE 16 END AS flag, 'Query_' || l_suppkey AS qname, l_partkey AS pos, CASE WHEN l_tax < 0.06 THEN 255 ELSE 60 END AS mapq,
 l_linenumber::BIGINT AS lead, l_quantity::BIGINT AS m, (l_suppkey % 3 + 1)::BIGINT AS i, (l_suppkey % 5 + 1)::BIGINT AS d, (l_partkey % 11 + 1)::BIGINT AS tail,
 round(l_extendedprice)::BIGINT::DOUBLE AS score, 90 + round(l_discount * 100) AS identity FROM lineitem)"""


def _sam(spark, sf):
    line = A.table(spark, sf, "lineitem")
    supp, no = F.col("l_suppkey"), F.col("l_linenumber")
    rname = (F.when(no < 5, F.concat(F.lit("chr"), supp % 25 + 1)).when(no == 5, F.concat(F.lit("NC_0609"), supp % 40 + 20, F.lit(".1")))
             .otherwise(F.concat(F.lit("chr1_ALT"), supp)))
    cigar = F.concat(no, F.lit("H"), F.col("l_quantity").cast("bigint"), F.lit("M"), supp % 3 + 1, F.lit("I"), supp % 5 + 1, F.lit("D"), F.col("l_partkey") % 11 + 1, F.lit("H"))
    lines = line.select(F.concat_ws("\t", rname, F.when(F.col("l_linestatus") == "O", 0).otherwise(16), F.concat(F.lit("Query_"), supp), "l_partkey",
                                    F.when(F.col("l_tax") < 0.06, 255).otherwise(60), cigar, F.lit("*"),
                                    F.concat(F.lit("AS:i:"), F.round("l_extendedprice").cast("bigint")), F.concat(F.lit("PI:f:"), 90 + F.round(F.col("l_discount") * 100).cast("int"))).alias("v"))
    return SA.read_blast_sam(spark, _written(lines.unionByName(spark.range(1).select(F.lit("@HD\tVN:1").alias("v"))), spark))


@query(f"""WITH {_SAM} SELECT 'Query_' || replace(qname, 'Query_', '') AS q, (SELECT max(s_nationkey) + 100 FROM supplier WHERE 'Query_' || s_suppkey = qname)::BIGINT AS qlen, pos - 1 AS qs, pos - 1 + m + d AS qe,
CASE WHEN flag = 0 THEN '+' ELSE '-' END AS strand, rname AS r, lead + m + i + tail AS rlen, CASE WHEN flag = 0 THEN lead ELSE tail END AS rs,
CASE WHEN flag = 0 THEN lead ELSE tail END + m + i AS re, m AS match, greatest(m + i, m + d) AS alen, 60 AS mapq, identity,
lead || 'H' || m || 'M' || i || 'I' || d || 'D' || tail || 'H' AS cigar FROM h""")
def sam_to_paf(spark, sf):
    sizes = A.table(spark, sf, "supplier").select(F.concat(F.lit("Query_"), "s_suppkey").alias("name"), (F.col("s_nationkey") + 100).cast("bigint").alias("length"))
    return SA.sam_to_paf(_sam(spark, sf), sizes)


@query(f"""WITH {_SAM} SELECT rname, qname, pos, score FROM h WHERE identity >= 95 AND mapq = 255 AND (rname IN (SELECT 'chr' || x FROM range(1, 23) t(x))
OR rname IN (SELECT 'NC_0609' || x || '.1' FROM range(25, 49) t(x)) OR rname IN (SELECT 'chr1_ALT' || s_suppkey FROM supplier WHERE s_nationkey < 12))""")
def blast_valid_hits(spark, sf):
    others = A.table(spark, sf, "supplier").where("s_nationkey < 12").select(F.concat(F.lit("chr1_ALT"), "s_suppkey").alias("contig"))
    return SA.valid_hits(_sam(spark, sf), others).select("rname", "qname", "pos", "score")


@query(f"WITH {_SAM} SELECT rname, qname, pos, score FROM h WHERE score > 30000 AND identity > 95")
def blast_strong_hits(spark, sf):
    return SA.strong_hits(_sam(spark, sf), 30000).select("rname", "qname", "pos", "score")


@query(f"WITH {_SAM} SELECT coalesce(s_name, qname) AS qname, count(*) AS n FROM h LEFT JOIN supplier ON 'Query_' || s_suppkey = qname AND s_suppkey > 5 GROUP BY 1")
def query_names_restored(spark, sf):
    names = A.table(spark, sf, "supplier").where("s_suppkey > 5").select(F.col("s_suppkey").alias("ordinal"), F.col("s_name").alias("name"))
    return SA.restored_names(_sam(spark, sf), names).groupBy("qname").agg(F.count(F.lit(1)).alias("n"))


# Orders per nation and priority: a small square matrix made symmetric.
_MATRIX = """c AS (SELECT c_nationkey AS a, o_custkey % 25 AS b, count(*)::DOUBLE / 7 AS v FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
u AS (SELECT least(a, b)::BIGINT AS i, greatest(a, b)::BIGINT AS j, sum(v) AS v FROM c GROUP BY 1, 2)"""


def _matrix(spark, sf):
    rows = A.table(spark, sf, "orders").join(A.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    counted = rows.groupBy(F.col("c_nationkey").cast("bigint").alias("a"), (F.col("o_custkey") % 25).alias("b")).agg((F.count(F.lit(1)) / 7.0).alias("v"))
    return counted.groupBy(F.least("a", "b").alias("i"), F.greatest("a", "b").alias("j")).agg(F.sum("v").alias("v"))


@query(f"WITH {_MATRIX} SELECT i, j, round(v, 6) AS v FROM u UNION ALL SELECT j, i, round(v, 6) FROM u WHERE i <> j")
def matrix_symmetric(spark, sf):
    return FI.symmetric(_matrix(spark, sf)).withColumn("v", F.round("v", 6))


@query(f"""WITH {_MATRIX}, s AS (SELECT i, j, v FROM u UNION ALL SELECT j, i, v FROM u WHERE i <> j)
SELECT a.x AS i, b.x AS j, round(coalesce(v, 0), 3) AS v FROM range(25) a(x) CROSS JOIN range(25) b(x) LEFT JOIN s ON i = a.x AND j = b.x""")
def matrix_text_round_trip(spark, sf):
    lines = ST.matrix_rows(FI.symmetric(_matrix(spark, sf)), 25).orderBy("i").coalesce(1).select("line")
    return ST.read_matrix(spark, _written(lines, spark)).withColumn("v", F.round("v", 3))


@query("""SELECT 'S' AS kind, s_suppkey::VARCHAR AS name, repeat('AC', (s_nationkey + 1)::INT) AS body, s_name AS extra, NULL::BIGINT AS aligned FROM supplier UNION ALL
SELECT 'L', c_custkey::VARCHAR, '>s_' || c_nationkey, c_nationkey || 'M', c_custkey FROM customer""")
def linear_graph_round_trip(spark, sf):
    supplier, customer = A.table(spark, sf, "supplier"), A.table(spark, sf, "customer")
    segments = supplier.select(F.col("s_suppkey").cast("string").alias("name"), F.expr("repeat('AC', s_nationkey + 1)").alias("seq"), F.lit("1;2;").alias("orders"), F.col("s_name").alias("origin"))
    paths = customer.select(F.col("c_custkey").cast("string").alias("allele"), F.concat(F.lit(">s_"), "c_nationkey").alias("names"), F.concat("c_nationkey", F.lit("M")).alias("cigar"),
                            F.col("c_custkey").alias("aligned"), F.lit(0).alias("left"), F.lit(3).alias("right"))
    path = scratch_path(spark)
    ST.write_linear_graph(segments, paths, path)
    s, p = ST.read_linear_graph(spark, path)
    return s.select(F.lit("S").alias("kind"), "name", F.col("seq").alias("body"), F.col("origin").alias("extra"), F.lit(None).cast("bigint").alias("aligned")).unionByName(
        p.select(F.lit("L").alias("kind"), F.col("allele").alias("name"), F.col("names").alias("body"), F.col("cigar").alias("extra"), "aligned"))


@query("""SELECT n_nationkey::DOUBLE AS score, 'AC' || repeat('-', n_regionkey) || 'GT' AS query, 'ACGT' || repeat('T', n_regionkey) AS ref FROM nation""")
def pair_alignment_round_trip(spark, sf):
    nation = A.table(spark, sf, "nation")
    text = F.concat(F.lit("# Score: "), "n_nationkey", F.lit("\nq 1 AC"), F.expr("repeat('-', n_regionkey)"), F.lit(" 2\nr 1 ACG 3\n\nq 3 GT 4\nr 4 T"), F.expr("repeat('T', n_regionkey)"), F.lit(" 9\n"))
    path = scratch_path(spark)
    nation.select("n_nationkey", text.alias("v")).write.partitionBy("n_nationkey").text(path)
    return SA.read_pair_alignments(spark, path + "/*").select("score", "query", "ref")


@query("SELECT s_name AS sample, CASE WHEN s_nationkey < 10 THEN '/data/' || s_suppkey || '.fa' ELSE 'none' END AS source FROM supplier")
def manifest_lookup(spark, sf):
    supplier = A.table(spark, sf, "supplier")
    lines = supplier.where("s_nationkey < 10").select(F.concat(F.translate("s_name", " ", "_"), F.lit("  /data/"), "s_suppkey", F.lit(".fa")).alias("v"))
    return ST.with_source(supplier.select(F.col("s_name").alias("sample")), ST.read_manifest(spark, _written(lines, spark)), default="none")


@query("SELECT DISTINCT '/data/' || c_mktsegment AS path FROM customer")
def path_list_round_trip(spark, sf):
    lines = A.table(spark, sf, "customer").select(F.concat(F.lit(" /data/"), "c_mktsegment", F.lit(" ")).alias("v"))
    return ST.read_path_list(spark, _written(lines, spark)).distinct()


@query("SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def report_round_trip(spark, sf):
    rows = A.table(spark, sf, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    path = scratch_path(spark)
    ST.write_report(rows, path)
    return ST.read_tabbed(spark, path, rows.schema)


@query("""SELECT n_name AS leaf, round(n_regionkey / 10.0 + 0.5, 6) AS length FROM nation UNION ALL SELECT 'x' || n_nationkey, 0.25 FROM nation""")
def newick_leaves(spark, sf):
    nation = A.table(spark, sf, "nation")
    text = F.concat(F.lit("(("), "n_name", F.lit(":"), F.col("n_regionkey") / 10.0 + 0.5, F.lit(",x"), "n_nationkey", F.lit(":0.25):0.125,y:1.0);"))
    path = scratch_path(spark)
    nation.select("n_nationkey", text.alias("v")).write.partitionBy("n_nationkey").text(path)
    return ST.read_newick(spark, path + "/*").where("leaf IS NOT NULL AND leaf <> 'y'").select("leaf", F.round("length", 6).alias("length"))


_WEIGHT = """w AS (SELECT l_orderkey * 8 + l_linenumber AS id, CASE WHEN l_suppkey % 3 = 0 THEN 'G_1_HG' || l_suppkey || '_h1' WHEN l_suppkey % 3 = 1 THEN 'G_1_KI' || l_suppkey || 'v1' ELSE 'G_1_x' END AS name,
 CASE l_linenumber WHEN 1 THEN 'chr1' WHEN 2 THEN 'NC_060925.1' WHEN 3 THEN 'chr1_KI2v1_alt' WHEN 4 THEN 'chr2v1' ELSE 'chrX' END AS contig, (l_quantity::BIGINT - 5) AS score FROM lineitem)"""


@query(f"""WITH {_WEIGHT} SELECT id, score * CASE WHEN contains(split_part(name, '_', 3), 'v') THEN CASE WHEN contains(contig, 'NC_0609') THEN 0.000001 WHEN contains(contig, '_') OR contains(contig, 'v') THEN 0 ELSE 1 END
ELSE CASE WHEN contains(contig, 'NC_0609') THEN 1 WHEN contains(contig, '_') OR contains(contig, 'v') THEN 0.9 ELSE 1 END END::DOUBLE AS weighted
FROM w WHERE score > 0 AND NOT (contains(contig, '_') AND NOT contains(contig, 'NC_0609') AND NOT contains(name, '_h'))""")
def location_weights(spark, sf):
    supp, no = F.col("l_suppkey"), F.col("l_linenumber")
    name = (F.when(supp % 3 == 0, F.concat(F.lit("G_1_HG"), supp, F.lit("_h1"))).when(supp % 3 == 1, F.concat(F.lit("G_1_KI"), supp, F.lit("v1"))).otherwise("G_1_x"))
    contig = F.when(no == 1, "chr1").when(no == 2, "NC_060925.1").when(no == 3, "chr1_KI2v1_alt").when(no == 4, "chr2v1").otherwise("chrX")
    weighted = FI.location_score(name, contig, F.col("l_quantity").cast("bigint") - 5)
    return A.table(spark, sf, "lineitem").select((F.col("l_orderkey") * 8 + no).alias("id"), weighted.cast("double").alias("weighted")).where("weighted IS NOT NULL")


@query("""SELECT l_orderkey * 8 + l_linenumber AS id FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE least(l_partkey + l_quantity::BIGINT, o_custkey + 900) > greatest(l_partkey, o_custkey) AND l_quantity::BIGINT - l_linenumber >= 0.9 * l_quantity::BIGINT""")
def exon_hits_inside(spark, sf):
    size = F.col("l_quantity").cast("bigint")
    hits = A.table(spark, sf, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), "l_orderkey", F.col("l_partkey").alias("start"),
                                                 (F.col("l_partkey") + size).alias("end"), size.alias("size"), (size - F.col("l_linenumber")).alias("match"))
    regions = A.table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("r_start"), (F.col("o_custkey") + 900).alias("r_end"))
    return FI.hits_inside(hits, regions, "l_orderkey").select("id")


_SUPPORT = """s AS (SELECT l_orderkey AS allele, l_linenumber * 10000000000 + l_partkey * 1000 + l_suppkey AS ord, 'G' || (l_partkey % 9) AS gene, 88 + round(l_discount * 100) AS percent, CASE WHEN l_returnflag = 'N' THEN 'protein_coding' ELSE 'lncRNA' END AS kind FROM lineitem)"""


def _support(spark, sf):
    return A.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("allele"),
        (F.col("l_linenumber").cast("bigint") * 10_000_000_000 + F.col("l_partkey") * 1000 + F.col("l_suppkey")).alias("ord"), F.concat(F.lit("G"), F.col("l_partkey") % 9).alias("gene"),
        (88 + F.round(F.col("l_discount") * 100)).alias("percent"), F.when(F.col("l_returnflag") == "N", "protein_coding").otherwise("lncRNA").alias("kind"))


@query(f"""WITH {_SUPPORT}, g AS (SELECT * FROM s WHERE percent > 90 AND kind = 'protein_coding')
SELECT allele, ord, gene, percent, kind FROM g UNION ALL
SELECT allele, ord, gene, percent, kind FROM s WHERE allele NOT IN (SELECT allele FROM g) QUALIFY row_number() OVER (PARTITION BY allele ORDER BY ord) = 1""")
def coding_support(spark, sf):
    return FI.coding_support(_support(spark, sf), "allele", "ord")


@query(f"""WITH {_SUPPORT}, m AS (SELECT allele, gene || CASE WHEN percent > 90 THEN '' ELSE '(Partial)' END AS gene, ord FROM s),
c AS (SELECT allele, gene, count(*) AS n, min(ord) AS o FROM m GROUP BY ALL) SELECT allele, string_agg(gene || ':' || n, ';' ORDER BY n DESC, o) AS genes FROM c GROUP BY allele""")
def partial_gene_counts(spark, sf):
    return FI.partial_counts(_support(spark, sf), "allele", "gene", "percent", "ord")


@query("""WITH t AS (SELECT l_orderkey * 8 + l_linenumber AS id, repeat('-', l_linenumber) || repeat('A', (l_partkey % 5 + 1)::INT) || repeat('-', (l_suppkey % 4)::INT) || repeat('C', 6) AS s, l_partkey % 5 + 1 AS a,
 l_linenumber AS g1, l_suppkey % 4 AS g2, (l_orderkey % 7)::INT AS p FROM lineitem)
SELECT id, (p + g1 + CASE WHEN p >= a THEN g2 ELSE 0 END)::INT AS gapped, (p + 1 + g1 + CASE WHEN p >= a THEN g2 ELSE 0 END)::INT AS gapped_end FROM t""")
def gapped_positions(spark, sf):
    text = F.expr("concat(repeat('-', l_linenumber), repeat('A', cast(l_partkey % 5 + 1 as int)), repeat('-', cast(l_suppkey % 4 as int)), repeat('C', 6))")
    place = (F.col("l_orderkey") % 7).cast("int")
    return A.table(spark, sf, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), FI.gapped_position(text, place).alias("gapped"),
                                                 FI.gapped_position(text, place + 1, end=True).alias("gapped_end"))


@query("""WITH p AS (SELECT c_custkey AS name, c_nationkey AS contig, c_custkey % 1000 AS s, c_custkey % 1000 + 40 AS e, (c_custkey % 41)::BIGINT AS ins FROM customer WHERE c_acctbal > 0),
r AS (SELECT s_suppkey AS ref, s_nationkey AS contig, (s_suppkey * 37) % 1000 AS s, (s_suppkey * 37) % 1000 + 60 AS e FROM supplier),
f AS (SELECT p.name, p.ins, (SELECT min(ref) FROM r WHERE r.contig = p.contig AND r.s < p.e AND p.s < r.e) AS ref FROM p)
SELECT c_custkey AS name, ref, CASE WHEN f.name IS NULL THEN 'Novel(unmap)' WHEN ref IS NULL THEN 'Novel(trans)' WHEN ins < 20 THEN 'Mutate' ELSE 'Novel(insert)' END AS kind
FROM customer LEFT JOIN f ON f.name = c_custkey""")
def liftover_outcomes(spark, sf):
    customer = A.table(spark, sf, "customer")
    at = F.col("c_custkey") % 1000
    placed = customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("name"), F.col("c_nationkey").alias("contig"), at.alias("start"), (at + 40).alias("end"),
                                                    (F.col("c_custkey") % 41).alias("inserted"), F.lit(40).alias("size"))
    from_ = (F.col("s_suppkey") * 37) % 1000
    refs = A.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("ref_id"), F.col("s_nationkey").alias("contig"), from_.alias("r_start"), (from_ + 60).alias("r_end"))
    found = I.first_overlap(placed, refs, ["contig"], "name", "ref_id", levels=12, out="ref").select("name", "ref", "inserted", "size")
    return customer.select(F.col("c_custkey").alias("name")).join(found, "name", "left").select(
        "name", "ref", FI.liftover_kind(F.col("ref"), F.col("inserted"), F.col("size")).alias("kind"))


@query("SELECT user_id, event_type, min(event_id) AS first FROM events GROUP BY ALL")
def ordered_distinct(spark, sf):
    return FI.ordered_distinct(A.table(spark, sf, "events"), ["user_id", "event_type"], "event_id")
