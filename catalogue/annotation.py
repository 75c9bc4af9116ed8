"""Summary, roll-up, exon and join queries of the annotation stage."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import query
from catalogue.fragments import IVL
from weftline import adapters as A
from weftline.operators import annotate as N


@query("""SELECT user_id, string_agg(event_type, ';' ORDER BY event_type) AS names FROM events GROUP BY user_id""")
def gene_list_agg(spark, sf):
    return N.sorted_names(A.table(spark, sf, "events"), "user_id", "event_type")


@query("""WITH c AS (SELECT user_id, event_type, count(*) AS n, min(event_id) AS o FROM events GROUP BY ALL)
SELECT user_id, string_agg(event_type || ':' || n, ';' ORDER BY -n, o) AS names FROM c GROUP BY user_id""")
def gene_counter(spark, sf):
    return N.counted_names(A.table(spark, sf, "events"), "user_id", "event_type", "event_id")


_MEMBERS = """mem AS (SELECT l_partkey AS type, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS ord,
 CASE l_returnflag WHEN 'A' THEN 'Pri' WHEN 'N' THEN 'Dup' ELSE 'Novel' END AS tag, 'g' || l_suppkey // 10 AS gene, 'r' || l_suppkey // 25 AS ref,
 CASE WHEN l_discount > 0.07 THEN 'Exon' WHEN l_discount > 0.04 THEN 'Decoy' ELSE 'Intron' END AS exon, l_quantity::BIGINT AS kmers,
 l_linestatus AS note FROM lineitem)"""


def _mode(field: str) -> str:
    return f"""m_{field} AS (SELECT type, arg_min({field}, (-n, o)) AS {field} FROM
 (SELECT type, {field}, count(*) AS n, min(ord) AS o FROM mem GROUP BY type, {field}) GROUP BY type)"""


def _members(spark, sf):
    line = A.table(spark, sf, "lineitem")
    flag, disc = F.col("l_returnflag"), F.col("l_discount")
    order = (((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 100000000) + F.col("l_partkey") * 1000 + F.col("l_suppkey"))
    return line.select(
        F.col("l_partkey").alias("type"), order.alias("ord"),
        F.when(flag == "A", "Pri").when(flag == "N", "Dup").otherwise("Novel").alias("tag"),
        F.concat(F.lit("g"), F.floor(F.col("l_suppkey") / 10)).alias("gene"),
        F.concat(F.lit("r"), F.floor(F.col("l_suppkey") / 25)).alias("ref"),
        F.when(disc > 0.07, "Exon").when(disc > 0.04, "Decoy").otherwise("Intron").alias("exon"),
        F.col("l_quantity").cast("bigint").alias("kmers"), F.col("l_linestatus").alias("note"))


@query(f"""WITH {_MEMBERS}, {_mode('gene')}, {_mode('ref')}, {_mode('note')},
b AS (SELECT type, CASE WHEN max(CASE WHEN exon = 'Exon' THEN 1 ELSE 0 END) = 1 THEN 'Exon' WHEN max(CASE WHEN exon = 'Decoy' THEN 1 ELSE 0 END) = 1
 THEN 'Decoy' ELSE 'Intron' END AS exon, min(kmers) AS kmers, count(*) AS size FROM mem GROUP BY type),
t AS (SELECT type, string_agg(tag, ';' ORDER BY -n, o) AS tags FROM (SELECT type, tag, count(*) AS n, min(ord) AS o FROM mem GROUP BY type, tag) GROUP BY type)
SELECT * FROM b JOIN m_gene USING (type) JOIN m_ref USING (type) JOIN m_note USING (type) JOIN t USING (type)""")
def type_rollup(spark, sf):
    return N.type_rollup(_members(spark, sf))


@query(f"""WITH {_MEMBERS}, {_mode('tag')} SELECT type, CASE WHEN bool_or(mem.tag = 'Ref') THEN 'Ref' ELSE any_value(m_tag.tag) END AS tag,
CASE WHEN bool_or(exon = 'Exon') THEN 'Exon' ELSE 'Intron' END AS exon FROM mem JOIN m_tag USING (type) GROUP BY type""")
def type_annotation(spark, sf):
    return N.annotate_types(_members(spark, sf))


@query("""WITH s AS (SELECT p_brand AS type, l_partkey AS member, CASE WHEN l_returnflag = 'A' THEN 'Deletion' ELSE 'Insertion' END AS kind,
 l_linenumber::BIGINT AS size, ((l_orderkey * 8 + l_linenumber) * 100000000 + l_partkey * 1000 + l_suppkey) AS o
 FROM lineitem JOIN part ON l_partkey = p_partkey),
m AS (SELECT type, member, list_sort(list((kind, size))) AS v, string_agg(kind, ';' ORDER BY kind) AS sig, min(o) AS o FROM s GROUP BY type, member),
b AS (SELECT type, arg_min(sig, (-n, o)) AS sig FROM (SELECT type, sig, count(*) AS n, min(o) AS o FROM m GROUP BY type, sig) GROUP BY type),
x AS (SELECT type, unnest(v) AS e, unnest(range(len(v))) AS p FROM m JOIN b USING (type, sig)),
z AS (SELECT type, p, e[1] AS k, e[2] AS s, count(*) AS n FROM x GROUP BY ALL),
w AS (SELECT type, p, k, arg_min(s, (-n, s)) AS s FROM z GROUP BY type, p, k)
SELECT type, string_agg(k || '(' || s || ')', ';' ORDER BY p, k) AS signature FROM w GROUP BY type""")
def sv_signature(spark, sf):
    line = A.table(spark, sf, "lineitem")
    svs = line.join(A.table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_brand").alias("type"), F.col("l_partkey").alias("member"),
        F.when(F.col("l_returnflag") == "A", "Deletion").otherwise("Insertion").alias("kind"),
        F.col("l_linenumber").cast("bigint").alias("size"),
        ((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 100000000 + F.col("l_partkey") * 1000 + F.col("l_suppkey")).alias("o"))
    return N.signature_mode(svs, "type", "member", "kind", "size", "o")


@query("""WITH a AS (SELECT c_custkey AS name, c_nationkey FROM customer),
m AS (SELECT o_custkey AS name, arg_max(o_orderpriority, o_orderkey) AS note, arg_max(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY 1),
g AS (SELECT o_custkey AS name, count(*) AS n_lines, sum(l_quantity)::BIGINT AS copies FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1),
e AS (SELECT user_id AS name, string_agg(event_type, ';' ORDER BY event_type) AS exons FROM events GROUP BY 1)
SELECT name, c_nationkey, coalesce(note, 'NA') AS note, coalesce(status, 'NA') AS status, coalesce(n_lines, 0)::BIGINT AS n_lines,
coalesce(copies, 3000)::BIGINT AS copies, coalesce(exons, 'NA') AS exons FROM a LEFT JOIN m USING (name) LEFT JOIN g USING (name) LEFT JOIN e USING (name)""")
def allele_summary(spark, sf):
    orders = A.table(spark, sf, "orders")
    alleles = A.table(spark, sf, "customer").select(F.col("c_custkey").alias("name"), "c_nationkey")
    match = N.last_written(orders.select(F.col("o_custkey").alias("name"), "o_orderkey", F.col("o_orderpriority").alias("note"),
                                         F.col("o_orderstatus").alias("status")), "name", "o_orderkey")
    copies = (orders.join(A.table(spark, sf, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
              .groupBy(F.col("o_custkey").alias("name")).agg(F.count(F.lit(1)).alias("n_lines"),
                                                             F.sum("l_quantity").cast("bigint").alias("copies")))
    exons = N.sorted_names(A.table(spark, sf, "events").select(F.col("user_id").alias("name"), "event_type"), "name", "event_type", "exons")
    return N.summarise_alleles(alleles, [(match, {"note": "NA", "status": "NA"}), (copies, {"n_lines": 0, "copies": 3000}),
                                         (exons, {"exons": "NA"})])


@query("""WITH l AS (SELECT o_orderkey AS name, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_custkey * 3 END AS ref, o_totalprice AS locus FROM orders)
SELECT a.name, a.ref, coalesce(b.ref, a.ref) AS final, coalesce(c.locus, b.locus) AS final_value
FROM l a LEFT JOIN l b ON b.name = a.ref LEFT JOIN l c ON c.name = b.ref""")
def two_hop_lookup(spark, sf):
    links = A.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("name"), F.when(F.col("o_orderstatus") != "F", F.col("o_custkey") * 3).alias("ref"),
        F.col("o_totalprice").alias("locus"))
    return N.two_hop(links)


@query("""WITH a AS (SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS ordinal FROM customer),
b AS (SELECT p_partkey, row_number() OVER (ORDER BY p_retailprice, p_partkey) AS ordinal FROM part)
SELECT ordinal, c_custkey, p_partkey FROM a FULL JOIN b USING (ordinal)""")
def positional_join(spark, sf):
    return N.positional_join(A.table(spark, sf, "customer").select("c_custkey", "c_acctbal"),
                             A.table(spark, sf, "part").select("p_partkey", "p_retailprice"),
                             ["c_acctbal", "c_custkey"], ["p_retailprice", "p_partkey"]).select("ordinal", "c_custkey", "p_partkey")


@query("""WITH d AS (SELECT DISTINCT l_suppkey, p_brand || CASE WHEN p_size > 40 THEN '-' || p_size ELSE '' END AS gene FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT l_suppkey, string_agg(gene, ';' ORDER BY gene) AS genes FROM d
WHERE NOT (contains(gene, '-') AND EXISTS (SELECT 1 FROM d x WHERE x.l_suppkey = d.l_suppkey AND x.gene = split_part(d.gene, '-', 1))) GROUP BY l_suppkey""")
def gene_tag_cleanup(spark, sf):
    gene = F.concat("p_brand", F.when(F.col("p_size") > 40, F.concat(F.lit("-"), F.col("p_size"))).otherwise(""))
    rows = A.table(spark, sf, "lineitem").join(A.table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return N.sorted_names(N.unshadowed(rows.select("l_suppkey", gene.alias("gene")), "l_suppkey", "gene"), "l_suppkey", "gene", "genes")


@query("""WITH d AS (SELECT DISTINCT l_suppkey, p_name AS gene, NOT contains(p_name, (l_suppkey % 10)::VARCHAR) AS late FROM lineitem JOIN part ON l_partkey = p_partkey),
r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY late, gene) AS k FROM d)
SELECT l_suppkey, string_agg(gene, 'OOO' ORDER BY k) AS tag FROM r WHERE k <= 3 GROUP BY l_suppkey""")
def top_gene_tag(spark, sf):
    rows = A.table(spark, sf, "lineitem").join(A.table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
        "l_suppkey", F.col("p_name").alias("gene"), (F.col("l_suppkey") % 10).cast("string").alias("prefix"))
    return N.top_names(rows, "l_suppkey", "gene", "prefix")


@query(f"""WITH {IVL}, n AS (SELECT l_partkey, contig, count(*) AS c FROM ivl GROUP BY ALL),
v AS (SELECT p_brand AS type, l_partkey AS member, contig AS axis, c FROM n JOIN part ON p_partkey = l_partkey),
o AS (SELECT type, member, sum(c * c) AS own FROM v GROUP BY ALL),
p AS (SELECT x.type, x.member AS i, y.member AS j, x.own + y.own AS total FROM o x JOIN o y ON x.type = y.type AND x.member < y.member),
d AS (SELECT a.type, a.member AS i, b.member AS j, sum(a.c * b.c) AS dot FROM v a JOIN v b ON a.type = b.type AND a.axis = b.axis AND a.member < b.member GROUP BY ALL)
SELECT type, greatest(max(total - 2 * coalesce(dot, 0)), 60)::DOUBLE AS largest FROM p LEFT JOIN d USING (type, i, j) GROUP BY type""")
def type_largest_distance(spark, sf):
    counts = A.intervals(spark, sf).groupBy("l_partkey", "contig").agg(F.count(F.lit(1)).alias("c"))
    rows = counts.join(A.table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("type")), "l_partkey")
    return N.largest_within(rows, "type", "l_partkey", "contig", "c", 60.0).select("type", F.col("largest").cast("double").alias("largest"))
