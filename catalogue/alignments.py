"""Alignment-string, location and attribute queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import query
from catalogue.fragments import IVL, SEQS, bases
from weftline import adapters as A
from weftline.functions import attrs as T, cigar as C, locus as L, sequence as S
from weftline.operators import alignments as AL, matching as M
from weftline.operators.scan import prefix_scan
from weftline.sources import records as R

_ID = "(l_orderkey * 8 + l_linenumber) * 100000000 + l_partkey * 1000 + l_suppkey"
_CIGAR = f"""cg AS (SELECT {_ID} AS id, l_quantity::BIGINT AS q, l_linenumber::BIGINT AS ln, round(l_discount * 100)::BIGINT + 1 AS x,
 round(l_tax * 100)::BIGINT + 1 AS t, l_partkey % 60 AS qstart, l_partkey % 60 + l_suppkey % 40 + 1 AS qend FROM lineitem),
ops AS (SELECT id, qstart, qend, unnest([0, 1, 2, 3, 4]) AS idx, unnest([q, ln, x, t * 7, q + 3]) AS len, unnest(['M', 'D', 'X', 'I', '=']) AS op FROM cg),
po AS (SELECT *, CASE WHEN op = 'I' THEN 0 ELSE len END AS ql, CASE WHEN op = 'D' THEN 0 ELSE len END AS rl FROM ops),
pp AS (SELECT *, sum(ql) OVER w - ql AS qb, sum(ql) OVER w AS qe, sum(rl) OVER w - rl AS rb, sum(rl) OVER w AS re FROM po
 WINDOW w AS (PARTITION BY id ORDER BY idx))"""


def _cigars(spark, sf):
    line = A.table(spark, sf, "lineitem")
    qty = F.col("l_quantity").cast("bigint")
    x = F.round(F.col("l_discount") * 100).cast("bigint") + 1
    t = (F.round(F.col("l_tax") * 100).cast("bigint") + 1) * 7
    ident = ((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 100000000 + F.col("l_partkey") * 1000 + F.col("l_suppkey"))
    return line.select(
        ident.alias("id"),
        F.concat(qty, F.lit("M"), F.col("l_linenumber"), F.lit("D"), x, F.lit("X"), t, F.lit("I"), qty + 3, F.lit("=")).alias("cigar"),
        (F.col("l_partkey") % 60).alias("qstart"),
        (F.col("l_partkey") % 60 + F.col("l_suppkey") % 40 + 1).alias("qend"))


@query(f"""WITH {_CIGAR} SELECT id, sum(CASE WHEN op IN ('M', 'X', 'I', '=') THEN len ELSE 0 END)::BIGINT AS r_size,
sum(CASE WHEN op IN ('M', 'X', 'D', '=') THEN len ELSE 0 END)::BIGINT AS q_size, 0::BIGINT AS clipped FROM ops GROUP BY id""")
def cigar_sizes(spark, sf):
    ops = _cigars(spark, sf).select("id", C.parse(F.col("cigar")).alias("ops"))
    r, q, h = C.hit_sizes(F.col("ops"))
    return ops.select("id", r.alias("r_size"), q.alias("q_size"), h.alias("clipped"))


def _score(divisor: int) -> str:
    return f"""sum(CASE op WHEN 'M' THEN len WHEN '=' THEN len WHEN 'X' THEN -20 * len WHEN 'D' THEN -(len + 20)
 ELSE -(len // {divisor} + 20) END)::BIGINT"""


@query(f"""WITH {_CIGAR} SELECT id, {_score(10)} AS chain_score, {_score(2)} AS map_score FROM ops GROUP BY id""")
def cigar_score(spark, sf):
    ops = _cigars(spark, sf).select("id", C.parse(F.col("cigar")).alias("ops"))
    return ops.select("id", C.score(F.col("ops"), 10).alias("chain_score"), C.score(F.col("ops"), 2).alias("map_score"))


@query(f"""WITH {_CIGAR} SELECT id,
coalesce(min(CASE WHEN qb <= qstart THEN CASE WHEN op IN ('M', '=', 'X') THEN rb + qstart - qb ELSE re END END), -1)::BIGINT AS rstart,
coalesce(max(CASE WHEN qe >= qend THEN CASE WHEN op IN ('M', '=', 'X') THEN re - (qe - qend) ELSE re END END), -1)::BIGINT AS rend,
string_agg((CASE WHEN ql = 0 THEN len ELSE least(qe, qend) - greatest(qb, qstart) END)::BIGINT::VARCHAR || op, '' ORDER BY idx) AS cigar
FROM pp WHERE qe > qstart AND qb < qend GROUP BY id""")
def cigar_slice(spark, sf):
    return AL.slice_by_query(_cigars(spark, sf), "id")


@query(f"""WITH {_CIGAR} SELECT id, string_agg(len::VARCHAR || CASE op WHEN 'I' THEN 'D' WHEN 'D' THEN 'I' ELSE op END, '' ORDER BY idx) AS swapped FROM ops GROUP BY id""")
def cigar_swap_sides(spark, sf):
    return _cigars(spark, sf).select("id", C.swap_sides(F.col("cigar")).alias("swapped"))


@query(f"""WITH {_CIGAR}, a AS (SELECT id, max(re) AS total FROM pp GROUP BY id)
SELECT id, string_agg((CASE WHEN rl = 0 THEN len ELSE least(re, total - 10) - greatest(rb, 10) END)::BIGINT::VARCHAR || op, '' ORDER BY idx) AS cigar
FROM pp JOIN a USING (id) WHERE CASE WHEN rl = 0 THEN rb > 10 AND rb < total - 10 ELSE re > 10 AND rb < total - 10 END GROUP BY id""")
def cigar_strip_anchors(spark, sf):
    return AL.strip_anchors(_cigars(spark, sf), "id", 10)


_PATH = """pth AS (SELECT o_orderkey AS id, '>s' || o_custkey || ':' || (o_custkey % 700) || 'M4D' || (o_custkey % 9 + 1) || 'I<t' || o_orderpriority[1:1] || ':'
 || (o_orderkey % 500) || '=3X' AS path, o_custkey % 700 AS m1, o_orderkey % 500 AS m2, 's' || o_custkey AS n1, 't' || o_orderpriority[1:1] AS n2,
 o_custkey % 9 + 1 AS ins FROM orders)"""


def _paths(spark, sf):
    cust, order = F.col("o_custkey"), F.col("o_orderkey")
    return A.table(spark, sf, "orders").select(order.alias("id"), F.concat(
        F.lit(">s"), cust, F.lit(":"), cust % 700, F.lit("M4D"), cust % 9 + 1, F.lit("I<t"),
        F.substring("o_orderpriority", 1, 1), F.lit(":"), order % 500, F.lit("=3X")).alias("path"))


@query(f"""WITH {_PATH} SELECT id, CASE WHEN m1 > 300 THEN '>' || n1 ELSE '' END || CASE WHEN m2 > 300 THEN '<' || n2 ELSE '' END AS kept,
'>' || n2 || ':' || m2 || '=3X<' || n1 || ':' || m1 || 'M4D' || ins || 'I' AS reversed,
'>' || n1 || ':' || CASE WHEN m1 > 0 AND m1 < 200 THEN (m1 + ins) || 'H' ELSE m1 || 'M4D' || ins || 'I' END
 || '<' || n2 || ':' || CASE WHEN m2 > 0 AND m2 < 200 THEN (m2 + 3) || 'H' ELSE m2 || '=3X' END AS masked FROM pth""")
def path_segments(spark, sf):
    p = F.col("path")
    return _paths(spark, sf).select("id", C.matched_segments(p).alias("kept"), C.reverse_path(p).alias("reversed"),
                                    C.mask_short_segments(p).alias("masked"))


@query(f"""WITH {IVL}, t AS (SELECT id, 'S' || contig || '#' || l_linenumber || '#ctg' AS name, start - 500 AS s, stop - 500 AS e, strand FROM ivl)
SELECT id, name AS contig, greatest(s, 0)::BIGINT AS start, e::BIGINT AS "end", strand,
(greatest(s, 0) + CASE WHEN strand = '+' THEN 3 ELSE 5 END)::BIGINT AS new_start,
(greatest(s, 0) + 100 - CASE WHEN strand = '+' THEN 5 ELSE 3 END - 1)::BIGINT AS new_end FROM t""")
def locus_parse(spark, sf):
    ivl = A.intervals(spark, sf)
    name = F.concat(F.lit("S"), F.col("contig"), F.lit("#"), F.col("l_linenumber"), F.lit("#ctg"))
    text = L.locus_text(name, F.col("start") - 500, F.col("end") - 500, F.col("strand"))
    parsed = ivl.select("id", L.locus_struct(text).alias("p")).select("id", "p.*")
    first, last = L.trimmed_locus(F.col("start"), F.lit(100), F.col("strand"), F.lit(3), F.lit(5))
    return parsed.withColumn("new_start", first).withColumn("new_end", last)


_NAMES = """CASE WHEN l_linenumber < 4 THEN 'HG' || l_suppkey || '#' || (l_linenumber % 2 + 1) || '#ctg' WHEN l_linenumber < 6 THEN 'NC_0609' || l_suppkey
 WHEN l_linenumber = 6 THEN 'chr' || l_suppkey ELSE 'chr' || l_suppkey || 'v1' END"""


@query(f"""WITH n AS (SELECT l_linenumber, l_suppkey, {_NAMES} AS contig FROM lineitem)
SELECT contig, CASE WHEN l_linenumber < 4 THEN 'HG' || l_suppkey || '_h' || (l_linenumber % 2 + 1) WHEN l_linenumber < 6 THEN 'CHM13_h1' ELSE 'HG38_h1' END AS haplotype,
CASE WHEN l_linenumber < 4 THEN 'Allele' WHEN l_linenumber < 6 THEN 'CHM13' WHEN l_linenumber = 6 THEN 'HG38' ELSE 'Alt' END AS class, count(*) AS n
FROM n GROUP BY ALL""")
def haplotype_of(spark, sf):
    no, supp = F.col("l_linenumber"), F.col("l_suppkey")
    contig = (F.when(no < 4, F.concat(F.lit("HG"), supp, F.lit("#"), no % 2 + 1, F.lit("#ctg")))
              .when(no < 6, F.concat(F.lit("NC_0609"), supp)).when(no == 6, F.concat(F.lit("chr"), supp))
              .otherwise(F.concat(F.lit("chr"), supp, F.lit("v1"))))
    named = A.table(spark, sf, "lineitem").select(contig.alias("contig"))
    return named.select("contig", L.haplotype(F.col("contig")).alias("haplotype"),
                        L.reference_class(F.col("contig")).alias("class")).groupBy(
        "contig", "haplotype", "class").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT event_id, 'G' || user_id AS gene_id, event_type AS gene_name, CASE WHEN event_type = 'click' THEN NULL ELSE event_type END AS single,
json_extract_string(props, '$.k')::BIGINT AS exon_number FROM events""")
def gff_attrs(spark, sf):
    kind, user = F.col("event_type"), F.col("user_id")
    again = F.when(kind == "click", F.concat(F.lit(";gene_name="), kind)).otherwise("")
    text = F.concat(F.lit("ID=x;gene_id=G"), user, F.lit("."), F.col("event_id"), F.lit(";gene_name="), kind, again,
                    F.lit(";exon_number="), F.get_json_object("props", "$.k"))
    at = A.table(spark, sf, "events").select("event_id", text.alias("text")).withColumn("m", T.gff_attributes(F.col("text")))
    return at.select("event_id", T.without_version(F.col("m")["gene_id"]).alias("gene_id"), F.col("m")["gene_name"].alias("gene_name"),
                     T.single_attribute(F.col("text"), "gene_name").alias("single"), F.col("m")["exon_number"].cast("bigint").alias("exon_number"))


@query(f"""WITH l AS (SELECT conv_id, turn, {bases('text')} AS line FROM conversations)
SELECT conv_id, count(*) AS n_lines, sum(length(line))::BIGINT AS len, md5(string_agg(line, '' ORDER BY turn)) AS digest FROM l GROUP BY conv_id""")
def record_assembly(spark, sf):
    lines = A.table(spark, sf, "conversations").select("conv_id", "turn", A.as_bases(F.col("text")).alias("line"))
    whole = R.assemble(lines, ["conv_id"], "turn", "line")
    return whole.select("conv_id", "n_lines", F.length("seq").cast("bigint").alias("len"), F.md5("seq").alias("digest"))


@query(f"""WITH l AS (SELECT conv_id, turn, length({bases('text')}) AS n FROM conversations)
SELECT conv_id, turn, coalesce(sum(n) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset" FROM l""")
def record_offsets(spark, sf):
    lines = A.table(spark, sf, "conversations").select("conv_id", "turn", F.length(A.as_bases(F.col("text"))).alias("n"))
    out = prefix_scan(lines, ["conv_id"], "turn", F.floor(F.col("turn") / 1024), F.col("n").cast("bigint"), "sum", "offset", inclusive=False)
    return out.select("conv_id", "turn", "offset")


@query(f"""WITH {SEQS}, i AS (SELECT doc_id AS name, quality * 7 + doc_id % 50 - 20 AS s, quality * 7 + doc_id % 50 + 60 AS e, CASE WHEN toxic = 1 THEN '-' ELSE '+' END AS strand FROM labels),
x AS (SELECT i.name, strand, substr(seq, greatest(s, 0)::INT + 1, greatest(e - greatest(s, 0), 0)::INT) AS t FROM i JOIN seqs USING (name))
SELECT name, CASE WHEN strand = '-' THEN reverse(translate(t, 'ACGTacgt', 'TGCAtgca')) ELSE t END AS bases FROM x""")
def slice_bases(spark, sf):
    start = F.col("quality") * 7 + F.col("doc_id") % 50 - 20
    asked = A.table(spark, sf, "labels").select(F.col("doc_id").alias("name"), start.alias("s"), (start + 80).alias("e"),
                                                F.when(F.col("toxic") == 1, "-").otherwise("+").alias("strand"))
    return A.sequences(spark, sf).join(asked, "name").select(
        "name", S.slice_bases(F.col("seq"), F.col("s"), F.col("e"), F.col("strand")).alias("bases"))


@query(f"""WITH {IVL}, e AS (SELECT o_custkey % 100 AS contig, date_diff('day', DATE '1992-01-01', o_orderdate::DATE) AS ms,
 date_diff('day', DATE '1992-01-01', o_orderdate::DATE) + 3 AS me FROM orders),
b AS (SELECT *, CASE WHEN ms - max(me) OVER (PARTITION BY contig ORDER BY ms, me ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= 0
 THEN 0 ELSE 1 END AS brk FROM (SELECT DISTINCT contig, ms, me FROM e)),
r AS (SELECT *, sum(brk) OVER (PARTITION BY contig ORDER BY ms, me) AS run FROM b),
m AS (SELECT contig, run, min(ms) AS lo, max(me) AS hi FROM r GROUP BY contig, run),
k AS (SELECT i.id, i.contig, i.stop - i.start - coalesce(sum(CASE WHEN m.lo IS NOT NULL THEN least(i.stop, m.hi) - greatest(i.start, m.lo) END), 0) AS unmasked, i.score, i.stop - i.start AS len
 FROM ivl i LEFT JOIN m ON m.contig = i.contig AND i.start < m.hi AND m.lo < i.stop GROUP BY i.id, i.contig, i.start, i.stop, i.score)
SELECT id, unmasked::BIGINT AS unmasked, (score % 100 > 90 AND ((unmasked > 30 AND score % 997 > 150) OR (score % 997 > 100 AND unmasked > len / 3))) AS keep FROM k""")
def alignment_filter(spark, sf):
    day = A.day_number("o_orderdate")
    masks = A.table(spark, sf, "orders").select((F.col("o_custkey") % 100).alias("contig"), day.alias("start"), (day + 3).alias("end"))
    out = AL.masked_bases(A.intervals(spark, sf), masks, "id", "contig", width=64)
    size = F.col("end") - F.col("start")
    # Lengths here are days: scale so that the published cut of 300 falls at 30.
    kept = AL.keep_alignment((size - F.col("masked")) * 10, F.col("score") % 100, F.col("score") % 997, size * 10)
    return out.select("id", (size - F.col("masked")).alias("unmasked"), kept.alias("keep"))


@query(f"""WITH {IVL} SELECT l_orderkey, arg_min(id, (-score, id)) AS id, max(score) AS score FROM ivl GROUP BY l_orderkey""")
def best_location(spark, sf):
    rows = A.intervals(spark, sf).select("l_orderkey", "id", "score")
    return M.best_per_group(rows, ["l_orderkey"], F.col("score"), "id")


@query(f"""WITH {IVL}, t AS (SELECT l_orderkey, max(score) AS top FROM ivl GROUP BY l_orderkey)
SELECT id, l_orderkey, score FROM ivl JOIN t USING (l_orderkey) WHERE score >= 0.95 * top""")
def within_95pct(spark, sf):
    rows = A.intervals(spark, sf).select("l_orderkey", "id", "score")
    return M.within_fraction_of_best(rows, ["l_orderkey"], "score")


@query(f"""WITH {IVL}, g AS (SELECT id, l_orderkey AS query, score, stop - start AS covered, 25 AS size FROM ivl),
v AS (SELECT * FROM g WHERE covered >= size * 0.5), t AS (SELECT query, max(score) AS top FROM v GROUP BY query),
n AS (SELECT v.* FROM v JOIN t USING (query) WHERE score >= 0.95 * top)
SELECT id, query, count(*) OVER (PARTITION BY query) > 1 AS multi FROM n""")
def mapped_locations(spark, sf):
    rows = A.intervals(spark, sf).select("id", F.col("l_orderkey").alias("query"), "score",
                                         (F.col("end") - F.col("start")).alias("covered"), F.lit(25).alias("size"))
    return AL.mapped_locations(rows).select("id", "query", "multi")


_MATCHES = """m AS (SELECT event_id AS ord, user_id * 1000 + floor(value)::BIGINT AS name, event_type AS hap,
 (event_id * 7919) % 100000 AS ref, value / 100 AS distance FROM events)"""


@query(f"""WITH {_MATCHES}, p AS (SELECT *, lag(name) OVER (ORDER BY ord) AS prev, count(*) OVER (PARTITION BY hap, ref) AS n FROM m)
SELECT DISTINCT name FROM p WHERE name = prev OR n > 1 OR distance > 0.5""")
def uncertain_alleles(spark, sf):
    rows = A.table(spark, sf, "events").select(
        F.col("event_id").alias("ord"), (F.col("user_id") * 1000 + F.floor("value")).alias("name"), F.col("event_type").alias("hap"),
        ((F.col("event_id") * 7919) % 100000).alias("ref"), (F.col("value") / 100).alias("distance"))
    return M.uncertain_alleles(rows, at_most=0.5)
