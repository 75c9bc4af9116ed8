"""Tree, type, gene, alignment and graph queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import query
from catalogue.fragments import DOC_HITS, TARGET_HITS
from catalogue.kmers import _LIST, _hotspot_sql, _informative
from catalogue.pairs import _marked
from weftline import adapters as A
from weftline.operators import aligner as AN, genes as G, graph as R, kmers as K, trees as T
from weftline.plans import annotate as AP, compile as CP, search as SE, select as SL
from weftline.session import cut


_hotspot_cte = "WITH " + _hotspot_sql("th", 50, 1000)


@query(f"""WITH {DOC_HITS}, {_LIST}, f AS (SELECT name, pos FROM hits WHERE kmer IN (SELECT kmer FROM list)),
c AS (SELECT name, pos, lag(pos) OVER (PARTITION BY name ORDER BY pos) AS pp FROM f),
r AS (SELECT *, sum(CASE WHEN pos - pp <= 31 THEN 0 ELSE 1 END) OVER (PARTITION BY name ORDER BY pos) AS g FROM c),
m AS (SELECT name, g, min(pos) AS s, max(pos) + 31 AS e FROM r GROUP BY name, g),
x AS (SELECT name, count(*) AS n_runs, sum(e - s)::BIGINT AS up FROM m GROUP BY name),
cov AS (SELECT DISTINCT name, p FROM (SELECT name, unnest(range(s, e)) AS p FROM m)),
b AS (SELECT name, p, substr(t, (p % 256)::INT + 1, 1) AS ch FROM (SELECT name, t0, t, unnest(range(t0, t0 + length(t))) AS p FROM
 (SELECT name, t0, substr(seq, t0 + 1, 256) AS t FROM (SELECT name, seq, unnest(range(0, length(seq), 256)) AS t0 FROM seqs))))
SELECT b.name, md5(string_agg(CASE WHEN cov.p IS NULL THEN lower(ch) ELSE upper(ch) END, '' ORDER BY b.p)) AS digest
FROM b LEFT JOIN cov ON cov.name = b.name AND cov.p = b.p GROUP BY b.name
UNION ALL SELECT name, md5('') FROM seqs WHERE seq = ''""")
def mask_by_kmers(spark, sf):
    out = K.mask_by_kmers(A.sequences(spark, sf), None, _informative(spark, sf))
    return out.select("name", F.md5("seq").alias("digest"))


@query(f"""WITH {DOC_HITS}, {_LIST}, f AS (SELECT DISTINCT name, pos + 30 AS p FROM hits WHERE kmer IN (SELECT kmer FROM list)),
b AS (SELECT name, p, substr(t, (p % 256)::INT + 1, 1) AS ch FROM (SELECT name, t0, t, unnest(range(t0, t0 + length(t))) AS p FROM
 (SELECT name, t0, substr(seq, t0 + 1, 256) AS t FROM (SELECT name, seq, unnest(range(0, length(seq), 256)) AS t0 FROM seqs))))
SELECT b.name, md5(string_agg(CASE WHEN f.p IS NULL THEN lower(ch) ELSE upper(ch) END, '' ORDER BY b.p)) AS digest
FROM b LEFT JOIN f ON f.name = b.name AND f.p = b.p GROUP BY b.name UNION ALL SELECT name, md5('') FROM seqs WHERE seq = ''""")
def mark_last_bases(spark, sf):
    out = K.mark_last_bases(A.sequences(spark, sf), None, _informative(spark, sf))
    return out.select("name", F.md5("seq").alias("digest"))


def _compiled(spark, sf):
    seqs = A.sequences(spark, sf).withColumn("grp", F.regexp_replace("hap", "[^0-9]", "").cast("bigint"))
    return CP.group_matrices(seqs)


_GROUP = f"""{DOC_HITS}, c AS (SELECT grp_id, name, kmer, count(*) AS c FROM (SELECT regexp_replace(hap, '[^0-9]', '', 'g')::BIGINT AS grp_id, name, kmer FROM hits) GROUP BY ALL),
f AS (SELECT grp_id, kmer, count(*) AS n FROM c GROUP BY ALL),
ix AS (SELECT regexp_replace(hap, '[^0-9]', '', 'g')::BIGINT AS grp_id, name, row_number() OVER (PARTITION BY hap ORDER BY name) - 1 AS idx FROM seqs),
own AS (SELECT grp_id, name, sum(c * c / CASE WHEN n = 1 THEN 20.0 ELSE 1.0 END) AS v FROM c JOIN f USING (grp_id, kmer) GROUP BY ALL),
dot AS (SELECT a.grp_id, a.name AS i, b.name AS j, sum(a.c * b.c)::DOUBLE AS v FROM c a JOIN c b ON a.grp_id = b.grp_id AND a.kmer = b.kmer AND a.name < b.name GROUP BY ALL)"""


@query(f"""WITH {_GROUP} SELECT d.grp_id AS grp, x.idx AS i, y.idx AS j, round(v, 6) AS v FROM dot d JOIN ix x ON x.name = i JOIN ix y ON y.name = j
UNION ALL SELECT own.grp_id, idx, idx, round(v, 6) FROM own JOIN ix USING (name)""")
def norm_matrix(spark, sf):
    return _compiled(spark, sf).entries.withColumn("v", F.round("v", 6))


@query()
def linkage_tree(spark, sf):
    return _compiled(spark, sf).merges()


@query()
def tree_newick(spark, sf):
    made = _compiled(spark, sf)
    return T.trees(made.merges(), made.members).select("grp", "newick", F.array_join("leaves", ",").alias("leaves"))


@query()
def matrix_in_tree_order(spark, sf):
    made = _compiled(spark, sf)
    return CP.reordered(made.norm, made.merges(), made.members)


def _exon_hits(spark, sf):
    """Exon hits on every customer."""
    day = A.day_number("l_shipdate")
    qty = F.col("l_quantity").cast("bigint")
    lines = A.table(spark, sf, "lineitem").join(A.table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    hits = lines.select(
        F.col("o_custkey").alias("allele"), F.col("l_partkey").alias("exon"), (qty * 10).alias("size"),
        (day * 10).alias("start"), (day * 10 + qty * 10).alias("end"),
        F.when(F.col("l_linestatus") == "O", "+").otherwise("-").alias("strand"),
        (qty * 10 - F.round(F.col("l_discount") * 100).cast("bigint")).alias("match"))
    return hits


@query("""WITH h AS (SELECT o_custkey AS allele, l_partkey AS exon, l_quantity::BIGINT * 10 AS size, date_diff('day', DATE '1992-01-01', l_shipdate::DATE) * 10 AS s,
 CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand, l_quantity::BIGINT * 10 - round(l_discount * 100)::BIGINT AS match FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
o AS (SELECT *, s + size AS e, match / size AS r FROM h WHERE size >= least(100.0, size * 0.5)
 QUALIFY row_number() OVER (PARTITION BY allele, exon, s, s + size ORDER BY match / size DESC, match DESC, strand DESC) = 1),
l AS (SELECT allele, exon, list({'s': s, 'e': e, 'size': size, 'strand': strand, 'match': match} ORDER BY -r, s, e, size, strand, match) AS hs FROM o GROUP BY 1, 2),
k AS (SELECT allele, exon, unnest(list_reduce(list_transform(hs, lambda x: [x]), lambda acc, x:
 CASE WHEN len(list_filter(acc, lambda y: least(y.e, x[1].e) > greatest(y.s, x[1].s))) > 0 THEN acc ELSE list_concat(acc, x) END)) AS x FROM l)
SELECT allele, exon, x.size AS size, x.s AS start, x.e AS "end", x.strand AS strand, x.match AS match FROM k""")
def exon_hits(spark, sf):
    return G.best_exon_hits(_exon_hits(spark, sf))


def _nearest(spark, sf):
    return AP.match_references(_marked(spark, sf))[1]


@query()
def global_align(spark, sf):
    return AP.call_variants(A.sequences(spark, sf), _nearest(spark, sf))[0]


@query()
def sv_call(spark, sf):
    return AP.call_variants(A.sequences(spark, sf), _nearest(spark, sf), longer_than=20, k=15)[1]


@query()
def msa_from_paths(spark, sf):
    near = cut(_nearest(spark, sf))
    seqs = A.sequences(spark, sf).select("name", F.upper("seq").alias("seq"))
    aligned = AP.call_variants(seqs, near)[0]
    paths = aligned.join(near.select(F.col("name").alias("id"), F.col("ref").alias("grp")), "id").select(
        "grp", F.col("id").alias("name"), "cigar")
    refs = seqs.withColumnRenamed("name", "grp").join(near.select(F.col("ref").alias("grp")).distinct(), "grp", "left_semi")
    return AN.msa(paths, refs)


_ORD = """o AS (SELECT m.name, m.grp, length(m.seq) AS len, row_number() OVER (PARTITION BY m.grp ORDER BY -is_ref::INT, -length(m.seq), m.name) AS ord FROM
 (SELECT s.*, coalesce(quality = 1, FALSE) AS is_ref FROM seqs s LEFT JOIN labels ON doc_id = name) m)"""
_SEGMENTS = f"""{DOC_HITS}, {_ORD}, w AS (SELECT h.grp, h.kmer, min(ord) AS first FROM hits h JOIN o USING (name) GROUP BY h.grp, h.kmer),
seen AS (SELECT h.grp, h.name, pos AS s, pos + 31 AS e FROM hits h JOIN o USING (name) JOIN w ON w.grp = h.grp AND w.kmer = h.kmer WHERE first < ord
 UNION ALL SELECT grp, name, 0, 0 FROM o UNION ALL SELECT grp, name, len, len FROM o),
rch AS (SELECT *, max(e) OVER (PARTITION BY name ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM seen),
sg AS (SELECT rch.grp, name, greatest(reach - 20, 0)::BIGINT AS s, least(rch.s + 20, len)::BIGINT AS e FROM rch JOIN o USING (name) WHERE rch.s - reach > 100)"""


@query(f"""WITH {_SEGMENTS} SELECT grp, name, s AS start, e AS "end" FROM sg""")
def graph_segments(spark, sf):
    return _segments(spark, sf)[1]


def _segments(spark, sf):
    seqs = _marked(spark, sf)
    order = R.insertion_order(seqs, F.col("is_ref").cast("int"))
    hits = K.kmer_hits(seqs, ("grp", "name"), strand=True)
    return hits, R.sequence_segments(seqs, order, longer_than=100, pad=20)


@query(f"""WITH {DOC_HITS}, f AS (SELECT name, kmer, min(pos) AS p0 FROM hits GROUP BY name, kmer),
a AS (SELECT h.name, pos AS s, pos + 31 AS e FROM hits h JOIN f USING (name, kmer) WHERE pos > p0),
b AS (SELECT *, CASE WHEN s - lag(e) OVER (PARTITION BY name ORDER BY s) <= 0 THEN 0 ELSE 1 END AS brk FROM a),
r AS (SELECT *, sum(brk) OVER (PARTITION BY name ORDER BY s) AS g FROM b)
SELECT name, min(s)::BIGINT AS start, max(e)::BIGINT AS "end" FROM r GROUP BY name, g HAVING max(e) - min(s) > 60""")
def self_repeats(spark, sf):
    return R.sequence_repeats(A.sequences(spark, sf), longer_than=60)


@query(f"""WITH {DOC_HITS}, {TARGET_HITS}, th AS (SELECT t.target, h.name AS contig, h.pos FROM hits h
JOIN (SELECT DISTINCT target, kmer FROM thits) t USING (kmer)), hs AS ({_hotspot_cte}),
u AS (SELECT *, sum(brk) OVER (PARTITION BY target, contig ORDER BY start, "end") AS g FROM (SELECT *, CASE WHEN start - max("end") OVER
 (PARTITION BY target, contig ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= 2000 THEN 0 ELSE 1 END AS brk FROM hs)),
r AS (SELECT target, contig, greatest(min(start) - 100, 0) AS s, max("end") + 100 AS e FROM u GROUP BY target, contig, g)
SELECT target, contig, s::BIGINT AS start, least(e, length(seq))::BIGINT AS "end", contig || ':' || s || '-' || least(e, length(seq)) || '+' AS header,
md5(substr(seq, s::INT + 1, (least(e, length(seq)) - s)::INT)) AS digest FROM r JOIN seqs ON name = contig""")
def allele_search(spark, sf):
    found = SE.search(A.sequences(spark, sf), A.targets(spark, sf), gap=2000, pad=100)
    return found.select("target", "contig", "start", "end", "header", F.md5("seq").alias("digest"))


@query()
def select_and_partition(spark, sf):
    seqs = A.sequences(spark, sf)
    kmers = cut(K.gc_and_complexity_filter(_informative(spark, sf)))
    decisions, groups, own = SL.trim_and_partition(seqs, kmers, common=60, ladder=((4, 200),), anchor=50, cutoff=60, rcutoff=0.1)
    sizes = own.groupBy("component").agg(F.count(F.lit(1)).alias("n_kmers"))
    return groups.join(decisions.select("name", "decision"), "name").join(sizes, "component", "left").fillna({"n_kmers": 0})
