"""Interval merging, joining, ranking and location-filter queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import query
from catalogue.fragments import IVL
from weftline import adapters as A
from weftline.operators import intervals as I
from weftline.operators.scan import mode_first_seen, ordinal

# The coordinates of these views are days: narrow chunks and few dyadic levels.
W, L = 512, 14


def _islands(gap: int, source: str = "ivl", keys: str = "contig") -> str:
    return f"""isl AS (SELECT *, min(CASE WHEN brk = 1 THEN start END) OVER (PARTITION BY {keys}, g) AS island FROM
 (SELECT *, sum(brk) OVER (PARTITION BY {keys} ORDER BY start, stop, id) AS g FROM
 (SELECT *, CASE WHEN start - max(stop) OVER (PARTITION BY {keys} ORDER BY start, stop, id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= {gap} THEN 0 ELSE 1 END AS brk FROM {source})))"""


def _by_part() -> str:
    return IVL.replace("l_suppkey AS contig", "l_partkey AS contig")


def _parts(spark, sf):
    """Intervals keyed by part: sparse enough per key to leave gaps."""
    return A.intervals(spark, sf).withColumn("contig", F.col("l_partkey"))


@query(f"""WITH {_by_part()}, {_islands(20)}
SELECT contig, greatest(min(start) - 10, 0)::BIGINT AS start, (max(stop) + 10)::BIGINT AS "end", count(*) AS n
FROM isl GROUP BY contig, g""")
def merge_intervals_gap(spark, sf):
    return I.merge_intervals(_parts(spark, sf), ["contig"], gap=20, pad=10, width=W)


@query(f"""WITH {_by_part()}, {_islands(0)}, m AS (SELECT contig, min(start) AS s, max(stop) AS e FROM isl GROUP BY contig, g)
SELECT contig, string_agg(s::VARCHAR || '_' || e::VARCHAR, ';' ORDER BY s) AS ranges FROM m GROUP BY contig""")
def exon_ranges(spark, sf):
    merged = I.merge_intervals(_parts(spark, sf), ["contig"], width=W)
    part = F.struct("start", F.concat_ws("_", "start", "end").alias("t"))
    return merged.groupBy("contig").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda p: p["t"]), ";").alias("ranges"))


@query(f"""WITH {IVL}, {_islands(0)} SELECT contig, min(start)::BIGINT AS start, max(stop)::BIGINT AS "end", count(*) AS n
FROM isl GROUP BY contig, g""")
def merge_intervals_exact(spark, sf):
    return I.merge_intervals(A.intervals(spark, sf), ["contig"], width=W)


@query(f"""WITH {_by_part()}, r AS (SELECT contig, start, max(stop) OVER (PARTITION BY contig ORDER BY start, stop, id
 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM ivl)
SELECT contig, reach::BIGINT AS gap_start, start::BIGINT AS gap_end FROM r WHERE start - reach > 30""")
def interval_gaps(spark, sf):
    return I.uncovered_gaps(_parts(spark, sf), ["contig"], 30, width=W)


@query(f"""WITH {IVL}, h AS (SELECT l_partkey, contig, strand, min(start) AS s, max(stop) AS e, min(id) AS o
 FROM ivl GROUP BY l_partkey, contig, strand), r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY o) AS k FROM h)
SELECT CASE WHEN k = 1 THEN l_partkey::VARCHAR ELSE l_partkey::VARCHAR || '00' || k::VARCHAR END AS name,
l_partkey, contig, strand, s::BIGINT AS start, e::BIGINT AS "end" FROM r""")
def interval_hull(spark, sf):
    return I.interval_hull(A.intervals(spark, sf), "l_partkey", ["contig", "strand"], "id")


@query(f"""WITH {_by_part()}, {_islands(-1)}
SELECT id, contig, island::BIGINT AS island, row_number() OVER (PARTITION BY contig, island, l_returnflag ORDER BY score, id) - 1 AS rank FROM isl""")
def cluster_loci_rank(spark, sf):
    ranked = I.cluster_loci(_parts(spark, sf), "contig", "l_returnflag", "score", "id", width=W)
    return ranked.select("id", "contig", "island", "rank")


_GENES = """genes AS (SELECT c_nationkey AS contig, date_diff('day', DATE '1992-01-01', o_orderdate::DATE) AS r_start,
 date_diff('day', DATE '1992-01-01', o_orderdate::DATE) + 2 AS r_end, o_orderkey AS gene, o_orderpriority AS label
 FROM orders JOIN customer ON o_custkey = c_custkey)"""
_PLACED = f"""{IVL}, placed AS (SELECT ivl.* EXCLUDE (contig), s_nationkey AS contig FROM ivl JOIN supplier ON contig = s_suppkey)"""


def _genes(spark, sf):
    day = A.day_number("o_orderdate")
    return (A.table(spark, sf, "orders").join(A.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
            .select(F.col("c_nationkey").alias("contig"), day.alias("r_start"), (day + 2).alias("r_end"),
                    F.col("o_orderkey").alias("gene"), F.col("o_orderpriority").alias("label")))


def _placed(spark, sf):
    return (A.intervals(spark, sf).join(A.table(spark, sf, "supplier"), F.col("contig") == F.col("s_suppkey"))
            .drop("contig").withColumnRenamed("s_nationkey", "contig"))


@query(f"""WITH {_PLACED}, {_GENES} SELECT p.id, count(*) AS n_genes, min(gene) AS first_gene, max(gene) AS last_gene
FROM placed p JOIN genes g ON p.contig = g.contig AND p.start < g.r_end AND g.r_start < p.stop GROUP BY p.id""")
def range_join_genes(spark, sf):
    # Positions are days: rows of one range meet the same genes, so each different range is joined once.
    placed = _placed(spark, sf).select("id", "contig", "start", "end")
    genes = _genes(spark, sf).groupBy("contig", "r_start", "r_end").agg(
        F.count(F.lit(1)).alias("n"), F.min("gene").alias("lo"), F.max("gene").alias("hi"))
    met = I.range_join(placed.select("contig", "start", "end").distinct(), genes, ["contig"], 32).groupBy("contig", "start", "end").agg(
        F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return placed.join(met, ["contig", "start", "end"]).groupBy("id").agg(
        F.sum("n").alias("n_genes"), F.min("lo").alias("first_gene"), F.max("hi").alias("last_gene"))


@query(f"""WITH {_PLACED}, {_GENES} SELECT p.contig, p.l_returnflag, count(*) AS n
FROM placed p JOIN genes g ON p.contig = g.contig AND p.start < g.r_end AND g.r_start <= p.stop
GROUP BY p.contig, p.l_returnflag""")
def range_join_touching(spark, sf):
    placed = _placed(spark, sf).groupBy("contig", "start", "end", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    genes = _genes(spark, sf).groupBy("contig", "r_start", "r_end").agg(F.count(F.lit(1)).alias("many"))
    met = I.range_join(placed, genes, ["contig"], 32, touch=True)
    return met.groupBy("contig", "l_returnflag").agg(F.sum(F.col("n") * F.col("many")).alias("n"))


_EXONS = "(SELECT * FROM genes WHERE label = '1-URGENT')"


@query(f"""WITH {_PLACED}, {_GENES} SELECT id, EXISTS (SELECT 1 FROM {_EXONS} g WHERE p.contig = g.contig
 AND p.start < g.r_end AND g.r_start < p.stop) AS on_exon FROM placed p""")
def sv_on_exon(spark, sf):
    exons = _genes(spark, sf).where("label = '1-URGENT'")
    return I.overlaps_any(_placed(spark, sf), exons, ["contig"], width=W, out="on_exon").select("id", "on_exon")


@query(f"""WITH {_PLACED}, {_GENES} SELECT l_returnflag, count(*) AS n, min(id) AS first FROM placed p WHERE NOT EXISTS
(SELECT 1 FROM {_EXONS} g WHERE p.contig = g.contig AND p.start <= g.r_end AND g.r_start <= p.stop) GROUP BY l_returnflag""")
def error_region_anti(spark, sf):
    errors = _genes(spark, sf).where("label = '1-URGENT'")
    out = I.overlaps_any(_placed(spark, sf), errors, ["contig"], touch=True, width=W).where("NOT overlaps")
    return out.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))


@query(f"""WITH {_PLACED}, {_GENES} SELECT p.id, min(gene) AS gene, CASE WHEN min(gene) IS NULL THEN 'Novel(trans)' ELSE 'Mutate' END AS kind
FROM placed p LEFT JOIN genes g ON p.contig = g.contig AND p.start < g.r_end AND g.r_start < p.stop GROUP BY p.id""")
def liftover_first_match(spark, sf):
    matched = I.first_overlap(_placed(spark, sf), _genes(spark, sf), ["contig"], "id", "gene", levels=L, out="gene")
    return matched.select("id", "gene", F.when(F.col("gene").isNull(), "Novel(trans)").otherwise("Mutate").alias("kind"))


_ENVELOPE = """pts AS (SELECT DISTINCT contig, p FROM (SELECT contig, start AS p FROM ivl UNION ALL SELECT contig, stop FROM ivl)),
seg AS (SELECT contig, p AS a, lead(p) OVER (PARTITION BY contig ORDER BY p) AS b FROM pts),
own AS (SELECT s.contig, a, b, arg_min(id, (-score, start, id)) AS id FROM seg s JOIN ivl i ON i.contig = s.contig AND i.start <= a AND i.stop >= b
 WHERE b IS NOT NULL GROUP BY s.contig, a, b),
run AS (SELECT *, sum(CASE WHEN id = pid AND a = pb THEN 0 ELSE 1 END) OVER (PARTITION BY contig ORDER BY a) AS g FROM
 (SELECT *, lag(id) OVER w AS pid, lag(b) OVER w AS pb FROM own WINDOW w AS (PARTITION BY contig ORDER BY a)))
SELECT contig, id, min(a)::BIGINT AS start, max(b)::BIGINT AS "end" FROM run GROUP BY contig, id, g HAVING max(b) - min(a) > 5"""


@query(f"WITH {_by_part()}, {_ENVELOPE}")
def best_score_envelope(spark, sf):
    return I.best_score_envelope(_parts(spark, sf), ["contig"], "id", longer_than=5, levels=L, width=W)


@query("""WITH pts AS (SELECT l_partkey AS contig, date_diff('day', DATE '1992-01-01', l_shipdate::DATE) AS p FROM lineitem),
c AS (SELECT contig, p, count(*) AS w FROM pts GROUP BY contig, p),
g AS (SELECT *, sum(CASE WHEN p - pp < 30 THEN 0 ELSE 1 END) OVER (PARTITION BY contig ORDER BY p) AS g FROM
 (SELECT *, lag(p) OVER (PARTITION BY contig ORDER BY p) AS pp FROM c)),
m AS (SELECT contig, g, arg_min(p, (-w, p)) AS mode FROM g GROUP BY contig, g),
n AS (SELECT contig, mode AS chunk_start, lead(mode) OVER (PARTITION BY contig ORDER BY mode) AS chunk_end FROM m)
SELECT contig, chunk_start::BIGINT AS chunk_start, chunk_end::BIGINT AS chunk_end FROM n WHERE chunk_end IS NOT NULL""")
def break_chunks(spark, sf):
    points = _parts(spark, sf).select("contig", F.col("start").alias("at"))
    return I.break_chunks(points, ["contig"], gap=30, width=W)


@query(f"""WITH {_by_part()}, {_islands(0)},
k AS (SELECT contig, g, min(start) AS s, max(stop) AS e, arg_min(l_returnflag, (start, id)) AS f, arg_max(l_returnflag, (stop, id)) AS t, count(*) AS n
 FROM isl GROUP BY contig, g),
b AS (SELECT *, CASE WHEN s - lag(e) OVER w > 10 AND f <> lag(t) OVER w THEN 1 ELSE 0 END AS brk FROM k WINDOW w AS (PARTITION BY contig ORDER BY s)),
r AS (SELECT *, sum(brk) OVER (PARTITION BY contig ORDER BY s) AS c FROM b)
SELECT contig, min(s)::BIGINT AS start, max(e)::BIGINT AS "end", sum(n)::BIGINT AS n FROM r GROUP BY contig, c""")
def label_clusters(spark, sf):
    return I.label_clusters(_parts(spark, sf), ["contig"], "l_returnflag", "id", gap=10, width=W)


@query(f"""WITH {_by_part()}, l AS (SELECT contig, start, max(stop) AS stop FROM ivl GROUP BY contig, start),
w AS (SELECT *, CASE WHEN stop - start < 40 THEN greatest(start - (40 - stop + start) // 2, 0) ELSE start END AS ws,
 stop + greatest(40 - stop + start, 0) // 2 AS we FROM l),
n AS (SELECT *, lag(stop) OVER o AS ps, lag(we) OVER o AS pw, lead(start) OVER o AS ns, lead(ws) OVER o AS nw FROM w
 WINDOW o AS (PARTITION BY contig ORDER BY start))
SELECT contig, start::BIGINT AS start, stop::BIGINT AS "end",
(CASE WHEN ws < pw THEN least(greatest((ws + pw) // 2, ps), start) ELSE ws END)::BIGINT AS new_start,
(CASE WHEN nw < we THEN least(greatest((we + nw) // 2, stop), ns) ELSE we END)::BIGINT AS new_end FROM n""")
def clamp_neighbours(spark, sf):
    return I.clamp_neighbours(_parts(spark, sf), ["contig"], anchor=8, width=W)


@query(f"""WITH {_by_part()}, {_islands(50)}, m AS (SELECT contig, min(start) AS s, max(stop) AS e, count(*) AS n FROM isl GROUP BY contig, g)
SELECT contig, s::BIGINT AS start, e::BIGINT AS "end", n, ((lag(e) OVER w + s) // 2)::BIGINT AS cut_left,
((e + lead(s) OVER w) // 2)::BIGINT AS cut_right FROM m WINDOW w AS (PARTITION BY contig ORDER BY s)""")
def split_overmerged(spark, sf):
    return I.split_overmerged(_parts(spark, sf), ["contig"], gap=50, width=W)


@query(f"""WITH {_by_part()} SELECT contig, CASE WHEN sum(CASE WHEN strand = '+' THEN stop - start ELSE start - stop END) >= 0 THEN '+' ELSE '-' END AS strand
FROM ivl GROUP BY contig""")
def strand_majority(spark, sf):
    return I.strand_majority(_parts(spark, sf), ["contig"], F.col("end") - F.col("start"))


@query("""WITH c AS (SELECT user_id, event_type, count(*) AS n, min(event_id) AS f FROM events GROUP BY user_id, event_type)
SELECT user_id, arg_min(event_type, (-n, f)) AS mode, max(n) AS n FROM c GROUP BY user_id""")
def mode_first_seen_type(spark, sf):
    return mode_first_seen(A.table(spark, sf, "events"), ["user_id"], "event_type", "event_id")



@query(f"""WITH {IVL}, sizes AS (SELECT s_suppkey AS contig, 3500 + s_nationkey::BIGINT AS length FROM supplier),
e AS (SELECT ivl.*, least(start, coalesce(length, 1000000000) - stop) AS edge,
 l_returnflag = 'A' AS is_main, l_returnflag = 'R' AS is_ref FROM ivl LEFT JOIN sizes USING (contig)),
m AS (SELECT min(edge) AS min_edge FROM e WHERE is_main),
err AS (SELECT s_suppkey AS contig, 100 * s_nationkey AS r_start, 100 * s_nationkey + 40 AS r_end FROM supplier)
SELECT id, edge::BIGINT AS edge FROM e, m WHERE edge >= least(CASE WHEN is_ref THEN 0 ELSE 400 END, min_edge / 2)
AND NOT EXISTS (SELECT 1 FROM err WHERE err.contig = e.contig AND start <= r_end AND r_start <= stop)""")
def edge_filter(spark, sf):
    supplier = A.table(spark, sf, "supplier")
    sizes = supplier.select(F.col("s_suppkey").alias("contig"), (F.col("s_nationkey") + 3500).cast("bigint").alias("length"))
    first = (F.col("s_nationkey") * 100).cast("bigint")
    errors = supplier.select(F.col("s_suppkey").alias("contig"), first.alias("start"), (first + 40).alias("end"))
    loci = A.intervals(spark, sf).withColumn("is_main", F.col("l_returnflag") == "A").withColumn(
        "is_ref", F.col("l_returnflag") == "R")
    return I.edge_filter(loci, sizes, errors, cutoff=400).select("id", "edge")


@query("""SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS ordinal FROM events""")
def ordinal_names(spark, sf):
    return ordinal(A.table(spark, sf, "events"), ["ts", "event_id"]).select("event_id", "ordinal")
