"""Queries on tiled sequences: slices, removal of repeats and the places bases move to."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import query
from catalogue.fragments import DOC_HITS, SEQS
from weftline import adapters as A
from weftline.operators import graph as R, tiling as TI
from weftline.session import cut
from weftline.sources.alignments import region_fasta


def _regions(spark, sf):
    """A region of a document for every line item: contig, start, end, strand."""
    start = F.col("l_quantity").cast("bigint") * 13 - 60
    return A.table(spark, sf, "lineitem").select(
        (F.col("l_partkey") % 1000).alias("contig"), start.alias("start"),
        (start + F.col("l_suppkey") % 300 * F.col("l_linenumber")).alias("end"),
        F.when(F.col("l_linestatus") == "O", "+").otherwise("-").alias("strand"), "l_orderkey", "l_linenumber")


@query(f"""WITH {SEQS}, r AS (SELECT l_partkey % 1000 AS contig, l_quantity::BIGINT * 13 - 60 AS s, l_quantity::BIGINT * 13 - 60 + l_suppkey % 300 * l_linenumber AS e,
 CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand, l_orderkey, l_linenumber FROM lineitem),
x AS (SELECT r.*, coalesce(substr(seq, greatest(s, 0)::INT + 1, greatest(e - greatest(s, 0), 0)::INT), '') AS t FROM r LEFT JOIN seqs ON name = contig)
SELECT l_orderkey || '.' || l_linenumber AS name, l_orderkey || '.' || l_linenumber || chr(9) || contig || ':' || s || '-' || e || strand AS header,
md5(CASE WHEN strand = '-' THEN reverse(translate(t, 'ACGTacgt', 'TGCAtgca')) ELSE t END) AS digest FROM x""")
def region_records(spark, sf):
    name = F.concat_ws(".", "l_orderkey", "l_linenumber")
    return region_fasta(A.sequences(spark, sf), _regions(spark, sf), name).select("name", "header", F.md5("seq").alias("digest"))


_REPEATS = f"""{DOC_HITS}, first AS (SELECT name, kmer, min(pos) AS p0 FROM hits GROUP BY name, kmer),
again AS (SELECT h.name, pos AS s, pos + 31 AS e FROM hits h JOIN first USING (name, kmer) WHERE pos > p0),
opened AS (SELECT *, CASE WHEN s - lag(e) OVER (PARTITION BY name ORDER BY s) <= 0 THEN 0 ELSE 1 END AS brk FROM again),
numbered AS (SELECT *, sum(brk) OVER (PARTITION BY name ORDER BY s) AS g FROM opened),
rep AS (SELECT name, min(s) AS s, max(e) AS e FROM numbered GROUP BY name, g HAVING max(e) - min(s) > 60)"""


def _repeats(spark, sf):
    return cut(R.sequence_repeats(A.sequences(spark, sf), longer_than=60))


@query(f"""WITH {_REPEATS}, tiles AS (SELECT name, t0, substr(seq, t0 + 1, 256) AS t FROM (SELECT name, seq, unnest(range(0, length(seq), 256)) AS t0 FROM seqs)),
b AS (SELECT name, p, substr(t, (p - t0)::INT + 1, 1) AS ch FROM (SELECT name, t0, t, unnest(range(t0, t0 + length(t))) AS p FROM tiles)),
gone AS (SELECT DISTINCT name, unnest(range(s, e)) AS p FROM rep)
SELECT name, count(*)::BIGINT AS len, md5(string_agg(ch, '' ORDER BY p)) AS digest FROM b ANTI JOIN gone USING (name, p) GROUP BY name""")
def repeats_removed(spark, sf):
    index = TI.tile_index(A.sequences(spark, sf))
    kept = cut(TI.kept_ranges(TI.tiled_lengths(index), _repeats(spark, sf)))
    return TI.joined_tiles(TI.cut_tiles(index, kept)).select("name", F.length("seq").cast("bigint").alias("len"), F.md5("seq").alias("digest"))


@query(f"""WITH {_REPEATS}, shifted AS (SELECT h.name, h.pos, coalesce(sum(least(e, pos) - s), 0) AS lost, coalesce(bool_or(pos < e), FALSE) AS gone
 FROM hits h LEFT JOIN rep ON rep.name = h.name AND s <= pos GROUP BY h.name, h.pos)
SELECT name, count(*) AS n, count(*) FILTER (NOT gone) AS n_kept, coalesce(sum(pos - lost) FILTER (NOT gone), 0)::BIGINT AS places,
coalesce(sum(pos % 97 * (pos - lost)) FILTER (NOT gone), 0)::BIGINT AS pairing FROM shifted GROUP BY name""")
def moved_kmers(spark, sf):
    index = TI.tile_index(A.sequences(spark, sf))
    kept = cut(TI.kept_ranges(TI.tiled_lengths(index), _repeats(spark, sf)))
    moved = TI.moved_places(None, kept, seqs=A.sequences(spark, sf))
    zero = F.lit(0).cast("bigint")
    return moved.groupBy("name").agg(
        F.count(F.lit(1)).alias("n"), F.count("new_pos").alias("n_kept"), F.coalesce(F.sum("new_pos"), zero).alias("places"),
        F.coalesce(F.sum(F.col("pos") % 97 * F.col("new_pos")), zero).alias("pairing"))


@query(f"""WITH {_REPEATS}, sz AS (SELECT name, length(seq)::BIGINT AS len FROM seqs WHERE seq <> ''),
marks AS (SELECT name, s, e FROM rep UNION ALL SELECT name, 0, 0 FROM sz UNION ALL SELECT name, len, len FROM sz),
gaps AS (SELECT name, max(e) OVER (PARTITION BY name ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS a, s AS b FROM marks),
wide AS (SELECT name, greatest(a - 40, 0) AS s, least(b + 40, len) AS e, len FROM gaps JOIN sz USING (name) WHERE b > a)
SELECT DISTINCT name, CASE WHEN s > 0 THEN greatest(s - greatest(151 - (e - s), 0), 0) ELSE s END::BIGINT AS start,
CASE WHEN s = 0 THEN least(e + greatest(151 - (e - s), 0), len) ELSE e END::BIGINT AS "end" FROM wide""")
def repeat_free_parts(spark, sf):
    sizes = A.sequences(spark, sf).select("name", F.length("seq").alias("len")).where("len > 0")
    return TI.split_at_repeats(sizes, _repeats(spark, sf), pad=40)
