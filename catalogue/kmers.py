"""K-mer extraction, counting, selection and sequence scalar queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalogue import query
from catalogue.fragments import DOC_HITS, SEQS, TARGET_HITS
from weftline import adapters as A
from weftline.functions import sequence as S
from weftline.operators import intervals as I, kmers as K, superkmers as SK
from weftline.session import cut


def doc_hits(spark: SparkSession, sf: str, *ids: str) -> DataFrame:
    return K.kmer_hits(A.sequences(spark, sf), ids or ("name",))


def target_hits(spark: SparkSession, sf: str) -> DataFrame:
    return K.kmer_hits(A.targets(spark, sf), ("target",))


def with_text(df: DataFrame) -> DataFrame:
    return df.withColumn("kmer", S.decode_kmer(F.col("kmer")))


@query(f"""WITH {DOC_HITS} SELECT kmer, least(count(*), 255)::INT AS cnt FROM hits GROUP BY kmer""")
def kmer_count(spark, sf):
    return SK.count_super_kmers(A.sequences(spark, sf), text=True)


@query(f"""WITH {DOC_HITS}, c AS (SELECT kmer, least(count(*), 255) AS cnt FROM hits GROUP BY kmer)
SELECT cnt::INT AS cnt, count(*) AS n_kmers FROM c GROUP BY cnt""")
def kmer_spectrum(spark, sf):
    return SK.count_super_kmers(A.sequences(spark, sf)).groupBy("cnt").agg(F.count(F.lit(1)).alias("n_kmers"))


@query(f"""WITH {DOC_HITS}, c AS (SELECT name, kmer, count(*) AS n FROM hits GROUP BY name, kmer)
SELECT name, sum(n)::BIGINT AS n_kmers, count(*) AS n_distinct, max(n)::BIGINT AS top FROM c GROUP BY name""")
def kmer_distinct_per_seq(spark, sf):
    per = K.sequence_counts(A.sequences(spark, sf))
    return per.groupBy("name").agg(F.sum("cnt").alias("n_kmers"), F.count(F.lit(1)).alias("n_distinct"),
                                   F.max("cnt").alias("top"))


@query(f"""WITH {DOC_HITS}, c AS (SELECT hap, kmer, least(count(*), 3) AS cnt FROM hits GROUP BY hap, kmer)
SELECT hap, sum(cnt)::BIGINT AS total, sum(CASE WHEN cnt = 3 THEN 1 ELSE 0 END)::BIGINT AS saturated
FROM c GROUP BY hap""")
def kmer_saturated(spark, sf):
    per = SK.count_super_kmers(A.sequences(spark, sf), ["hap"], limit=3)
    return per.groupBy("hap").agg(F.sum("cnt").alias("total"),
                                  F.sum(F.when(F.col("cnt") == 3, 1).otherwise(0)).alias("saturated"))


@query(f"""WITH {SEQS} SELECT name, md5(reverse(translate(seq, 'ACGTacgt', 'TGCAtgca'))) AS digest FROM seqs""")
def revcomp(spark, sf):
    return A.sequences(spark, sf).select("name", F.md5(S.reverse_complement(F.col("seq"))).alias("digest"))


@query(f"""WITH {TARGET_HITS} SELECT DISTINCT kmer,
list_sum(list_transform(range(0, 31), lambda i: (strpos('ACGT', substr(kmer, i + 1, 1)) - 1)::BIGINT
 * (1::BIGINT << (2 * (30 - i)))))::BIGINT AS code, kmer AS decoded FROM thits""")
def kmer_encode_decode(spark, sf):
    text = with_text(target_hits(spark, sf).select("kmer").distinct())
    return text.withColumn("code", S.encode_kmer(F.col("kmer"))).withColumn(
        "decoded", S.decode_kmer(F.col("code")))


@query(f"""WITH {SEQS} SELECT name, length(seq)::INT AS len,
length(regexp_replace(seq, '[^GC]', '', 'g'))::INT AS gc, length(regexp_replace(seq, '[^N]', '', 'g'))::INT AS gaps
FROM seqs""")
def gc_content(spark, sf):
    seq = F.col("seq")
    return A.sequences(spark, sf).select("name", F.length(seq).alias("len"), S.gc_count(seq).alias("gc"),
                                         S.ambiguous_bases(seq).alias("gaps"))


@query(f"""WITH {SEQS} SELECT name, length(regexp_replace(seq, '[^A-Z]', '', 'g'))::INT AS uniq FROM seqs""")
def unique_bases(spark, sf):
    return A.sequences(spark, sf).select("name", S.unique_bases(F.col("seq")).alias("uniq"))


_COMPLEX = """(SELECT kmer,
 list_max(list_transform(list_distinct(d), lambda w: len(list_filter(d, lambda x: x = w)))) > 9
 OR list_max(list_transform(list_distinct(t), lambda w: len(list_filter(t, lambda x: x = w)))) > 6 AS low,
 length(regexp_replace(kmer, '[^GC]', '', 'g')) AS gc
 FROM (SELECT kmer, list_transform(range(1, 31), lambda i: substr(kmer, i, 2)) AS d,
  list_transform(range(1, 30), lambda i: substr(kmer, i, 3)) AS t FROM (SELECT DISTINCT kmer FROM {hits})))"""


@query(f"""WITH {TARGET_HITS} SELECT kmer, low, gc > 0.3 * 31 AND gc < 0.7 * 31 AS gc_ok
FROM {_COMPLEX.format(hits='thits')}""")
def low_complexity(spark, sf):
    text = with_text(target_hits(spark, sf).select("kmer").distinct())
    return text.select("kmer", S.low_complexity(F.col("kmer")).alias("low"),
                       S.gc_in_range(F.col("kmer")).alias("gc_ok"))


@query(f"""WITH {DOC_HITS}, f AS (SELECT kmer FROM {_COMPLEX.format(hits='hits')}
WHERE NOT low AND gc > 0.3 * 31 AND gc < 0.7 * 31)
SELECT substr(kmer, 1, 2) AS head, count(*) AS n, min(kmer) AS first, max(kmer) AS last FROM f GROUP BY 1""")
def kmer_gc_filter(spark, sf):
    kept = K.gc_and_complexity_filter(SK.count_super_kmers(A.sequences(spark, sf)).select("kmer"))
    head = F.shiftright("kmer", 58)
    per = kept.groupBy(head.alias("_head")).agg(F.count(F.lit(1)).alias("n"), F.min("kmer").alias("lo"),
                                                F.max("kmer").alias("hi"))
    return per.select(S.decode_kmer(F.col("_head"), 2).alias("head"), "n",
                      S.decode_kmer(F.col("lo")).alias("first"), S.decode_kmer(F.col("hi")).alias("last"))


@query(f"""WITH {DOC_HITS}, {TARGET_HITS}, t AS (SELECT DISTINCT target, kmer FROM thits),
s AS (SELECT name, kmer, least(count(*), 255) AS cnt FROM hits GROUP BY name, kmer)
SELECT target, name, count(*) AS n_found, sum(cnt)::BIGINT AS total FROM s JOIN t USING (kmer) GROUP BY target, name""")
def kmer_target_probe(spark, sf):
    probed = K.probe_sequences(A.sequences(spark, sf), K.target_set(target_hits(spark, sf)))
    return probed.groupBy("target", "name").agg(F.count(F.lit(1)).alias("n_found"), F.sum("cnt").alias("total"))


@query(f"""WITH {DOC_HITS}, t AS (SELECT DISTINCT grp, kmer FROM hits),
m AS (SELECT kmer, count(*) AS n FROM t GROUP BY kmer)
SELECT grp, count(*) AS targetsize, sum(CASE WHEN n > 1 THEN 1 ELSE 0 END)::BIGINT AS shared
FROM t JOIN m USING (kmer) GROUP BY grp""")
def kmer_multi_target(spark, sf):
    return SK.group_sizes(A.sequences(spark, sf)).select("grp", F.col("size").alias("targetsize"), "shared")


_COUNTS = f"""{DOC_HITS}, {TARGET_HITS},
a AS (SELECT kmer, least(count(*), 255)::INT AS cnt FROM hits GROUP BY kmer),
g AS (SELECT kmer, least(count(*), 255)::INT AS cnt FROM thits GROUP BY kmer)"""
_SELECTED = f"""{_COUNTS}, s AS (SELECT kmer, coalesce(g.cnt, 0) = coalesce(a.cnt, 0) AND coalesce(g.cnt, 0) < 255 AS include,
 abs(coalesce(g.cnt, 0) - coalesce(a.cnt, 0)) AS diff FROM g FULL JOIN a USING (kmer))"""


def _selected(spark, sf):
    return K.select_informative(K.count_kmers(target_hits(spark, sf)), SK.count_super_kmers(A.sequences(spark, sf)))


@query(f"""WITH {_SELECTED} SELECT kmer FROM s WHERE include""")
def kmer_select_include(spark, sf):
    return with_text(_selected(spark, sf).where("include").select("kmer"))


@query(f"""WITH {_SELECTED} SELECT diff::INT AS diff, count(*) AS n, min(kmer) AS first FROM s WHERE NOT include GROUP BY diff""")
def kmer_select_exclude(spark, sf):
    out = _selected(spark, sf).where("NOT include").groupBy("diff").agg(
        F.count(F.lit(1)).alias("n"), F.min("kmer").alias("lo"))
    return out.select("diff", "n", S.decode_kmer(F.col("lo")).alias("first"))


@query(f"""WITH {_COUNTS} SELECT kmer, kmer NOT IN (SELECT kmer FROM a) AS kept FROM g""")
def kmer_anti(spark, sf):
    include = cut(target_hits(spark, sf).select("kmer").distinct())
    # Both sides ask for included k-mers only, so no others are written; a short list is sent to the counts.
    asked = include.hint("broadcast") if include.count() <= 1_000_000 else include
    named = cut(SK.count_super_kmers(A.sequences(spark, sf)).select("kmer").join(asked, "kmer", "left_semi"))
    kept, dropped = K.subtract_excluded(include, named)
    return with_text(kept.withColumn("kept", F.lit(True)).unionByName(dropped.withColumn("kept", F.lit(False))))


@query(f"""WITH {_COUNTS} SELECT kmer, g.cnt AS c1, coalesce(a.cnt, 0)::INT AS c2 FROM g LEFT JOIN a USING (kmer)
WHERE g.cnt > 0 AND g.cnt < 255""")
def kmer_compare(spark, sf):
    return with_text(K.compare_counts(K.count_kmers(target_hits(spark, sf)), SK.count_super_kmers(A.sequences(spark, sf))))


@query(f"""WITH {DOC_HITS}, e AS (SELECT kmer, min(grp) AS grp FROM hits GROUP BY kmer HAVING min(grp) = max(grp))
SELECT grp, count(*) AS n, min(kmer) AS first, max(kmer) AS last FROM e GROUP BY grp""")
def kmer_exclusive_to_group(spark, sf):
    per = SK.exclusive_super_kmers(A.sequences(spark, sf)).groupBy("grp").agg(
        F.count(F.lit(1)).alias("n"), F.min("kmer").alias("lo"), F.max("kmer").alias("hi"))
    return per.select("grp", "n", S.decode_kmer(F.col("lo")).alias("first"), S.decode_kmer(F.col("hi")).alias("last"))


@query(f"""WITH {SEQS}, b AS (SELECT name, p, substr(seq, p + 1, 1) AS c FROM
 (SELECT name, upper(seq) AS seq, unnest(range(0, length(seq))) AS p FROM seqs)),
w AS (SELECT name, p, c, coalesce(max(CASE WHEN c = 'N' THEN p + 1 END) OVER u, 0) AS clean,
 sum(CASE WHEN c IN ('G', 'C') THEN 1 ELSE 0 END) OVER u AS cum FROM b
 WINDOW u AS (PARTITION BY name ORDER BY p)),
x AS (SELECT e.name, e.p, greatest(e.clean, e.p - 99) AS f, e.cum FROM w e WHERE e.p - e.clean >= 30)
SELECT x.name, count(*) AS n, sum(x.cum - coalesce(w.cum, 0))::BIGINT AS gc, sum(x.p - x.f + 1)::BIGINT AS span
FROM x LEFT JOIN w ON w.name = x.name AND w.p = x.f - 1 GROUP BY x.name""")
def gc_window(spark, sf):
    return K.window_gc(A.sequences(spark, sf), ["name"]).groupBy("name").agg(
        F.count(F.lit(1)).alias("n"), F.sum("gc").alias("gc"), F.sum("span").alias("span"))


# K-mers of one language only that occur at least twice.
_LIST = """list AS (SELECT kmer FROM hits GROUP BY kmer HAVING min(grp) = max(grp) AND count(*) > 1)"""
_TRIM = dict(anchor=50, cutoff=60, rcutoff=0.1)
_WALK = """
{o}_s AS (SELECT name, {o}, hit, sum(CASE WHEN hit THEN 900000 ELSE -100000 END) OVER (PARTITION BY name ORDER BY {o}) AS s FROM marks),
{o}_m AS (SELECT *, least(coalesce(min(s) OVER (PARTITION BY name ORDER BY {o} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) AS m FROM {o}_s),
{o}_e AS (SELECT name, min({o}) AS stop FROM {o}_m WHERE s >= m AND s - m >= 54000000 GROUP BY name),
{o}_t AS (SELECT name, max({o}) AS trim FROM {o}_m LEFT JOIN {o}_e USING (name) WHERE s < m AND (stop IS NULL OR {o} < stop) GROUP BY name)"""
_TRIMMED = f"""{DOC_HITS}, {_LIST}, found AS (SELECT name, pos, kmer FROM hits WHERE kmer IN (SELECT kmer FROM list)),
base AS (SELECT name, length(seq) AS len, (SELECT count(*) FROM found f WHERE f.name = s.name) AS n FROM seqs s),
st AS (SELECT *, CASE WHEN n < 60 THEN 'filter' WHEN n >= (len - 100) * 0.1 THEN 'pass' ELSE 'trim' END AS state FROM base),
grid AS (SELECT name, len - 30 AS w, unnest(range(0, len - 30)) AS pos FROM st WHERE state = 'trim'),
marks AS (SELECT g.name, g.pos, w - 1 - g.pos AS back, f.pos IS NOT NULL AS hit FROM grid g LEFT JOIN found f ON f.name = g.name AND f.pos = g.pos),
{_WALK.format(o='pos')},{_WALK.format(o='back')},
cuts AS (SELECT st.*, coalesce(p.trim, 0) AS a, coalesce(b.trim, 0) AS z FROM st LEFT JOIN pos_t p USING (name) LEFT JOIN back_t b USING (name)),
lost AS (SELECT name, sum((CASE WHEN pos < a THEN 1 ELSE 0 END) + (CASE WHEN pos >= len - 30 - z THEN 1 ELSE 0 END)) AS lost
 FROM found JOIN cuts USING (name) WHERE state = 'trim' GROUP BY name),
dec AS (SELECT name, len, n, state, a, z, n - coalesce(lost, 0) AS rest, CASE WHEN state <> 'trim' THEN state
 WHEN n - coalesce(lost, 0) >= 60 THEN 'trim' ELSE 'filter' END AS decision FROM cuts LEFT JOIN lost USING (name))"""


def _informative(spark, sf):
    return SK.exclusive_super_kmers(A.sequences(spark, sf)).where("n > 1").select("kmer")


def _listed(spark, sf):
    """The informative k-mers and their hits: two scans, whatever reads them later."""
    kmers = cut(_informative(spark, sf))
    return kmers, cut(SK.found_windows(A.sequences(spark, sf), kmers))


@query(f"""WITH {_TRIMMED} SELECT name, len::BIGINT AS len,
(CASE WHEN state = 'trim' THEN rest ELSE n END)::BIGINT AS count,
(CASE WHEN decision = 'trim' THEN a ELSE 0 END)::BIGINT AS start,
(CASE WHEN decision = 'trim' THEN z ELSE 0 END)::BIGINT AS "end", decision FROM dec""")
def trim_by_kmer(spark, sf):
    _, hits = _listed(spark, sf)
    return K.trim_by_kmers(A.sequences(spark, sf), hits, None, **_TRIM)


@query(f"""WITH {_TRIMMED}, gone AS (SELECT kmer FROM found JOIN dec USING (name) WHERE decision <> 'pass'
AND (decision = 'filter' OR pos < a OR pos >= len - 30 - z))
SELECT count(*) AS n, min(kmer) AS first, max(kmer) AS last FROM list WHERE kmer NOT IN (SELECT kmer FROM gone)""")
def trim_surviving_kmers(spark, sf):
    kmers, hits = _listed(spark, sf)
    decisions = K.trim_by_kmers(A.sequences(spark, sf), hits, None, **_TRIM)
    left = K.surviving_kmers(kmers, hits, decisions)
    out = left.agg(F.count(F.lit(1)).alias("n"), F.min("kmer").alias("lo"), F.max("kmer").alias("hi"))
    return out.select("n", S.decode_kmer(F.col("lo")).alias("first"), S.decode_kmer(F.col("hi")).alias("last"))


def _hotspot_sql(source: str, cutoff: int, span: int) -> str:
    return f"""lagged AS (SELECT target, contig, lag(pos, {cutoff}) OVER (PARTITION BY target, contig ORDER BY pos) AS s, pos AS e
 FROM (SELECT DISTINCT target, contig, pos FROM {source})),
close AS (SELECT * FROM lagged WHERE e - s < {span}),
isl AS (SELECT *, sum(brk) OVER (PARTITION BY target, contig ORDER BY s, e) AS g FROM
 (SELECT *, CASE WHEN s - max(e) OVER (PARTITION BY target, contig ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) < {span}
  THEN 0 ELSE 1 END AS brk FROM close))
SELECT target, contig, min(s)::BIGINT AS start, max(e)::BIGINT AS "end", count(*) AS n FROM isl GROUP BY target, contig, g"""


@query(f"""WITH {DOC_HITS}, {TARGET_HITS}, th AS (SELECT t.target, h.name AS contig, h.pos FROM hits h
JOIN (SELECT DISTINCT target, kmer FROM thits) t USING (kmer)), {_hotspot_sql('th', 50, 1000)}""")
def hotspots(spark, sf):
    placed = doc_hits(spark, sf).join(K.target_set(target_hits(spark, sf)), "kmer").select(
        "target", F.col("name").alias("contig"), "pos")
    return I.hotspots(placed, cutoff=50)


@query(f"""WITH ev AS (SELECT event_type AS target, user_id AS contig, floor(epoch(ts))::BIGINT AS pos FROM events),
{_hotspot_sql('ev', 3, 604800)}""")
def hotspots_of_events(spark, sf):
    return I.hotspots(A.hits(spark, sf), cutoff=3, span=604800)
