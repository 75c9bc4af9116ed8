"""Similarity, nearest-match and component queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import query
from catalogue.fragments import SEQS, hits
from weftline import adapters as A
from weftline.operators import components as C, kmers as K, matching as M, pairs as P, superkmers as SK

# Exact copies are folded on both sides of the check; a labelled document of good
# quality is a reference allele.
_FOLD = f"""{SEQS}, marked AS (SELECT s.*, coalesce(quality = 1, FALSE) AS is_ref FROM seqs s
 LEFT JOIN labels ON doc_id = name),
reps AS (SELECT min(name) AS name, count(*) AS copies, is_ref, upper(seq) AS seq FROM marked GROUP BY is_ref, upper(seq)),
{hits('h', 'reps', 'name, copies, is_ref')},
cnt AS (SELECT name, kmer, count(*) AS c, max(copies) AS copies FROM h GROUP BY name, kmer),
df AS (SELECT kmer, count(*) AS n, sum(copies) AS df FROM cnt GROUP BY kmer),
own AS (SELECT name, sum(c * c / CASE WHEN df = 1 THEN 20.0 ELSE 1.0 END) AS own FROM cnt JOIN df USING (kmer) GROUP BY name),
sh AS (SELECT cnt.* FROM cnt JOIN df USING (kmer) WHERE n > 1)"""
_MIN = "pr AS (SELECT a.name AS i, b.name AS j, sum(least(a.c, b.c))::BIGINT AS total FROM sh a JOIN sh b ON a.kmer = b.kmer AND a.name < b.name GROUP BY 1, 2)"
_DOT = "dt AS (SELECT a.name AS i, b.name AS j, sum(a.c * b.c)::DOUBLE AS total FROM sh a JOIN sh b ON a.kmer = b.kmer AND a.name < b.name GROUP BY 1, 2)"
_D = """dd AS (SELECT i, j, total, 1 - total / sqrt(greatest(1.0, x.own) * greatest(1.0, y.own)) AS d
 FROM dt JOIN own x ON x.name = i JOIN own y ON y.name = j)"""


# The same over records: every copy has its own rows.
_ALL = f"""{_FOLD}, acnt AS (SELECT m.name, cnt.kmer, cnt.c FROM marked m
 JOIN reps ON reps.is_ref = m.is_ref AND reps.seq = upper(m.seq) JOIN cnt ON cnt.name = reps.name),
apr AS (SELECT a.name AS i, b.name AS j, sum(least(a.c, b.c))::BIGINT AS total FROM acnt a JOIN acnt b ON a.kmer = b.kmer AND a.name < b.name GROUP BY 1, 2)"""


def _marked(spark, sf):
    labels = A.table(spark, sf, "labels").select(F.col("doc_id").alias("name"), (F.col("quality") == 1).alias("_q"))
    return A.sequences(spark, sf).join(labels, "name", "left").withColumn(
        "is_ref", F.coalesce("_q", F.lit(False))).drop("_q")


def _folded(spark, sf):
    """Distinct texts, their members, how many k-mers each has (``name, cnt``), and what they share."""
    chosen, members = P.fold_copies(_marked(spark, sf).withColumn("cnt", K.window_numbers()), by=("is_ref",))
    return chosen, members, chosen.select("name", "cnt"), P.sequence_colours(chosen)


def _chosen(spark, sf):
    return P.fold_copies(_marked(spark, sf), by=("is_ref",))


def _colours(spark, sf):
    return P.sequence_colours(_chosen(spark, sf)[0])


@query(f"""WITH {_FOLD} SELECT reps.name AS rep, m.name AS name, m.is_ref FROM marked m
JOIN reps ON reps.is_ref = m.is_ref AND reps.seq = upper(m.seq)""")
def fold_copies(spark, sf):
    return _chosen(spark, sf)[1]


@query(f"WITH {_FOLD}, {_MIN} SELECT * FROM pr WHERE total > 100")
def pair_min_similarity(spark, sf):
    """Pairs of distinct texts (``fold_copies`` lists the records of each)."""
    return P.min_similarity(None, 100, _colours(spark, sf))


@query(f"WITH {_FOLD}, {_MIN} SELECT i, count(*) AS n, sum(total)::BIGINT AS total FROM pr GROUP BY i")
def pair_min_similarity_all(spark, sf):
    """Per distinct text: partners and summed similarity."""
    return P.min_similarity(None, colours=_colours(spark, sf)).groupBy("i").agg(
        F.count(F.lit(1)).alias("n"), F.sum("total").alias("total"))


@query(f"""WITH {_FOLD}, {_DOT} SELECT i, j, total FROM dt
UNION ALL SELECT name, name, round(own, 6) FROM own""")
def pair_weighted_dot(spark, sf):
    """The norm matrix over distinct texts."""
    colours = _colours(spark, sf)
    own = P.diagonal(colours).select(F.col("name").alias("i"), F.col("name").alias("j"), F.round("own", 6).alias("total"))
    return P.weighted_dot(None, colours).unionByName(own)


@query(f"WITH {_FOLD}, {_DOT}, {_D} SELECT i, j, total, round(d, 6) AS d FROM dd WHERE d <= 0.2")
def pair_distance(spark, sf):
    """Near pairs of distinct texts (``fold_copies`` lists the records of each)."""
    return P.pair_distances(None, 0.2, _colours(spark, sf)).select("i", "j", "total", F.round("d", 6).alias("d"))


_NEAR = f"""{_FOLD}, {_DOT}, {_D}, cls AS (SELECT name, is_ref FROM reps),
cand AS (SELECT CASE WHEN x.is_ref THEN j ELSE i END AS rep, CASE WHEN x.is_ref THEN i ELSE j END AS ref, round(d, 9) AS d
 FROM dd JOIN cls x ON x.name = i JOIN cls y ON y.name = j WHERE x.is_ref <> y.is_ref AND d <= 0.2),
every AS (SELECT reps.name AS rep, m.name, m.hap, m.is_ref FROM marked m JOIN reps ON reps.is_ref = m.is_ref AND reps.seq = upper(m.seq)),
al AS (SELECT a.name, a.hap, b.name AS ref, d FROM cand JOIN every a ON a.rep = cand.rep AND NOT a.is_ref
 JOIN every b ON b.rep = cand.ref AND b.is_ref)"""


def _to_references(chosen):
    return P.pair_distances(None, 0.2, P.sequence_colours(chosen), labels=chosen.select("name", F.col("is_ref").alias("label")))


@query(f"""WITH {_NEAR}, t AS (SELECT *, row_number() OVER (PARTITION BY hap, ref ORDER BY d, name) AS k FROM al)
SELECT name, ref, round(d, 6) AS distance, CASE WHEN k = 1 THEN 'Pri' ELSE 'Dup' END AS tag FROM t
UNION ALL SELECT name, NULL, 0.0, CASE WHEN is_ref THEN 'Ref' ELSE 'Novel' END FROM marked WHERE name NOT IN (SELECT name FROM t)""")
def nearest_ref_match(spark, sf):
    chosen, members = _chosen(spark, sf)
    alleles = _marked(spark, sf).select("name", "hap", "is_ref")
    out = M.reference_matches(_to_references(chosen), chosen.select("name", "is_ref"), members, alleles)
    return out.select("name", "ref", F.round("distance", 6).alias("distance"), "tag")


@query(f"""WITH {_NEAR} SELECT name, arg_min(ref, (d, ref)) AS ref, round(min(d), 6) AS distance FROM al GROUP BY name""")
def nearest_ref_single(spark, sf):
    chosen, members = _chosen(spark, sf)
    out = M.nearest_reference(_to_references(chosen), chosen.select("name", "is_ref"), members)
    return out.select("name", "ref", F.round("distance", 6).alias("distance"))


def _components_sql(common: int, out: str = "comp", edges: str = "pr", nodes: str = "reps") -> str:
    return f"""{out}_e AS (SELECT i, j FROM {edges} WHERE total > {common} UNION SELECT j, i FROM {edges} WHERE total > {common}),
{out}_r AS (SELECT name, name AS seen FROM {nodes} UNION SELECT r.name, e.j FROM {out}_r r JOIN {out}_e e ON e.i = r.seen),
{out} AS (SELECT name, min(seen) AS component FROM {out}_r GROUP BY name)"""


@query(f"WITH RECURSIVE {_ALL}, {_components_sql(100, edges='apr', nodes='marked')} SELECT name, component FROM comp")
def similarity_components(spark, sf):
    chosen, members, masses, colours = _folded(spark, sf)
    found = C.similarity_components(None, chosen.select("name"), common=100, colours=colours)
    return C.unfold_components(found, masses, members, common=100)


@query(f"""WITH RECURSIVE {_ALL}, {_components_sql(60, 'c1', 'apr', 'marked')},
big AS (SELECT name FROM c1 WHERE component IN (SELECT component FROM c1 GROUP BY component HAVING count(*) > 4)),
{_components_sql(300, 'c2', '(SELECT * FROM apr WHERE i IN (SELECT name FROM big) AND j IN (SELECT name FROM big))', 'big')}
SELECT name, component, 300 AS level FROM c2 UNION ALL
SELECT name, component, 60 FROM c1 WHERE name NOT IN (SELECT name FROM big)""")
def repartition_components(spark, sf):
    _, members, masses, colours = _folded(spark, sf)
    return C.repartition_components(masses, members, [(4, 300)], common=60, colours=colours)


@query(f"""WITH RECURSIVE {_FOLD}, {_MIN}, {_components_sql(100)}, k AS (SELECT component, kmer FROM cnt JOIN comp USING (name) GROUP BY 1, 2),
x AS (SELECT kmer, min(component) AS component FROM k GROUP BY kmer HAVING count(*) = 1)
SELECT component, count(*) AS n_exclusive FROM x GROUP BY component""")
def component_exclusive_kmers(spark, sf):
    chosen, _, _, colours = _folded(spark, sf)
    groups = C.similarity_components(None, chosen.select("name"), common=100, colours=colours)
    tagged = chosen.select("name", "seq").join(groups, "name")
    return SK.exclusive_marked_kmers(tagged, "component").groupBy("component").agg(F.count(F.lit(1)).alias("n_exclusive"))
