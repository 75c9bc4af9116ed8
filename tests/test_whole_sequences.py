"""K-mers of whole sequences, exclusive k-mers by buckets, and alignments gathered without a row per site."""

import random

import pytest
from pyspark.sql import functions as F

from weftline.operators import aligner as AN, graph as R, kmers as K, pairs as P, superkmers as SK
from weftline.operators.scan import prefix_scan


@pytest.fixture(scope="module")
def seqs(spark):
    rng = random.Random(5)
    part = "".join(rng.choice("ACGT") for _ in range(300))
    rows = [(i, None if i % 7 == 0 else f"g{i % 3}", "".join(rng.choice("ACGT") for _ in range(200)) + part[:40 * (i % 5)] * 2) for i in range(1, 30)]
    rows += [(3, "g1", part), (None, "g0", part + part), (40, "g2", None), (41, "g2", ""), (42, "g2", "ACGTNACGT")]
    return spark.createDataFrame(rows, "name bigint, grp string, seq string").cache()


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("longest", [1 << 20, 300])
def test_counts_of_whole_sequences(seqs, longest):
    want = K.count_kmers(K.kmer_hits(seqs.where("seq IS NOT NULL")), ["name"], None)
    assert _rows(K.sequence_counts(seqs, longest=longest)) == _rows(want)


@pytest.mark.parametrize("longest", [1 << 20, 300])
def test_repeats_of_whole_sequences(seqs, longest):
    want = R.self_repeats(K.kmer_hits(seqs.where("seq IS NOT NULL")), longer_than=35).select("name", "start", "end")
    assert want.count() > 5
    assert _rows(R.sequence_repeats(seqs, longer_than=35, longest=longest)) == _rows(want)


def test_whole_sequences_shuffle_no_windows(seqs):
    plain = seqs.where("name > 3")
    plan = K.sequence_counts(plain)._jdf.queryExecution().analyzed().toString()
    assert plan.count("MapInArrow") == 2  # the long ones' windows stand beside, over no rows here
    assert K.apart(plain.select("name", "seq"), ["name"], "seq", K.LONGEST)[1].isEmpty()


@pytest.mark.parametrize("buckets", [1, 5])
def test_exclusive_by_buckets(seqs, buckets):
    hits = K.kmer_hits(seqs.where("seq IS NOT NULL"), ("grp",))
    skipping = K.exclusive_to_group(hits).select("kmer", "grp")
    assert _rows(SK.exclusive_super_kmers(seqs, null_is_group=False, buckets=buckets).select("kmer", "grp")) == _rows(skipping)
    own = K.exclusive_to_group(hits, groups=seqs.select("grp")).join(hits.groupBy("kmer").agg(F.count(F.lit(1)).alias("n")), "kmer")
    assert _rows(SK.exclusive_super_kmers(seqs, buckets=buckets)) == _rows(own.select("kmer", "grp", "n"))


def test_shared_kmers_only_get_hashes(spark):
    rows = [("a", 1, 1, 2), ("a", 1, 2, 3), ("b", 2, 2, 3), ("b", 2, 3, 4), ("c", 1, 2, 1), ("d", 1, 9, 5)]
    found = P.colour_postings(spark.createDataFrame(rows, "name string, copies int, kmer bigint, cnt bigint"))
    assert _rows(found.postings) == [(2, "a", 3, 1, 3), (2, "b", 3, 1, 3), (2, "c", 1, 1, 3)]
    assert {r["name"]: (r["lone"], r["inner"]) for r in found.alone.collect()} == {"a": (4, 0), "b": (0, 16), "c": (0, 0), "d": (25, 0)}


def test_msa_has_no_row_per_site(spark):
    paths = spark.createDataFrame([(1, 1, "2M1IT2M"), (1, 2, "1M3ITTT3M"), (1, 3, "4M")], "grp int, name int, cigar string")
    refs = spark.createDataFrame([(1, "ACGT")], "grp int, seq string")
    out = AN.msa(paths, refs)
    assert _rows(out.select("name", "row")) == [(1, "A---CTGT"), (2, "ATTTC-GT"), (3, "A---C-GT")]
    assert "Broadcast" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join Inner") == 1  # the reference only


def test_totals_are_not_broadcast(spark):
    df = spark.createDataFrame([(i, 1, 1) for i in range(20)], "key int, at int, v int")
    out = prefix_scan(df, ["key"], "at", F.floor(F.col("at") / 8), F.col("v"), "sum", "s")
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.agg(F.sum("s")).first()[0] == 20
