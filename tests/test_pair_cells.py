"""Pairs are made where postings meet: the same totals as by definition, and no pair is shuffled."""

from __future__ import annotations

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from weftline.operators import pairs as P
from weftline.plans import compile as CP


def _counts(names, kmers=30, seed=5):
    rng = random.Random(seed)
    return [(n, k, rng.randint(1, 3)) for n in names for k in range(kmers) if rng.random() < 0.3]


def _brute(rows, dot):
    held: dict = {}
    for name, kmer, cnt in rows:
        held.setdefault(name, {})[kmer] = cnt
    out = {}
    for i, j in combinations(sorted(held), 2):
        total = sum(held[i][k] * held[j][k] if dot else min(held[i][k], held[j][k]) for k in held[i].keys() & held[j].keys())
        if total:
            out[i, j] = total
    return out


@pytest.mark.parametrize("dot", [False, True])
@pytest.mark.parametrize("cell, small, step", [(1 << 20, 1 << 16, 1 << 21), (40, 40, 7), (60, 20, 1)])
def test_cells_of_any_size_give_all_pairs(spark, dot, cell, small, step):
    rows = _counts([f"s{i}" for i in range(30)])
    postings = P.colour_postings(spark.createDataFrame(rows, "name string, kmer long, cnt long")).postings
    got = P.pair_totals(postings, dot, cell=cell, small=small, step=step).collect()
    assert {(r.i, r.j): r.total for r in got} == _brute(rows, dot) and len(got) == len(_brute(rows, dot))


def test_counts_beyond_exact_doubles_stay_exact(spark):
    big = (1 << 30) + 1
    rows = [(1, 7, big), (2, 7, big), (3, 7, 1)]
    got = P.pair_totals(P.colour_postings(spark.createDataFrame(rows, "name long, kmer long, cnt long")).postings, True, step=1)
    assert {(r.i, r.j): r.total for r in got.collect()} == {(1, 2): big * big, (1, 3): big, (2, 3): big}


def test_no_pair_is_shuffled(spark):
    """candidates were joined with the postings of their sequences, one row per pair and k-mer."""
    counts = spark.createDataFrame(_counts(range(20)), "name long, kmer long, cnt long")
    for found in (P.min_similarity(counts, 5), P.min_similarity(counts), P.pair_distances(counts, 0.4), P.weighted_dot(counts)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(i#" not in plan and "hashpartitioning(j#" not in plan
        assert "FlatMapGroupsInArrow" in plan


def test_labels_keep_pairs_apart(spark):
    rows = _counts(range(24))
    counts = spark.createDataFrame(rows, "name long, kmer long, cnt long")
    labels = spark.range(24).select(F.col("id").alias("name"), F.when(F.col("id") != 5, F.col("id") % 3 == 0).alias("label"))
    everything = {(r.i, r.j): (r.total, round(r.d, 9)) for r in P.pair_distances(counts, 0.8).collect()}
    got = {(r.i, r.j): (r.total, round(r.d, 9)) for r in P.pair_distances(counts, 0.8, labels=labels).collect()}
    assert got == {(i, j): v for (i, j), v in everything.items() if 5 not in (i, j) and (i % 3 == 0) != (j % 3 == 0)} and got


def test_norm_entries_go_out_as_they_are_made(spark):
    """the entries were summed, joined with the members and written before they were returned."""
    rng = random.Random(2)
    parts = ["".join(rng.choice("ACGT") for _ in range(60)) for _ in range(6)]
    rows = [(g, f"{g}{n}", "N".join(rng.sample(parts, 3))) for g in ("a", "b", "c") for n in range(6)]
    made = CP.group_matrices(spark.createDataFrame(rows, "grp string, name string, seq string"))
    plan = made.entries._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(i#" not in plan and "hashpartitioning(j#" not in plan
    texts = {g: sorted((n, s.split("N")) for h, n, s in rows if h == g) for g in ("a", "b", "c")}
    want = {(g, i, j): 30.0 * len(set(own[i][1]) & set(own[j][1])) for g, own in texts.items() for i, j in combinations(range(6), 2)}
    got = {(r.grp, r.i, r.j): r.v for r in made.entries.where("i < j").collect()}
    assert got == {k: v for k, v in want.items() if v}
    assert made.norm.count() == made.entries.count()
