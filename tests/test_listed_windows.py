"""Listed k-mers, group sizes and moved windows where the sequences or their buckets are: the same rows as by windows."""

import random

import numpy as np
from pyspark.sql import functions as F

from weftline.operators import kmers as K, superkmers as SK, tiling as TI


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def sequences(spark, name="long"):
    rng = random.Random(4)
    word = ["".join(rng.choice("ACGT") for _ in range(60)) for _ in range(4)]
    texts = [word[0] + word[1], (word[1] + "N" + word[0]).lower(), word[1] * 3, word[2], "ACG", None, word[3] + word[0] + word[2], "", word[1]]
    made = [("gh"[i % 2], i, t) for i, t in enumerate(texts)] + [("g", 2, word[3]), (None, 20, word[0]), ("h", None, word[1])]
    seqs = spark.createDataFrame(made, "grp string, name long, seq string")
    return seqs.withColumn("name", F.col("name").cast(name))


def windows(seqs, *ids):
    return K.kmer_hits(seqs.where("seq IS NOT NULL"), ids or ("name",))


def listed(seqs):
    return SK.exclusive_super_kmers(seqs.where("name < 7")).where("n > 1").select("kmer")


def test_found_windows(spark):
    for kind in ("long", "string"):
        seqs = sequences(spark, kind)
        kmers = listed(sequences(spark))
        want = rows(K.found_kmers(windows(seqs.where("name IS NOT NULL")), kmers).select("name", "pos", "kmer"))
        assert rows(SK.found_windows(seqs, kmers, buckets=3)) == want and want
    pieces = SK.found_windows(seqs, kmers, True).collect()
    assert sorted((p["name"], at) for p in pieces for at in range(p["start"], p["end"])) == sorted((n, p) for n, p, _ in want)
    assert len(pieces) < len(want)


def test_minimisers_of_windows():
    text = np.frombuffer(b"ACGTTGCAACGGTACCATGCATTTGACCAGTACGTAACGTTGCA" * 3, np.uint8)
    start, first, _, _, least = SK.located_runs(text, 31, 15)
    assert np.array_equal(SK.minimisers_of(first, 31, 15), least)
    assert np.array_equal(SK.minimisers_of(SK.reverse_codes(first, 31), 31, 15), least)


def test_masks_without_hits(spark):
    seqs, kmers = sequences(spark).where("name <> 2"), listed(sequences(spark))
    for f in (K.mask_by_kmers, K.mark_last_bases):
        want = rows(f(seqs, windows(seqs), kmers))
        assert rows(f(seqs, None, kmers)) == want and any(s and s != s.lower() for _, _, s in want)


def test_runs_of_long_sequences(spark):
    seqs = sequences(spark).where("name <> 2")
    runs = spark.createDataFrame([(0, 3, 9), (0, 20, 119), (1, 0, 5), (4, 1, 3), (4, 3, 3)], "name long, start long, end long")
    for hard in (False, True):
        assert rows(K.mark_runs(seqs, runs, hard)) == rows(K.mark_runs(seqs, runs, hard, longest=10))


def test_trims_by_listed_hits(spark):
    seqs, kmers = sequences(spark).where("name <> 2"), listed(sequences(spark))
    hits = windows(seqs)
    found = SK.found_windows(seqs, kmers)
    options = dict(anchor=0, cutoff=20, rcutoff=0.6)
    want = K.trim_by_kmers(seqs, hits, kmers, **options)
    assert rows(K.trim_by_kmers(seqs, found, None, **options)) == rows(want)
    left = rows(K.surviving_kmers(kmers, found, want))
    assert rows(K.surviving_kmers(kmers, hits, want)) == left


def test_group_sizes(spark, monkeypatch):
    seqs = sequences(spark)
    sets = {}
    for grp, kmer in windows(seqs, "grp").select("grp", "kmer").collect():
        sets.setdefault(grp, set()).add(kmer)
    want = {g: (len(s), sum(any(x in o for h, o in sets.items() if h != g) for x in s)) for g, s in sets.items()}
    for steps in (SK.STEP_RUNS, 2):
        monkeypatch.setattr(SK, "STEP_RUNS", steps)
        got = SK.group_sizes(seqs, buckets=2).collect()
        assert {r["grp"]: (r["size"], r["shared"]) for r in got} == want and len(got) == 3
        assert sum(r["leads"] for r in got) == len(set().union(*sets.values()))


def test_windows_move_with_their_sequence(spark):
    seqs = sequences(spark)
    kept = spark.createDataFrame([(0, 0, 10, 0), (0, 40, 120, 10), (1, 5, 90, 0), (2, 0, 60, 0), (6, 30, 31, 0)], "name long, start long, end long, new_start long")
    want = rows(TI.moved_places(windows(seqs).select("name", "pos"), kept).select("name", "pos", "new_pos"))
    assert rows(TI.moved_places(None, kept, seqs=seqs)) == want and any(r[2] is None for r in want)
