"""K-mers told apart in the buckets of their minimisers: same rows as counts and windows joined by k-mer."""

import random

import numpy as np
from pyspark.sql import functions as F

from weftline.functions.sequence import decode_kmer
from weftline.operators import graph as R, kmers as K, pairs as P, superkmers as SK
from weftline.plans import search as SE


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def sequences(spark):
    rng = random.Random(8)
    word = ["".join(rng.choice("ACGT") for _ in range(70)) for _ in range(5)]
    texts = [word[0] + word[1], word[1] + "N" + word[0], word[1] * 3, word[2], word[2] + word[3], word[4], "ACG", None, word[3] + word[0]]
    made = [("g" if i % 3 else "h", i, 1 + i % 2, t) for i, t in enumerate(texts)]
    made += [("g", 1, 2, word[4] + word[1]), (None, 20, 1, word[0]), (None, 21, 1, word[0] + word[4]), ("g", 30, 1, word[1]), ("h", 31, 1, word[1])]
    return spark.createDataFrame(made, "grp string, name long, copies int, seq string")


def test_colours_of_sequences(spark):
    seqs = sequences(spark)
    for by, ids in ((None, ("name", "copies")), ("grp", ("grp", "name", "copies"))):
        counts = K.sequence_counts(seqs, ids)
        if by:
            counts = counts.withColumn("kmer", F.struct("grp", "kmer"))
        want, got = P.colour_postings(counts.select("name", "copies", "kmer", "cnt")), P.sequence_colours(seqs, by=by)
        assert rows(got.postings.select(want.postings.columns)) == rows(want.postings) and not got.postings.isEmpty()
        assert rows(P.diagonal(got)) == rows(P.diagonal(want))
        # The plan of the postings holds no rows of windows or counts.
        assert rows(P.min_similarity(None, 10, got)) == rows(P.min_similarity(counts, 10))


def test_crowded_bucket_in_shares(spark, monkeypatch):
    rng = np.random.default_rng(3)
    first = rng.integers(0, 1 << 62, 50)
    size = np.full(50, 1, np.int64)
    whole = [np.sort(c) for c, _, _ in SK._shares(first, first, size, 31)]
    monkeypatch.setattr(SK, "BUCKET_WINDOWS", 8)
    parts = list(SK._shares(first, first, size, 31))
    assert len(parts) > 1 and np.array_equal(np.sort(np.concatenate([c for c, _, _ in parts])), whole[0])


def test_segments_of_sequences(spark):
    seqs = sequences(spark).where("seq IS NOT NULL")
    order = R.insertion_order(seqs, F.lit(0))
    hits = K.kmer_hits(seqs, ("grp", "name"))
    lengths = seqs.select("grp", "name", F.length("seq").alias("len"))
    want = rows(R.new_segments(hits, lengths, order, longer_than=10, pad=5))
    assert rows(R.sequence_segments(seqs, order, longer_than=10, pad=5)) == want and want


def test_letters():
    codes = np.array([0, 1, (1 << 62) - 1, 27], np.int64)
    assert SK.letters(codes, 31).to_pylist() == ["A" * 31, "A" * 30 + "C", "T" * 31, "A" * 28 + "CGT"]


def test_counts_as_letters(spark):
    seqs = sequences(spark)
    want = rows(SK.count_super_kmers(seqs).select(decode_kmer(F.col("kmer")).alias("kmer"), "cnt"))
    assert rows(SK.count_super_kmers(seqs, text=True)) == want


def test_counts_in_steps(spark, monkeypatch):
    text = np.frombuffer(b"ACGTTGCAAC" * 40, np.uint8)
    first, last, size, _ = SK.runs_of(text, 31, 15)
    assert len(first) > 1 and int(size.sum()) == len(text) - 30
    assert SK.STEP_RUNS * 31 <= SK.BUCKET_WINDOWS


def test_probes_from_counts(spark):
    seqs = sequences(spark).where("seq IS NOT NULL")
    targets = K.target_set(K.kmer_hits(seqs.where("name < 4").withColumnRenamed("name", "target"), ("target",)))
    want = rows(K.probe_targets(K.kmer_hits(seqs, ("name",)), targets, "name", limit=2))
    assert rows(K.probe_sequences(seqs, targets, limit=2)) == want and want


def test_unique_enough_few_and_many(spark):
    seqs = sequences(spark)
    targets = seqs.where("name < 6").select(F.col("name").alias("target"), "seq")
    few = rows(SE.unique_enough(targets, seqs, limit=3))
    assert few == rows(SE.unique_enough(targets, seqs, limit=3, few=0)) and few
