import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.functions.sequence import decode_kmer
from weftline.operators import kmers as K, superkmers as SK

FLIP = str.maketrans("ACGT", "TGCA")


def canonical(text):
    return max(text, text[::-1].translate(FLIP))


def plain(seqs, k):
    out = Counter()
    for group, seq in seqs:
        text = (seq or "").upper()
        for i in range(len(text) - k + 1):
            if set(text[i:i + k]) <= set("ACGT"):
                out[group, canonical(text[i:i + k])] += 1
    return out


def drawn(seed):
    rng = random.Random(seed)
    base = "".join(rng.choice("ACGT") for _ in range(700))
    out = [("a", base), ("b", base[::-1].translate(FLIP)), ("a", base[100:400] + "N" + base[200:300]), (None, base[:60].lower()),
           ("a", "A" * 200), ("b", "ACG" * 90), ("a", None), ("b", ""), ("a", "ACGTN" * 30), ("b", "A" * 30), ("a", base), ("a", base)]
    return out


@pytest.mark.parametrize("k, m, stretch, buckets", [(31, 15, 1 << 21, None), (31, 7, 100, 3), (9, 4, 37, 1), (5, 5, 64, 2)])
def test_counts_equal_brute_force(spark, monkeypatch, k, m, stretch, buckets):
    monkeypatch.setattr(SK, "STRETCH", stretch)
    seqs = drawn(k)
    df = spark.createDataFrame(seqs, "grp string, seq string").repartition(3)
    got = SK.count_super_kmers(df, ["grp"], k=k, m=m, limit=None, buckets=buckets).select("grp", decode_kmer(F.col("kmer"), k).alias("t"), "cnt")
    assert {(r.grp, r.t): r.cnt for r in got.collect()} == plain(seqs, k)
    whole = Counter()
    for (_, t), c in plain(seqs, k).items():
        whole[t] += c
    rows = SK.count_super_kmers(df, k=k, m=m, limit=4, buckets=buckets).select(decode_kmer(F.col("kmer"), k).alias("t"), "cnt").collect()
    assert len(rows) == len(whole) and {r.t: r.cnt for r in rows} == {t: min(c, 4) for t, c in whole.items()}


def test_runs_hold_every_window_once():
    rng = np.random.default_rng(1)
    text = np.frombuffer("".join(rng.choice(list("ACGTN"), 3000, p=[.3, .3, .2, .19, .01])).encode(), np.uint8)
    codes, valid, _ = K.pack_kmers(text, 31, False)
    first, last, size, _ = SK.runs_of(text, 31, 15)
    assert size.max() <= 31 and size.sum() == valid.sum()
    assert sorted(c for part, _ in SK.windows_of(first, last, size, 31) for c in part) == sorted(codes[valid])


def test_reverse_codes():
    rng = random.Random(2)
    for k in (1, 2, 15, 31):
        for _ in range(20):
            text = "".join(rng.choice("ACGT") for _ in range(k))
            code = K.pack_kmers(np.frombuffer(text.encode(), np.uint8), k, False)[0]
            other = K.pack_kmers(np.frombuffer(text[::-1].translate(FLIP).encode(), np.uint8), k, False)[0]
            assert K.reverse_codes(code, k) == other


def test_empty_table(spark):
    assert SK.count_super_kmers(spark.createDataFrame([], "seq string")).count() == 0
