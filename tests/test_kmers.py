import random
from collections import Counter

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from weftline.functions import sequence as S
from weftline.operators import kmers as K

FLIP = str.maketrans("ACGTacgt", "TGCAtgca")


def rc(text):
    return text[::-1].translate(FLIP)


def spec_hits(text, k):
    text = text.upper()
    return [(i, max(text[i:i + k], rc(text[i:i + k]))) for i in range(len(text) - k + 1)
            if set(text[i:i + k]) <= set("ACGT")]


def code(kmer):
    value = 0
    for ch in kmer:
        value = value * 4 + "ACGT".index(ch)
    return value


@settings(max_examples=60, deadline=None)
@given(st.text("ACGTacgtN", max_size=80), st.integers(1, 31))
def test_pack_matches_definition(text, k):
    import numpy as np

    codes, valid, _ = K.pack_kmers(np.frombuffer(text.encode(), np.uint8), k, True)
    got = [(i, int(c)) for i, (c, v) in enumerate(zip(codes, valid)) if v]
    assert got == [(i, code(s)) for i, s in spec_hits(text, k)]


def test_hits_across_tiles_case_and_short(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("ACGTacgtN") if rng.random() < .05 else rng.choice("ACgt") for _ in range(n)))
            for i, n in enumerate([0, 5, 31, 32, 900, 2001])]
    df = spark.createDataFrame(rows, "name long, seq string")
    got = {(r.name, r.pos, r.kmer) for r in K.kmer_hits(df, step=100).collect()}
    assert got == {(n, i, code(s)) for n, t in rows for i, s in spec_hits(t, 31)}


def test_strand_and_wrap_invariance(spark):
    text = "ACGTTGCAAGGCTTAACCGGTTACGATCGATCGGCTAACGTAGCTAGCTAGG"
    df = spark.createDataFrame([(1, text), (2, rc(text))], "name long, seq string")
    per = {n: Counter() for n in (1, 2)}
    for r in K.kmer_hits(df).collect():
        per[r.name][r.kmer] += 1
    assert per[1] == per[2]


def test_saturation_and_round_trip(spark):
    df = spark.createDataFrame([(1, "A" * 400)], "name long, seq string")
    row = K.count_kmers(K.kmer_hits(df)).withColumn("t", S.decode_kmer(F.col("kmer"))).first()
    assert (row.cnt, row.t) == (255, "T" * 31)
    back = spark.createDataFrame([("T" * 31,)], "k string").select(S.encode_kmer(F.col("k"))).first()[0]
    assert back == 4 ** 31 - 1 == row.kmer


def test_filter_kernel_equals_column_functions(spark):
    rng = random.Random(5)
    words = ["AC" * 15 + "A", "ACG" * 10 + "A", "GC" * 15 + "G"] + ["".join(rng.choice("ACGT") for _ in range(31)) for _ in range(200)]
    df = spark.createDataFrame([(w,) for w in set(words)], "t string").withColumn("kmer", S.encode_kmer(F.col("t")))
    kept = {r.kmer for r in K.gc_and_complexity_filter(df.select("kmer")).collect()}
    spec = {r.kmer for r in df.where(S.gc_in_range(F.col("t")) & ~S.low_complexity(F.col("t"))).collect()}
    assert kept == spec and 0 < len(kept) < len(set(words))


def spec_trim(flags, cutoff, r):
    loss = r / (1 - r)

    def side(marks):
        at, score = 0, 0.0
        for pos, hit in enumerate(marks):
            score += 1 if hit else -loss
            if score < -1e-9:
                at, score = pos, 0.0
            elif score >= cutoff - 1e-9:
                break
        return at

    left, right = side(flags), side(flags[::-1])
    n = len(flags)
    return sum(flags) - sum(flags[:left]) - sum(flags[n - right:] if right else []), left, right


def test_trim_equals_walk(spark):
    rng = random.Random(11)
    base = "".join(rng.choice("ACGT") for _ in range(4000))
    seqs, listed = [], set()
    for name in range(8):
        text = "".join(rng.choice("ACGT") for _ in range(rng.randint(100, 900)))
        at = rng.randint(0, 3000)
        text += base[at:at + rng.randint(40, 300)] + "".join(rng.choice("ACGT") for _ in range(rng.randint(100, 900)))
        seqs.append((name, text))
    listed = {code(s) for _, s in spec_hits(base, 31)}
    df = spark.createDataFrame(seqs, "name long, seq string")
    kmers = spark.createDataFrame([(c,) for c in listed], "kmer long")
    got = {r.name: r for r in K.trim_by_kmers(df, K.kmer_hits(df), kmers, anchor=0, cutoff=60, rcutoff=0.3).collect()}
    for name, text in seqs:
        flags = [code(s) in listed for _, s in spec_hits(text, 31)]
        n = sum(flags)
        if n < 60:
            expect = (n, 0, 0, "filter")
        elif n >= len(text) * 0.3:
            expect = (n, 0, 0, "pass")
        else:
            left = spec_trim(flags, 60, 0.3)
            expect = (*left, "trim") if left[0] >= 60 else (left[0], 0, 0, "filter")
        assert (got[name]["count"], got[name].start, got[name].end, got[name].decision) == expect


def test_mask_runs(spark):
    df = spark.createDataFrame([(1, "ACGTACGTAC"), (2, "acgt")], "name long, seq string")
    runs = spark.createDataFrame([(1, 2, 5), (1, 8, 9)], "name long, start long, end long")
    assert {r.name: r.seq for r in K.mark_runs(df, runs).collect()} == {1: "acGTAcgtAc", 2: "acgt"}
    assert {r.name: r.seq for r in K.mark_runs(df, runs, hard=True).collect()} == {1: "nnGTAnnnAn", 2: "nnnn"}
