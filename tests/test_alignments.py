import random
import re

from pyspark.sql import functions as F

from weftline.functions import cigar as C
from weftline.operators import aligner as AN, alignments as AL, genes as G, graph as R, kmers as K


def best_score(q, r):
    low = -10 ** 9
    best, ins, dele = ([[low] * (len(r) + 1) for _ in range(len(q) + 1)] for _ in range(3))
    best[0][0] = 0
    for i in range(len(q) + 1):
        for j in range(len(r) + 1):
            if i:
                ins[i][j] = max(ins[i - 1][j] - AN.EXTEND, best[i - 1][j] - AN.OPEN)
            if j:
                dele[i][j] = max(dele[i][j - 1] - AN.EXTEND, best[i][j - 1] - AN.OPEN)
            diag = best[i - 1][j - 1] + (AN.MATCH if q[i - 1] == r[j - 1] else AN.MISMATCH) if i and j else low
            if i or j:
                best[i][j] = max(diag, ins[i][j], dele[i][j])
    return best[-1][-1]


def replay(q, r, text):
    i = j = 0
    for size, op, bases in re.findall(r"(\d+)([MXID])([ACGT]*)", text):
        size = int(size)
        if op == "M":
            assert q[i:i + size] == r[j:j + size]
        if op in "XI":
            assert bases == q[i:i + size]
        i += size if op != "D" else 0
        j += size if op != "I" else 0
    assert (i, j) == (len(q), len(r))


def test_global_alignment_is_optimal(monkeypatch):
    rng = random.Random(1)
    for cells in (10 ** 6, 12):
        monkeypatch.setattr(AN, "_CELLS", cells)
        for _ in range(150):
            q = "".join(rng.choice("ACGT"[:rng.choice([2, 4])]) for _ in range(rng.randint(0, 14)))
            r = list(q)
            for _ in range(rng.randint(0, 5)):
                if r and rng.random() < .5:
                    del r[rng.randrange(len(r))]
                else:
                    r.insert(rng.randint(0, len(r)), rng.choice("ACGT"))
            r = "".join(r)
            score, text = AN.align_pair(q, r)
            assert score == best_score(q, r)
            replay(q, r, text)


def test_variants_and_names(spark):
    rng = random.Random(2)
    core = "".join(rng.choice("ACGT") for _ in range(600))
    extra = "".join(rng.choice("ACGT") for _ in range(80))
    pairs = spark.createDataFrame([
        (1, core[:300] + extra + core[300:], core), (2, core[:300] + core[100:180] + core[300:], core),
        (3, core, core[:300] + extra + core[300:])], "id long, query string, ref string")
    found = AN.classify_variants(AN.variants(AN.global_align(pairs), pairs, longer_than=40), pairs)
    got = {r.id: (r.type, r.size) for r in found.collect()}
    assert got == {1: ("Insertion", 80), 2: ("Duplication", 80), 3: ("Deletion", 80)}


def test_msa_rows(spark):
    refs = spark.createDataFrame([(1, "ACGTACGT")], "grp long, seq string")
    paths = spark.createDataFrame([(1, 1, "4M2ITT4M"), (1, 2, "4M1IG2D2M"), (1, 3, "8M"), (1, 4, "1XG7M1IC")],
                                  "grp long, name long, cigar string")
    got = {r.name: r.row for r in AN.msa(paths, refs).collect()}
    assert got == {1: "ACGTTTACGT-", 2: "ACGTG---GT-", 3: "ACGT--ACGT-", 4: "GCGT--ACGTC"}


def test_expand_check_polish(spark):
    df = spark.createDataFrame([(1, "6M2I2M1D2M", "ACGTACTTAGG", "ACCTACGGTTGG")], "id long, cigar string, query string, ref string")
    out = AL.expand_matches(df, "id")
    assert out.first().cigar == "2=1X3=2I2=1D2="
    assert AL.check_bases(df.drop("cigar").join(out, "id"), "id").count() == 0
    long = spark.createDataFrame([(1, "5M10X300M40X250M9I3M"), (2, "50M")], "id long, cigar string")
    kept = {r.id: (r.qstart, r.cigar) for r in AL.polish_ends(long, "id").collect()}
    assert kept == {1: (15, "300M40X250M")}


def test_slice_composes(spark):
    df = spark.createDataFrame([(1, "10M5I10M5D10M", 4, 30)], "id long, cigar string, qstart long, qend long")
    one = AL.slice_by_query(df, "id").first()
    assert (one.rstart, one.rend, one.cigar) == (4, 30, "6M5I10M5D5M")
    parts = spark.createDataFrame([(1, one.cigar, 3, 9), (2, "10M5I10M5D10M", 7, 13)], "id long, cigar string, qstart long, qend long")
    a, b = (r for r in sorted(AL.slice_by_query(parts, "id").collect()))
    assert a.cigar == b.cigar == "3M5I3M" and b.rstart == a.rstart + 4


def test_exon_hits(spark):
    hits = spark.createDataFrame(
        [(1, 1, 100, 0, 100, "+", 99), (1, 1, 100, 50, 150, "+", 95), (1, 1, 100, 120, 220, "+", 90), (1, 1, 100, 400, 420, "+", 20),
         (1, 2, 100, 300, 400, "+", 100), (1, 3, 100, 600, 700, "+", 100)],
        "allele long, exon long, size long, start long, end long, strand string, match long")
    kept = sorted((r.exon, r.start) for r in G.best_exon_hits(hits).collect())
    assert kept == [(1, 0), (1, 120), (2, 300), (3, 600)]


def test_graph_segments_and_paths(spark):
    rng = random.Random(4)
    a, b, c = ("".join(rng.choice("ACGT") for _ in range(600)) for _ in range(3))
    flip = str.maketrans("ACGT", "TGCA")
    seqs = spark.createDataFrame([("g", 1, a + b), ("g", 2, a + c), ("g", 3, c[::-1].translate(flip) + b)], "grp string, name long, seq string")
    order = R.insertion_order(seqs, F.lit(0))
    hits = K.kmer_hits(seqs, ("grp", "name"), strand=True)
    lengths = seqs.select("grp", "name", F.length("seq").alias("len"))
    found = R.new_segments(hits.drop("fwd"), lengths, order)
    assert sorted((r.name, r.start, r.end) for r in found.collect()) == [(1, 0, 1200), (2, 540, 1200)]
    segments = R.cut_segments(seqs, found)
    paths = R.graph_paths(R.colinear_runs(hits, segments))
    text = {r.name: r.path for r in R.path_text(paths).collect()}
    assert text == {1: ">0", 2: ">0>1", 3: "<1>0"}
    spelled = {r.name: r.seq for r in R.path_sequence(paths, segments).collect()}
    assert spelled[1] == a + b and spelled[3].endswith(b)
    assert R.chunk_successors(paths, gap=100).count() > 0


def test_path_functions(spark):
    df = spark.createDataFrame([(">s1:400M<s2:100M5D",)], "p string")
    row = df.select(C.matched_segments(F.col("p")), C.reverse_path(F.col("p")), C.mask_short_segments(F.col("p"))).first()
    assert tuple(row) == (">s1", ">s2:100M5D<s1:400M", ">s1:400M<s2:100H")
