"""Components and their own k-mers from shared colours: no query writes the k-mer counts of its sequences."""

import random

import pytest
from pyspark.sql import functions as F

from catalogue import pairs as CP
from weftline.operators import components as C, kmers as K, pairs as P, superkmers as SK


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def folder(spark, tmp_path):
    """Documents of six classes of near copies, two records a text, and labels of a few."""
    rng = random.Random(5)
    texts = ["".join(rng.choice("ABCD") for _ in range(400)) for _ in range(6)]
    made = []
    for i in range(24):
        text = texts[i % 6]
        made.append((i, text[:300] + ("" if i < 12 else texts[(i + 1) % 6][100:260]) + text[300:], "en", f"s{i % 3}"))
    made += [(50, "AB", "de", "s1"), (51, "", "de", "s1"), (52, None, "de", "s1")]
    spark.createDataFrame(made, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1), (7, 0)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_queries_write_no_counts(spark, folder, monkeypatch):
    chosen, members = P.fold_copies(CP._marked(spark, folder), by=("is_ref",))
    counts = K.sequence_counts(chosen, ("name", "copies"))
    found = C.similarity_components(counts, chosen.select("name"), common=100)
    whole = rows(C.unfold_components(found, counts, members, 100))
    ladder = rows(C.repartition_components(counts, members, [(4, 300)], common=60))
    own = K.exclusive_to_group(counts.select("name", "kmer").join(found, "name"), "component")
    sizes = rows(own.groupBy("component").agg(F.count(F.lit(1)).alias("n")))

    def refuse(*_, **__):
        raise AssertionError("rows of counts")
    monkeypatch.setattr(K, "sequence_counts", refuse)
    assert rows(CP.similarity_components(spark, folder)) == whole and len({c for _, c in whole}) < len(whole)
    assert rows(CP.repartition_components(spark, folder)) == ladder and {r[2] for r in ladder} == {60, 300}
    assert rows(CP.component_exclusive_kmers(spark, folder)) == sizes and sizes


def test_numbers_of_windows(spark):
    seqs = spark.createDataFrame([(1, "ACGTT" * 9 + "N" + "acg" * 11), (2, "ACG"), (3, ""), (4, None), (5, "A" * 31)], "name long, seq string")
    want = {r["name"]: r["n"] for r in K.sequence_counts(seqs).groupBy("name").agg(F.sum("cnt").alias("n")).collect()}
    got = {r["name"]: r["n"] for r in seqs.select("name", K.window_numbers().alias("n")).collect()}
    assert {k: v for k, v in got.items() if v} == want == {1: 18, 5: 1}


def test_exclusive_to_a_mark(spark, monkeypatch):
    rng = random.Random(2)
    word = ["".join(rng.choice("ACGT") for _ in range(60)) for _ in range(3)]
    seqs = spark.createDataFrame([(1, word[0] + word[1]), (2, word[1] + word[2]), (1, word[0]), (3, "ACN"), (4, None)], "grp long, seq string")
    want = rows(SK.exclusive_super_kmers(seqs).select("kmer", "grp", "n"))
    assert rows(SK.exclusive_marked_kmers(seqs, "grp")) == want and want
    monkeypatch.setattr(SK, "BUCKET_WINDOWS", 16)
    assert rows(SK.exclusive_marked_kmers(seqs, "grp", buckets=1)) == want
