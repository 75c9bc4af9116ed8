"""Envelopes swept key by key, alignments cut in their row: same rows as by blocks, scans and rows of operations."""

import random

from pyspark.sql import functions as F

from weftline.functions.attrs import gff_attributes
from weftline.operators import alignments as AL, intervals as I


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_envelope_swept(spark, monkeypatch):
    rng = random.Random(5)
    made = []
    for i in range(300):
        s = rng.randrange(120)
        made.append((rng.randrange(6), s, s + rng.randrange(0, 40), None if i % 50 == 0 else rng.randrange(9), i % 290))
    made += [(None, 1, 9, 3, 1), (7, 0, 9, 3, None), (7, 4, 12, 2, 5)]
    df = spark.createDataFrame(made, "key int, start long, end long, score long, id long")
    def envelope(few):
        return I.best_score_envelope(df, ["key"], "id", longer_than=2, levels=10, width=16, few=few)
    want = rows(envelope(0))
    assert rows(envelope(1000)) == want and want
    monkeypatch.setattr(I, "SWEPT", 7)
    assert rows(envelope(1000)) == want
    # Only the key with an id that is null goes by scans.
    assert envelope(1000).where("key <> 7").count() == len([r for r in want if r[0] != 7])


def test_levels_follow_the_ranges(spark):
    one = spark.createDataFrame([(1, 0, 3), (1, 2, 4)], "k int, start long, end long").withColumn("v", F.col("start"))
    points = spark.createDataFrame([(1, 2), (1, 3)], "k int, p long")
    found = I.stab_best(points, one, ["k"], "p", "v", levels=30)
    assert rows(found) == [(1, 2, 0), (1, 3, 2)]
    assert "sequence(0, 30" not in found._jdf.queryExecution().analyzed().toString()


def test_anchors_cut_in_the_row(spark):
    texts = ["10M5I10M5D10M", "30=", "5M", "12M3D2X8H9M", "20M3D", "3I4M20XacG5S", None, "", "0M15M0D20M", "2M2D30M2D2M"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, "40M")], "id long, cigar string")
    twice = df.unionByName(spark.createDataFrame([(20, "40M"), (20, "40M")], "id long, cigar string"))
    want = rows(AL.strip_anchors(df, "id", 4, most=0))
    assert rows(AL.strip_anchors(df, "id", 4)) == want and len(want) > 4
    assert rows(AL.strip_anchors(twice.where("id < 20"), "id", 4)) == want
    assert AL.strip_anchors(twice, "id", 4).where("id = 20").count() == 1


def test_last_of_repeated_keys(spark):
    df = spark.createDataFrame([("a=1;b=2",), ("a=1; a=3;b=2=x",), ("x",), ("",), (None,)], "t string")
    got = [r[0] for r in df.select(gff_attributes(F.col("t"))).collect()]
    assert got == [{"a": "1", "b": "2"}, {"a": "3", "b": "2=x"}, {}, {}, None]
