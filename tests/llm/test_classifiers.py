import random

import pytest
from pyspark.sql import functions as F

from weftline.llm import quality as Q, toxicity as T
from weftline.llm.labelled import fold, sample


def prose(rng, n):
    return " ".join("".join(rng.choice(["the", "an", "er", "on", "ti", "re"]) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(1)
    docs, labels = [], []
    for d in range(1500):
        toxic, good = int(rng.random() < 0.2), int(rng.random() < 0.7)
        words = prose(rng, rng.randint(5, 60)).split()
        if not good:
            words = [w + rng.choice(["###", "$$$"]) for w in words]
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "gruxel", "gruxish", "vortmal", "vortine"]))
        docs.append((d, " ".join(words)))
        if d % 3:
            labels.append((d, good, toxic))
    docs += [(5000, None), (5001, ""), (5002, " \n"), (None, "idiot gruxel vortmal"), (5003, prose(rng, 20_000))]
    labels += [(5000, 1, 0), (None, 0, 1), (1, None, None), (9999, 1, 1)]
    return (spark.createDataFrame([(d, t, 0.0) for d, t in docs], "doc_id long, text string, score double").cache(),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int").cache())


def held_out_accuracy(scored, labels, flag, label):
    rows = scored.join(labels.where(F.col(label).isNotNull()), "doc_id").where(flag & F.col("text").isNotNull())
    return rows.select(F.avg(((F.col("score") >= 0.5).cast("int") == F.col(label)).cast("int"))).first()[0]


def test_toxicity(spark, tables):
    docs, labels = tables
    model = T.fit(docs, labels, ~T.held_out())
    scored = T.score(docs, model)
    assert scored.columns == ["doc_id", "text", "score"] and scored.count() == docs.count()
    assert held_out_accuracy(scored, labels, T.held_out(), "toxic") > 0.97
    rows = {r.doc_id: r.score for r in scored.collect()}
    assert rows[5000] == rows[5001] == rows[5002] < 0.5 < rows[None] and rows[5003] < 0.5


def test_quality(spark, tables):
    docs, labels = tables
    model = Q.fit(docs, labels, ~Q.held_out())
    scored = Q.score(docs, model)
    assert held_out_accuracy(scored, labels, Q.held_out(), "quality") > 0.97
    rows = {r.doc_id: r.score for r in scored.collect()}
    assert rows[5000] == rows[5001] == model.prior and len(rows) == docs.count() and rows[5003] > 0.5
    assert all(0 <= s <= 1 for s in rows.values())


def test_without_labels_or_rows(spark, tables):
    docs, labels = tables
    none = labels.limit(0)
    some = docs.where("doc_id < 20 OR doc_id IS NULL")
    lone = T.score(some, T.fit(some, none, ~T.held_out())).collect()
    assert len(lone) == 21 and all(0 <= r.score <= 1 for r in lone)
    assert {r.score for r in Q.score(some, Q.fit(some, none, ~Q.held_out())).collect()} == {0.5}
    empty = docs.limit(0)
    assert T.score(empty, T.fit(empty, labels, ~T.held_out())).count() == 0
    assert Q.score(empty, Q.fit(empty, labels, ~Q.held_out())).count() == 0


def test_sample_is_bounded_and_hides_the_fold(spark, tables):
    import zlib
    docs, labels = tables
    rows = sample(docs, labels, "toxic", ~T.held_out(), 100).collect()
    assert len(rows) <= 100 and all(zlib.crc32(str(r.id).encode()) % 5 for r in rows)
    got = spark.range(50).select("id", fold(F.col("id"), 3).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 3 for r in got)
