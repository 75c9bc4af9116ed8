from collections import Counter

from weftline.llm import mixing as M


def shared_out(sizes, weights, most=3):
    """Share by weight, cut at the limit, share the excess again until none is above."""
    left, target = float(sum(sizes)), [0.0] * len(sizes)
    free = set(range(len(sizes)))
    while free:
        total = sum(weights[i] for i in free)
        over = {i for i in free if most * sizes[i] <= left * weights[i] / total}
        if not over:
            for i in free:
                target[i] = left * weights[i] / total
            break
        for i in over:
            target[i] = float(most * sizes[i])
        left -= sum(target[i] for i in over)
        free -= over
    return target


def docs_of(spark):
    rows, n = [], 0
    for source, count, words in [("b", 40, 10), ("a", 300, 7), (None, 5, 100), ("c", 3, 2), ("é", 50, 30), ("z", 4, 0)]:
        for _ in range(count):
            rows.append((n, "w " * words if words else None, source, "x"))
            n += 1
    rows.append((n, "wide space and\ttabs\n", "a", "x"))
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size string")


def test_targets_and_copies(spark):
    docs = docs_of(spark)
    rows = M.plan_copies(docs).collect()
    sizes = Counter()
    for r in rows:
        assert r["size"] == len((r.text or "").replace(" ", "_").split())
        sizes[r.source] += r["size"]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = dict(zip(order, shared_out([sizes[s] for s in order], [i % 3 + 1 for i in range(len(order))])))
    for r in rows:
        assert abs(r.target - want[r.source]) < 1e-6 and r.source_size == sizes[r.source]
        assert r.copies in (int(r.rate), int(r.rate) + 1) and r.copies <= 3 and r.taken == r.copies * r["size"]
    assert abs(sum(want.values()) - sum(sizes.values())) < 1e-6
    again = M.plan_copies(docs.repartition(7)).select("doc_id", "copies").collect()
    assert {tuple(r) for r in again} == {(r.doc_id, r.copies) for r in rows}


def test_mix_repeats_rows(spark):
    docs = docs_of(spark)
    copies = {r.doc_id: r.copies for r in M.plan_copies(docs).collect()}
    mixed = M.mix(docs)
    assert mixed.columns == docs.columns and {r["size"] for r in mixed.collect()} == {"x"}
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({d: c for d, c in copies.items() if c})


def test_empty_and_wordless(spark):
    none = docs_of(spark).limit(0)
    assert M.plan_copies(none).count() == 0 and M.mix(none).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert {(r.target, r.copies) for r in M.plan_copies(blank).collect()} == {(0.0, 0)}


def test_share_of_bernoulli_copies(spark):
    from pyspark.sql import functions as F
    drawn = spark.range(20000).select(M.copies(F.lit(1.3), F.col("id"), 11).alias("c")).agg(F.avg("c")).first()[0]
    assert abs(drawn - 1.3) < 0.02
