import random

import pytest
from pyspark.sql import functions as F

from weftline.operators import intervals as I
from weftline.operators.scan import mode_first_seen, ordinal, prefix_scan


def rows(seed, n, keys=2, span=300, size=25):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        s = rng.randint(0, span)
        out.append((rng.randrange(keys), i, s, s + rng.randint(1, size), rng.randint(1, 9), rng.choice("ab")))
    return out


SCHEMA = "key long, id long, start long, end long, score long, label string"


@pytest.mark.parametrize("width", [7, 64, 100000])
def test_merge_any_chunk_width(spark, width):
    data = rows(1, 60)
    df = spark.createDataFrame(data, SCHEMA)
    for gap in (0, 5):
        expect = []
        for key in {d[0] for d in data}:
            cur = None
            for _, _, s, e, *_ in sorted((d for d in data if d[0] == key), key=lambda d: d[2:4]):
                if cur and s - cur[2] <= gap:
                    cur[2] = max(cur[2], e)
                else:
                    cur = [key, s, e]
                    expect.append(cur)
        got = sorted([r.key, r.start, r.end] for r in I.merge_intervals(df, ["key"], gap, width=width).collect())
        assert got == sorted(expect)
    again = I.merge_intervals(I.merge_intervals(df, ["key"], 5), ["key"], 5)
    assert again.count() == len(expect)


@pytest.mark.parametrize("touch", [False, True])
def test_range_join_and_flags(spark, touch):
    left, right = rows(2, 50), rows(3, 40)
    a = spark.createDataFrame(left, SCHEMA)
    b = spark.createDataFrame([(d[0], d[1], d[2], d[3]) for d in right], "key long, rid long, r_start long, r_end long")

    def meets(x, y):
        return x[0] == y[0] and x[2] < y[3] and (y[2] <= x[3] if touch else y[2] < x[3])

    expect = sorted((x[1], y[1]) for x in left for y in right if meets(x, y))
    for hot in (3, 10 ** 6):
        got = sorted((r.id, r.rid) for r in I.range_join(a, b, ["key"], 16, touch=touch, hot=hot).collect())
        assert got == expect
    flags = {r.id: r.overlaps for r in I.overlaps_any(a, b, ["key"], width=32).collect()}
    strict = {x[1] for x in left for y in right if x[0] == y[0] and x[2] < y[3] and y[2] < x[3]}
    assert {i for i, f in flags.items() if f} == strict
    first = {r.id: r.match for r in I.first_overlap(a, b, ["key"], "id", "rid", levels=10).collect()}
    for x in left:
        ids = [y[1] for y in right if x[0] == y[0] and x[2] < y[3] and y[2] < x[3]]
        assert first[x[1]] == (min(ids) if ids else None)


def test_envelope_per_base(spark):
    data = rows(4, 40, keys=2, span=120, size=50)
    df = spark.createDataFrame(data, SCHEMA)
    got = I.best_score_envelope(df, ["key"], "id", longer_than=0, levels=10, width=16).collect()
    owner = {(r.key, p): r.id for r in got for p in range(r.start, r.end)}
    for key in (0, 1):
        for p in range(200):
            cover = [d for d in data if d[0] == key and d[2] <= p < d[3]]
            best = min(cover, key=lambda d: (-d[4], d[2], d[1]))[1] if cover else None
            assert owner.get((key, p)) == best


def test_hotspots(spark):
    rng = random.Random(9)
    pos = sorted(rng.sample(range(400000), 900) + list(range(65500, 65600, 3)))
    df = spark.createDataFrame([(0, 0, p) for p in pos], "target long, contig long, pos long")
    pos = sorted(set(pos))
    close = [(pos[i - 5], pos[i]) for i in range(5, len(pos)) if pos[i] - pos[i - 5] < 1000]
    merged = []
    for s, e in close:
        if merged and s - merged[-1][1] < 1000:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    assert sorted([r.start, r.end] for r in I.hotspots(df, 5).collect()) == merged and merged


def test_scan_and_ordinal(spark):
    df = spark.range(200).select((F.col("id") % 3).alias("k"), "id", (F.col("id") * 7 % 11).alias("v"))
    out = prefix_scan(df, ["k"], "id", F.floor(F.col("id") / 10), F.col("v"), "sum", "s").collect()
    total = {}
    for r in sorted(out, key=lambda r: r.id):
        total[r.k] = total.get(r.k, 0) + r.v
        assert r.s == total[r.k]
    ranks = ordinal(df, ["v", "id"], "n", ["k"]).collect()
    for k in range(3):
        mine = sorted((r for r in ranks if r.k == k), key=lambda r: (r.v, r.id))
        assert [r.n for r in mine] == list(range(1, len(mine) + 1))


def test_mode_tie_goes_to_first(spark):
    df = spark.createDataFrame([(1, "b", 1), (1, "a", 2), (1, "a", 3), (1, "b", 4)], "k long, v string, o long")
    assert mode_first_seen(df, ["k"], "v", "o").first()["mode"] == "b"


def test_edge_filter(spark):
    loci = spark.createDataFrame(
        [("chr1", 50000, 60000, True, True), ("c1", 30000, 40000, False, False), ("c1", 100, 900, False, False),
         ("c2", 30000, 31000, False, False)], "contig string, start long, end long, is_main boolean, is_ref boolean")
    sizes = spark.createDataFrame([("c1", 200000), ("chr1", 1000000)], "contig string, length long")
    errors = spark.createDataFrame([("c2", 31000, 32000)], "contig string, start long, end long")
    got = {(r.contig, r.start) for r in I.edge_filter(loci, sizes, errors).collect()}
    assert got == {("chr1", 50000), ("c1", 30000)}


def test_ranges_longer_than_the_last_level(spark):
    """A range keeps its aligned middle whatever the number of levels."""
    ranges = [(1, 0, 65536, 5), (1, 100, 70000, 7), (1, 65000, 200000, 3), (1, -90000, 10, 9)]
    df = spark.createDataFrame(ranges, "k long, start long, end long, v long")
    points = [5, 100, 40000, 65535, 65536, 150000, 199999, 200000, -1, -90000, -90001]
    asked = spark.createDataFrame([(1, p) for p in points], "k long, p long")
    want = {p: min(v for _, s, e, v in ranges if s <= p < e) for p in points if any(s <= p < e for _, s, e, _ in ranges)}
    for levels in (3, 14, 32):
        got = {r.p: r.best for r in I.stab_best(asked, df, ["k"], "p", "v", levels=levels).collect()}
        assert got == want
    left = spark.createDataFrame([(n, 1, p, p + 3) for n, p in enumerate(points)], "id long, k long, start long, end long")
    right = df.withColumnsRenamed({"start": "r_start", "end": "r_end"})
    met = {r.id: r.match for r in I.first_overlap(left, right, ["k"], "id", "v", levels=4).collect()}
    assert met == {n: min((v for _, s, e, v in ranges if s < p + 3 and p < e), default=None) for n, p in enumerate(points)}


def test_scratch_names_do_not_clash(spark):
    """Columns named as the operators' own working columns come through, in either case of letters."""
    scratch = ["_bin", "_ours", "_other", "_n", "_many_l", "_many_r", "_chunk", "_value", "_local", "_carry", "_total", "_part", "_RN", "_offset"]
    left, right = rows(5, 30), rows(6, 25)
    plain = spark.createDataFrame(left, SCHEMA)
    other = spark.createDataFrame([d[:4] for d in right], "key long, rid long, r_start long, r_end long")
    for hot in (3, 10 ** 6):
        want = sorted((r.id, r.rid) for r in I.range_join(plain, other, ["key"], 16, hot=hot).collect())
        assert want
        for a, b in zip(scratch, scratch[1:] + scratch[:1]):
            named = plain.withColumnRenamed("start", a).withColumnRenamed("end", b)
            got = I.range_join(named, other, ["key"], 16, (a, b), hot=hot)
            assert set(got.columns) == {*named.columns, "rid", "r_start", "r_end"}
            if a in ("_bin", "_ours", "_n", "_many_l"):
                assert sorted((r.id, r.rid) for r in got.collect()) == want
    extra = plain
    for name in scratch:
        extra = extra.withColumn(name, F.col("score"))
    sums = prefix_scan(extra, ["key"], "id", F.floor(F.col("id") / 8), F.col("score"), "sum", "run").collect()
    for r in sums:
        assert r.run == sum(d[4] for d in left if d[0] == r.key and d[1] <= r.id) and all(r[c] == r.score for c in scratch)
    numbers = ordinal(extra, ["start", "id"], "place", ["key"]).collect()
    assert all(r[c] == r.score for r in numbers for c in scratch)
    for key in {d[0] for d in left}:
        mine = sorted((d for d in left if d[0] == key), key=lambda d: (d[2], d[1]))
        assert [r.id for r in sorted((r for r in numbers if r.key == key), key=lambda r: r.place)] == [d[1] for d in mine]
