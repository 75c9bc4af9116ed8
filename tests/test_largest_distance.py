"""Largest distances: only members that can be far apart are paired, and the result is that of all pairs."""

import random

from weftline.operators import annotate as N


def brute(rows, floor):
    vectors = {}
    for t, m, a, v in rows:
        vectors.setdefault(t, {}).setdefault(m, {})[a] = v
    out = {}
    for t, own in vectors.items():
        held = [v for v in own.values() if any(v.values())]
        out[t] = max([floor] + [sum((x.get(a, 0) - y.get(a, 0)) ** 2 for a in {*x, *y}) for x in held for y in held])
    return out


def test_few_members_are_paired(spark, monkeypatch):
    rng = random.Random(6)
    rows = [("t", m, a, 1) for m in range(300) for a in rng.sample(range(900), 5)] + [("t", 1000 + i, 2000 + a, 1) for i in range(2) for a in range(9 * i, 9 * i + 9)]
    rows += [("u", m, a, rng.choice((-2, -1, 1, 3))) for m in range(40) for a in rng.sample(range(12), 4)]
    paired, one = [], N._farthest

    def counted(members, *rest):
        paired.append({r["t"]: r["count"] for r in members.groupBy("t").count().collect()})
        return one(members, *rest)
    monkeypatch.setattr(N, "_farthest", counted)
    monkeypatch.setattr(N, "OUTER", 8)
    df = spark.createDataFrame(rows, "t string, m long, a long, v long")
    got = {r["t"]: r["largest"] for r in N.largest_within(df, "t", "m", "a", "v", 1.0).collect()}
    assert got == brute(rows, 1.0)
    assert paired[0]["t"] <= 8 and paired[-1]["t"] < 10
