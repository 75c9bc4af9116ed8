"""Range joins of the catalogue: rows of equal ranges are joined once, and the counts are those of all pairs."""

import datetime as dt
from collections import Counter

from catalogue import intervals as CI
from weftline.operators import intervals as I


def test_equal_ranges_meet_once(spark, tmp_path, monkeypatch):
    day = lambda n: dt.date(1992, 1, 1) + dt.timedelta(n)
    lines = [(i // 4, i % 4, i % 5, i % 3, day(10 + i % 6), float(1 + i % 2), "O", "AN"[i % 2], 1.0) for i in range(60)] + [(0, 0, 0, 0, day(300), 2.0, "O", "A", 1.0)]
    orders = [(100 + i, i % 4, day(9 + i % 8), "1-URGENT") for i in range(40)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber long, l_partkey long, l_suppkey long, l_shipdate date, l_quantity double, l_linestatus string, l_returnflag string, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate date, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(4)], "c_custkey long, c_nationkey long").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(3)], "s_suppkey long, s_nationkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    placed = [(r["id"], r["contig"], r["start"], r["end"], r["l_returnflag"]) for r in CI._placed(spark, str(tmp_path)).collect()]
    genes = [(r["contig"], r["r_start"], r["r_end"], r["gene"]) for r in CI._genes(spark, str(tmp_path)).collect()]
    met, touching = {}, Counter()
    for id_, c, s, e, flag in placed:
        own = [g for k, a, z, g in genes if k == c and s < z and a < e]
        if own:
            met.setdefault(id_, []).extend(own)
        touching[c, flag] += sum(k == c and s < z and a <= e for k, a, z, _ in genes)
    joined, one = [], I.range_join

    def counted(left, right, *rest, **more):
        joined.append(left.count() * right.count())
        return one(left, right, *rest, **more)
    monkeypatch.setattr(I, "range_join", counted)
    got = CI.range_join_genes(spark, str(tmp_path)).collect()
    assert {r["id"]: (r["n_genes"], r["first_gene"], r["last_gene"]) for r in got} == {k: (len(v), min(v), max(v)) for k, v in met.items()} and met
    got = CI.range_join_touching(spark, str(tmp_path)).collect()
    assert {(r["contig"], r["l_returnflag"]): r["n"] for r in got} == {k: n for k, n in touching.items() if n}
    assert max(joined) < len(placed) * len(genes) / 2
