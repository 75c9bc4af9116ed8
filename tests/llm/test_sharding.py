from collections import Counter

import pytest

from weftline.llm import sharding as S


def filled_slowly(shards, slots):
    """Turn by turn, each shard walking its whole preference list."""
    prefs = []
    for name in shards:
        start, step = S._number(f"start:{name}") % slots, S._number(f"step:{name}") % (slots - 1) + 1
        prefs.append([(start + k * step) % slots for k in range(slots)])
    owner = {}
    while len(owner) < slots:
        for i, order in enumerate(prefs):
            free = next((s for s in order if s not in owner), None)
            if free is not None:
                owner[free] = i
    return [owner[s] for s in range(slots)]


@pytest.mark.parametrize("n", [1, 2, 5, 9])
def test_table_equals_slow_filling(n):
    shards = [f"s{i}" for i in range(n)]
    slots = S.prime_at_least(20 * n + 1)
    table = S.fill_table(shards, slots)
    assert table == filled_slowly(shards, slots)
    sizes = Counter(table)
    assert max(sizes.values()) - min(sizes.values()) <= 1


def test_a_new_shard_moves_few_slots():
    old = S.fill_table([f"s{i}" for i in range(10)], 1009)
    new = S.fill_table([f"s{i}" for i in range(11)], 1009)
    assert sum(a != b for a, b in zip(old, new)) < 0.25 * 1009


def test_assignment(spark):
    rows = [(1, "x", "mine"), (1, "x", "mine"), (None, None, None), (2, "y" * 100_000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string")
    out = S.assign(df, "doc_id", ["a", "b"])
    assert out.columns == ["doc_id", "text", "slot", "shard"] and out.count() == 4
    found = {(r.doc_id, r.shard) for r in out.collect()}
    assert len(found) == 3 and {s for _, s in found} <= {"a", "b"}
    assert S.assign(df.limit(0), "doc_id", ["a"]).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "BroadcastHashJoin" in plan
    with pytest.raises(ValueError):
        S.assign(df, "doc_id", ["a", "a"])
