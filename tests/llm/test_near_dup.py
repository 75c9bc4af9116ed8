import random

import pytest

from weftline.llm import crowds, near_dup as N


def shingles(text, width=5):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace(" ", "_").split()
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def brute(docs, percent=85):
    ids = [d for d, _ in docs if d is not None]
    sets = {d: shingles(t) for d, t in docs}
    root = {d: d for d in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in ids:
        for j in ids:
            a, b = sets[i], sets[j]
            if i < j and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {(d, len(sets[d]), find(d)) for d in ids}


def corpus():
    rng = random.Random(9)

    def text(n):
        return " ".join(rng.choice("abcdefghijklmnop") + str(rng.randint(0, 400)) for _ in range(n))
    docs = [(0, None), (1, ""), (2, "  \n"), (3, "one two"), (4, "ONE  two"), (5, "one two three four five"), (6, "W" * 50_000)]
    base = text(150)
    for d in range(10, 130):  # one crowd with similarities around the threshold
        words = base.split()
        for _ in range(rng.randint(0, 9)):
            words[rng.randrange(len(words))] = text(1)
        docs.append((d, " ".join(words)))
    docs += [(200 + i, base) for i in range(40)] + [(300 + i, text(rng.randint(1, 60))) for i in range(30)]
    docs += [(-7, docs[20][1].upper())]
    return docs


@pytest.mark.parametrize("cell", [50_000, 900])
def test_components_equal_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(crowds, "CELL_ITEMS", cell)
    docs = corpus()
    df = spark.createDataFrame([(d, t, 0) for d, t in docs] + [(None, docs[20][1], 0)], "doc_id long, text string, component int")
    got = N.near_duplicates(df).collect()
    assert {tuple(r) for r in got if r.id is not None} == brute(docs) and len(got) == len(docs) + 1
    assert [r.component for r in got if r.id is None] == [None]


def test_empty_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")
    assert sorted(tuple(r) for r in N.near_duplicates(df).collect()) == [(1, 2, 1), (1, 2, 1), (2, 2, 1)]
    assert N.near_duplicates(df.limit(0)).count() == 0


def test_estimate_is_unbiased():
    import numpy as np
    from weftline.llm.shingles import MinHash
    rng = np.random.default_rng(4)
    hasher, errors = MinHash(N.LANES), []
    for _ in range(60):
        pool = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
        a, b = pool[:250], pool[50:]
        x, y = (N._packed(hasher.minima(s)) for s in (a, b))
        diff = x ^ y
        same = sum(int(w) >> (4 * i) & 15 == 0 for w in diff for i in range(16))
        errors.append(((same / N.LANES) - 1 / 16) / (15 / 16) - 200 / 300)
    assert abs(np.mean(errors)) < 0.03
