import math
import random
from collections import Counter
from itertools import combinations

import numpy as np

from weftline.operators import annotate as N, components as C, pairs as P, trees as T


def tables(seed=1, n=30, vocab=60):
    rng = random.Random(seed)
    rows = {}
    for i in range(n):
        if i and rng.random() < .4:
            base = dict(rows[rng.randrange(i)])
            for key in rng.sample(sorted(base), min(2, len(base))):
                base.pop(key)
        else:
            base = {}
        for _ in range(rng.randint(1, 8)):
            base[rng.randrange(vocab)] = rng.randint(1, 3)
        base[1000] = 1  # one k-mer everybody has
        rows[i] = base
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, k, c) for i, r in rows.items() for k, c in r.items()], "name long, kmer long, cnt long")


def test_totals_with_and_without_threshold(spark):
    rows = tables()
    counts = frame(spark, rows)
    mins = {(i, j): sum(min(rows[i][k], rows[j][k]) for k in rows[i] if k in rows[j]) for i, j in combinations(rows, 2)}
    assert {(r.i, r.j): r.total for r in P.min_similarity(counts).collect()} == {p: v for p, v in mins.items() if v}
    for cut in (3, 8):
        assert {(r.i, r.j): r.total for r in P.min_similarity(counts, cut).collect()} == {p: v for p, v in mins.items() if v > cut}


def test_blocks_cover_each_pair_once(spark):
    rows = tables(2)
    postings = P.colour_postings(frame(spark, rows)).postings
    for block in (1, 4, 1000):
        met = P._self_join(postings.where("n > 20"), ["cnt"], block=block)
        pairs = [(r.i, r.j) for r in met.collect()]
        assert len(pairs) == len(set(pairs)) == len(rows) * (len(rows) - 1) // 2


def test_distance_limit_is_exact(spark):
    rows = tables(3)
    df = Counter(k for r in rows.values() for k in r)
    own = {i: sum(c * c / (20 if df[k] == 1 else 1) for k, c in r.items()) for i, r in rows.items()}
    expect = {}
    for i, j in combinations(rows, 2):
        dot = sum(rows[i][k] * rows[j][k] for k in rows[i] if k in rows[j])
        d = 1 - dot / math.sqrt(max(1, own[i]) * max(1, own[j]))
        if d <= 0.4:
            expect[i, j] = round(d, 9)
    got = {(r.i, r.j): round(r.d, 9) for r in P.pair_distances(frame(spark, rows), 0.4).collect()}
    assert got == expect and expect


def closure(nodes, edges):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def test_components_are_the_transitive_closure(spark):
    edges = [(0, 3), (1, 2), (2, 3), (5, 6), (8, 7), (7, 9)]
    got = C.connected_components(spark.createDataFrame(edges, "i long, j long")).collect()
    assert {r.node: r.component for r in got} == closure({x for e in edges for x in e}, edges)
    rows = tables(4, 40)
    for cut in (2, 6):
        want = closure(rows, [(i, j) for i, j in combinations(rows, 2)
                              if sum(min(rows[i][k], rows[j][k]) for k in rows[i] if k in rows[j]) > cut])
        names = spark.createDataFrame([(i,) for i in rows], "name long")
        got = {r.name: r.component for r in C.similarity_components(frame(spark, rows), names, cut).collect()}
        assert got == want


def spec_merges(dist):
    n = len(dist)
    active = {i: {j: dist[i][j] for j in range(n) if j != i} for i in range(n)}
    out = []
    for new in range(n, 2 * n - 1):
        d, i, j = min((active[i][j], i, j) for i in active for j in active[i])
        out.append((i, j, d))
        joined = {k: (active[i][k] + active[j][k]) / 2 for k in active if k not in (i, j)}
        for gone in (i, j):
            active.pop(gone)
        for k in active:
            active[k].pop(i)
            active[k].pop(j)
            active[k][new] = joined[k]
        active[new] = joined
    return out


def test_merge_order_with_ties():
    rng = random.Random(6)
    for trial in range(20):
        n = rng.randint(2, 14)
        m = [[0.0] * n for _ in range(n)]
        for i, j in combinations(range(n), 2):
            m[i][j] = m[j][i] = rng.choice([0.0, 0.25, 0.5, 1.0]) if trial % 2 else rng.random()
        assert T.merge_order(np.array(m)) == spec_merges(m)


def test_small_and_distributed_linkage_agree(spark):
    rng = random.Random(8)
    members, dist = [], []
    for grp, n in ((1, 9), (2, 13), (3, 1)):
        members += [(grp, grp * 100 + i, i) for i in range(n)]
        dist += [(grp, i, j, round(rng.random(), 6)) for i, j in combinations(range(n), 2) if rng.random() < .7]
    members = spark.createDataFrame(members, "grp long, name long, idx long")
    dist = spark.createDataFrame(dist, "grp long, i long, j long, d double")
    a, b = (sorted((r.grp, r.step, r.height, r.size, *sorted((r.left, r.right))) for r in T.linkage(dist, members, small).collect()
                   if r.height < 1) for small in (100, 0))
    assert a == b and a
    ends = {r.grp: r.size for r in T.linkage(dist, members, 0).collect() if r.step == {1: 7, 2: 11}[r.grp]}
    assert ends == {1: 9, 2: 13}


def read_tree(text):
    """Edges by plain recursion: (parent, child, length, leaf) with leaves numbered first, inner nodes in order of closing."""
    leaves, inner, edges = [], [], []
    pos = 0

    def length():
        nonlocal pos
        if pos < len(text) and text[pos] == ":":
            end = next(i for i in range(pos + 1, len(text) + 1) if i == len(text) or text[i] in ",();")
            value, pos = float(text[pos + 1:end]), end
            return value
        return 0.0

    def word():
        nonlocal pos
        end = next(i for i in range(pos, len(text) + 1) if i == len(text) or text[i] in ":,();")
        value, pos = text[pos:end].strip(), end
        return value

    def node():
        nonlocal pos
        if text[pos] != "(":
            leaves.append(word())
            return ("leaf", len(leaves) - 1), length(), leaves[-1]
        kids = []
        while text[pos] in "(,":
            pos += 1
            kids.append(node())
        pos += 1
        inner.append(None)
        mine = ("inner", len(inner) - 1)
        word()
        edges.extend((mine, child, size, name) for child, size, name in kids)
        return mine, length(), None
    node()
    number = lambda x: x[1] + (len(leaves) if x[0] == "inner" else 0)
    return sorted((number(p), number(c), round(d, 9), n or "") for p, c, d, n in edges)


def test_newick_edges_equal_recursion(spark, tmp_path):
    from weftline.sources import tables as ST

    rng = random.Random(6)

    def drawn(depth):
        size = rng.choice(["", f":{rng.randint(0, 99) / 8}", ":1e-3"])
        if depth == 0 or rng.random() < .2:
            return f"{rng.choice(['a', 'b c', 'x_1'])}{rng.randint(0, 99)}{size}"
        inner = ",".join(drawn(depth - 1) for _ in range(rng.randint(1, 4)))
        return f"({inner}){rng.choice(['', 'n' + str(depth)])}{size}"
    texts = {f"t{i}": f"({drawn(4)},{drawn(3)})root;\n" for i in range(6)} | {"one": "only;", "flat": "(a:1,b:2,c:3);", "deep": "(" * 40 + "q" + ",r)" * 40 + ";"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40")
    try:
        got = {}
        for r in ST.read_newick(spark, str(tmp_path)).collect():
            got.setdefault(r.path.split("/")[-1], []).append((r.parent, r.child, round(r.length, 9), r.leaf or ""))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for name, text in texts.items():
        assert sorted(got.get(name, [])) == read_tree(text.strip()), text


def test_newick_text():
    tree = T.Tree(3, [1, 3], [0, 2], [0.2, 0.6])
    text = tree.newick(["a", "b", "c"])
    assert text.startswith("((b:0.1000000,a:0.1000000):0.200000,c:0.3000000)")
    assert {(c, d) for _, c, d, _ in read_tree(text)} == {(0, .1), (1, .1), (2, .3), (3, .2)}


def test_leaf_places_equal_a_walk(spark):
    rng = random.Random(13)
    members, merges = [], []
    want = {}
    for grp, n in ((1, 1), (2, 2), (3, 40), (4, 17)):
        members += [(grp, grp * 1000 + i, i) for i in range(n)]
        alive, size, left, right = list(range(n)), {i: 1 for i in range(n)}, [], []
        for step in range(n - 1):
            # Group 3 is a chain, which is as deep as it has leaves.
            a = alive.pop(-1 if grp == 3 else rng.randrange(len(alive)))
            b = alive.pop(rng.randrange(len(alive)))
            a, b = (a, b) if rng.random() < .5 else (b, a)
            node = n + step
            size[node] = size[a] + size[b]
            alive.append(node)
            left.append(a)
            right.append(b)
            merges.append((grp, step, a, b, step / n, size[node]))
        order, _ = T.Tree(n, left, right, [0.0] * (n - 1)).leaf_ranges()
        want.update({(grp, leaf): place for place, leaf in enumerate(order)})
    got = T.leaf_places(spark.createDataFrame(merges, T.MERGES), spark.createDataFrame(members, "grp long, name long, idx long"))
    assert {(r.grp, r.idx): r.place for r in got.collect()} == want


def test_largest_within_brute_force(spark):
    rng = random.Random(12)
    data = {(t, m): {a: rng.randint(1, 9) for a in rng.sample(range(12), rng.randint(1, 5))} for t in range(4) for m in range(9)}
    df = spark.createDataFrame([(t, m, a, v) for (t, m), r in data.items() for a, v in r.items()], "t long, m long, a long, v long")
    got = {r.t: r.largest for r in N.largest_within(df, "t", "m", "a", "v", 1.0).collect()}
    for t in range(4):
        mine = [r for (k, _), r in data.items() if k == t]
        best = max(sum((x.get(a, 0) - y.get(a, 0)) ** 2 for a in range(12)) for x, y in combinations(mine, 2))
        assert abs(got[t] - best) < 1e-6


def test_within_between(spark):
    d = spark.createDataFrame([(0, 1, .1), (0, 2, .9), (1, 2, .7)], "i long, j long, d double")
    labels = spark.createDataFrame([(0, "x"), (1, "x"), (2, "y")], "name long, grp string")
    got = {r.grp: r for r in N.within_between(d, labels).collect()}
    assert got["x"].within_mean == .1 and got["y"].between_min == .7 and got["y"].within_mean is None
