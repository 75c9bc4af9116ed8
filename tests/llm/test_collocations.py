import random
import re
from collections import Counter, defaultdict

import numpy as np

from weftline.llm import collocations as C

UPPER = {i: i + 32 for i in range(65, 91)}


def plain(rows, least, longest=5, top=2000):
    """All phrases by slices of word lists."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                f[lang].update(tuple(words[i:i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, counts in f.items():
        often = {p: c for p, c in counts.items() if len(p) > 1 and c >= least}
        found = []
        for p, a in often.items():
            if any(len(q) > len(p) and 100 * c >= 100 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, c in often.items()):
                continue
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            found.append((score, a, " ".join(p), counts[p[:k]], counts[p[k:]]))
        found.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        out += [(lang, i + 1, p, a, left, right, n[lang], score) for i, (score, a, p, left, right) in enumerate(found[:top])]
    return sorted(out)


def result(spark, rows, least, longest=5, top=2000):
    docs = spark.createDataFrame([(t, lang, 1, "x") for lang, t in rows], "text string, lang string, n long, id string").repartition(3)
    found = C.ranked(C.mine(docs, least=least, longest=longest), top)
    return sorted(map(tuple, found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def drawn(seed, count):
    rng = random.Random(seed)
    fixed = ["new York city", "alpha beta gamma delta epsilon zeta", "Über den Fluß", "a a a a a a", " x y z"]
    rows = []
    for _ in range(count):
        parts = []
        for _ in range(rng.randint(0, 12)):
            parts.append(rng.choice(fixed) if rng.random() < 0.4 else " ".join(f"w{min(rng.randint(1, 9), rng.randint(1, 9))}" for _ in range(rng.randint(1, 5))))
        rows.append((rng.choice(["en", "en", "de", None]), rng.choice([" ", "  ", "\t", ", ", "!\n"]).join(parts)))
    return rows


def test_equals_brute_force(spark, monkeypatch):
    rows = drawn(1, 150) + [("en", None), ("en", ""), (None, " \t\n.,"), ("fr", "one"), ("und", "A b C " * 5)]
    rows += rows[:20]
    want = plain(rows, 8)
    assert len(want) > 60 and {r[0] for r in want} == {"en", "de", "und"}
    assert result(spark, rows, 8) == want
    # Small chunks and many bands, so that both ways of counting and all joins are used.
    monkeypatch.setattr(C, "CHUNK_WORDS", 40)
    monkeypatch.setattr(C, "TILE_PAIRS", 30)
    assert result(spark, rows, 8) == want
    assert result(spark, rows, 8, longest=3, top=7) == plain(rows, 8, 3, 7)


def test_odd_tables(spark):
    assert result(spark, [], 2) == [] and result(spark, [("en", None), (None, "")], 1) == []
    # One language and one phrase hold all rows; a long text is one chunk.
    many = [("en", "Same words here.")] * 300 + [("en", "same words " * 40000)]
    assert result(spark, many, 100)[:1] == plain(many, 100)[:1]


def test_tiles_equal_plain_count(monkeypatch):
    rng = np.random.default_rng(2)
    left, right = rng.zipf(1.4, 5000) % 300, rng.zipf(1.4, 5000) % 300
    weight = rng.integers(1, 9, 5000)
    once, heavy = Counter(zip(left.tolist(), right.tolist())), Counter()
    for i, j, w in zip(left.tolist(), right.tolist(), weight.tolist()):
        heavy[i, j] += w
    for cells in (0, 1 << 22):
        monkeypatch.setattr(C, "DENSE_CELLS", cells)
        for want, w in ((once, None), (heavy, weight)):
            pairs, counts = C.count_tile(left, right, w)
            assert (np.diff(pairs) > 0).all()
            assert want == {(p >> 32, p & 0xFFFFFFFF): c for p, c in zip(pairs.tolist(), counts.tolist())}


def test_packing_is_exact():
    rng = np.random.default_rng(4)
    for n in (0, 1, 1000):
        line = rng.integers(-1, 1 << 30, n).astype(np.int32)
        assert (C._unpack(C._pack(line), np.int32) == line).all()
        keys, counts = np.unique(rng.integers(0, 1 << 62, n)), rng.integers(1, 1 << 40, n)
        got = C._unpack_counts(C._pack_counts(keys, counts[:len(keys)]))
        assert (got[0] == keys).all() and (got[1] == counts[:len(keys)]).all()


def test_scores_need_more_than_64_bits(spark):
    big = 4_000_000_000_000
    row = spark.createDataFrame([(big, 9 * big, [big, big + 1], [big + 7, big])], "a long, n long, s array<long>, r array<long>")
    cut = row.select(C._weakest_cut("a", "n", "s", "r").alias("c")).first().c
    want = min((1000 * big * 9 * big // (x * y), k, x, y) for k, (x, y) in enumerate([(big, big + 7), (big + 1, big)], 1))
    assert tuple(cut) == want
