import hashlib
import random
import zlib

from weftline.llm import periodic as P
from weftline.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"


def plain_runs(words):
    """All runs by trying every period at every place."""
    n, found = len(words), set()
    for q in range(1, n // 4 + 1):
        start = 0
        while start + q < n:
            end = start
            while end + q < n and words[end] == words[end + q]:
                end += 1
            s, e = start, end + q
            if e - s >= max(6, 4 * q) and not any(
                    all(words[t] == words[t + p] for t in range(s, e - p)) for p in range(1, q)):
                found.add((s, e, q))
            start = end + 1
    return sorted(found)


def told(words, runs):
    """The result's columns from a list of runs, by their definitions."""
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in sorted(runs, key=lambda r: (r[0], r[2])))
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    s, e, q = min(runs, key=lambda r: (r[0] - r[1], r[0], r[2])) if runs else (None, None, None)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (len(runs), s, e - s if runs else None, q, 1000 * (e - s) // q if runs else None, digest(listed), digest(kept)), kept


def drawn(rng):
    words = [rng.randint(0, rng.randint(0, 3)) for _ in range(rng.randint(0, 70))]
    for _ in range(rng.randint(0, 3) if len(words) > 6 else 0):
        at, period = rng.randrange(len(words)), rng.randint(1, 12)
        for i in range(at + period, min(len(words), at + rng.randint(4, 50))):
            words[i] = words[i - period]
    return [b"%d" % w for w in words]


def test_runs_equal_brute_force():
    rng = random.Random(3)
    for _ in range(600):
        docs = [drawn(rng) for _ in range(rng.randint(1, 4))]
        for words, runs in zip(docs, P._chunk_runs(docs)):
            assert sorted(map(tuple, runs.tolist())) == plain_runs(words)


def test_wavelet_successor():
    import numpy as np
    rng = np.random.default_rng(5)
    for n in (1, 2, 7, 64, 200):
        values = rng.permutation(n)
        tree = P.WaveletTree(values, n)
        low = rng.integers(0, n + 1, 300)
        high = np.maximum(low, rng.integers(0, n + 1, 300))
        x = rng.integers(0, n + 3, 300)
        want = [min((v for v in values[a:b] if v >= c), default=P._FAR) for a, b, c in zip(low, high, x)]
        assert tree.successor(low, high, x).tolist() == want


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t\n", "x"), (4, "a a a a a a", "x"), (4, "a a a a a a", "x"),
            (5, "a a a a a", "x"), (None, "b c " * 4, "x"), (6, "  é é\té\né é é z", "x"), (7, "a b " * 30000 + "c", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_runs string")
    out = P.find_runs(docs, keep=["doc_id", "n_runs"]).collect()
    assert len(out) == len(rows) and "n_runs" in out[0].asDict()
    want = {1: (0, None, None, None, ""), 2: (0, None, None, None, ""), 3: (0, None, None, None, ""), 4: (1, 0, 6, 1, "a"),
            5: (0, None, None, None, "a a a a a"), None: (1, 0, 8, 2, "b c"), 6: (1, 0, 6, 1, "é z"), 7: (1, 0, 60000, 2, "a b c")}
    for r in out:
        assert (r.n_runs, r.start, r.length, r.period, r.collapsed) == want[r.doc_id]
    assert P.find_runs(docs.limit(0)).count() == 0
    assert [f.name for f in P.find_runs(docs, keep=["doc_id", "text"], collapsed=False).schema][:3] == ["doc_id", "text", "n_words"]


def test_chunks_do_not_matter(spark, monkeypatch):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(60)
    whole = sorted(map(tuple, P.find_runs(docs).collect()))
    monkeypatch.setattr(P, "CHUNK_WORDS", 50)
    assert sorted(map(tuple, P.find_runs(docs).collect())) == whole


def test_query_equals_definition(spark):
    found = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_periodic_runs"](spark, DATA).collect()}
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(docs)
    planted = 0
    for r in docs:
        words, h = (r.text or "").encode().split(), zlib.crc32(str(r.doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        if h % 10 == 0 or n < 400:
            assert found[r.doc_id] == told([w.decode() for w in words], plain_runs(words))[0]
    assert planted > 5
