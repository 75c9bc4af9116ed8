import math
import random
from collections import Counter, defaultdict

from weftline.llm import perplexity as P


def kneser_ney(texts):
    """Probability of the last byte of a 5-byte tuple, straight from the definition."""
    grams = Counter()
    for t in texts:
        for w in (t or "").encode().split():
            s = b"\0\0\0 " + w + b"\n"
            for i in range(len(s) - 4):
                grams[s[i:i + 5]] += 1
    counts = {5: grams}
    for k in (4, 3, 2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    total, freed, discounts = defaultdict(Counter), {}, {}
    for k, table in counts.items():
        n = Counter(table.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + n[2] else None
        d = {}
        for i in (1, 2, 3):
            v = i - (i + 1) * y * n[i + 1] / n[i] if y is not None and n[i] and n[1] else None
            d[i] = v if v is not None and 0 <= v <= i else i / 2
        discounts[k] = d
        freed[k] = defaultdict(float)
        for g, c in table.items():
            total[k][g[:-1]] += c
            freed[k][g[:-1]] += d[min(c, 3)]

    def p(g):
        k = len(g)
        if k == 0:
            return 1 / P.SYMBOLS
        below = p(g[1:])
        ctx = g[:-1]
        if not total[k][ctx]:
            return below
        c = counts[k].get(g, 0)
        return (max(c - (discounts[k][min(c, 3)] if c else 0), 0) + freed[k][ctx] * below) / total[k][ctx]
    return p


def corpus():
    rng = random.Random(3)
    docs = []
    for d in range(60):
        lang = rng.choice(["en", "fr", None])
        words = ["".join(rng.choice(["the", "an", "é", "ou", "X"]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 120))]
        docs.append((d, " ".join(words), lang))
    return docs + [(100, None, "en"), (101, "", None), (102, " \n\t", "fr"), (103, "q" * 3000, "de"), (5, docs[5][1], "en")]


def test_perplexity_equals_the_definition_both_ways(spark):
    docs = corpus()
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, lang string, kept string")
    models = {l: kneser_ney([t for _, t, k in docs if (k or "") == l]) for l in ("", "en", "fr", "de")}
    want = []
    for d, t, l in docs:
        words = (t or "").encode().split()
        s = 0.0
        for w in words:
            seq = b"\0\0\0 " + w + b"\n"
            s -= sum(math.log(models[l or ""](seq[i:i + 5])) for i in range(len(seq) - 4))
        want.append((d, len(words), s / len(words) if words else None))
    for most in (P.MOST_ENTRIES, 0):
        got = [(r.id, r.n_words, r.per_word) for r in P.measure(df, most_entries=most).collect()]
        assert len(got) == len(want)
        for a, b in zip(sorted(got, key=str), sorted(want, key=str)):
            assert a[:2] == b[:2] and (a[2] is b[2] is None or abs(a[2] - b[2]) < 1e-9)


def test_unseen_symbols_and_empty(spark):
    df = spark.createDataFrame([(1, "abc abd", "en")], "doc_id long, text string, lang string")
    arrays = P.collect_arrays(P.build_model(df))["en"]
    p = kneser_ney(["abc abd"])
    keys, size = P._keys([b"zz", b"ab"])
    seq = [b"\0\0\0 zz\n", b"\0\0\0 ab\n"]
    want = [math.log(p(s[i:i + 5])) for s in seq for i in range(len(s) - 4)]
    assert size.tolist() == [3, 3] and max(abs(a - b) for a, b in zip(arrays.log_probabilities(keys), want)) < 1e-9
    assert P.judge(df.limit(0)).count() == 0
    assert P.judge(df).first().kept is False


def test_base_counts():
    words = P.WordHashes()
    found, chars, symbols, dup, rep = P.base_counts(words, "a b c a b c é#\n\nx |\nx |\n \n".encode())
    assert (len(found), chars, symbols, dup, rep) == (11, 12, 3, 1, 6)
    assert P.base_counts(words, None) == ([], 0, 0, 0, 0)
    assert P.base_counts(words, b"z z z z")[4] == 4 and P.base_counts(words, b"a b")[4] == 0
