import random

from weftline.llm import lines as L

BLANKS = " \t\n\x0b\x0c\r"


def brute(docs, least=10):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))
    first, holders = {}, {}
    for d, t in docs:
        if d is not None:
            for line in (t or "").split("\n"):
                holders.setdefault(key(line), set()).add(d)
    for k, ids in holders.items():
        first[k] = min(ids)
    out = []
    for d, t in docs:
        parts = (t or "").split("\n")
        kept = [x for x in parts if d is None or len(key(x)) < least or len(holders[key(x)]) < 2 or first[key(x)] == d]
        out.append((d, len(parts), len(parts) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def test_equals_brute_force(spark):
    rng = random.Random(2)
    stock = ["A common line of text", " a COMMON line of text\t", "Éclair au chocolat", "éclair au chocolat", "short", "tencharss!", "ninechars",
             "x" * 5000, "", "  "]
    docs = [(0, None), (1, ""), (2, "\n\n"), (None, "A common line of text"), (40, "\n".join(f"line number {i}" for i in range(300)))]
    for d in range(3, 40):
        docs.append((d, "\n".join(rng.choice(stock + [f"own {d} {rng.random()}"]) for _ in range(rng.randint(1, 150)))))
    docs += [(41, docs[4][1]), (-5, "a common LINE of text"), (90, docs[10][1])]
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, n_lines int")
    bitmaps = L.dedup_bitmaps(df)
    out = L.apply_bitmaps(df, bitmaps)
    got = sorted([(r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in out.collect()], key=str)
    assert got == brute(docs)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_common_line_and_empty_table(spark):
    df = spark.range(500).selectExpr("id AS doc_id", "concat('the very common line\nown line ', id) AS text")
    out = L.apply_bitmaps(df, L.dedup_bitmaps(df))
    assert out.agg({"n_dropped": "sum"}).first()[0] == 499
    none = df.limit(0)
    assert L.apply_bitmaps(none, L.dedup_bitmaps(none)).count() == 0
