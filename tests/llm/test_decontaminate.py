import random

import numpy as np
import pytest

from weftline.llm import decontaminate as D


def fewest_edits(passage, text):
    """Semi-global edit distance, one cell at a time."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(passage, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


def edited(rng, text, n):
    text = list(text)
    for _ in range(n):
        at = rng.randrange(len(text) or 1)
        kind = rng.randrange(3)
        if kind == 0 and text:
            text[at] = rng.choice("abcde ")
        elif kind == 1 and text:
            del text[at]
        else:
            text.insert(at, rng.choice("abcde "))
    return "".join(text)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(n))


@pytest.mark.parametrize("q", [1, 2, 5, 7, 10, 13])
def test_rolling_equals_horner(q):
    codes = np.arange(40, dtype=np.uint32) % 7
    want = []
    for i in range(len(codes) - q + 1):
        h = 0
        for c in codes[i:i + q].tolist():
            h = (h * D._BASE + c + 1) % (1 << 64)
        want.append(h)
    assert D.rolling(codes, q).tolist() == want


def test_every_passage_within_budget_is_found(spark):
    rng = random.Random(3)
    items = [(i, words(rng, n)) for i, n in enumerate([1, 2, 3, 5, 8, 12, 20, 30, 40])] + [(90, None), (91, ""), (92, "  \n")]
    docs = [(0, None), (1, ""), (2, " "), (3, words(rng, 300))]
    for n in range(60):
        _, item = items[rng.randrange(9)]
        changed = edited(rng, item, rng.randint(0, 6)) if item else ""
        docs.append((10 + n, words(rng, rng.randint(0, 30)) + " " + changed.upper() + "\n\t" + words(rng, rng.randint(0, 30))))
    docs.append((10, docs[-1][1]))  # one id twice
    got = D.find_passages(spark.createDataFrame(docs, "doc_id long, text string"),
                          spark.createDataFrame(items + items[:2], "item_id long, text string"), part_chars=150)
    got = sorted((r.doc_id, r.item_id, r.edits) for r in got.collect())
    want = []
    for d, t in docs:
        for i, p in items:
            p = D.normalised(p)
            if p:
                edits = fewest_edits(p, D.normalised(t))
                if edits <= int(D.EDIT_RATE * len(p)):
                    want.append((d, i, edits))
    assert got == sorted(want) and len({e for *_, e in want}) > 2


def test_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "some text of no weight here", "x")], "doc_id long, text string, item_id string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.find_passages(docs, none).count() == 0
    assert D.find_passages(docs.limit(0), spark.createDataFrame([(1, "abc")], "item_id long, text string")).count() == 0
    kept = D.without_passages(docs, spark.createDataFrame([(1, "other")], "item_id long, text string"))
    assert kept.columns == ["doc_id", "text", "item_id"] and kept.count() == 1
