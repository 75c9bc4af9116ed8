import random

from weftline.llm import passages as P


def line(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(docs, percent=80, least=25):
    """Clusters of paragraphs over several documents, by comparing all pairs."""
    items = sorted({(d, p, t) for d, text in docs if d is not None and text
                    for p, t in enumerate(text.split("\n")) if len(t.split()) >= least})
    parent = list(range(len(items)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    sets = [shingles(t) for *_, t in items]
    for i in range(len(items)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    groups = {}
    for i, (d, p, t) in enumerate(items):
        groups.setdefault(root(i), []).append((d, p, len(t.split())))
    out = set()
    for members in groups.values():
        members.sort()
        n = len({d for d, *_ in members})
        if n > 1:
            out |= {(d, p, w, *members[0][:2], n, (d, p) != members[0][:2]) for d, p, w in members}
    return out


def corpus():
    rng = random.Random(5)
    shared = [line(rng, n) for n in (30, 60, 120, 25, 40)]
    docs = [(0, None), (1, ""), (2, "\n\n"), (3, line(rng, 24)), (None, shared[0])]
    for d in range(4, 120):
        parts = [line(rng, rng.choice([3, 20, 26, 80])) for _ in range(rng.randint(1, 3))]
        for s in shared:
            if rng.random() < 0.3:
                w = s.split()
                for _ in range(rng.choice([0, 0, 1, 2, 4])):
                    w[rng.randrange(len(w))] = line(rng, 1)
                parts.insert(rng.randrange(len(parts) + 1), " ".join(w))
        docs.append((d, "\n".join(parts)))
    docs.append(docs[50])
    return docs


def test_clusters_equal_all_pairs(spark, monkeypatch):
    from weftline.llm import crowds
    docs = corpus()
    frame = spark.createDataFrame([(*d, 7, "x") for d in docs], "doc_id long, text string, pos int, component string")
    for size in (50_000, 400):  # one cell per crowd, and many
        monkeypatch.setattr(crowds, "CELL_ITEMS", size)
        got = {tuple(r) for r in P.repeated_passages(frame, recall=0.9999999).collect()}
        assert got == brute(docs)
    assert any(r[-1] for r in got)


def test_bands_reach_the_recall():
    for percent in (70, 80, 90):
        n = P.bands_for(percent, 0.999)
        miss = (1 - (percent / 100) ** P.ROWS) ** n
        assert miss <= 0.001 < (1 - (percent / 100) ** P.ROWS) ** (n - 1)


def test_removal_and_empty(spark):
    rng = random.Random(1)
    same = line(rng, 30)
    docs = spark.createDataFrame([(1, same + "\nshort", "a"), (2, "x\n" + same, "b"), (3, None, None)],
                                 "doc_id long, text string, pos string")
    found = P.repeated_passages(docs)
    kept = {r.doc_id: (r.text, r.pos) for r in P.without_repeats(docs, found).collect()}
    assert kept == {1: (same + "\nshort", "a"), 2: ("x", "b"), 3: (None, None)}
    assert P.repeated_passages(docs.limit(0)).count() == 0


def test_runs_in_long_and_wrapped_lines(spark):
    rng = random.Random(11)
    shared = line(rng, 60).split()
    lead, long_ = line(rng, 900), line(rng, 1040)
    wrapped = "\n".join(" ".join(shared[i:i + 12]) for i in range(0, 60, 12))
    across = f"{line(rng, 40)} {' '.join(shared[:30])}\n{' '.join(shared[30:])} {line(rng, 40)}"
    docs = [(1, f"{lead} {' '.join(shared).upper()} {long_}"), (2, "a b\n" + wrapped + "\nc d"), (3, across),
            (4, line(rng, 300) + " " + " ".join(shared[:24])), (5, None), (None, wrapped), (2, "a b\n" + wrapped + "\nc d")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert P.repeated_passages(frame).count() == 0
    found = P.repeats(frame)
    assert {tuple(r) for r in found.collect()} == {
        (1, 0, 60, 1, 0, 3, False, 900), (2, 1, 60, 1, 0, 3, True, 2), (3, 0, 60, 1, 0, 3, True, 40)}
    kept = P.without_repeats(frame, found).collect()
    assert sorted(r.text.split() for r in kept if r.doc_id == 2) == [["a", "b", "c", "d"]] * 2
    assert {r.text for r in kept if r.doc_id in (1, 4, 5, None)} == {t for d, t in docs if d in (1, 4, 5, None)}
    assert [r.text.split() for r in kept if r.doc_id == 3] == [across.split()[:40] + across.split()[100:]]
    assert P.repeats(frame.limit(0)).count() == 0


def test_every_shared_run_is_found(spark):
    rng = random.Random(12)
    least = P.RUN_WORDS + P.RUN_WINDOW - 1
    docs, want = [], set()
    for d in range(0, 300, 3):
        shared = line(rng, rng.randint(least, 90))
        for i in range(3):
            n, m = rng.randint(0, 80), rng.randint(0, 80)
            docs.append((d + i, f"{line(rng, n)} x{d + i} {shared} y{d + i} {line(rng, m)}"))
            want.add((d + i, n + 1, len(shared.split()), d, 3, i > 0))
    found = P.repeated_runs(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {(r.doc, r.word, r.n_words, r.first_doc, r.n_docs, r.removed) for r in found} == want


def test_one_document_is_sketched_in_pieces(spark, monkeypatch):
    rng = random.Random(13)
    docs = spark.createDataFrame([(1, "\n".join(line(rng, 30) for _ in range(40)))], "doc_id long, text string")

    def sketch(hashes, *rest, plain=P._sketch):
        assert len(hashes) <= 4
        return plain(hashes, *rest)
    whole = {tuple(r) for r in P.sketches(docs, "doc_id", "text", 80, 5, 25, 0.9).collect()}
    monkeypatch.setattr(P, "CHUNK_WORDS", 100)
    monkeypatch.setattr(P, "_sketch", sketch)
    pieces = {tuple(r) for r in P.sketches(docs, "doc_id", "text", 80, 5, 25, 0.9).collect()}
    assert pieces == whole and len(whole) == 40


def test_removed_lines_keep_nothing_alive(spark):
    """A line that goes as a near copy is no first place of a run: its own words would be nowhere then."""
    rng = random.Random(14)
    first = line(rng, 200).split()
    second = [w if not 60 <= i < 66 else f"changed{i}" for i, w in enumerate(first)]
    third = f"{line(rng, 500)} {' '.join(second[40:120])} {line(rng, 300)}"
    frame = spark.createDataFrame([(1, " ".join(first)), (2, " ".join(second)), (3, third)], "doc_id long, text string")
    found = P.repeats(frame)
    rows = found.collect()
    assert {(r.doc, r.removed) for r in rows if r.word is None} == {(1, False), (2, True)}
    kept = {r.doc_id: r.text for r in P.without_repeats(frame, found).collect()}
    assert kept[1] == " ".join(first) and kept[2] == ""
    assert all(f"changed{i}" in kept[3] for i in range(60, 66))


def test_every_removed_run_stays_somewhere(spark):
    """Each word of a removed run is left in some document, at the same place of 25 words in a row."""
    rng = random.Random(15)
    shared = [line(rng, n).split() for n in (50, 60, 90, 140)]
    docs = []
    for d in range(60):
        parts = []
        for _ in range(rng.randint(1, 4)):
            s = rng.choice(shared)
            a = rng.randint(0, len(s) - 50)
            words = s[a:a + rng.randint(50, len(s))]
            for _ in range(rng.choice([0, 0, 1, 3])):
                words = [*words[:(i := rng.randrange(len(words)))], line(rng, 1), *words[i + 1:]]
            parts.append((line(rng, rng.choice([0, 5, 30])) + rng.choice([" ", "\n"]) + " ".join(words)).strip())
        docs.append((d, rng.choice([" ", "\n"]).join(parts)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = P.repeats(frame).collect()
    text = {d: t.split() for d, t in docs}
    begin = {d: [sum(len(x.split()) for x in t.split("\n")[:i]) for i in range(t.count("\n") + 2)] for d, t in docs}
    gone = {d: set() for d in text}
    for r in rows:
        if r.removed:
            at = begin[r.doc][r.pos] if r.word is None else r.word
            gone[r.doc] |= set(range(at, at + r.n_words))
    left = {}
    for d, words in text.items():
        for i, w in enumerate(words):
            if i not in gone[d]:
                left.setdefault(w, []).append((d, i))
    runs = [r for r in rows if r.removed and r.word is not None]
    assert len(runs) > 20
    for r in runs:
        for i in range(r.word, r.word + r.n_words):
            around = text[r.doc]
            assert any(words[j - k:j - k + 25] == around[i - k:i - k + 25] for d, j in left.get(around[i].lower(), [])
                       for words in [text[d]] for k in range(25) if j >= k and i >= k and len(around[i - k:i - k + 25]) == 25), (r, i)


def test_window_hashes_and_selected_positions_keep_their_values():
    """The quick forms give what the plain ones do, equal values in a window included."""
    import numpy as np

    from weftline.llm.passages import _selected
    from weftline.llm.shingles import _STEP, windows
    from weftline.llm.text import mix64

    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 24, 25, 26, 300):
        words = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        for width in (1, 2, 3, 5, 8, 13, 25):
            took = min(width, n)
            plain = np.zeros(n - took + 1, np.uint64)
            for i in range(took):
                plain = plain * _STEP + words[i:i + len(plain)]
            assert (windows(words, width) == mix64(plain + np.uint64(took))).all()
        for values in (words, words % np.uint64(7), np.tile(words[:3], n)):
            for window in (1, 2, 24):
                spans = np.lib.stride_tricks.sliding_window_view(values, min(window, len(values)))
                at = spans.argmin(axis=1) + np.arange(len(spans))
                assert _selected(values, window).tolist() == sorted(set(at.tolist()))


def test_lines_and_runs_come_from_one_look_at_the_words(spark):
    """Each text is split and hashed once for both kinds of rows, which are what the separate ways give."""
    rng = random.Random(16)
    docs = spark.createDataFrame([(d, "\n".join(line(rng, rng.choice([0, 3, 30, 70])) for _ in range(rng.randint(0, 6)))) for d in range(200)]
                                 + [(500, None), (None, line(rng, 60)), (501, " ".join(["same"] * 90)), (502, line(rng, 26))], "doc_id long, text string")
    both = P.marks(docs, "doc_id", "text", (80, 5, 25, 0.9), (25, 24)).cache()
    for rows, alone in ((P._sketched(both), P.sketches(docs, "doc_id", "text", 80, 5, 25, 0.9)),
                        (P._chosen(both), P.selected_grams(docs, "doc_id", "text", 25, 24))):
        got = sorted(map(tuple, rows.collect()))
        assert got and got == sorted(map(tuple, alone.collect()))
    both.unpersist()


def test_hashes_of_many_texts_are_selected_as_of_each():
    import numpy as np
    rng = np.random.default_rng(4)
    for top in (1 << 63, 1 << 63, 30):  # few different words: equal values in a window
        for counts in ((30,), (25, 26, 48, 49, 500, 25), (25, 25), rng.integers(25, 200, 60).tolist()):
            texts, whole = [rng.integers(0, top, n, dtype=np.uint64) for n in counts], P._Texts()
            if top < 1 << 63:
                texts = [np.tile(t[:7], 40)[:len(t)] for t in texts]
            want = []
            for d, hashes in enumerate(texts):
                cuts = sorted(rng.integers(0, len(hashes) + 1, 4).tolist())
                sizes = np.diff([0, *cuts, len(hashes)]).tolist()
                lines = np.repeat(np.arange(len(sizes)), sizes)
                whole.add(d, hashes, sizes)
                grams = P.windows(hashes, 25)
                for at in P._selected(grams, 24).tolist():
                    want.append((d, at, int(grams[at].astype(np.int64)), int(lines[at]), int(lines[at + 24])))
            assert list(zip(*(c.tolist() for c in whole.selected(25, 24)))) == want


def test_chains_and_cells_equal_the_plain_ways(spark):
    import numpy as np

    from weftline.llm import crowds
    rng = random.Random(17)
    marks = [(rng.randrange(6), rng.randrange(300), rng.randrange(3), rng.randrange(20), rng.randint(2, 5)) for _ in range(600)]
    want = set()
    for doc in range(6):
        held = {}
        for _, at, first, other, n in sorted(m for m in marks if m[0] == doc):
            row = held.get((first, at - other))
            if row and at <= row[2]:
                row[2], row[5], row[6] = at + 25, other + 25, max(row[6], n)
            else:
                held[first, at - other] = row = [doc, at, at + 25, first, other, other + 25, n]
                held[len(held), "row"] = row
        want |= {tuple(r) for r in held.values()}
    frame = spark.createDataFrame(marks, "doc long, word int, first_doc long, first_word int, n_docs long")
    assert {tuple(r) for r in P._chains(frame, 25).collect()} == want

    few = np.random.default_rng(5)
    sets = [np.unique(few.integers(0, 40, few.integers(3, 30)).astype(np.int64)) for _ in range(60)]
    labels, blocks = np.arange(60) // 2, np.arange(60) % 2
    for first, second in ((0, 0), (0, 1), (1, 1)):
        here = [i for i in range(60) if blocks[i] in (first, second)]
        parent = {int(x): int(x) for x in labels[here]}

        def joined(links):
            root = dict.fromkeys(parent)
            for x in root:
                root[x] = x
            for a, b in links:
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {x: new if r == old else r for x, r in root.items()}
            return root
        close = [(int(labels[i]), int(labels[j])) for i in here for j in here if i < j and (first == second or blocks[i] != blocks[j])
                 and 100 * len(set(sets[i]) & set(sets[j])) >= 50 * len(set(sets[i]) | set(sets[j]))]
        got = crowds._cell_links(np.array([*here]), labels[here], blocks[here], [sets[i] for i in here], first, second, 50)
        assert set(got) <= {*close, *((b, a) for a, b in close)} and joined(got) == joined(close) and len(got) < len(parent)
    assert crowds._cell_links(np.arange(3), np.array([4, 4, 4]), np.zeros(3, int), sets[:3], 0, 0, 50) == []
