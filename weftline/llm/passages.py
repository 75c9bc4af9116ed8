"""Repeated passages across documents: paragraph MinHash banding with exact confirmation.

Lines of at least ``min_words`` words are paragraphs.  The number of bands follows from
the wanted recall at the threshold.  Equal paragraphs are folded first (by a 64-bit digest of
their set); paragraphs sharing a band key are joined through hubs and bounded cells (see ``crowds``) and confirmed by the exact Jaccard
similarity of their sets of word shingles.  Components of the links are clusters.
In each cluster that reaches over two or more documents, the first paragraph
(smallest document, then position) stays and the others are removed.

Runs of words are found apart from lines (``repeated_runs``): of the hashes of all
``RUN_WORDS`` words in a row, the smallest of every ``RUN_WINDOW`` in a row is kept.  The choice
depends on the words alone, so a run of ``RUN_WORDS + RUN_WINDOW - 1`` words or more that two documents
share, whatever its lines, has a hash that both keep.  Equal hashes are matched with their
first place; matches in step with each other are chained and then extended, word by word,
on both sides.

Defined cases: null, empty and short texts have no paragraphs; null ids take no part;
rows with one id count as one document, equal (id, position) rows once; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from weftline.llm.crowds import classes, comparable, lists, stars
from weftline.llm.shingles import MinHash, WordHashes, shingle_set, windows
from weftline.llm.text import mix64, utf8_rows
from weftline.operators.superkmers import smallest
from weftline.session import cut, drop_cuts, ship

PERCENT, SHINGLE, MIN_WORDS, RECALL = 80, 5, 25, 0.999
# Every shared run of 48 words or more is found, and none of less than 25 is reported.
RUN_WORDS, RUN_WINDOW = 25, 24
# Unrelated paragraphs share no shingles, so two minima per band are enough to keep them apart.
ROWS = 2
CHUNK_WORDS = 1 << 19
# Words whose hashes are selected at once, so that they stay in the processor's cache, and rows of a batch.
TEXT_WORDS, MOST_ROWS = 1 << 14, 1 << 16
_ITEM_BITS = np.uint64(44)
_ITEM = np.uint64((1 << 44) - 1)


def bands_for(percent: int, recall: float, rows: int = ROWS) -> int:
    """Fewest bands of ``rows`` minima that find a pair at the threshold with the recall."""
    return math.ceil(math.log(1 - recall) / math.log(1 - (percent / 100) ** rows))


def _split(raw: bytes | None) -> list[list[bytes]]:
    """The words of every line, A-Z lower-cased."""
    return [line.split() for line in raw.lower().split(b"\n")] if raw else []


def _sketch(hashes: list[np.ndarray], width: int, hasher: MinHash) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Set size, set digest and band keys of many paragraphs (each of ``width`` words or more) at once."""
    size = np.fromiter(map(len, hashes), np.int64, len(hashes))
    grams = windows(np.concatenate(hashes), width)
    ends = np.cumsum(size)
    inside = np.ones(ends[-1], bool)
    for i in range(1, width):
        inside[ends - i] = False
    owner = np.repeat(np.arange(len(hashes), dtype=np.uint64), size - width + 1)
    # Owner and 44 bits of the shingle in one word: one plain sort brings equal shingles together.
    packed = np.sort((owner << _ITEM_BITS) | (grams[inside[:len(grams)]] >> np.uint64(20)))
    packed = packed[np.concatenate(([True], packed[1:] != packed[:-1]))]
    owner, item = packed >> _ITEM_BITS, mix64(packed & _ITEM)
    starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    digest = np.add.reduceat(mix64(item + np.uint64(1)), starts)
    bands = []
    for lane in range(0, len(hasher.mul), ROWS):
        key = np.full(len(starts), lane + 1, np.uint64)
        for i in range(lane, lane + ROWS):
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(item * hasher.mul[i] + hasher.add[i], starts))
        bands.append(key)
    return np.diff(np.append(starts, len(packed))), digest, np.stack(bands)


def marks(docs: DataFrame, id_col: str, text: str, lines: tuple[int, int, int, float] | None, runs: tuple[int, int] | None) -> DataFrame:
    """Rows of paragraphs and of selected hashes (``gram`` is null or not), from one look at the words of a text.

    ``lines`` has the arguments of ``sketches``, ``runs`` those of ``selected_grams``; what is None is left out.
    """
    ship(docs.sparkSession)
    percent, width, min_words, recall = lines or (0, 0, 0, 0)
    run_width, window = runs or (0, 0)
    count = bands_for(percent, recall) if lines else 0
    kinds = {"doc": pa.int64(), "pos": pa.int32(), "n_words": pa.int64(), "id": pa.int64(), "n": pa.int64(),
             **{f"b{i}": pa.int64() for i in range(count)},
             "word": pa.int32(), "gram": pa.int64(), "line": pa.int32(), "last_line": pa.int32()}

    def rows(columns: dict[str, np.ndarray | list]) -> pa.RecordBatch:
        size = len(columns["doc"])
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[c], kind) if c in columns else pa.nulls(size, kind) for c, kind in kinds.items()], list(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, hasher = WordHashes(), MinHash(count * ROWS)
        doc, pos, held, total = [], [], [], 0
        whole, found, chosen = _Texts(), [], 0

        def flush() -> pa.RecordBatch:
            n, digest, bands = _sketch(held, width, hasher)
            return rows({"doc": doc, "pos": pos, "n_words": list(map(len, held)), "id": digest.view(np.int64), "n": n,
                         **{f"b{i}": b.view(np.int64) for i, b in enumerate(bands)}})

        def selected() -> pa.RecordBatch:
            columns = [np.concatenate(c) for c in zip(*found)]
            return rows(dict(zip(("doc", "word", "gram", "line", "last_line"), columns)))
        for batch in batches:
            for id_, raw in zip(batch.column(0).to_pylist(), utf8_rows(batch.column(1))):
                parts = _split(raw)
                sizes = list(map(len, parts))
                hashes = words.each([w for part in parts for w in part])
                at = 0
                for number, size in enumerate(sizes if lines else ()):
                    if size >= min_words:
                        doc.append(id_)
                        pos.append(number)
                        held.append(hashes[at:at + size])
                        total += size
                        # Inside a document too: the number of paragraphs held must fit above the shingle.
                        if total > CHUNK_WORDS:
                            yield flush()
                            doc, pos, held, total = [], [], [], 0
                    at += size
                if runs and len(hashes) >= run_width:
                    whole.add(id_, hashes, sizes)
                    if whole.total >= TEXT_WORDS:
                        found.append(whole.selected(run_width, window))
                        chosen += len(found[-1][0])
                        whole = _Texts()
                        if chosen > MOST_ROWS:
                            yield selected()
                            found, chosen = [], 0
        if held:
            yield flush()
        if whole.total:
            found.append(whole.selected(run_width, window))
        if found:
            yield selected()
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text).alias("text")).where("id IS NOT NULL").mapInArrow(
        run, ", ".join(f"{c} {'int' if kind == pa.int32() else 'bigint'}" for c, kind in kinds.items()))


def _sketched(rows: DataFrame) -> DataFrame:
    return rows.where("gram IS NULL").drop("word", "gram", "line", "last_line")


def _chosen(rows: DataFrame) -> DataFrame:
    return rows.where("gram IS NOT NULL").select("doc", "word", "gram", "line", "last_line")


def sketches(docs: DataFrame, id_col: str, text: str, percent: int, width: int, min_words: int, recall: float) -> DataFrame:
    """``doc, pos, n_words, id, n, b0..``: set digest, set size and band keys of every paragraph."""
    return _sketched(marks(docs, id_col, text, (percent, width, min_words, recall), None))


def full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text: str, width: int, min_words: int) -> DataFrame:
    """``id, items`` of the paragraphs in ``wanted`` (``id, doc, pos``)."""
    ship(docs.sparkSession)
    per_doc = wanted.groupBy("doc").agg(F.collect_list(F.struct("pos", "id")).alias("wanted"))
    joined = per_doc.join(docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text).alias("text")), "doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            ids, sets = [], []
            for marks, raw in zip(batch.column(0).to_pylist(), utf8_rows(batch.column(1))):
                by_pos = {m["pos"]: m["id"] for m in marks}
                for at, line in enumerate(raw.split(b"\n") if raw else ()):
                    # Only the wanted lines are hashed.
                    if at in by_pos and len(hashes := words.of(line)) >= min_words:
                        ids.append(by_pos[at])
                        sets.append(shingle_set(hashes, width))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), lists(sets)], ["id", "items"])
    return joined.select("wanted", "text").mapInArrow(run, "id bigint, items array<bigint>")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = PERCENT, width: int = SHINGLE,
                      min_words: int = MIN_WORDS, recall: float = RECALL, sketched: DataFrame | None = None) -> DataFrame:
    """One row per paragraph of every cluster over several documents.

    ``doc, pos, n_words, first_doc, first_pos, n_docs, removed``: the first paragraph of the
    cluster, its number of documents, and whether this paragraph goes.  ``sketched`` has the
    ``sketches`` of these texts, where they are written already.
    """
    if min_words < width:
        raise ValueError("a paragraph must hold at least one whole shingle")
    if sketched is None:
        sketched = cut(sketches(docs, id_col, text, percent, width, min_words, recall))
    bands = [c for c in sketched.columns if c[0] == "b"]
    folded = cut(sketched.groupBy("id").agg(F.first("n").alias("n"), *[F.first(b).alias(b) for b in bands])
                 .select("id", "n", F.array(*bands).alias("bands")))
    met = cut(stars(folded))
    pairs = cut(comparable(met, folded.select("id", "n"), percent))
    # One place per set that needs a comparison.
    wanted = (sketched.select("id", "doc", "pos").join(met.select("id").distinct(), "id", "left_semi")
              .groupBy("id").agg(F.min(F.struct("doc", "pos")).alias("at")).select("id", "at.doc", "at.pos"))
    sets = cut(full_sets(docs, wanted, id_col, text, width, min_words).dropDuplicates(["id"]))
    found = cut(classes(folded, met, pairs, sets, percent))
    members = cut(sketched.select("doc", "pos", "n_words", "id").join(found, "id").drop("id"))
    drop_cuts(folded, met, pairs, sets, found)
    # Distinct documents per cluster, counted on (cluster, document) rows: no list per cluster.
    clusters = (members.groupBy("component", "doc").agg(F.min("pos").alias("pos")).groupBy("component")
                .agg(F.min(F.struct("doc", "pos")).alias("first"), F.count(F.lit(1)).alias("n_docs")).where("n_docs > 1"))
    return members.join(clusters, "component").select(
        "doc", "pos", "n_words", F.col("first.doc").alias("first_doc"), F.col("first.pos").alias("first_pos"), "n_docs",
        ((F.col("doc") != F.col("first.doc")) | (F.col("pos") != F.col("first.pos"))).alias("removed")).distinct()


def _selected(grams: np.ndarray, window: int) -> np.ndarray:
    """Positions of the smallest of every ``window`` values in a row (of all, if they are fewer); the first one of equals."""
    window = min(window, len(grams))
    least = smallest(grams, window)
    # A value is the smallest of some window if the greatest of the minima over its windows is the value itself.
    edge = np.zeros(window - 1, np.uint64)
    at = np.flatnonzero(~smallest(~np.concatenate((edge, least, edge)), window) == grams)
    if not ((np.diff(at) < window) & (grams[at[1:]] == grams[at[:-1]])).any():
        return at
    # Equal values in one window: only the first of them counts.
    spans = np.lib.stride_tricks.sliding_window_view(grams, window)
    at = spans.argmin(axis=1) + np.arange(len(spans))
    return at[np.concatenate(([True], at[1:] != at[:-1]))]


class _Texts:
    """Word hashes of several texts, whose hashes of words in a row are made and selected at once."""

    def __init__(self):
        self.ids, self.hashes, self.n_lines, self.sizes, self.total = [], [], [], [], 0

    def add(self, id_: int, hashes: np.ndarray, sizes: list[int]) -> None:
        """A text, with the number of words of each of its lines."""
        self.ids.append(id_)
        self.hashes.append(hashes)
        self.n_lines.append(len(sizes))
        self.sizes += sizes
        self.total += len(hashes)

    def selected(self, width: int, window: int) -> tuple[np.ndarray, ...]:
        """``doc, word, gram, line, last_line`` of the selected hashes; every text has ``width`` words at least."""
        size = np.fromiter(map(len, self.hashes), np.int64, len(self.hashes))
        begin = np.cumsum(size) - size
        grams = windows(np.concatenate(self.hashes), width)
        at = _selected_of(grams, begin, size - width + 1, window)
        owner = np.searchsorted(begin, at, "right") - 1
        line_ends, line_begin = np.cumsum(self.sizes), (np.cumsum(self.n_lines) - self.n_lines)[owner]
        return (np.array(self.ids, np.int64)[owner], (at - begin[owner]).astype(np.int32), grams[at].view(np.int64),
                *[(np.searchsorted(line_ends, word, "right") - line_begin).astype(np.int32) for word in (at, at + width - 1)])


def _selected_of(grams: np.ndarray, begin: np.ndarray, count: np.ndarray, window: int) -> np.ndarray:
    """``_selected`` within every stretch of ``count`` values from ``begin``: ascending positions in ``grams``."""
    again, at = count < window, np.empty(0, np.int64)
    if not again.all():
        least = smallest(grams, window)
        # Only windows that lie in one stretch count.
        first = np.arange(len(least))
        owner = np.searchsorted(begin, first, "right") - 1
        least[first + window > (begin + count)[owner]] = 0
        edge = np.zeros(window - 1, np.uint64)
        at = np.flatnonzero(~smallest(~np.concatenate((edge, least, edge)), window) == grams)
        owner = np.searchsorted(begin, at, "right") - 1
        # Equal values in one window: such a stretch is looked at by itself, like those shorter than a window.
        near = (owner[1:] == owner[:-1]) & (np.diff(at) < window) & (grams[at[1:]] == grams[at[:-1]])
        again[owner[1:][near]] = True
        at = at[~again[owner] & (at < (begin + count)[owner])]
    alone = [begin[i] + _selected(grams[begin[i]:begin[i] + count[i]], window) for i in np.flatnonzero(again)]
    return np.sort(np.concatenate([at, *alone])) if alone else at


def _words_and_lines(words: WordHashes, raw: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a text, and the line each one is in."""
    parts = _split(raw)
    return words.each([w for part in parts for w in part]), np.repeat(np.arange(len(parts)), list(map(len, parts)))


def selected_grams(docs: DataFrame, id_col: str, text: str, width: int, window: int) -> DataFrame:
    """``doc, word, gram, line, last_line``: the selected hashes of ``width`` words in a row, the number of the first
    word, and the lines of the first and the last one."""
    return _chosen(marks(docs, id_col, text, None, (width, window)))


def _chains(matched: DataFrame, width: int) -> DataFrame:
    """``doc, a, b, first_doc, fa, fb, n_docs``: words a to b - 1 of a document equal words fa to fb - 1 of the first."""
    ship(matched.sparkSession)
    names = ["doc", "a", "b", "first_doc", "fa", "fb", "n_docs"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column(1)
            word, first_doc, first_word, n_docs = [c.to_numpy() for c in marks.flatten().flatten()]
            doc = np.repeat(batch.column(0).to_numpy(), marks.value_lengths().to_numpy())
            if not len(doc):
                continue
            shift = word - first_word
            by = np.lexsort((word, shift, first_doc, doc))
            doc, word, first_doc, shift, n_docs = doc[by], word[by], first_doc[by], shift[by], n_docs[by]
            new = word[1:] > word[:-1] + width
            for key in (doc, first_doc, shift):
                new |= key[1:] != key[:-1]
            a = np.flatnonzero(np.concatenate(([True], new)))
            b = word[np.append(a[1:], len(doc)) - 1] + width
            columns = [doc[a], word[a], b, first_doc[a], word[a] - shift[a], b - shift[a], np.maximum.reduceat(n_docs, a)]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names)
    return matched.groupBy("doc").agg(F.collect_set(F.struct("word", "first_doc", "first_word", "n_docs")).alias("marks")).mapInArrow(
        run, "doc bigint, a int, b int, first_doc bigint, fa int, fb int, n_docs bigint")


def _sides(spans: DataFrame, docs: DataFrame, removed: DataFrame, id_col: str, text: str, reach: int) -> DataFrame:
    """``doc, a, b`` with the hashes of up to ``reach`` words before (nearest first) and after, and the
    lines of the words from a backwards.  Words of removed lines (``doc, pos``) equal no other word."""
    ship(spans.sparkSession)
    per_doc = spans.distinct().groupBy("doc").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    gone = removed.groupBy("doc").agg(F.collect_set("pos").alias("gone"))
    joined = (per_doc.join(gone, "doc", "left")
              .join(docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text).alias("text")), "doc"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            rows, before, after, lines = [], [], [], []
            for doc, marks, out, raw in zip(*[batch.column(i).to_pylist() for i in range(3)], utf8_rows(batch.column(3))):
                hashes, line = _words_and_lines(words, raw)
                if out:
                    at = np.flatnonzero(np.isin(line, out))
                    hashes[at] = mix64(at.astype(np.uint64) ^ mix64(np.full(len(at), doc & 0xFFFFFFFFFFFFFFFF, np.uint64)))
                for m in marks:
                    a, b = m["a"], m["b"]
                    if b > len(hashes):
                        continue  # a span of another row with this id
                    low = max(0, a - reach)
                    rows.append((doc, a, b))
                    before.append(hashes[low:a][::-1])
                    after.append(hashes[b:b + reach])
                    lines.append(line[low:a + 1][::-1].astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), *[pa.array([r[i] for r in rows], pa.int32()) for i in (1, 2)],
                 lists(before), lists(after), lists(lines)], ["doc", "a", "b", "before", "after", "lines"])
    return joined.select("doc", "spans", "gone", "text").mapInArrow(
        run, "doc bigint, a int, b int, before array<bigint>, after array<bigint>, lines array<bigint>").dropDuplicates(["doc", "a", "b"])


def _alike(left: str, right: str) -> F.Column:
    """Number of leading elements that two arrays have in common."""
    same = F.zip_with(left, right, lambda x, y: F.coalesce(x == y, F.lit(False)))
    differ = F.array_position(same, False)
    return F.when(differ > 0, differ - 1).otherwise(F.size(same)).cast("int")


def shared_grams(grams: DataFrame) -> DataFrame:
    """The selected hashes that several documents hold: most occur in one, and leave before anything is counted by document."""
    several = grams.groupBy("gram").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi").select("gram")
    return grams.join(several, "gram")


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = RUN_WORDS,
                  window: int = RUN_WINDOW, removed: DataFrame | None = None, shared: DataFrame | None = None) -> DataFrame:
    """Runs of equal words that several documents hold, in lines of any length.

    ``doc, pos, n_words, first_doc, first_pos, n_docs, removed, word``: the line and the number of the
    run's first word, and the first document and line with these words.  The words of
    a removed run stay in the first document only, whose own row is not removed.  Lines that are ``removed``
    already (``doc, pos``) are in no run: neither is what they hold kept, nor does it make others go.
    ``shared`` has the ``shared_grams`` of these texts as ``cut`` returned them, and is removed once read.
    """
    if removed is None:
        removed = docs.sparkSession.createDataFrame([], "doc bigint, pos int")
    if shared is None:
        grams = cut(selected_grams(docs, id_col, text, width, window))
        shared = cut(shared_grams(grams))
        drop_cuts(grams)
    # A run's words are in few lines; those of a removed line leave before the first place is chosen.
    out = removed.select("doc", F.col("pos").alias("out")).distinct()
    met = shared.withColumn("out", F.explode(F.sequence("line", "last_line"))).join(out, ["doc", "out"], "left_semi")
    held = cut(shared.join(met.select("doc", "word", "gram").distinct(), ["doc", "word", "gram"], "left_anti")
               .select("doc", "word", "gram"))
    drop_cuts(shared)
    firsts = (held.groupBy("gram", "doc").agg(F.min("word").alias("word")).groupBy("gram")
              .agg(F.min(F.struct("doc", "word")).alias("first"), F.count(F.lit(1)).alias("n_docs")).where("n_docs > 1"))
    matched = (held.join(firsts, "gram").where((F.col("doc") != F.col("first.doc")) | (F.col("word") != F.col("first.word")))
               .select("doc", "word", F.col("first.doc").alias("first_doc"), F.col("first.word").alias("first_word"), "n_docs"))
    chains = cut(_chains(matched, width))
    first = [F.col("first_doc").alias("doc"), F.col("fa").alias("a"), F.col("fb").alias("b")]
    # A hash lies within a window of the end of its run.
    sides = cut(_sides(chains.select("doc", "a", "b").unionByName(chains.select(*first)), docs, removed, id_col, text, window))
    theirs = sides.select(F.col("doc").alias("first_doc"), F.col("a").alias("fa"), F.col("b").alias("fb"),
                          *[F.col(c).alias(f"first_{c}") for c in ("before", "after", "lines")])
    grown = (chains.join(sides, ["doc", "a", "b"]).join(theirs, ["first_doc", "fa", "fb"])
             .withColumn("left", _alike("before", "first_before")).withColumn("right", _alike("after", "first_after")))
    found = grown.select(
        "doc", F.get("lines", F.col("left")).cast("int").alias("pos"),
        (F.col("b") - F.col("a") + F.col("left") + F.col("right")).cast("bigint").alias("n_words"), "first_doc",
        F.get("first_lines", F.col("left")).cast("int").alias("first_pos"), "n_docs", F.lit(True).alias("removed"),
        (F.col("a") - F.col("left")).alias("word"), (F.col("fa") - F.col("left")).alias("first_word")).distinct()
    # Near the ends of a run, hashes may be kept by some documents only: these give the run, or a part of it, again.
    end = F.col("word") + F.col("n_words")
    earlier = Window.partitionBy("doc").orderBy("word", end.desc(), "first_doc", "first_word", F.col("n_docs").desc()).rowsBetween(
        Window.unboundedPreceding, -1)
    rows = cut(found.withColumn("_reach", F.max(end).over(earlier)).where(F.coalesce(F.col("_reach") < end, F.lit(True))).drop("_reach"))
    kept = rows.groupBy("first_doc", "first_pos", "first_word", "n_words").agg(F.max("n_docs").alias("n_docs")).select(
        F.col("first_doc").alias("doc"), F.col("first_pos").alias("pos"), "n_words", "first_doc", "first_pos", "n_docs",
        F.lit(False).alias("removed"), F.col("first_word").alias("word"))
    return rows.drop("first_word").unionByName(kept)


def repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Repeated lines (``word`` is null), and repeated runs of what their removal leaves."""
    read = cut(marks(docs, id_col, text, (PERCENT, SHINGLE, MIN_WORDS, RECALL), (RUN_WORDS, RUN_WINDOW)))
    lines = cut(repeated_passages(docs, id_col, text, sketched=_sketched(read)).withColumn("word", F.lit(None).cast("int")))
    shared = cut(shared_grams(_chosen(read)))
    drop_cuts(read)
    return lines.unionByName(repeated_runs(docs, id_col, text, removed=lines.where("removed").select("doc", "pos"), shared=shared))


def _without_words(raw: bytes, lines: set[int], words: set[int]) -> bytes:
    """``raw`` without whole lines and without single words; a line that loses all its words goes."""
    out, at = [], 0
    for number, line in enumerate(raw.split(b"\n")):
        pieces = re.findall(rb"\s*\S+", line)
        stays = [i not in words for i in range(at, at + len(pieces))]
        at += len(pieces)
        if number in lines or (pieces and not any(stays)):
            continue
        if not all(stays):
            line = b"".join(p for p, s in zip(pieces, stays) if s)
            line = line if stays[0] else line.lstrip()
        out.append(line)
    return b"\n".join(out)


def without_repeats(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the removed paragraphs taken out of the text, and the removed runs if ``found`` has ``word``."""
    ship(docs.sparkSession)
    if "word" in found.columns:
        gone = found.where("removed").groupBy(F.col("doc").alias("_doc")).agg(
            F.collect_set(F.when(F.col("word").isNull(), F.col("pos"))).alias("_lines"),
            F.collect_set(F.when(F.col("word").isNotNull(), F.struct("word", "n_words"))).alias("_runs"))
        joined = docs.join(gone, docs[id_col] == gone["_doc"], "left").drop("_doc")
        schema = docs.schema

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = utf8_rows(batch.column(text))
                for i, (lines, runs) in enumerate(zip(batch.column("_lines").to_pylist(), batch.column("_runs").to_pylist())):
                    if texts[i] and (lines or runs):
                        words = {w for r in runs for w in range(r["word"], r["word"] + r["n_words"])}
                        texts[i] = _without_words(texts[i], set(lines), words)
                kept = pa.array(texts, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [kept if name == text else batch.column(name) for name in schema.names], schema.names)
        return joined.mapInArrow(run, schema)
    gone = found.where("removed").groupBy(F.col("doc").alias("_doc")).agg(F.collect_set("pos").alias("_gone"))
    joined = docs.join(gone, docs[id_col] == gone["_doc"], "left")
    kept = F.array_join(F.filter(F.split(F.col(text), "\n"), lambda _, i: ~F.array_contains("_gone", i)), "\n")
    return joined.withColumn(text, F.when(F.col("_gone").isNull(), F.col(text)).otherwise(kept)).select(docs.columns)
