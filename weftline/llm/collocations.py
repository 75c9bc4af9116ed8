"""Phrase collocations by direct-address tiling.

Texts are cut into pieces at punctuation and line ends and pieces into words.  The words of a
language that occur ``LEAST`` times or more are numbered by falling frequency.  A text is then a line of
numbers, and neighbouring numbers are the cells of a matrix of pairs.  The numbers are split into bands of equal
mass, and two bands make a tile: a tile of few words that many pairs fall into is counted with a dense
``bincount``, any other one as sorted coordinates.  The frequent pairs are numbered by frequency in turn, and
neighbouring pairs are counted the same way, which gives phrases of three words, and so on: a
phrase is frequent only if its first and last parts are.

No table is sent to all tasks.  Texts are held as *chunks* of about ``CHUNK_WORDS`` words of one
language.  A chunk sends what it counted in a tile as one packed value; Spark brings the values of a tile
together, which adds them up, and joins the numbers of the frequent pairs back to the values, and these to their
chunk.  Bands of equal mass bound what a tile can get to about ``TILE_PAIRS`` pairs, whatever the words'
distribution; a word that is a band of its own gives one cell per chunk.  Words are added up in the same way, by buckets.
Everything moved is in proportion to the words of the texts.

A candidate is scored at its weakest cut, with exact decimal products.  It is dropped if it lies inside
a longer candidate that is as frequent; the chain of phrases between the two is as frequent as well, so the
next longer ones decide.

Defined cases: null text is empty; null language is ``und``; repeated rows count as often as they occur; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from weftline.llm.text import utf8_rows
from weftline.operators.scan import ordinal, prefix_scan
from weftline.session import cut, ship

LEAST = 100
LONGEST = 5
TOP = 2000
# A tile of at most DENSE_CELLS cells is counted densely when a pair falls into one of DENSE_SHARE cells at least.
DENSE_CELLS = 1 << 22
DENSE_SHARE = 16
TILE_PAIRS = 1 << 21
CHUNK_WORDS = 1 << 20
# A bucket of words gets what about this much text holds of them: some 200,000 entries of its chunks' lists.
BUCKET_BYTES = 1 << 23
SPREAD = 64

# The characters that end a piece; a tab separates words as a blank does.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(_ENDS + b"\t", b"\n" * len(_ENDS) + b" ")


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers byte plane by byte plane, so that small ones cost little."""
    size = values.dtype.itemsize
    return zlib.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, size).T).tobytes(), 1)


def _unpack(raw: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(raw), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def _pack_counts(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys as differences, and their counts."""
    return _pack(np.stack((np.diff(keys, prepend=0), counts)).astype(np.int64).reshape(-1))


def _unpack_counts(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, counts = _unpack(raw, np.int64).reshape(2, -1)
    return np.cumsum(steps), counts


class _Codes(dict):
    """Numbers for words in the order of appearance; the first two are the empty word and the end of a piece."""

    def __init__(self):
        super().__init__({b"": 0, b"\n": 1})

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        return code


def word_chunks(docs: DataFrame, buckets: int, text: str = "text", lang: str = "lang") -> DataFrame:
    """``chunk, lang, bucket, codes, words, counts``: packed chunks of the texts.

    A chunk is one row with its codes in the order of the text (-1 between pieces), and one row per bucket of words with
    the codes, the words themselves and how often each occurs in the chunk.
    """
    ship(docs.sparkSession)
    names = ["chunk", "lang", "bucket", "codes", "words", "counts"]

    def rows(chunk: int, lang: str, codes: np.ndarray, words: list[bytes]) -> pa.RecordBatch:
        counts = np.bincount(codes[codes >= 0], minlength=len(words))
        bucket = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets
        order = np.argsort(bucket, kind="stable")
        ends = np.flatnonzero(np.diff(bucket[order], append=-1)) + 1
        out = [(None, _pack(codes), None, None)]
        for part in np.split(order, ends[:-1]):
            out.append((int(bucket[part[0]]), _pack(part.astype(np.int32)), zlib.compress(b"\n".join([words[i] for i in part]), 1),
                        _pack(counts[part].astype(np.int32))))
        return pa.RecordBatch.from_arrays(
            [pa.array([chunk] * len(out)), pa.array([lang] * len(out)), pa.array([r[0] for r in out], pa.int64()),
             *[pa.array([r[i] for r in out], pa.binary()) for i in (1, 2, 3)]], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[_Codes, list[np.ndarray]]] = {}
        number, size = TaskContext.get().partitionId() << 32, 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number, size
            for name, (known, parts) in held.items():
                words = list(known)[2:]
                if words:
                    yield rows(number, name, np.concatenate(parts) - np.int32(2), words)
                    number += 1
            held.clear()
            size = 0
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), utf8_rows(batch.column(1))):
                if raw:
                    known, parts = held.setdefault(name, (_Codes(), []))
                    tokens = raw.lower().translate(_TABLE).replace(b"\n", b" \n ").split(b" ")
                    codes = np.fromiter(map(known.__getitem__, tokens), np.int32, len(tokens))
                    parts += [codes[codes > 0], np.ones(1, np.int32)]
                    size += len(tokens)
                    if size >= CHUNK_WORDS:
                        yield from flush()
        yield from flush()
    return (docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
            .mapInArrow(run, "chunk bigint, lang string, bucket bigint, codes binary, words binary, counts binary"))


def _line(numbers: np.ndarray) -> bytes:
    """A line of numbers, in which -1 stands for any stretch without one."""
    gone = numbers < 0
    return _pack(numbers[~(gone & np.concatenate(([True], gone[:-1])))].astype(np.int32))


def _lines(rows: DataFrame, numbers) -> DataFrame:
    """``chunk, lang, line`` from ``chunk, lang``, a packed line and a list; ``numbers`` makes the new numbers from the two."""
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                line = numbers(_unpack(batch.column(2)[i].as_py(), np.int32), batch.column(3)[i].values)
                if (line >= 0).any():
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), batch.column(1).slice(i, 1),
                                                      pa.array([_line(line)], pa.binary())], ["chunk", "lang", "line"])
    return rows.mapInArrow(run, "chunk bigint, lang string, line binary")


# What a group gives back: one row per frequent entry (with its place in the group's list), and one per chunk with what
# of the chunk is frequent and the places in the list; a bucket of words tells its number of words in all as well.
_COUNTED = "lang string, tile bigint, place int, {entry}, f bigint, total bigint, chunk bigint, held binary, places binary"


def _counted(group: pa.Table, entries: pa.Array, f: np.ndarray, total: int | None, held: list[bytes], places: list[np.ndarray],
             name: str) -> pa.Table:
    """The rows of a group: entries first, then its chunks."""
    m, n = len(entries), group.num_rows
    keep = [i for i in range(n) if len(places[i])]
    rows = m + len(keep) + (total is not None)

    def column(first: pa.Array, last: pa.Array, kind: pa.DataType) -> pa.Array:
        middle = pa.nulls(rows - len(first) - len(last), kind)
        return pa.concat_arrays([first.cast(kind), middle, last.cast(kind)])
    none, chunk = pa.nulls(0), group.column("chunk").combine_chunks()
    return pa.table({
        "lang": pa.array([group.column("lang")[0].as_py()] * rows, pa.string()),
        "tile": pa.array([group.column("tile")[0].as_py()] * rows, pa.int64()),
        "place": column(pa.array(np.arange(m, dtype=np.int32)), none, pa.int32()), name: column(entries, none, entries.type),
        "f": column(pa.array(f), none, pa.int64()),
        "total": pa.array([None] * m + ([total] if total is not None else []) + [None] * len(keep), pa.int64()),
        "chunk": column(none, chunk.take(pa.array(keep, pa.int64())), pa.int64()),
        "held": column(none, pa.array([held[i] for i in keep], pa.binary()), pa.binary()),
        "places": column(none, pa.array([_pack(places[i].astype(np.int32)) for i in keep], pa.binary()), pa.binary())})


def ranked_entries(counted: DataFrame, entry: str) -> DataFrame:
    """``lang, tile, place, entry, f, id``: the frequent entries with numbers by falling frequency per language."""
    found = counted.where("place IS NOT NULL").select("lang", "tile", "place", entry, "f", (-F.col("f")).alias("behind"))
    return cut(ordinal(cut(found), ["behind", entry], "id", ["lang"], 0).drop("behind"))


def _answers(counted: DataFrame, known: DataFrame) -> DataFrame:
    """``chunk, answers``: per chunk, what of it is frequent in each group, with the numbers."""
    ship(counted.sparkSession)
    lists = known.groupBy("lang", "tile").agg(F.collect_list(F.struct("place", "id")).alias("known"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = []
            for i in range(batch.num_rows):
                pairs = batch.column(3)[i].values
                number = np.empty(len(pairs), np.int32)
                number[pairs.field(0).to_numpy()] = pairs.field(1).to_numpy()
                ids.append(_pack(number[_unpack(batch.column(2)[i].as_py(), np.int32)]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.binary())], ["chunk", "held", "ids"])
    rows = counted.where("chunk IS NOT NULL").join(lists, ["lang", "tile"]).select("chunk", "held", "places", "known")
    return rows.mapInArrow(run, "chunk bigint, held binary, ids binary").groupBy("chunk").agg(F.collect_list(F.struct("held", "ids")).alias("answers"))


def counted_words(chunks: DataFrame, least: int) -> DataFrame:
    """The words of each bucket that occur ``least`` times or more, the codes they have in each chunk, and the bucket's total."""
    ship(chunks.sparkSession)

    def add(group: pa.Table) -> pa.Table:
        found: dict[bytes, int] = {}
        texts = [zlib.decompress(w).split(b"\n") for w in group.column("words").to_pylist()]
        for words, counts in zip(texts, group.column("counts").to_pylist()):
            for word, n in zip(words, _unpack(counts, np.int32).tolist()):
                found[word] = found.get(word, 0) + n
        often = [w for w, n in found.items() if n >= least]
        place = dict(zip(often, range(len(often))))
        held, places = [], []
        for words, codes in zip(texts, group.column("codes").to_pylist()):
            mine = np.fromiter((place.get(w, -1) for w in words), np.int32, len(words))
            held.append(_pack(_unpack(codes, np.int32)[mine >= 0]))
            places.append(mine[mine >= 0])
        return _counted(group, pa.array(often, pa.binary()).cast(pa.string()), np.array([found[w] for w in often], np.int64),
                        sum(found.values()), held, places, "word")
    listed = chunks.where("bucket IS NOT NULL").select("lang", F.col("bucket").alias("tile"), "chunk", "codes", "words", "counts")
    return listed.groupBy("lang", "tile").applyInArrow(add, _COUNTED.format(entry="word string"))


def word_lines(chunks: DataFrame, counted: DataFrame, known: DataFrame) -> DataFrame:
    """The chunks as lines of word numbers; other words are gaps."""
    def numbers(codes: np.ndarray, answers: pa.Array) -> np.ndarray:
        # One place more, which code -1 reads.
        number = np.full(int(codes.max(initial=-1)) + 2, -1, np.int32)
        for mine, ids in zip(answers.field(0).to_pylist(), answers.field(1).to_pylist()):
            number[_unpack(mine, np.int32)] = _unpack(ids, np.int32)
        return number[codes]
    coded = chunks.where("bucket IS NULL").select("chunk", "lang", "codes")
    return _lines(coded.join(_answers(counted, known), "chunk"), numbers)


def bands(known: DataFrame) -> dict[str, np.ndarray]:
    """First numbers of the bands of each language: as many bands of equal mass as keep a tile near ``TILE_PAIRS`` pairs.

    Their number grows with the root of the words; they are the only thing that goes through the driver.
    """
    mass = prefix_scan(known.select("lang", "id", "f"), ["lang"], "id", F.floor(F.col("id") / (1 << 16)), F.col("f"), "sum", "before",
                       inclusive=False)
    whole = known.groupBy("lang").agg(F.sum("f").alias("total"))
    count = F.ceil(F.sqrt(F.col("total") / TILE_PAIRS))
    place = F.floor(F.coalesce("before", F.lit(0)) * count / F.col("total"))
    firsts = mass.join(whole, "lang").groupBy("lang", place.alias("band")).agg(F.min("id").alias("first")).collect()
    found: dict[str, list[int]] = {}
    for row in firsts:
        found.setdefault(row["lang"], []).append(row["first"])
    return {lang: np.array(sorted(f), np.int64) for lang, f in found.items()}


def count_tile(left: np.ndarray, right: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The different pairs in order (left number in the high half) and the sum of their weights (1 each without)."""
    low_l, low_r = int(left.min()), int(right.min())
    wide = int(right.max()) - low_r + 1
    cells = (int(left.max()) - low_l + 1) * wide
    if cells <= DENSE_CELLS and cells <= len(left) * DENSE_SHARE:
        place = (left.astype(np.int64) - low_l) * wide + (right - low_r)
        # Sums stay below 2^53, up to which floating point is exact.
        seen = np.bincount(place, weight, cells)
        used = np.flatnonzero(seen)
        return (used // wide + low_l) << 32 | (used % wide + low_r), seen[used].astype(np.int64)
    pair = left.astype(np.int64) << 32 | right
    if weight is None:
        return np.unique(pair, return_counts=True)
    order = np.argsort(pair, kind="stable")
    pair, weight = pair[order], weight[order]
    first = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
    return pair[first], np.add.reduceat(weight, first)


def _neighbours(line: np.ndarray) -> np.ndarray:
    """Places whose number has a number right after it."""
    return np.flatnonzero((line[:-1] >= 0) & (line[1:] >= 0))


def tile_counts(lines: DataFrame, edges: dict[str, np.ndarray]) -> DataFrame:
    """``lang, tile, chunk, counts``: what each chunk counted in each tile, packed."""
    ship(lines.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                line = _unpack(batch.column(2)[i].as_py(), np.int32)
                at = _neighbours(line)
                if not len(at):
                    continue
                lang = batch.column(1)[i].as_py()
                first = edges[lang]
                left, right = line[at].astype(np.int64), line[at + 1].astype(np.int64)
                tile = (np.searchsorted(first, left, "right") - 1) * len(first) + np.searchsorted(first, right, "right") - 1
                order = np.argsort(tile.astype(np.int16) if len(first) < 181 else tile, kind="stable")
                tile, left, right = tile[order], left[order], right[order]
                ends = np.flatnonzero(np.concatenate((tile[1:] != tile[:-1], [True]))) + 1
                starts = np.concatenate(([0], ends[:-1]))
                packed = [_pack_counts(*count_tile(left[s:e], right[s:e])) for s, e in zip(starts, ends)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(packed), pa.string()), pa.array(tile[starts]),
                     pa.array([batch.column(0)[i].as_py()] * len(packed), pa.int64()), pa.array(packed, pa.binary())],
                    ["lang", "tile", "chunk", "counts"])
    return lines.select("chunk", "lang", "line").mapInArrow(run, "lang string, tile bigint, chunk bigint, counts binary")


def counted_pairs(counts: DataFrame, least: int) -> DataFrame:
    """The pairs of each tile that occur ``least`` times or more, and those that each chunk has."""
    ship(counts.sparkSession)

    def add(group: pa.Table) -> pa.Table:
        mine = [_unpack_counts(raw) for raw in group.column("counts").to_pylist()]
        keys, n = np.concatenate([k for k, _ in mine]), np.concatenate([c for _, c in mine])
        pairs, f = count_tile(keys >> 32, keys & 0xFFFFFFFF, n)
        pairs, f = pairs[f >= least], f[f >= least]
        held, places = [], []
        for keys, _ in mine:
            both, place, _ = np.intersect1d(pairs, keys, assume_unique=True, return_indices=True)
            held.append(_pack(np.diff(both, prepend=0)))
            places.append(place)
        return _counted(group, pa.array(pairs), f, None, held, places, "pair")
    return counts.groupBy("lang", "tile").applyInArrow(add, _COUNTED.format(entry="pair bigint"))


def pair_lines(lines: DataFrame, counted: DataFrame, known: DataFrame) -> DataFrame:
    """The lines of numbers of frequent pairs."""
    def numbers(line: np.ndarray, answers: pa.Array) -> np.ndarray:
        pair = np.concatenate([np.cumsum(_unpack(raw, np.int64)) for raw in answers.field(0).to_pylist()])
        number = np.concatenate([_unpack(raw, np.int32) for raw in answers.field(1).to_pylist()])
        out = np.full(max(0, len(line) - 1), -1, np.int32)
        at = _neighbours(line)
        if len(pair) and len(at):
            order = np.argsort(pair)
            pair, number = pair[order], number[order]
            mine = line[at].astype(np.int64) << 32 | line[at + 1]
            where = np.minimum(np.searchsorted(pair, mine), len(pair) - 1)
            out[at] = np.where(pair[where] == mine, number[where], -1)
        return out
    return _lines(lines.select("chunk", "lang", "line").join(_answers(counted, known), "chunk"), numbers)


def _phrases(found: DataFrame, shorter: DataFrame) -> DataFrame:
    """Phrases from the numbers of their first and last parts, with the frequencies of all parts."""
    first = shorter.select("lang", F.col("id").alias("i"), F.col("f").alias("first_f"), F.col("phrase").alias("head"), "starts")
    last = shorter.select("lang", F.col("id").alias("j"), F.col("f").alias("last_f"), "last", "rests")
    return (found.select("lang", "id", "f", F.shiftright("pair", 32).alias("i"), F.col("pair").bitwiseAND(0xFFFFFFFF).alias("j"))
            .join(first, ["lang", "i"]).join(last, ["lang", "j"])
            .select("lang", "id", "f", F.concat_ws(" ", "head", "last").alias("phrase"), "last",
                    F.concat("starts", F.array("first_f")).alias("starts"), F.concat(F.array("last_f"), "rests").alias("rests"),
                    "i", "j", "first_f", "last_f"))


def _weakest_cut(a: str, n: str, starts: str, rests: str) -> Column:
    """``score, k, l, r`` of the cut with the smallest score; ties go to the smallest k.

    Products are whole numbers of up to 38 digits, which hold 1000 * a * n for 10^17 words.
    """
    big = "CAST({} AS DECIMAL(38, 0))".format
    return F.expr(f"array_min(transform({starts}, (l, k) -> named_struct("
                  f"'score', ({big(1000)} * {big(a)} * {big(n)}) div ({big('l')} * {big(f'{rests}[k]')}), 'k', k + 1, 'l', l, 'r', {rests}[k])))")


def mine(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """``lang, phrase, a, l, r, n, score``: all phrases of 2 to ``longest`` words that are frequent and not inside one as frequent."""
    letters = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    chunks = cut(word_chunks(docs, letters // BUCKET_BYTES + 1, text, lang))
    counted = cut(counted_words(chunks, least))
    total = counted.where("total IS NOT NULL").groupBy("lang").agg(F.sum("total").alias("total"))
    known = ranked_entries(counted, "word")
    lines = cut(word_lines(chunks, counted, known))
    none = F.array().cast("array<bigint>")
    level = known.select("lang", "id", "f", F.col("word").alias("phrase"), F.col("word").alias("last"),
                         none.alias("starts"), none.alias("rests"))
    kept = []
    for k in range(2, longest + 1):
        counted = cut(counted_pairs(tile_counts(lines, bands(known)), least))
        known = ranked_entries(counted, "pair")
        if k < longest:
            lines = cut(pair_lines(lines, counted, known))
        longer = cut(_phrases(known, level))
        if k > 2:
            inside = (longer.where("f = first_f").select("lang", F.col("i").alias("id"))
                      .unionByName(longer.where("f = last_f").select("lang", F.col("j").alias("id"))))
            kept.append(level.join(inside, ["lang", "id"], "left_anti"))
        level = longer.select("lang", "id", "f", "phrase", "last", "starts", "rests")
    kept.append(level)
    found = kept[0]
    for part in kept[1:]:
        found = found.unionByName(part)
    return (found.join(total, "lang").withColumn("cut", _weakest_cut("f", "total", "starts", "rests"))
            .select("lang", "phrase", F.col("f").alias("a"), F.col("cut.l").alias("l"), F.col("cut.r").alias("r"),
                    F.col("total").alias("n"), F.col("cut.score").alias("score")))


def ranked(found: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language with their ``rank``, best score first, then more frequent, then by code point."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language may hold most rows: each of SPREAD parts keeps its best ones, and these are ranked together.
    part = F.pmod(F.xxhash64("phrase"), F.lit(SPREAD))
    best = (found.withColumn("part", part).withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
            .where(F.col("place") <= top).drop("part", "place"))
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= top)
