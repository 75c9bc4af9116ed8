"""N-gram perplexity with a modified Kneser-Ney model counted by Spark.

Symbols are the UTF-8 bytes of a word, between a start and an end mark, so every
language and script is covered and an n-gram packs into a whole number without
collisions.  Every text of the collection is counted, separately per language: tasks count words,
turn the counts into n-gram counts, and Spark adds these up.  Lower orders use the
number of distinct symbols seen before, all orders interpolate, and three discounts per
order and language come from the counts of counts.

The model is a table of sorted hash arrays (per language and order: n-grams with their log
probabilities, contexts with their back-off weights).  Up to ``MOST_ENTRIES`` entries,
counted first, it is sent to the tasks, which look words up by binary search.  A
larger model stays a table: distinct words are scored by joins with it, and documents by
a join with their words.  Both ways give the same perplexities.

A document's log perplexity per byte and per word must lie inside its language's bands:
the median plus and minus a multiple of the quartile distance, over the documents
that pass the base rules.

Defined cases: null language is the language ``""``; texts without words have perplexities
null and fail the base rule; empty tables give an empty result; a language whose
documents all fail has no band and rejects nothing further; repeated rows count as often
as they occur; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weftline.llm.shingles import WordHashes, windows
from weftline.llm.text import utf8_rows
from weftline.session import cut, ship

ORDER = 5
MOST_ENTRIES = 3_000_000
SYMBOLS = 257
FLUSH_WORDS = 400_000
START, END = b"\x00\x00\x00 ", b"\n"
LOWER, UPPER = 4.0, 4.0

_BLANK = b" \t\n\x0b\x0c\r"
_MARKS = b"#*$%&|<>"


def _keys(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams that predict each byte and the end of each word, and their number per word."""
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    text = np.frombuffer(b"".join(START + w + END for w in words), np.uint8).astype(np.int64)
    key = text[:len(text) - ORDER + 1].copy()
    for i in range(1, ORDER):
        key = (key << 8) | text[i:len(text) - ORDER + 1 + i]
    # A word of m bytes takes m + ORDER symbols; only its first m + 1 windows lie inside.
    ends = np.cumsum(size + ORDER - 1)
    inside = np.ones(len(text), bool)
    for i in range(1, ORDER):
        inside[ends - i] = False
    return key[inside[:len(key)]], size


def _counted(words: Counter) -> tuple[np.ndarray, np.ndarray]:
    keys, size = _keys(list(words))
    weight = np.repeat(np.fromiter(words.values(), np.int64, len(words)), size)
    order = np.argsort(keys, kind="stable")
    keys, weight = keys[order], weight[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(weight, first)


def count_ngrams(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, key, c`` over all texts."""
    ship(docs.sparkSession)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for name, words in held.items():
                if words:
                    keys, counts = _counted(words)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(keys), pa.string()), pa.array(keys), pa.array(counts)],
                                                     ["lang", "key", "c"])
            held.clear()
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), utf8_rows(batch.column(1))):
                if raw:
                    held.setdefault(name, Counter()).update(raw.split())
                    if sum(map(len, held.values())) > FLUSH_WORDS:
                        yield from flush()
        yield from flush()
    return (docs.select(F.coalesce(F.col(lang), F.lit("")).alias("lang"), F.col(text).alias("text"))
            .mapInArrow(run, "lang string, key bigint, c bigint")
            .groupBy("lang", "key").agg(F.sum("c").alias("c")))


def _discounts(counts: DataFrame) -> DataFrame:
    """``lang, d1, d2, d3`` from the counts of counts."""
    n = counts.groupBy("lang").agg(*[F.sum(F.when(F.col("c") == i, 1.0).otherwise(0.0)).alias(f"n{i}") for i in range(1, 5)])
    share = F.try_divide("n1", F.col("n1") + 2 * F.col("n2"))

    def discount(i: int) -> F.Column:
        value = i - (i + 1) * share * F.try_divide(f"n{i + 1}", f"n{i}")
        # Too few counts for the estimate: half of the count.
        good = (F.col(f"n{i}") > 0) & (F.col("n1") > 0)
        return F.when(good & value.between(0.0, float(i)), value).otherwise(i / 2.0)
    return n.select("lang", *[discount(i).alias(f"d{i}") for i in (1, 2, 3)])


def build_model(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, kind, key, value``: kind k > 0 holds log probabilities of k-grams, kind -k
    the log back-off weights of contexts of k - 1 symbols."""
    counts = {ORDER: cut(count_ngrams(docs, text, lang))}
    for k in range(ORDER - 1, 0, -1):
        mask = (1 << (8 * k)) - 1
        counts[k] = cut(counts[k + 1].groupBy("lang", F.col("key").bitwiseAND(F.lit(mask)).alias("key"))
                        .agg(F.count(F.lit(1)).alias("c")))
    parts, lower = [], None
    for k in range(1, ORDER + 1):
        taken = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        rows = (counts[k].join(_discounts(counts[k]), "lang").withColumn("taken", taken)
                .select("lang", "key", "c", "taken", F.shiftright("key", 8).alias("context")))
        contexts = rows.groupBy("lang", "context").agg(F.sum("c").alias("total"), F.sum("taken").alias("freed"))
        rows = rows.join(contexts, ["lang", "context"])
        if lower is None:
            below = F.lit(1.0 / SYMBOLS)
        else:
            mask = (1 << (8 * (k - 1))) - 1
            rows = (rows.withColumn("suffix", F.col("key").bitwiseAND(F.lit(mask)))
                    .join(lower.select("lang", F.col("key").alias("suffix"), F.exp("value").alias("below")), ["lang", "suffix"]))
            below = F.col("below")
        value = F.log((F.col("c") - F.col("taken") + F.col("freed") * below) / F.col("total"))
        lower = cut(rows.select("lang", F.lit(k).alias("kind"), "key", value.alias("value")))
        parts += [lower, contexts.select("lang", F.lit(-k).alias("kind"), F.col("context").alias("key"),
                                         F.log(F.col("freed") / F.col("total")).alias("value"))]
    model = parts[0]
    for part in parts[1:]:
        model = model.unionByName(part)
    return cut(model)


@dataclass
class Arrays:
    """Sorted keys and values of one language, by kind."""

    kinds: dict[int, tuple[np.ndarray, np.ndarray]]

    def _find(self, kind: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        known, values = self.kinds.get(kind, (np.empty(0, np.int64), np.empty(0)))
        if not len(known):
            return np.zeros(len(keys), bool), np.zeros(len(keys))
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return known[at] == keys, values[at]

    def log_probabilities(self, keys: np.ndarray) -> np.ndarray:
        out, weight = np.zeros(len(keys)), np.zeros(len(keys))
        left = np.arange(len(keys))
        for k in range(ORDER, 0, -1):
            gram = keys[left] & ((1 << (8 * k)) - 1)
            found, value = self._find(k, gram)
            out[left[found]] = weight[left[found]] + value[found]
            left, gram = left[~found], gram[~found]
            known, value = self._find(-k, gram >> 8)
            weight[left] += np.where(known, value, 0.0)
        out[left] = weight[left] - np.log(SYMBOLS)
        return out


def collect_arrays(model: DataFrame) -> dict[str, Arrays]:
    """The model on the driver; the caller has checked its size."""
    table = model.toArrow()
    lang, kind = table.column("lang").combine_chunks().dictionary_encode(), table.column("kind").to_numpy()
    key, value = table.column("key").to_numpy(), table.column("value").to_numpy()
    code = lang.indices.to_numpy()
    out = {}
    for i, name in enumerate(lang.dictionary.to_pylist()):
        kinds = {}
        for k in [*range(1, ORDER + 1), *range(-ORDER, 0)]:
            mine = (code == i) & (kind == k)
            order = np.argsort(key[mine])
            kinds[k] = key[mine][order], value[mine][order]
        out[name] = Arrays(kinds)
    return out


class WordScores(dict):
    """Log probability of a word, remembered for short words."""

    MOST = 1 << 19

    def __init__(self, arrays: Arrays):
        super().__init__()
        self.arrays = arrays

    def total(self, words: list[bytes]) -> float:
        new = list({w for w in words if w not in self})
        if new:
            if len(self) + len(new) > self.MOST:
                self.clear()
                new = list(set(words))
            keys, size = _keys(new)
            sums = np.add.reduceat(self.arrays.log_probabilities(keys), np.cumsum(size) - size)
            self.update(zip(new, sums.tolist()))
        return sum(map(self.__getitem__, words))


def base_counts(words: WordHashes, raw: bytes | None) -> tuple[list[bytes], int, int, int, int]:
    """Words, characters in words, symbols, repeated lines, words in repeated windows."""
    if not raw:
        return [], 0, 0, 0, 0
    found = raw.split()
    chars = len(raw.translate(None, _BLANK).decode("utf-8", "surrogatepass"))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    repeats = 0
    if len(found) >= 3:
        grams = windows(words.each(found), 3)
        _, inverse, times = np.unique(grams, return_inverse=True, return_counts=True)
        twice = times[inverse] > 1
        covered = np.zeros(len(found), bool)
        for i in range(3):
            covered[i:i + len(twice)] |= twice
        repeats = int(covered.sum())
    return found, chars, len(raw) - len(raw.translate(None, _MARKS)), len(lines) - len(set(lines)), repeats


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_BASE = ", ".join(f"{c} bigint" for c in _COUNTS)


def _measure(docs: DataFrame, id_col: str, text: str, lang: str, arrays: dict[str, Arrays] | None) -> DataFrame:
    """Base counts of every whole text, and its log perplexity where the model is at hand."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(arrays) if arrays is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        scores = {name: WordScores(a) for name, a in shared.value.items()} if shared else {}
        for batch in batches:
            rows, values, symbols = [], [], []
            for name, raw in zip(batch.column(1).to_pylist(), utf8_rows(batch.column(2))):
                found, *rest = base_counts(hashes, raw)
                rows.append((len(found), *rest))
                values.append(-scores[name].total(found) if found and shared else None)
                symbols.append(sum(map(len, found)) + len(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(1), *[pa.array([r[i] for r in rows], pa.int64()) for i in range(5)],
                 pa.array(symbols, pa.int64()), pa.array(values, pa.float64())],
                ["id", "lang", *_COUNTS, "symbols", "surprise"])
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(lang), F.lit("")).alias("lang"),
                       F.col(text).alias("text")).mapInArrow(
        run, f"id bigint, lang string, {_BASE}, symbols bigint, surprise double")


def joined_surprise(docs: DataFrame, model: DataFrame, text: str, lang: str) -> DataFrame:
    """``row, surprise`` by joins, for a model too large to send; ``docs`` has a column ``row``."""
    ship(docs.sparkSession)
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, name, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8_rows(batch.column(2))):
                counts = Counter((raw or b"").split())
                n = len(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row] * n, pa.int64()), pa.array([name] * n, pa.string()), pa.array(list(counts), pa.binary()),
                     pa.array(list(counts.values()), pa.int64())], ["row", "lang", "word", "n"])

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, size = _keys(batch.column(1).to_pylist()) if len(batch) else (np.empty(0, np.int64), np.empty(0, np.int64))
            pick = pa.array(np.repeat(np.arange(len(size)), size))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pick), batch.column(1).take(pick), pa.array(keys)],
                                             ["lang", "word", "key"])
    held = cut(docs.select("row", F.coalesce(F.col(lang), F.lit("")).alias("lang"), F.col(text).alias("text"))
               .mapInArrow(words, "row bigint, lang string, word binary, n bigint"))
    parts = cut(held.select("lang", "word").distinct().mapInArrow(grams, "lang string, word binary, key bigint"))
    # Distinct n-grams, each resolved once: the longest order found, and the weights above it.
    todo = parts.select("lang", "key").distinct().withColumn("weight", F.lit(0.0)).withColumn("value", F.lit(None).cast("double"))
    for k in range(ORDER, 0, -1):
        gram = F.col("key").bitwiseAND(F.lit((1 << (8 * k)) - 1))
        found = model.where(F.col("kind") == k).select("lang", F.col("key").alias("gram"), F.col("value").alias("found"))
        back = model.where(F.col("kind") == -k).select("lang", F.col("key").alias("context"), F.col("value").alias("back"))
        todo = (todo.withColumn("gram", gram).withColumn("context", F.shiftright("gram", 8))
                .join(found, ["lang", "gram"], "left").join(back, ["lang", "context"], "left")
                .select("lang", "key", F.coalesce("value", F.col("weight") + F.col("found")).alias("value"),
                        F.when(F.col("value").isNull() & F.col("found").isNull(), F.col("weight") + F.coalesce("back", F.lit(0.0)))
                        .otherwise(F.col("weight")).alias("weight")))
    values = todo.select("lang", "key", F.coalesce("value", F.col("weight") - float(np.log(SYMBOLS))).alias("value"))
    scored = parts.join(values, ["lang", "key"]).groupBy("lang", "word").agg(F.sum("value").alias("value"))
    return held.join(scored, ["lang", "word"]).groupBy("row").agg((-F.sum(F.col("n") * F.col("value"))).alias("surprise"))


def measure(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
            most_entries: int = MOST_ENTRIES) -> DataFrame:
    """``id, lang``, base counts and log perplexities of every document."""
    model = build_model(docs, text, lang)
    if model.count() <= most_entries:
        out = _measure(docs, id_col, text, lang, collect_arrays(model))
    else:
        numbered = cut(docs.select(id_col, text, lang).withColumn("row", F.monotonically_increasing_id()))
        # The row number stands in for the id, which is joined back.
        counted = _measure(numbered.select("row", text, lang), "row", text, lang, None).drop("surprise").withColumnRenamed("id", "row")
        ids = numbered.select("row", F.col(id_col).cast("bigint").alias("id"))
        out = counted.join(joined_surprise(numbered, model, text, lang), "row", "left").join(ids, "row").drop("row")
    return out.select("id", "lang", *_COUNTS, F.try_divide("surprise", "symbols").alias("per_byte"),
                      F.try_divide("surprise", "n_words").alias("per_word"))


def judge(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
          most_entries: int = MOST_ENTRIES, lower: float = LOWER, upper: float = UPPER) -> DataFrame:
    """The measures with ``base_failed``, the language's bands and ``kept``."""
    measured = cut(measure(docs, id_col, text, lang, most_entries)
                   .withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))))
    kinds = ("per_byte", "per_word")
    quarters = measured.where(~F.col("base_failed")).groupBy("lang").agg(
        *[F.percentile_approx(k, [0.25, 0.5, 0.75], 10_000).alias(k) for k in kinds])
    ends = []
    for k in kinds:
        q = F.col(k)
        # A quartile lies 0.6745 deviations from the median of a normal distribution.
        ends += [(q[1] - (q[1] - q[0]) / 0.6745 * lower).alias(f"{k}_low"), (q[1] + (q[2] - q[1]) / 0.6745 * upper).alias(f"{k}_high")]
    inside = F.lit(True)
    for k in kinds:
        inside = inside & F.coalesce(F.col(k).between(F.col(f"{k}_low"), F.col(f"{k}_high")), F.lit(True))
    return measured.join(quarters.select("lang", *ends), "lang", "left").withColumn("kept", ~F.col("base_failed") & inside)
