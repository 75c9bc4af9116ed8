"""Near-duplicate documents by b-bit MinHash, with exact confirmation.

1. Every document gets the set of its distinct word shingles, MinHash minima of it,
   band keys, and a packed signature that keeps only the low bits of the minima.
2. Equal sets are folded to their smallest id, in a map-side aggregate.
3. Sets that share a band key are candidates.  A crowd of n candidates is not
   expanded into pairs: each band bucket has a hub (the member that meets most others), and
   members are compared with hubs only.  Equal low bits, corrected for
   chance, estimate the similarity and drop hopeless comparisons; the others are confirmed on
   the full sets.
4. Where a hub's members are still in different classes, they are compared with each
   other in cells of bounded size: a crowd is dealt into blocks, a cell holds two
   blocks of full sets, and only links that join two classes leave it.
5. Components of all links give every document its class.

With 20 bands of 4 minima a pair at the threshold 0.85 is missed with probability
4e-7, one at 0.8 with 3e-5; nothing else is approximate, and no bucket, crowd or candidate is capped.

Defined cases: A-Z are lower-cased; words are separated by blanks; with
fewer words than ``width`` the whole sequence is the one shingle; null, empty and blank texts
have an empty set and are linked with nothing, not even each other; null ids are
linked with nothing and keep a null component; rows with one id count as one
document; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from weftline.llm.crowds import classes, comparable, lists, stars
from weftline.llm.shingles import MinHash, WordHashes, shingle_set
from weftline.llm.text import mix64, utf8_rows
from weftline.session import cut, ship

BANDS, ROWS, BITS = 20, 4, 4
LANES = BANDS * ROWS
WORDS64 = LANES * BITS // 64
# Signatures are ruled out at an estimate six deviations below the threshold.
SLACK = 0.25
_SECOND = np.uint64(0xD6E8FEB86659FD93)
_LOW_BITS = 0x1111111111111111


def _packed(minima: np.ndarray) -> np.ndarray:
    """Low ``BITS`` of each lane, packed into 64-bit words."""
    low = (mix64(minima) & np.uint64((1 << BITS) - 1)).reshape(WORDS64, -1)
    shifts = np.arange(low.shape[1], dtype=np.uint64) * np.uint64(BITS)
    return np.bitwise_or.reduce(low << shifts, axis=1)


def _bands(minima: np.ndarray) -> np.ndarray:
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in minima.reshape(BANDS, ROWS).T:
        keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + column)
    return keys


def sketches(docs: DataFrame, id_col: str, text: str, width: int = 5) -> DataFrame:
    """``id, n, k1, k2, bands, s0..``: set size, set digest, band keys and packed signature."""
    ship(docs.sparkSession)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, hasher = WordHashes(), MinHash(LANES)
        for batch in batches:
            n, k1, k2, bands, sigs = [], [], [], [], []
            for raw in utf8_rows(batch.column(1)):
                items = shingle_set(words.of(raw), width)
                n.append(len(items))
                k1.append(mix64(items).sum(dtype=np.uint64))
                k2.append(mix64(items ^ _SECOND).sum(dtype=np.uint64))
                minima = hasher.minima(items)
                bands.append(_bands(minima) if len(items) else items)
                sigs.append(_packed(minima))
            packed = np.array(sigs, np.uint64).reshape(-1, WORDS64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(np.array(k1, np.uint64).view(np.int64)),
                 pa.array(np.array(k2, np.uint64).view(np.int64)), lists(bands),
                 *[pa.array(np.ascontiguousarray(packed[:, i])) for i in range(WORDS64)]],
                ["id", "n", "k1", "k2", "bands", *[f"s{i}" for i in range(WORDS64)]])
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text).alias("text")).mapInArrow(
        run, "id bigint, n bigint, k1 bigint, k2 bigint, bands array<bigint>, "
        + ", ".join(f"s{i} bigint" for i in range(WORDS64)))


def full_sets(docs: DataFrame, id_col: str, text: str, width: int = 5) -> DataFrame:
    """``id, items``: the full shingle sets."""
    ship(docs.sparkSession)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            sets = [shingle_set(words.of(raw), width) for raw in utf8_rows(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), lists(sets)], ["id", "items"])
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text).alias("text")).mapInArrow(
        run, "id bigint, items array<bigint>")


def estimate(left: str, right: str) -> Column:
    """Similarity from equal low bits, corrected for lanes that agree by chance."""
    differ = F.lit(0)
    for i in range(WORDS64):
        x = F.col(f"{left}.s{i}").bitwiseXOR(F.col(f"{right}.s{i}"))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        differ = differ + F.bit_count(x.bitwiseAND(F.lit(_LOW_BITS)))
    chance = 1.0 / (1 << BITS)
    return ((F.lit(1.0) - differ / F.lit(float(LANES))) - chance) / (1.0 - chance)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = 85,
                    width: int = 5) -> DataFrame:
    """``id, n_shingles, component``: the smallest id reachable over links of at least ``percent``."""
    sketched = cut(sketches(docs, id_col, text, width))
    packed = [f"s{i}" for i in range(WORDS64)]
    folded = cut(sketched.where("n > 0 AND id IS NOT NULL").groupBy("k1", "k2", "n")
                 .agg(F.min(F.struct("id", "bands", *packed)).alias("rep"))
                 .select("k1", "k2", "n", "rep.*"))
    met = cut(stars(folded))
    a = folded.select("id", *packed).alias("a")
    b = folded.select(F.col("id").alias("hub"), *packed).alias("b")
    pairs = cut(comparable(met, folded.select("id", "n"), percent).join(a, "id").join(b, "hub")
                .where(estimate("a", "b") >= percent / 100 - SLACK).select("hub", "id"))
    sets = cut(full_sets(docs.join(met.select(F.col("id").alias(id_col)).distinct(), id_col, "left_semi"),
                         id_col, text, width).dropDuplicates(["id"]))
    found = classes(folded, met, pairs, sets, percent)
    by_set = cut(folded.select("k1", "k2", "n", "id").join(found, "id").drop("id"))
    # The ids of folded copies: each document finds the class of its set.
    return sketched.select("id", "n", "k1", "k2").join(by_set, ["k1", "k2", "n"], "left").select(
        "id", F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"))
