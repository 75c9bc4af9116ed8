"""Quality by compression with dictionaries of good and of bad labelled text.

A bounded sample of labelled documents is dealt into two halves.  From one, a zstandard
dictionary is trained for either class.  Every text is cut into blocks of whole
UTF-8 bytes (a dictionary helps little once a compressor has seen a few kilobytes),
each block is compressed with both dictionaries, and the sizes are added up.  The
difference of the sums, divided by the sum of both, says which dictionary explains the text
better; so does the size against the plain length for text that repeats itself.  A
logistic curve on these two numbers, fitted on the other half, gives the score.

Language, source and ids are never inputs of a score.

Defined cases: null and empty texts have difference 0 and the prior odds as their score;
without labelled rows of both classes the score is the share of good rows (0.5
without rows); a null id is scored and counts as not held out; an empty table
gives an empty result; columns named like an output are replaced.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from weftline.llm.labelled import fold, sample
from weftline.llm.text import utf8_rows
from weftline.session import ship

# Documented bounds: labelled rows read, bytes of text used per class, size of a dictionary.
SAMPLE_ROWS = 6_000
TRAIN_BYTES = 6_000_000
DICTIONARY_BYTES = 48 * 1024
BLOCK = 2048
LEVEL = 3


@dataclass
class Model:
    good: bytes = b""
    bad: bytes = b""
    weights: tuple[float, ...] = ()
    prior: float = 0.5


def blocks_of(raw: bytes) -> list[bytes]:
    return [raw[at:at + BLOCK] for at in range(0, len(raw), BLOCK)]


class Sizes:
    """Compressed sizes of whole texts under both dictionaries."""

    def __init__(self, model: Model):
        def packer(data: bytes) -> zstandard.ZstdCompressor:
            known = zstandard.ZstdCompressionDict(data)
            known.precompute_compress(level=LEVEL)
            return zstandard.ZstdCompressor(dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False)
        self.good, self.bad = packer(model.good), packer(model.bad)

    def measures(self, raw: bytes | None) -> tuple[float, float]:
        """Normalised size difference, and log share of the plain length."""
        if not raw:
            return 0.0, 0.0
        good = bad = 0
        for block in blocks_of(raw):
            good += len(self.good.compress(block))
            bad += len(self.bad.compress(block))
        return (bad - good) / (bad + good), float(np.log((good + bad) / (2 * len(raw))))


def _dictionary(texts: list[bytes]) -> bytes:
    """A dictionary of whole blocks, drawn in random order up to the bound."""
    blocks = [b for t in texts for b in blocks_of(t) if len(b) >= 64]
    random.Random(7).shuffle(blocks)
    total, used = 0, []
    for block in blocks:
        total += len(block)
        if total > TRAIN_BYTES:
            break
        used.append(block)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, used).as_bytes()
    except zstandard.ZstdError:
        # Too few samples to train on: the text itself serves as a dictionary.
        return b"".join(used)[:DICTIONARY_BYTES]


def _expand(x: np.ndarray) -> np.ndarray:
    """Measures with their squares: text may be bad for being odd in either direction."""
    return np.column_stack([np.ones(len(x)), x, x ** 2])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 60) -> np.ndarray:
    """Newton steps for a small logistic regression."""
    w = np.zeros(x.shape[1])
    penalty = ridge * np.diag([0.0] + [1.0] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(x @ w).clip(-50, 50)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x / len(y) + penalty + 1e-9 * np.eye(len(w)),
                               x.T @ (p - y) / len(y) + penalty @ w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, seen: Column, label: str = "quality", id_col: str = "doc_id",
        text: str = "text", rows: int = SAMPLE_ROWS, most_bytes: int = 1 << 20) -> Model:
    """Dictionaries from one half of the labelled sample, the curve from the other.

    Sampled texts over ``most_bytes`` are left out of fitting (not of scoring), so the
    sample has a bound in bytes as well.
    """
    labelled = sample(docs, labels, label, seen, rows, id_col, text).where(F.octet_length("text") <= most_bytes)
    half = labelled.withColumn("train", F.pmod(F.xxhash64(F.lit(9), "id"), F.lit(2)) == 0)
    budget = 2 * TRAIN_BYTES
    # A fixed number of bytes for the driver: rows in hash order, each class up to the budget.
    rows_ = half.where("train AND text IS NOT NULL").select("id", "y", "text", F.xxhash64("id").alias("h"))
    good, bad = (_texts(rows_.where(F.col("y") == y), budget) for y in (1, 0))
    share = labelled.agg(F.avg("y")).first()[0]
    prior = 0.5 if share is None else float(np.clip(share, 0.01, 0.99))
    if not good or not bad:
        return Model(prior=prior)
    model = Model(_dictionary(good), _dictionary(bad), prior=prior)
    measured = _measure(half.where("NOT train").select("id", "text", "y"), model).toPandas().sort_values("id")
    if measured["y"].nunique() < 2:
        return Model(prior=prior)
    x = measured[["difference", "density"]].to_numpy()
    scale = x.std(axis=0) + 1e-9
    w = _logistic(_expand((x - x.mean(axis=0)) / scale), measured["y"].to_numpy(np.float64))
    model.weights = (*x.mean(axis=0), *scale, *w)
    return model


def _texts(rows: DataFrame, budget: int) -> list[bytes]:
    out, total = [], 0
    for r in rows.orderBy("h").select("text").toLocalIterator():
        raw = r.text.encode("utf-8", "surrogatepass")
        total += len(raw)
        if total > budget and out:
            break
        out.append(raw)
    return out


def _measure(df: DataFrame, model: Model) -> DataFrame:
    ship(df.sparkSession)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(model)
        for batch in batches:
            got = np.array([sizes.measures(raw) for raw in utf8_rows(batch.column(1))], np.float64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(2).cast(pa.int32()), pa.array(got[:, 0]),
                                              pa.array(got[:, 1])], ["id", "y", "difference", "density"])
    return df.mapInArrow(run, "id bigint, y int, difference double, density double")


def scores_of(model: Model, measures: np.ndarray) -> np.ndarray:
    if not model.weights:
        return np.full(len(measures), model.prior)
    mean, scale, w = np.array(model.weights[:2]), np.array(model.weights[2:4]), np.array(model.weights[4:])
    z = _expand(((measures - mean) / scale).clip(-20, 20)) @ w
    out = 1 / (1 + np.exp(-z.clip(-50, 50)))
    out[(measures == 0).all(axis=1)] = model.prior
    return out


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``difference`` and ``score`` of every whole text."""
    ship(docs.sparkSession)
    new = ("difference", "score")
    kept = [f for f in docs.schema.fields if f.name not in new]
    narrow = docs.select([f.name for f in kept])
    place = narrow.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(model) if model.weights else None
        for batch in batches:
            got = np.array([sizes.measures(raw) if sizes else (0.0, 0.0) for raw in utf8_rows(batch.column(place))],
                           np.float64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got[:, 0]), pa.array(scores_of(model, got))],
                                             [*batch.schema.names, *new])
    return narrow.mapInArrow(run, StructType([*kept, *[StructField(n, DoubleType()) for n in new]]))


def held_out(id_col: str = "doc_id", folds: int = 3, left_out: int = 1) -> Column:
    return fold(F.col(id_col), folds) == left_out
