"""Toxicity by weak supervision.

1. *Voters.*  Lexicons of words, word beginnings and word ends are mined from a bounded sample of
   labelled documents (features that occur in toxic documents far too often to be
   chance).  Word lexicons, one voter per beginning and ending length, a fixed word list and
   patterns make ``VOTERS`` voters, each of which fires or stays silent.
2. *Label model.*  The voters run over all documents and Spark counts the vote patterns (at
   most 2^VOTERS rows).  A voter that stays silent abstains (a lexicon of one language says nothing about
   another); only when all are silent, that counts as a vote for the clean class.
   Expectation-maximisation over the counts estimates the prior and each voter's rates of firing in either
   class; correlations left between voters within the classes discount voters that
   repeat each other.  The posterior is the training label.
3. *Classifier.*  A logistic model on binary word, beginning and ending features is fitted to the
   posteriors of the labelled sample; it scores every whole text.

True labels only choose the lexicons.  Language, source and ids are never inputs of a score.

Defined cases: null, empty and blank texts have no features and get the score of the intercept;
without labelled rows of both classes no lexicon is mined and the fixed voters alone
decide; rows with one id are scored one by one; a null id is scored and counts as held out; an
empty table gives an empty result; columns named like an output are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from weftline.llm.labelled import fold, sample
from weftline.session import ship

# Documented bounds: labelled rows read, and features kept.
SAMPLE_ROWS = 16_000
MOST_FEATURES = 8_192
HEADS, TAILS, GROUPS = (4, 5, 6), (4, 5), 6
VOTERS = GROUPS + len(HEADS) + len(TAILS) + 3
_SILENT = VOTERS  # one more vote, for the clean class, cast when no voter fires
EVIDENCE, WEAK_EVIDENCE = 20.0, 6.0

# Common English insults, and letters written as signs.
INSULTS = ("idiot", "moron", "stupid", "dumb", "loser", "scum", "trash", "pathetic", "worthless", "disgusting", "clown",
           "imbecile", "fool", "jerk", "bastard", "bitch", "shit", "fuck", "fucking", "asshole", "retard", "whore", "slut")
_SIGNS = str.maketrans({"@": "a", "4": "a", "3": "e", "1": "i", "!": "i", "0": "o", "$": "s", "5": "s", "7": "t"})
_EDGES = ".,;:!?\"'()[]{}<>*#$%&|~`^_-+=/\\«»“”‘’…¡¿"
_AIMED = re.compile(r"\b(?:you|your|you're|u)\b[^.!?\n]{0,40}\b(?:" + "|".join(INSULTS) + r")s?\b", re.I)


def features_of(word: str) -> list[str]:
    """The word itself, its beginnings and its ends."""
    out = ["=" + word]
    out += [f"{k}<" + word[:k] for k in HEADS if len(word) >= k]
    out += [f"{k}>" + word[-k:] for k in TAILS if len(word) >= k]
    return out


def words_of(text: str | None) -> set[str]:
    if not text:
        return set()
    found = {w.strip(_EDGES) for w in text.lower().split()}
    found.discard("")
    return found


@dataclass
class Model:
    #: Feature to its number; weights and the voters that a feature makes fire.
    number: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    intercept: float = -4.0
    votes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    prior: float = 0.1
    rates: np.ndarray = field(default_factory=lambda: np.full((2, VOTERS + 1), 0.5))
    discount: np.ndarray = field(default_factory=lambda: np.ones(VOTERS + 1))


class _Known(dict):
    """Numbers of the known features of a word."""

    MOST = 1 << 20

    def __init__(self, number: dict[str, int]):
        super().__init__()
        self.number = number

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= self.MOST:
            self.clear()
        value = self[word] = tuple(self.number[f] for f in features_of(word) if f in self.number)
        return value

    def of(self, words: set[str]) -> list[int]:
        found: set[int] = set()
        for word in words:
            if hit := self[word]:
                found.update(hit)
        return sorted(found)


def fixed_votes(text: str | None, words: set[str]) -> int:
    """Bits of the voters that need no mined lexicon."""
    first = GROUPS + len(HEADS) + len(TAILS)
    bits = 0
    if any(w in words for w in INSULTS):
        bits |= 1 << first
    if any(w.translate(_SIGNS) in INSULTS for w in words if len(w) < 12 and not w.isalpha()):
        bits |= 1 << (first + 1)
    if text and _AIMED.search(text):
        bits |= 1 << (first + 2)
    return bits


def mined(labelled: DataFrame) -> tuple[list[tuple[str, int, int, float]], int, int]:
    """Features with some evidence, strongest first, and the class sizes."""
    ship(labelled.sparkSession)
    sizes = dict(labelled.groupBy("y").count().collect())
    n_pos, n_neg = sizes.get(1, 0), sizes.get(0, 0)
    if not n_pos or not n_neg:
        return [], n_pos, n_neg

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = Counter(), Counter()
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[y].update({f for w in words_of(text) for f in features_of(w)})
            names = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([counts[1][f] for f in names], pa.int64()),
                 pa.array([counts[0][f] for f in names], pa.int64())], ["feature", "pos", "neg"])

    base = n_pos / (n_pos + n_neg)
    n = F.col("pos") + F.col("neg")
    ratio = 2 * (F.when(F.col("pos") > 0, F.col("pos") * F.log(F.col("pos") / (n * base))).otherwise(0.0)
                 + F.when(F.col("neg") > 0, F.col("neg") * F.log(F.col("neg") / (n * (1 - base)))).otherwise(0.0))
    strong = (labelled.select("text", "y").mapInArrow(count, "feature string, pos bigint, neg bigint")
              .groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
              .where(n >= 4).withColumn("ratio", ratio).where(F.col("ratio") >= WEAK_EVIDENCE)
              .orderBy(F.desc("ratio"), "feature").limit(MOST_FEATURES))
    signed = [(r.feature, r.pos, r.neg, r.ratio if r.pos > (r.pos + r.neg) * base else -r.ratio) for r in strong.collect()]
    return signed, n_pos, n_neg


def lexicon_votes(features: list[tuple[str, int, int, float]]) -> np.ndarray:
    """Bits of the voters that each mined feature makes fire."""
    out = np.zeros(len(features), np.int64)
    for i, (name, pos, neg, ratio) in enumerate(features):
        if ratio < EVIDENCE or pos < 4 * neg:
            continue
        if name[0] == "=":
            voter = sum(name.encode()) % GROUPS
        elif name[1] == "<":
            voter = GROUPS + HEADS.index(int(name[0]))
        else:
            voter = GROUPS + len(HEADS) + TAILS.index(int(name[0]))
        out[i] = 1 << voter
    return out


def _vote(model: Model, known: _Known, text: str | None) -> tuple[int, list[int]]:
    words = words_of(text)
    numbers = known.of(words)
    bits = int(np.bitwise_or.reduce(model.votes[numbers])) if numbers else 0
    return bits | fixed_votes(text, words), numbers


def vote_patterns(docs: DataFrame, model: Model, text: str = "text") -> list[tuple[int, int]]:
    """(pattern, documents) over all documents: at most 2^VOTERS rows."""
    ship(docs.sparkSession)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(model.number)
        for batch in batches:
            counts = Counter(_vote(model, known, t)[0] for t in batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())],
                                             ["pattern", "n"])
    rows = (docs.select(F.col(text).alias("text")).mapInArrow(run, "pattern bigint, n bigint")
            .groupBy("pattern").agg(F.sum("n").alias("n")).collect())
    return [(r.pattern, r.n) for r in rows]


def _bits(patterns: np.ndarray) -> np.ndarray:
    """Votes as columns; the last one is cast when all others are silent."""
    fired = ((patterns[:, None] >> np.arange(VOTERS)) & 1).astype(np.float64)
    return np.hstack([fired, (patterns == 0)[:, None].astype(np.float64)])


def posterior(model: Model, patterns: np.ndarray) -> np.ndarray:
    """Probability of the toxic class for vote patterns."""
    gain = (np.log(model.rates[1]) - np.log(model.rates[0])) * model.discount
    return 1 / (1 + np.exp(-(np.log(model.prior / (1 - model.prior)) + _bits(patterns) @ gain).clip(-500, 500)))


def fit_label_model(model: Model, counts: list[tuple[int, int]], rounds: int = 200) -> None:
    """Prior, firing rates and correlation discounts from unlabelled vote patterns."""
    patterns = np.array(sorted(p for p, _ in counts), np.int64)
    by_pattern = dict(counts)
    n = np.array([by_pattern[p] for p in patterns.tolist()], np.float64)
    fired = _bits(patterns)
    start = np.array([[0.05] * VOTERS + [0.8], [0.5] * VOTERS + [0.05]])
    model.rates = start
    for _ in range(rounds):
        toxic = posterior(model, patterns) * n
        weight = np.stack([n - toxic, toxic])
        # One added document per class keeps the rates inside (0, 1).
        rates = np.clip((weight @ fired + start) / (weight.sum(axis=1, keepdims=True) + 1), 1e-4, 1 - 1e-4)
        model.prior = float(np.clip(weight[1].sum() / n.sum(), 1e-3, 0.5)) if n.sum() else 0.1
        shared = np.zeros((VOTERS, VOTERS))
        for w, r in zip(weight, rates[:, :VOTERS]):
            centred = fired[:, :VOTERS] - r
            spread = np.sqrt(r * (1 - r))
            shared += (centred * w[:, None]).T @ centred / (spread[:, None] * spread[None, :])
        shared /= max(1.0, n.sum())
        np.fill_diagonal(shared, 0)
        moved = np.abs(rates - model.rates).max()
        model.rates = rates
        model.discount = np.append(1 / (1 + np.clip(shared, 0, 1).sum(axis=1)), 1.0)
        if moved < 1e-6:
            break


def _fit_weights(rows: list[list[int]], target: np.ndarray, size: int, ridge: float = 2e-3,
                 steps: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on binary features by accelerated gradient steps."""
    flat = np.fromiter((i for r in rows for i in r), np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    most = max([len(r) for r in rows], default=0) + 1
    # Classes weigh the same, so a rare class is not drowned.
    share = float(np.clip(target.mean(), 1e-3, 1 - 1e-3))
    weight = target / share + (1 - target) / (1 - share)
    weight /= weight.sum()
    w, b = np.zeros(size), 0.0
    vw, vb, step = w.copy(), b, 4.0 / (0.25 * most)
    for t in range(1, steps + 1):
        z = np.bincount(owner, vw[flat], len(rows)) + vb
        err = weight * (1 / (1 + np.exp(-z.clip(-50, 50))) - target)
        gw = np.bincount(flat, err[owner], size) + ridge * vw / max(1, most)
        nw, nb = vw - step * gw, vb - step * err.sum()
        k = (t - 1) / (t + 2)
        vw, vb = nw + k * (nw - w), nb + k * (nb - b)
        w, b = nw, nb
    return w, b


def fit(docs: DataFrame, labels: DataFrame, seen: Column, label: str = "toxic", id_col: str = "doc_id",
        text: str = "text", rows: int = SAMPLE_ROWS) -> Model:
    """Mine lexicons, fit the label model to all documents, fit the classifier to its posteriors."""
    ship(docs.sparkSession)
    labelled = sample(docs, labels, label, seen, rows, id_col, text)
    features, _, _ = mined(labelled)
    model = Model(number={name: i for i, (name, *_) in enumerate(features)}, votes=lexicon_votes(features),
                  weights=np.zeros(len(features)))
    fit_label_model(model, vote_patterns(docs, model, text))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(model.number)
        for batch in batches:
            found = [_vote(model, known, t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([p for p, _ in found], pa.int64()), pa.array([f for _, f in found], pa.list_(pa.int32()))],
                ["id", "pattern", "features"])
    # Bounded: at most ``rows`` rows of at most MOST_FEATURES numbers.
    got = labelled.select(F.col("id").cast("bigint").alias("id"), "text").mapInArrow(
        extract, "id bigint, pattern bigint, features array<int>").toArrow().sort_by("id")
    if len(got):
        target = posterior(model, got.column("pattern").to_numpy())
        model.weights, model.intercept = _fit_weights(got.column("features").to_pylist(), target, len(features))
    return model


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text."""
    ship(docs.sparkSession)
    from pyspark.sql.types import DoubleType, StructField, StructType

    kept = [f for f in docs.schema.fields if f.name != out]
    place = docs.select([f.name for f in kept]).columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(model.number)
        for batch in batches:
            z = np.array([model.weights[known.of(words_of(t))].sum() for t in batch.column(place).to_pylist()], np.float64)
            z = 1 / (1 + np.exp(-(z + model.intercept).clip(-500, 500)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(z)], [*batch.schema.names, out])
    return docs.select([f.name for f in kept]).mapInArrow(
        run, StructType([*kept, StructField(out, DoubleType())]))


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    return fold(F.col(id_col), folds) == 0
