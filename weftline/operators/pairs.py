"""Similarity of sequence pairs that share k-mers.

The input is a count table ``(name, kmer, cnt)``.  Three things keep the self
join small and whole:

* exact copies are folded first (``fold_copies``), so a group of copies costs
  one row and is unfolded through its member table;
* k-mers carried by the same sequences with the same counts are one *colour*
  with a weight, so a shared passage is joined once and not once per k-mer;
* a threshold is turned into an exact prefix filter: per sequence, the commonest
  k-mers whose weight cannot reach the threshold alone are left out of candidate
  search (never out of the totals).

Pairs are made where the postings of their sequences meet (``pair_totals``): what is
shuffled are postings, never pairs, and a threshold is applied before a pair leaves its task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from weftline.operators.kmers import sequence_squares
from weftline.operators.superkmers import shared_colours
from weftline.session import cut, parallelism, ship

SINGLE_WEIGHT = 20  # fixed value: divisor for k-mers carried by one sequence
BLOCK = 1024
# Postings of a block at most; a smaller home is cut into up to SPREAD blocks of SMALL, so that several tasks share it.
CELL, SMALL, SPREAD = 1 << 20, 1 << 17, 8
# Meetings of two postings that are added up at once.
STEP = 1 << 21


def fold_copies(seqs: DataFrame, name: str = "name", seq: str = "seq",
                by: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """One row per distinct text (``copies`` tells how many) and the member table.

    ``by`` columns keep copies apart that differ in them.  The member table is
    ``rep, name`` plus ``by``.
    """
    marked = seqs.withColumn("_digest", F.sha2(F.upper(seq), 256))
    keys = [*by, "_digest"]
    # The texts are read once for their digests.
    digests = cut(marked.select(name, *keys))
    reps = digests.groupBy(*keys).agg(F.min(name).alias("rep"), F.count(F.lit(1)).alias("copies"))
    members = digests.join(reps.drop("copies"), keys).select("rep", name, *by)
    chosen = seqs.join(reps.select(F.col("rep").alias(name), "copies"), name)
    return chosen, members


def folded_counts(hits: DataFrame) -> DataFrame:
    """``name, kmer, cnt, copies`` from hits carrying ``name`` and ``copies``."""
    return hits.groupBy("name", "copies", "kmer").agg(F.count(F.lit(1)).alias("cnt"))


@dataclass
class Colours:
    """``postings(colour, name, cnt, weight, n)`` for k-mers of two or more rows,
    and ``alone(name, lone, inner)``: summed squared counts of k-mers of a single
    sequence and of k-mers shared among copies of one sequence only."""

    postings: DataFrame
    alone: DataFrame


def colour_postings(counts: DataFrame) -> Colours:
    """Group k-mers by the exact set of (sequence, count) rows carrying them.

    The set is identified by its size and two independent 64-bit hashes
    combined by xor, which partial aggregates can merge in any order.
    """
    if "copies" not in counts.columns:
        counts = counts.withColumn("copies", F.lit(1))
    # The per-sequence counts are a k-mer scan; everything below reads them again.
    counts = cut(counts)
    # Most k-mers are of one sequence: what tells them apart is summed without hashes, which only shared ones get.
    often = counts.groupBy("kmer").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = cut(counts.join(often, "kmer").select("kmer", "name", F.col("cnt").cast("bigint").alias("cnt"), "copies", "n"))
    square = F.sum(F.col("cnt").cast("bigint") * F.col("cnt"))
    alone = _alone(counts.groupBy("name", "copies").agg(square.alias("_s")), shared.groupBy("name", "copies").agg((-square).alias("_s")))
    pair = (F.col("name"), F.col("cnt"))
    colours = shared.groupBy("kmer").agg(
        F.max("n").alias("n"), F.bit_xor(F.xxhash64(*pair)).alias("h1"),
        F.bit_xor(F.xxhash64(F.lit("second"), *pair)).alias("h2")).groupBy("n", "h1", "h2").agg(
        F.min("kmer").alias("kmer"), F.count(F.lit(1)).alias("weight"))
    postings = shared.join(colours.select("kmer", "weight"), "kmer").select(
        F.col("kmer").alias("colour"), "name", "cnt", "weight", "n")
    # The postings are far fewer than the hits and are read several times.
    return Colours(cut(postings), alone)


def _alone(whole: DataFrame, shared: DataFrame) -> DataFrame:
    """What is not shared is the rest of a sequence's squares."""
    return whole.unionByName(shared).groupBy("name", "copies").agg(F.sum("_s").alias("_s")).groupBy("name").agg(
        F.sum(F.when(F.col("copies") == 1, F.col("_s")).otherwise(0)).alias("lone"),
        F.sum(F.when(F.col("copies") > 1, F.col("_s")).otherwise(0)).alias("inner"))


def sequence_colours(seqs: DataFrame, seq: str = "seq", k: int = 31, by: str | None = None) -> Colours:
    """``colour_postings`` of ``sequence_counts``, from the sequences (``name``, maybe ``copies``): counts that no other sequence
    shares are never rows.  With ``by`` a k-mer counts per value of that column.

    Runs of windows meet in the bucket of their minimiser, which tells shared k-mers and their colours.
    """
    if "copies" not in seqs.columns:
        seqs = seqs.withColumn("copies", F.lit(1))
    kept = [*([by] if by else []), "name", "copies"]
    # A number for each sequence; sequences of one name count as one.
    texts = cut(seqs.select(*kept, F.col(seq).alias("_text")).withColumn("_row", F.monotonically_increasing_id()))
    again = cut(texts.groupBy(*kept).agg(F.min("_row").alias("_own"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"))
    names = texts.select(*kept, "_row")
    if not again.isEmpty():
        same = [texts[c].eqNullSafe(again[c]) for c in kept]
        texts = texts.join(again, same, "left").select(
            *[texts[c] for c in kept], "_text", F.coalesce("_own", "_row").alias("_row"))
        names = names.join(again.select("_own"), F.col("_row") == F.col("_own"), "left").drop("_own")
    found = cut(shared_colours(texts, "_row", [by] if by else [], "_text", k))
    place = [*([by] if by else []), "kmer"]
    owned = found.join(names.select("_row", "name", "copies"), "_row")
    shared = owned.groupBy("name", "copies").agg((-F.sum(F.col("weight") * F.col("cnt") * F.col("cnt"))).alias("_s"))
    alone = _alone(sequence_squares(texts, (*kept, "_row"), "_text", k).groupBy("name", "copies").agg(F.sum("square").alias("_s")), shared)
    # A colour has a k-mer in each of several buckets: the smallest one stands for all.
    heads = found.groupBy(*place).agg(*[F.max(c).alias(c) for c in ("n", "h1", "h2", "weight")])
    colours = heads.groupBy(*place[:-1], "n", "h1", "h2").agg(F.min("kmer").alias("kmer"), F.sum("weight").alias("weight"))
    colour = F.struct(*place) if by else F.col("kmer")
    chosen = colours.select("kmer", F.col("weight").alias("_all"), *[F.col(c).alias(f"_{c}") for c in place[:-1]])
    met = F.col("kmer") == F.col("_kmer")
    if by:
        met = met & F.col(by).eqNullSafe(F.col(f"_{by}"))
    postings = owned.join(chosen.withColumnRenamed("kmer", "_kmer"), met).select(
        colour.alias("colour"), "name", "cnt", F.col("_all").alias("weight"), "n")
    return Colours(cut(postings), alone)


def diagonal(colours: Colours, single_weight: int = SINGLE_WEIGHT) -> DataFrame:
    """``name, own``: the weighted dot product of each sequence with itself.

    K-mers of one sequence only count 1/``single_weight``.
    """
    zero = F.lit(0).cast("bigint")
    shared = colours.postings.select(
        "name", (F.col("weight") * F.col("cnt") * F.col("cnt")).alias("whole"), zero.alias("lone"))
    alone = colours.alone.select("name", F.col("inner").alias("whole"), "lone")
    return shared.unionByName(alone).groupBy("name").agg(
        (F.sum("whole") + F.sum("lone") / single_weight).alias("own"))


def _prefix(postings: DataFrame, mass: Column, budget: DataFrame | Column) -> DataFrame:
    """Postings to search for candidates.

    Per sequence, k-mers are taken from the commonest down while their summed
    ``mass`` stays within the budget; those are not searched.  Two sequences
    whose shared mass exceeds the budget must share one of the others, because
    the sequence with the lower cut would otherwise hold the whole overlap in
    its skipped part.  The histogram has one row per (sequence, frequency).
    """
    histogram = postings.groupBy("name", "n").agg(F.sum(mass).alias("_mass"))
    commonest = Window.partitionBy("name").orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, 0)
    summed = histogram.withColumn("_above", F.sum("_mass").over(commonest))
    if isinstance(budget, DataFrame):
        summed = summed.join(budget, "name")
        limit = F.col("_budget")
    else:
        limit = budget
    cuts = summed.groupBy("name").agg(F.max(F.when(F.col("_above") > limit, F.col("n"))).alias("_cut"))
    return postings.join(cuts.where("_cut IS NOT NULL"), "name").where("n <= _cut").drop("_cut")


def _self_join(postings: DataFrame, columns: list[str], distinct_labels: bool = False,
               block: int = BLOCK) -> DataFrame:
    """Pairs ``i < j`` meeting on a colour.

    A colour with more than ``block`` sequences is cut into blocks and its
    pairs into block-by-block cells, so no task holds more than ``block``
    squared of them.
    """
    blocks = F.ceil(F.col("n") / block).cast("int")
    placed = postings.select("colour", "name", *columns, blocks.alias("_nb"),
                             F.pmod(F.xxhash64("name", "colour"), blocks).cast("int").alias("_b"))
    left = placed.withColumn("_c", F.explode(F.sequence(F.col("_b"), F.col("_nb") - 1)))
    right = placed.withColumn("_c", F.explode(F.sequence(F.lit(0), F.col("_b"))))
    l = left.select("colour", F.col("_b").alias("_x"), F.col("_c").alias("_y"), F.col("name").alias("_l"),
                    *[F.col(c).alias(f"l_{c}") for c in columns])
    r = right.select("colour", F.col("_c").alias("_x"), F.col("_b").alias("_y"), F.col("name").alias("_r"),
                     *[F.col(c).alias(f"r_{c}") for c in columns])
    met = l.join(r, ["colour", "_x", "_y"]).where(
        (F.col("_x") < F.col("_y")) | (F.col("_l") < F.col("_r")))
    if distinct_labels:
        met = met.where("l_label <> r_label")
    return met.withColumn("i", F.least("_l", "_r")).withColumn("j", F.greatest("_l", "_r"))


def _verify(candidates: DataFrame, postings: DataFrame, total: Column) -> DataFrame:
    """Exact totals of candidate pairs over all their shared k-mers."""
    a = postings.select(F.col("name").alias("j"), "colour", F.col("cnt").alias("b"), "weight")
    b = postings.select(F.col("name").alias("i"), "colour", F.col("cnt").alias("a"))
    return (candidates.select("i", "j").join(a, "j").join(b, ["i", "colour"])
            .groupBy("i", "j").agg(total.alias("total")))


def _min_sum() -> Column:
    return F.sum(F.col("weight") * F.least("a", "b"))


def _numbered(postings: DataFrame) -> DataFrame:
    """Postings whose colours are whole numbers."""
    if dict(postings.dtypes)["colour"] == "bigint":
        return postings
    numbers = cut(postings.select("colour").distinct().withColumn("_number", F.monotonically_increasing_id()))
    return postings.join(numbers, "colour").withColumn("colour", F.col("_number")).drop("_number")


def _cell_totals(owner: np.ndarray, colour: np.ndarray, cnt: np.ndarray, weight: np.ndarray, side: np.ndarray | None,
                 rows: int, dot: bool, step: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of rows with a common colour and their totals: within one block, or between rows of side 0 and of side 1."""
    order = np.lexsort((owner, colour) if side is None else (owner, side[owner], colour))
    owner, colour, cnt, weight = owner[order], colour[order], cnt[order], weight[order]
    # The partners of a posting are the later ones of its colour; those on side 0 take the ones on side 1.
    new = np.flatnonzero(np.concatenate(([True], colour[1:] != colour[:-1])))
    ends = np.repeat(np.append(new[1:], len(colour)), np.diff(np.append(new, len(colour))))
    if side is None:
        start = np.arange(1, len(colour) + 1)
    else:
        theirs = side[owner].astype(bool)
        other = np.add.reduceat(~theirs, new) + new
        start = np.where(theirs, ends, np.repeat(other, np.diff(np.append(new, len(colour)))))
    mine = np.flatnonzero(ends > start)
    mine = mine[np.argsort(owner[mine], kind="stable")]
    start, many, held = start[mine], (ends - start)[mine], owner[mine]
    done = np.concatenate(([0], np.cumsum(many)))
    exact = float((weight.astype(float) * cnt * cnt).sum()) < 2.0 ** 53

    def met(lo: int, hi: int, row: int) -> tuple[np.ndarray, np.ndarray]:
        n = many[lo:hi]
        left = np.repeat(mine[lo:hi], n)
        right = np.repeat(start[lo:hi] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        value = weight[left] * (cnt[left] * cnt[right] if dot else np.minimum(cnt[left], cnt[right]))
        return (owner[left] - row) * rows + owner[right], value

    firsts = np.flatnonzero(np.concatenate(([True], held[1:] != held[:-1]))) if len(held) else np.empty(0, np.int64)
    bounds = np.append(firsts, len(held))
    at = 0
    while at < len(firsts):
        lo, row = int(bounds[at]), int(held[bounds[at]])
        # Whole rows with ``step`` meetings in all; one crowded row is added up in parts.
        to = max(int(np.searchsorted(done[bounds], done[lo] + step, "right")) - 1, at + 1)
        hi = int(bounds[to])
        wide = (int(held[hi - 1]) - row + 1) * rows
        if exact and (to == at + 1 or wide <= 4 * step):
            total = np.zeros(wide)
            while lo < hi:
                part = min(max(int(np.searchsorted(done, done[lo] + step, "right")) - 1, lo + 1), hi)
                key, value = met(lo, part, row)
                total += np.bincount(key, value, wide)
                lo = part
            key = np.flatnonzero(total)
            total = total[key].astype(np.int64)
        else:
            keys, totals = np.empty(0, np.int64), np.empty(0, np.int64)
            while lo < hi:
                part = min(max(int(np.searchsorted(done, done[lo] + step, "right")) - 1, lo + 1), hi)
                key, value = met(lo, part, row)
                keys, totals = np.concatenate((keys, key)), np.concatenate((totals, value))
                order = np.argsort(keys, kind="stable")
                keys = keys[order]
                lead = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
                keys, totals = keys[lead], np.add.reduceat(totals[order], lead)
                lo = part
            key, total = keys, totals
        yield row + key // rows, key % rows, total
        at = to


Kept = Callable[[np.ndarray, dict[str, np.ndarray], dict[str, np.ndarray]], np.ndarray]


def pair_totals(postings: DataFrame, dot: bool, carry: Sequence[str] = (), home: str | None = None, keep: Kept | None = None,
                cell: int = CELL, small: int = SMALL, step: int = STEP) -> DataFrame:
    """``i, j, total`` and ``l_*, r_*`` of the ``carry`` columns, for all ``i < j`` that share a colour of one home.

    The total is the sum of weight * min(cnt) over the common colours, or with ``dot`` of weight * cnt * cnt.  Each
    sequence travels with all its postings.  Those of one ``home`` (whole numbers, not null) meet: a large home is dealt into blocks
    of about ``cell`` postings, and each two blocks are a cell, the work of one task; small homes share tasks.  So a task holds
    two blocks, and pairs leave it as they are made, if ``keep(total, left, right)`` says so.
    """
    spark = postings.sparkSession
    ship(spark)
    carry = list(carry)
    named = _numbered(postings).where("name IS NOT NULL").withColumn("_home", F.col(home) if home else F.lit(0).cast("bigint"))
    rows = cut(named.groupBy("_home", "name", *carry).agg(F.collect_list(F.struct(
        "colour", *[F.col(c).cast("bigint").alias(c) for c in ("cnt", "weight")])).alias("_held")))
    sizes = cut(rows.groupBy("_home").agg(F.sum(F.size("_held")).alias("_all")))
    pools = max(parallelism(spark), (sizes.agg(F.sum("_all")).first()[0] or 0) // small + 1)
    blocks = F.greatest(F.ceil(F.col("_all") / cell), F.least(F.lit(SPREAD), F.ceil(F.col("_all") / small))).cast("int")
    dealt = (rows.join(sizes, "_home").withColumn("_blocks", blocks)
             .withColumn("_b", F.pmod(F.xxhash64("name"), "_blocks").cast("int"))
             .withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
             .withColumn("_x", F.least("_b", "_o")).withColumn("_y", F.greatest("_b", "_o"))
             .withColumn("_pool", F.when(F.col("_blocks") == 1, F.pmod(F.xxhash64("_home"), F.lit(pools))).otherwise(-1).cast("int"))
             .withColumn("_one", F.when(F.col("_blocks") > 1, F.col("_home")).otherwise(0))
             .select("_pool", "_one", "_x", "_y", "_home", "_b", "name", *carry, "_held"))
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    schema = T.StructType([T.StructField("i", kinds["name"]), T.StructField("j", kinds["name"]), T.StructField("total", T.LongType()),
                           *[T.StructField(f"{at}_{c}", kinds[c]) for c in carry for at in "lr"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        names = table.column("name").combine_chunks()
        # Rows by home, then by name; rows of one name make no pair.
        by_name = pc.sort_indices(names)
        sorted_ = names.take(by_name)
        code = np.empty(len(names), np.int64)
        code[by_name.to_numpy()] = np.cumsum(np.concatenate(([0], pc.not_equal(sorted_[1:], sorted_[:-1]).to_numpy(zero_copy_only=False))))
        homes = table.column("_home").to_numpy()
        order = np.lexsort((code, homes))
        table, homes, code = table.take(pa.array(order)), homes[order], code[order]
        names = table.column("name").combine_chunks()
        block = table.column("_b").to_numpy()
        extra = {c: table.column(c).combine_chunks() for c in carry}
        plain = {c: a.to_numpy(zero_copy_only=False) for c, a in extra.items()} if keep else {}
        held = table.column("_held").combine_chunks()
        size = np.diff(held.offsets.to_numpy())
        flat = held.flatten()
        colour, cnt, weight = (flat.field(c).to_numpy() for c in ("colour", "cnt", "weight"))
        opens = np.concatenate(([0], np.cumsum(size)))
        cut_at = np.flatnonzero(np.concatenate(([True], homes[1:] != homes[:-1])))
        for s, e in zip(cut_at, np.append(cut_at[1:], len(homes))):
            if e - s < 2:
                continue
            part = slice(opens[s], opens[e])
            side = block[s:e] != block[s:e].min()
            # A cell of two blocks has the pairs between them; those inside have a cell of their own.
            two = table.column("_x")[int(s)].as_py() != table.column("_y")[int(s)].as_py()
            if two and not side.any():
                continue
            owner = np.repeat(np.arange(e - s), size[s:e])
            for a, b, total in _cell_totals(owner, colour[part], cnt[part], weight[part], side if two else None, int(e - s), dot, step):
                a, b = a + s, b + s
                a, b = np.where(code[a] < code[b], a, b), np.where(code[a] < code[b], b, a)
                chosen = code[a] != code[b]
                if keep:
                    chosen &= keep(total, {c: v[a] for c, v in plain.items()}, {c: v[b] for c, v in plain.items()})
                a, b, total = a[chosen], b[chosen], total[chosen]
                for lo in range(0, len(a), 1 << 18):
                    l, r = pa.array(a[lo:lo + (1 << 18)]), pa.array(b[lo:lo + (1 << 18)])
                    yield pa.RecordBatch.from_arrays(
                        [names.take(l), names.take(r), pa.array(total[lo:lo + (1 << 18)]),
                         *[extra[c].take(x) for c in carry for x in (l, r)]], schema.names)
    return dealt.groupBy("_pool", "_one", "_x", "_y").applyInArrow(run, schema)


def _linked(searched: DataFrame, label: str | None = None) -> DataFrame:
    """``name, home`` of the sequences that searched colours join, directly or by others: no pair to be found leaves its home.

    With ``label``, colours of one label join nothing.  Names are numbered, so homes are whole numbers.
    """
    first = searched.groupBy("colour").agg(
        F.min("name").alias("_first"), F.max("name").alias("_last"),
        *([F.min(label).alias("_lo"), F.max(label).alias("_hi")] if label else []))
    first = first.where("_first <> _last" + (" AND _lo <> _hi" if label else ""))
    edges = searched.join(first, "colour").select(F.col("_first").alias("i"), F.col("name").alias("j"))
    from weftline.operators.components import connected_components
    found = connected_components(edges)
    return found.select(F.col("node").alias("name"), F.xxhash64("component").alias("home"))


def min_similarity(counts: DataFrame, more_than: int = 0,
                   colours: Colours | None = None) -> DataFrame:
    """``i, j, total`` with total = sum over k-mers of min(count_i, count_j).

    Only pairs whose total exceeds ``more_than`` are returned.
    """
    postings = (colours or colour_postings(counts)).postings
    if more_than <= 0:
        return pair_totals(postings, False)
    searched = _prefix(postings, F.col("weight") * F.col("cnt"), F.lit(more_than))
    homes = cut(_linked(cut(searched.select("colour", "name"))))
    return pair_totals(postings.join(homes, "name"), False, home="home", keep=lambda total, left, right: total > more_than)


def weighted_dot(counts: DataFrame, colours: Colours | None = None) -> DataFrame:
    """Off-diagonal norm matrix ``i, j, total`` for every pair sharing a k-mer."""
    postings = (colours or colour_postings(counts)).postings
    return pair_totals(postings, True).withColumn("total", F.col("total").cast("double"))


def distance(total: Column, own_i: Column, own_j: Column) -> Column:
    """1 - m_ij / sqrt(max(1, m_ii) max(1, m_jj))."""
    one = F.lit(1.0)
    return one - total / F.sqrt(F.greatest(one, own_i) * F.greatest(one, own_j))


def pair_distances(counts: DataFrame, at_most: float | None = None,
                   colours: Colours | None = None, labels: DataFrame | None = None) -> DataFrame:
    """``i, j, total, own_i, own_j, d`` for pairs within distance ``at_most``.

    With ``labels`` (name, label) only pairs of different labels are searched.  A limit of
    1 or more also wants pairs that share no k-mer, which is every pair: it is refused.

    With a limit below 1 the cosine bound gives the prefix: if the skipped part
    of either sequence has less than (1 - limit)^2 of its self product, the dot
    product over it cannot reach the limit alone.
    """
    colours = colours or colour_postings(counts)
    own = cut(diagonal(colours))
    if at_most is not None and at_most >= 1:
        raise ValueError("pairs without a common k-mer have distance 1; take a limit below 1, or none for all pairs that share one")
    placed, home, carry, keep = colours.postings.join(own, "name"), None, ["own"], None
    labelled = labels is not None
    if at_most is not None:
        slack = (1.0 - at_most) ** 2 * (1 - 1e-9)
        budget = own.select("name", (F.greatest(F.col("own"), F.lit(1.0)) * slack).alias("_budget"))
        searched = _prefix(colours.postings, F.col("weight") * F.col("cnt") * F.col("cnt"), budget).select("colour", "name")
        if labelled:
            # A name may have several labels; a pair counts if any of them differ.
            marks = cut(labels.where("label IS NOT NULL").select("name", F.xxhash64("label").alias("_mark"))
                        .groupBy("name").agg(F.min("_mark").alias("_lo"), F.max("_mark").alias("_hi")))
            searched = searched.join(marks.select("name", F.explode(F.array("_lo", "_hi")).alias("_mark")), "name")
            placed, carry = placed.join(marks, "name"), [*carry, "_lo", "_hi"]
        placed, home = placed.join(cut(_linked(cut(searched), "_mark" if labelled else None)), "name"), "home"

        def keep(total: np.ndarray, left: dict[str, np.ndarray], right: dict[str, np.ndarray]) -> np.ndarray:
            near = 1.0 - total / np.sqrt(np.maximum(1.0, left["own"]) * np.maximum(1.0, right["own"])) <= at_most
            if labelled:
                near &= (left["_lo"] != right["_hi"]) | (left["_hi"] != right["_lo"])
            return near
    return pair_totals(placed, True, carry, home, keep).select(
        "i", "j", F.col("total").cast("double").alias("total"), F.col("l_own").alias("own_i"), F.col("r_own").alias("own_j")
    ).withColumn("d", distance(F.col("total"), F.col("own_i"), F.col("own_j")))
