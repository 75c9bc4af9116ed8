"""Connected components of similarity graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weftline.operators import pairs as P
from weftline.session import cut


def connected_components(edges: DataFrame, src: str = "i", dst: str = "j") -> DataFrame:
    """``node, component`` with the smallest member as component id.

    Alternating large-star and small-star rounds: every node's neighbours are
    linked to the smallest of them.  The minimum per node is an ordinary
    aggregate, so a hub costs map-side partials and not a list.
    """
    pairs = cut(
        edges.select(F.least(src, dst).alias("u"), F.greatest(src, dst).alias("v"))
        .where("u <> v").distinct())
    nodes = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()

    def signature(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())

    state = signature(pairs)
    while True:
        both = pairs.union(pairs.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("u"), "v").where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (down.join(low, "u").where("v <> m").select(F.col("m").alias("u"), "v")
                 .union(low.select(F.col("m").alias("u"), F.col("u").alias("v")))
                 .where("u <> v").distinct())
        pairs = cut(small)
        now = signature(pairs)
        if now == state:
            break
        state = now
    roots = pairs.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("component"))
    return nodes.join(roots, "node", "left").select(
        "node", F.coalesce("component", "node").alias("component"))


def _spread(labels: DataFrame, found: DataFrame) -> DataFrame:
    """Labels after joining the classes that the found pairs connect."""
    tagged = (found.select("i", "j")
              .join(labels.select(F.col("name").alias("i"), F.col("label").alias("a")), "i")
              .join(labels.select(F.col("name").alias("j"), F.col("label").alias("b")), "j"))
    merged = connected_components(tagged.select("a", "b"), "a", "b")
    return (labels.join(merged.select(F.col("node").alias("label"), "component"), "label", "left")
            .select("name", F.coalesce("component", "label").alias("label")))


def unfold_components(labels: DataFrame, counts: DataFrame, members: DataFrame, common: int) -> DataFrame:
    """``name, component`` of every record, from components of distinct texts.

    ``members`` has ``rep, name``; of ``counts`` only ``name, cnt`` is read, so ``kmers.window_numbers`` will do.  Two copies of a text have its whole k-mer mass in common, so
    they are linked when that exceeds ``common``; otherwise each is a component of its own.
    """
    mass = counts.groupBy(F.col("name").alias("rep")).agg(F.sum("cnt").alias("_mass"))
    placed = members.join(labels.withColumnRenamed("name", "rep"), "rep").join(mass, "rep", "left")
    return placed.select("name", F.when(F.col("_mass") > common, F.col("component")).otherwise(F.col("name")).alias("component"))


def similarity_components(counts: DataFrame | None, names: DataFrame, common: int = 500,
                          star_rounds: int = 2, colours: P.Colours | None = None) -> DataFrame:
    """Components of the graph joining sequences with similarity above ``common``.

    Pairs inside a crowd of near copies are never listed.  First every sequence
    is checked only against the first member of each k-mer colour it shares
    (a star); what those checks join is one class.  Then only pairs of different
    classes that still share a searched k-mer are checked.  Every skipped pair
    lies inside one class already, so the components are exact.

    Without ``counts``, ``colours`` (of these or more sequences) tell what is shared.
    """
    postings = (colours or P.colour_postings(counts)).postings
    searched = cut(P._prefix(postings, F.col("weight") * F.col("cnt"), F.lit(common)))
    labels = cut(names.select("name", F.col("name").alias("label")).distinct())
    checked = None
    for step in range(star_rounds + 1):
        placed = searched.select("colour", "name", "n").join(labels, "name")
        mixed = (placed.groupBy("colour").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi"),
                                              F.min(F.struct("label", "name")).alias("_first"))
                 .where("_lo <> _hi"))
        if step < star_rounds:
            met = placed.join(mixed, "colour").where(F.col("label") != F.col("_first.label"))
            candidates = met.select(F.least("name", F.col("_first.name")).alias("i"),
                                    F.greatest("name", F.col("_first.name")).alias("j")).distinct()
        else:
            left = placed.join(mixed.select("colour"), "colour", "left_semi")
            candidates = P._self_join(left, ["label"], distinct_labels=True).select("i", "j").distinct()
        if checked is not None:
            candidates = candidates.join(checked, ["i", "j"], "left_anti")
        candidates = cut(candidates)
        if candidates.isEmpty():
            if step < star_rounds:
                continue
            break
        checked = candidates if checked is None else cut(checked.union(candidates))
        found = P._verify(candidates, postings, P._min_sum()).where(F.col("total") > common)
        labels = cut(_spread(labels, found))
    return labels.withColumnRenamed("label", "component")


def repartition_components(counts: DataFrame, members: DataFrame, ladder: list[tuple[int, int]],
                           common: int = 500, colours: P.Colours | None = None) -> DataFrame:
    """Split components that stay too large, with rising thresholds.

    ``members`` has ``rep, name`` for every record; ``counts`` is per rep.  ``ladder`` lists
    (largest allowed number of records, next threshold).  Records of components
    within the size keep their label.  With ``colours`` of the reps, ``counts`` gives their masses only.
    """
    reps = members.select(F.col("rep").alias("name")).distinct()
    labels = cut(unfold_components(similarity_components(counts, reps, common, colours=colours), counts, members, common)
                 .withColumn("level", F.lit(common)))
    for largest, threshold in ladder:
        sizes = labels.groupBy("component").agg(F.count(F.lit(1)).alias("_n"))
        big = cut(labels.join(sizes.where(F.col("_n") > largest), "component").select("name"))
        if big.isEmpty():
            break
        part = cut(members.select("rep", "name").join(big, "name"))
        reps = part.select(F.col("rep").alias("name")).distinct()
        own = counts.join(reps, "name", "left_semi")
        # A colour says which sequences share it; without some of them it still does.
        left = P.Colours(cut(colours.postings.join(reps, "name", "left_semi")), colours.alone) if colours else None
        split = unfold_components(similarity_components(own, reps, threshold, colours=left), own, part, threshold)
        labels = cut(
            labels.join(big, "name", "left_anti")
            .unionByName(split.withColumn("level", F.lit(threshold))))
    return labels
