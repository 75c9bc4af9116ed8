"""Mixing sources to target weights by repeating documents.

Sizes are added up per source.  Targets share the total by weight; no target may
exceed ``most`` times its source's size, and what that cuts off is shared again by
weight.  The fixed point is ``least(most * size, level * weight)``; the level is found by
a few small aggregates over the table of sources, each of which moves it up to
where the sources already at their limit put it.

A source's repetition rate is target / size.  Every document is emitted
floor(rate) times, plus one more when a number in [0, 1) made from its id is below
the fraction.  Nothing is sorted and no source is gathered in one task: a hot
source costs map-side partial sums only, and the per-source table is joined by
whatever means its written size allows.

Defined cases: null text has size 0; a null source is a source of its own, last
in order; sources without words have target 0 and rate 0, their documents are taken zero
times; equal rows get the same number; an empty table gives an empty result.
``plan_copies`` replaces columns of the input named like one of its own; ``mix`` keeps them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weftline.llm.text import unit_hash, word_count
from weftline.operators.scan import ordinal
from weftline.session import cut

OUT = ("size", "source_size", "target", "rate", "copies", "taken")


def cyclic_weights(sources: DataFrame, cycle: int = 3) -> DataFrame:
    """Weights 1, 2, ..., ``cycle``, repeating along the sources; null comes last."""
    ordered = ordinal(sources.withColumn("_null", F.col("source").isNull()), ["_null", "source"], out="_n", start=0)
    return ordered.withColumn("weight", (F.col("_n") % cycle + 1).cast("bigint")).drop("_n", "_null")


def targets(sources: DataFrame, most: int = 3) -> DataFrame:
    """``source, source_size, weight`` with ``target`` and ``rate``."""
    sources = cut(sources)
    limit = F.col("source_size") * most
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)).cast("bigint")).first()[0]
    over, under = 0, None
    full = F.lit(False)
    while True:
        now = sources.agg(
            F.coalesce(F.sum(F.when(full, limit)), F.lit(0)).cast("bigint").alias("over"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).cast("bigint").alias("under")).first()
        if (now.over, now.under) == (over, under) or now.under == 0:
            over, under = now.over, now.under
            break
        over, under = now.over, now.under
        # limit <= (total - over) * weight / under, in whole numbers
        full = (limit.cast("decimal(20,0)") * F.lit(under)) <= (F.col("weight").cast("decimal(20,0)") * F.lit(total - over))
    shared = (F.lit(float(total - over)) * F.col("weight").cast("double") / F.lit(float(under or 1)))
    target = F.when(full, limit.cast("double")).otherwise(shared) if under else limit.cast("double")
    return (sources.withColumn("target", target)
            .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))))


def plan_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
                seed: int = 11, cycle: int = 3, most: int = 3) -> DataFrame:
    """``docs`` with the columns of ``OUT``."""
    sized = docs.drop(*OUT).withColumn("size", word_count(F.col(text)))
    totals = (docs.select(F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
              .groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size")))
    rates = cut(targets(cyclic_weights(totals, cycle), most).select(
        F.col("source").alias("_source"), "source_size", "target", "rate"))
    joined = sized.join(rates, sized[source].eqNullSafe(rates["_source"])).drop("_source")
    return joined.withColumn("copies", copies(F.col("rate"), F.col(id_col), seed)).withColumn(
        "taken", F.col("size") * F.col("copies"))


def copies(rate: Column, key: Column, seed: int) -> Column:
    """Whole part of the rate, plus one with the probability of the fraction."""
    whole = F.floor(rate)
    return (whole + F.when(unit_hash(seed, key) < rate - whole, 1).otherwise(0)).cast("bigint")


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mixed collection: rows of ``docs``, each repeated as planned and otherwise untouched."""
    whole = F.struct(*[docs[c] for c in docs.columns]).alias("_row")
    planned = plan_copies(docs.select(whole, docs[id_col].alias("_id"), docs[text].alias("_text"), docs[source].alias("_from")),
                          "_id", "_text", "_from", **options)
    return planned.select("_row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("_row.*")
