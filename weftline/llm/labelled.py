"""Bounded samples of labelled documents, and the split that keeps a part of the labels unseen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def fold(id_: Column, folds: int) -> Column:
    """CRC-32 of the id's decimal text, modulo ``folds``; a null id is in fold 0."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % folds, F.lit(0))


def sample(docs: DataFrame, labels: DataFrame, label: str, seen: Column, bound: int, id_col: str = "doc_id",
           text: str = "text", seed: int = 5) -> DataFrame:
    """``id, text, y`` of at most ``bound`` labelled ids for which ``seen`` holds.

    Ids are taken in the order of a hash, so the sample does not depend on the layout.
    An id labelled twice has the larger label.
    """
    known = (labels.where(seen & F.col(id_col).isNotNull() & F.col(label).isNotNull())
             .groupBy(F.col(id_col).alias("_id")).agg(F.max(label).cast("int").alias("y"))
             .orderBy(F.xxhash64(F.lit(seed), "_id"), "_id").limit(bound))
    # Bounded by ``bound`` narrow rows.
    return docs.join(F.broadcast(known), docs[id_col] == known["_id"]).select(
        F.col("_id").alias("id"), F.col(text).alias("text"), "y")
