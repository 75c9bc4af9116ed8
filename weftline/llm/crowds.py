"""Classes of similar sets from shared band keys, without listing the pairs of a crowd.

``folded`` has one row per distinct set: ``id`` (bigint), ``n`` (set size), ``bands`` (keys).
Each band bucket has a hub, the member that meets most others; members are compared
with hubs first.  Where members of one hub are still in different classes, they are
compared with each other in cells of bounded size: a crowd is dealt into blocks, a
cell holds two blocks of full sets, and only links that join two classes leave it.
Every two sets that share a band key are thereby either confirmed, refuted or
already in one class.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from weftline.operators.components import connected_components
from weftline.session import cut, ship

CELL_ITEMS = 50_000


def lists(values: list[np.ndarray]) -> pa.Array:
    """An Arrow list column of 64-bit words."""
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    flat = np.concatenate(values).view(np.int64) if values else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _close(common: Column, a: Column, b: Column, percent: int) -> Column:
    return common * 100 >= (a + b - common) * percent


def stars(folded: DataFrame) -> DataFrame:
    """``hub, id``: every member of a crowded bucket with the bucket's hub."""
    rows = folded.select("id", F.explode("bands").alias("key"))
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    crowd = cut(rows.join(sizes, "key"))
    met = crowd.groupBy("id").agg(F.sum("size").alias("met"))
    hubs = crowd.join(met, "id").groupBy("key").agg(
        F.max(F.struct("met", (-F.col("id")).alias("id"))).alias("best")).select("key", (-F.col("best.id")).alias("hub"))
    return crowd.join(hubs, "key").select("hub", "id").distinct()


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (hub, id) whose full sets are close enough."""
    member = pairs.join(sets, "id")
    hub = sets.select(F.col("id").alias("hub"), F.col("items").alias("hub_items"))
    common = F.size(F.array_intersect("items", "hub_items"))
    return member.join(hub, "hub").where(
        _close(common, F.size("items"), F.size("hub_items"), percent)).select("hub", "id")


def _cell_links(ids: np.ndarray, labels: np.ndarray, blocks: np.ndarray, sets: list[np.ndarray],
                first: int, second: int, percent: int) -> list[tuple[int, int]]:
    """Links between different classes in one cell, at most one for each two classes joined."""
    if (labels == labels[0]).all():
        return []
    size = np.array([len(s) for s in sets], np.int64)
    rows = np.repeat(np.arange(len(sets)), size)
    _, item = np.unique(np.concatenate(sets), return_inverse=True)
    by_item = np.argsort(item, kind="stable")
    held = np.bincount(item)
    starts = np.concatenate(([0], np.cumsum(held)))
    holders = rows[by_item]
    offset = np.concatenate(([0], np.cumsum(size)))
    parent = {x: x for x in labels.tolist()}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    out, parts = [], len(parent)
    for i in range(len(sets)):
        if first != second and blocks[i] != first:
            continue
        if parts == 1:
            break
        own = item[offset[i]:offset[i + 1]]
        # The places of the holders of all its items, one stretch after another.
        n = held[own]
        spans = np.arange(n.sum()) + np.repeat(starts[own] - np.cumsum(n) + n, n)
        common = np.bincount(holders[spans], minlength=len(sets))
        near = np.flatnonzero(common * 100 >= (size + size[i] - common) * percent)
        for j in near.tolist():
            if (j > i if first == second else blocks[j] == second):
                a, b = root(int(labels[i])), root(int(labels[j]))
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    parts -= 1
                    out.append((int(labels[i]), int(labels[j])))
    return out


def _within_crowds(met: DataFrame, labels: DataFrame, sets: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """``i, j``: classes joined by links between two members of one hub's crowd."""
    ship(met.sparkSession)
    placed = (met.join(sizes, "id").join(labels, "id", "left")
              .select("hub", "id", "n", F.coalesce("label", "id").alias("label")))
    mixed = placed.groupBy("hub").agg(
        F.min("label").alias("_lo"), F.max("label").alias("_hi"), F.sum("n").alias("_items")).where("_lo < _hi")
    dealt = (placed.join(mixed, "hub")
             .withColumn("blocks", F.ceil(F.col("_items") / CELL_ITEMS).cast("int"))
             .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("hub", "id", "label", "block", F.least("block", "other").alias("first"),
                     F.greatest("block", "other").alias("second")))

    def run(key: tuple, cell: pa.Table) -> pa.Table:
        links = []
        if len(cell) > 1:
            items = cell.column("items").combine_chunks()
            flat, ends = items.values.to_numpy(zero_copy_only=False), items.offsets.to_numpy()
            sets_ = [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]
            links = _cell_links(cell.column("id").to_numpy(), cell.column("label").to_numpy(),
                                cell.column("block").to_numpy(), sets_, key[1].as_py(), key[2].as_py(), percent)
        return pa.table({"i": pa.array([a for a, _ in links], pa.int64()), "j": pa.array([b for _, b in links], pa.int64())})

    return dealt.join(sets, "id").groupBy("hub", "first", "second").applyInArrow(run, "i bigint, j bigint")


def comparable(pairs: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """The pairs (hub, id) whose sizes allow the similarity."""
    return (pairs.where("hub <> id").join(sizes, "id")
            .join(sizes.select(F.col("id").alias("hub"), F.col("n").alias("hub_n")), "hub")
            .where(F.least("n", "hub_n") * 100 >= F.greatest("n", "hub_n") * percent).select("hub", "id"))


def classes(folded: DataFrame, met: DataFrame, pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``id, component`` for every set linked to another.

    ``met`` comes from ``stars``; ``pairs`` are those of its rows worth confirming;
    ``sets`` has the full ``items`` of every id in ``met``.
    """
    links = cut(_confirm(pairs, sets, percent))
    # One step towards the smallest confirmed hub is enough to skip what is surely joined;
    # a pair whose classes are not known to be one yet is only compared once more.
    labels = cut(links.select("id", "hub").unionByName(links.select(F.col("hub").alias("id"), "hub"))
                 .groupBy("id").agg(F.min("hub").alias("label")))
    more = _within_crowds(met, labels, sets, folded.select("id", "n"), percent)
    edges = links.select(F.col("hub").alias("i"), F.col("id").alias("j")).unionByName(more)
    found = connected_components(edges).select(F.col("node").alias("id"), "component")
    return folded.select("id").join(found, "id", "left").select("id", F.coalesce("component", "id").alias("component"))
