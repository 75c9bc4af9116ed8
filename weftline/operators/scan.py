"""Ordered scans that never put one key's rows in one task.

A plain window partitioned by a key sends every row of that key to a single
task.  Here the ordered axis of each key is cut into chunks of bounded width.
A window runs inside a chunk, the chunk totals (one row per chunk) are scanned
in turn, and the carried value is joined back.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from weftline.session import cut, parallelism

_AGGREGATES = {"sum": F.sum, "max": F.max, "min": F.min}


def _combine(how: str, left: Column, right: Column) -> Column:
    if how == "sum":
        return F.coalesce(left, F.lit(0)) + F.coalesce(right, F.lit(0))
    return F.greatest(left, right) if how == "max" else F.least(left, right)


def fresh(taken: Iterable[str], *wanted: str) -> list[str]:
    """The wanted column names, changed where a name is taken (names differ by more than case)."""
    used, out = {c.lower() for c in taken}, []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def prefix_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    chunk: Column,
    value: Column,
    how: str,
    out: str,
    inclusive: bool = True,
    descending: bool = False,
) -> DataFrame:
    """Running ``sum``/``max``/``min`` of ``value`` per key along ``order``.

    ``order`` must be unique per key and ``chunk`` non-decreasing along it.
    With ``descending`` the scan runs from the far end.  The window and the
    totals both read the input, so it is written once: scans on top of scans
    then cost one computation each.  There may be as many totals as keys, and the
    written size of ordered numbers is far below theirs in memory: the join back
    is never a broadcast.
    """
    keys = list(keys)
    fold = _AGGREGATES[how]
    at, item, local, carry, total = fresh([*df.columns, out], "_chunk", "_value", "_local", "_carry", "_total")
    work = cut(df.withColumns({at: chunk, item: value}))
    direction = F.desc if descending else F.asc
    bound = Window.currentRow if inclusive else -1
    inside = (Window.partitionBy(*keys, at).orderBy(direction(order))
              .rowsBetween(Window.unboundedPreceding, bound))
    work = work.withColumn(local, fold(item).over(inside))
    totals = work.groupBy(*keys, at).agg(fold(item).alias(total))
    before = (Window.partitionBy(*keys).orderBy(direction(at))
              .rowsBetween(Window.unboundedPreceding, -1))
    carried = totals.select(*keys, at, fold(total).over(before).alias(carry))
    return (
        work.join(carried.hint("merge"), [*keys, at], "left")
        .withColumn(out, _combine(how, F.col(local), F.col(carry)))
        .drop(at, item, local, carry)
    )


def ordinal(df: DataFrame, order: Sequence[str], out: str = "ordinal",
            keys: Sequence[str] = (), start: int = 1) -> DataFrame:
    """Row numbers along a total order, per key, without a single-task sort.

    Rows are range-partitioned on (keys, order), so a hot key spreads over many
    partitions; the layout is made durable before the partition ids are used.
    """
    keys = list(keys)
    part, number, size, offset = fresh([*df.columns, out], "_part", "_rn", "_n", "_offset")
    laid = cut(
        df.repartitionByRange(parallelism(df.sparkSession), *keys, *order)
        .withColumn(part, F.spark_partition_id())
    )
    local = Window.partitionBy(*keys, part).orderBy(*order)
    numbered = laid.withColumn(number, F.row_number().over(local))
    sizes = laid.groupBy(*keys, part).agg(F.count(F.lit(1)).alias(size))
    before = (Window.partitionBy(*keys).orderBy(part)
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(*keys, part, F.coalesce(F.sum(size).over(before), F.lit(0)).alias(offset))
    return (
        numbered.join(offsets.hint("merge"), [*keys, part])
        .withColumn(out, (F.col(number) + F.col(offset) + F.lit(start - 1)).cast("bigint"))
        .drop(part, number, offset)
    )


def mode_first_seen(df: DataFrame, keys: Sequence[str], value: str, order: str,
                    out: str = "mode") -> DataFrame:
    """Commonest value per key; ties go to the value seen first along ``order``."""
    keys = list(keys)
    counted = df.groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("_n"), F.min(order).alias("_first"))
    best = F.max(F.struct(F.col("_n"), (-F.col("_first")).alias("_first"),
                          F.col(value).alias("_value")))
    return counted.groupBy(*keys).agg(best.alias("_best")).select(
        *keys, F.col("_best._value").alias(out), F.col("_best._n").alias("n"))
