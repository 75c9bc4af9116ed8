"""Views with the shapes the operators expect, over general-purpose tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weftline.session import ship

# Letters cycle through the four bases in either case; digits and
# line ends stand for unknown bases; every other character is dropped.
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_OTHER = "0123456789\n"
FROM_CHARS = _UPPER + _UPPER.lower() + _OTHER
TO_CHARS = ("ACGT" * 7)[:26] + ("acgt" * 7)[:26] + "N" * len(_OTHER)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def as_bases(text: Column) -> Column:
    return F.translate(F.regexp_replace(text, "[^A-Za-z0-9\n]", ""), FROM_CHARS, TO_CHARS)


def sequences(spark: SparkSession, folder: str) -> DataFrame:
    """``name, grp, hap, seq`` from whole document texts."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("name"), F.col("lang").alias("grp"),
        F.col("source").alias("hap"), as_bases(F.col("text")).alias("seq"))


def targets(spark: SparkSession, folder: str) -> DataFrame:
    """``target, seq`` from the benchmark passages, which documents may contain."""
    return table(spark, folder, "benchmark").select(
        F.col("item_id").alias("target"), as_bases(F.col("text")).alias("seq"))


def day_number(ts: str) -> Column:
    return F.datediff(F.col(ts).cast("date"), F.lit("1992-01-01").cast("date")).cast("bigint")


def intervals(spark: SparkSession, folder: str) -> DataFrame:
    """``contig, start, end, strand, id, score`` from every line item."""
    return table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("contig"), day_number("l_shipdate").alias("start"),
        (day_number("l_shipdate") + F.col("l_quantity").cast("bigint")).alias("end"),
        F.when(F.col("l_linestatus") == "O", "+").otherwise("-").alias("strand"),
        ((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 100000000
         + F.col("l_partkey") * 1000 + F.col("l_suppkey")).alias("id"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("score"),
        "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag")


def hits(spark: SparkSession, folder: str) -> DataFrame:
    """``target, contig, pos`` from every event: seconds since the epoch."""
    return table(spark, folder, "events").select(
        F.col("event_type").alias("target"), F.col("user_id").alias("contig"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("pos"))
