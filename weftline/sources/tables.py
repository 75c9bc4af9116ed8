"""Tab-separated tables, k-mer lists and count tables, matrices, graph rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from weftline.functions.sequence import decode_kmer, encode_kmer
from weftline.operators.scan import ordinal, prefix_scan
from weftline.sources.records import numbered_lines
from weftline.session import cut

_KMER = r"^[ACGTacgt]+$"


def read_tabbed(spark: SparkSession, paths: str | list[str], schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("sep", "\t").option("quote", "").csv(paths)


def write_report(df: DataFrame, path: str, header: bool = False) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("header", header).option("quote", "").option(
        "emptyValue", "").csv(path)


def write_in_order(df: DataFrame, order: list[str], path: str, columns: list[str]) -> None:
    """Tab-separated lines whose files, taken by name, hold the rows in the given order; no task sorts them all."""
    laid = df.repartitionByRange(*order).sortWithinPartitions(*order)
    laid.select(F.concat_ws("\t", *columns).alias("value")).write.mode("overwrite").text(path)


def read_in_order(spark: SparkSession, path: str) -> DataFrame:
    """``line_no, line`` over all files of a folder, taken by name."""
    lines = numbered_lines(spark, path).withColumnRenamed("line_no", "at")
    return ordinal(lines, ["path", "at"], "line_no", start=0).select("line_no", "line")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``sample, path`` from two white-space columns."""
    part = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).where(F.trim("value") != "").select(part[0].alias("sample"), part[1].alias("path"))


def read_path_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).where(F.trim("value") != "").select(F.trim("value").alias("path"))


def with_source(df: DataFrame, manifest: DataFrame, sample: str = "sample", default: str = "") -> DataFrame:
    """Path of each row's sample, or the default one."""
    return df.join(manifest.select(F.col("sample").alias(sample), F.col("path").alias("source")), sample, "left").fillna(
        {"source": default})


def read_kmer_list(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Packed k-mers of a list file; ``>`` and ``@`` lines are separators."""
    word = F.regexp_extract("value", r"^(\S+)", 1)
    return spark.read.text(paths).where(word.rlike(_KMER)).select(encode_kmer(word).alias("kmer")).distinct()


def write_kmer_list(kmers: DataFrame, path: str, k: int = 31, partition: str | None = None) -> None:
    """``>`` and k-mer lines alternating, one folder per ``partition`` value when given."""
    text = kmers.select(F.concat(F.lit(">\n"), decode_kmer(F.col("kmer"), k)).alias("value"), *([partition] if partition else []))
    writer = text.write.mode("overwrite")
    (writer.partitionBy(partition) if partition else writer).text(path)


def read_counts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``kmer, cnt`` rows of a count table, without its ``@targetsize`` line."""
    part = F.split("value", "\t")
    return spark.read.text(paths).where(~F.col("value").startswith("@")).select(
        encode_kmer(part[0]).alias("kmer"), part[1].cast("int").alias("cnt"))


def read_target_sizes(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.text(paths).where(F.col("value").startswith("@targetsize")).select(
        F.col("_metadata.file_path").alias("path"), F.element_at(F.split("value", "\t"), 2).cast("long").alias("targetsize"))


def write_counts(counts: DataFrame, path: str, k: int = 31, nonzero: bool = True, target_size: int | None = None) -> None:
    """``kmer<tab>count`` lines; with ``target_size`` a file of its own holds the ``@targetsize`` line."""
    rows = counts.where("cnt > 0") if nonzero else counts
    rows.select(F.concat_ws("\t", decode_kmer(F.col("kmer"), k), "cnt").alias("value")).write.mode("overwrite").text(path)
    if target_size is not None:
        head = counts.sparkSession.range(1).select(F.concat_ws("\t", F.lit("@targetsize"), F.lit(target_size)).alias("value"))
        head.write.mode("append").text(path)


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """``i, j, v`` from a square comma-separated matrix, one row per line."""
    numbered = numbered_lines(spark, path).withColumnRenamed("line_no", "_row").withColumnRenamed("line", "value")
    return numbered.select(F.col("_row").alias("i"), F.posexplode(F.split("value", ",")).alias("j", "v")).select(
        "i", F.col("j").cast("long").alias("j"), F.col("v").cast("double").alias("v"))


def matrix_rows(entries: DataFrame, size: int) -> DataFrame:
    """``i, line``: dense rows with four decimals from sparse entries of one group."""
    held = entries.groupBy("i").agg(F.map_from_entries(F.collect_list(F.struct("j", "v"))).alias("_m"))
    cells = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(size - 1).cast("long")),
                        lambda j: F.format_string("%.4f", F.coalesce(F.element_at(F.col("_m"), j), F.lit(0.0))))
    return held.select("i", F.array_join(cells, ",").alias("line"))


def write_linear_graph(segments: DataFrame, paths: DataFrame, path: str) -> None:
    """``S`` lines from ``name, seq, orders, origin`` and ``L`` lines from
    ``allele, names, cigar, aligned, left, right`` (sizes of the aligned part and of both ends)."""
    s = segments.select(F.concat_ws("\t", F.lit("S"), F.concat(F.lit("s_"), "name"), "seq", "orders",
                                    F.concat(F.lit("LN:i:"), F.length("seq")), F.concat(F.lit("SN:Z:"), "origin")).alias("value"))
    plus = F.lit("+")
    tail = [F.concat(F.lit(f"{tag}:i:"), F.col(c)) for tag, c in (("SR", "aligned"), ("L1", "left"), ("L2", "right"))]
    l = paths.select(F.concat_ws("\t", F.lit("L"), "allele", plus, "names", plus, "cigar", *tail).alias("value"))
    s.unionByName(l).write.mode("overwrite").text(path)


def read_linear_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The tables ``write_linear_graph`` takes."""
    part = F.split("value", "\t")
    def tagged(i: int) -> Column:
        return F.regexp_extract(part[i], r"^\w+:[iZ]:(.*)$", 1)
    lines = spark.read.text(path).select("value", F.substring("value", 1, 1).alias("kind"))
    segments = lines.where("kind = 'S'").select(
        F.regexp_replace(part[1], "^[<>]?s_?", "").alias("name"), part[2].alias("seq"), part[3].alias("orders"), tagged(5).alias("origin"))
    paths = lines.where("kind = 'L'").select(
        part[1].alias("allele"), part[3].alias("names"), part[5].alias("cigar"),
        *[tagged(i).cast("bigint").alias(c) for i, c in ((6, "aligned"), (7, "left"), (8, "right"))])
    return segments, paths


def read_newick(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``path, parent, child, length, leaf``: edges of each Newick file's tree.

    The reader cuts files at commas, so one of any size is many rows.  A bracket's depth is a running sum, and the
    parent of a node is the next closing bracket of its depth.  Leaves are numbered in order of appearance, inner nodes
    after them in order of closing; inner labels are not kept, a missing length is 0.
    """
    raw = spark.read.option("lineSep", ",").text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), F.col("value"))
    pieces = ordinal(cut(raw), ["block", "row"], "piece", ["path"], start=0)
    parts = F.regexp_extract_all("value", F.lit(r"[()]|:[^(),;:]+|[^(),;:]+"), F.lit(0))
    words = F.filter(F.transform(parts, lambda t: F.regexp_replace(t, r"^\s+|\s+$", "")), lambda t: t != "")

    def token(t: Column, i: Column) -> Column:
        one, two = F.get("t", i + 1), F.get("t", i + 2)
        label = ~F.coalesce(one.rlike("^[():]"), F.lit(True))
        size = F.when(one.startswith(":"), one).when(label & two.startswith(":"), two)
        return F.struct(i.cast("bigint").alias("i"), t.alias("t"), F.substring(size, 2, 64).try_cast("double").alias("length"),
                        (F.get("t", i - 1) == ")").alias("after"))
    tokens = pieces.withColumn("t", words).select("path", "piece", F.explode(F.transform("t", token)).alias("k")).select(
        "path", (F.col("piece") * (1 << 20) + F.col("k.i")).alias("at"), "k.t", F.coalesce("k.length", F.lit(0.0)).alias("length"),
        F.coalesce("k.after", F.lit(False)).alias("after"))
    leaf = ~F.col("t").rlike("^[():]") & ~F.col("after")
    tokens = tokens.withColumn("leaf", leaf).where("leaf OR t IN ('(', ')')")
    chunk = F.floor(F.col("at") / (1 << 36))
    one = F.lit(1).cast("bigint")
    for out, value in (("depth", F.when(F.col("t") == "(", one).when((F.col("t") == ")") & ~F.col("leaf"), -one).otherwise(0)),
                       ("leaves", F.when(F.col("leaf"), one).otherwise(0)), ("closed", F.when((F.col("t") == ")") & ~F.col("leaf"), one).otherwise(0))):
        tokens = prefix_scan(tokens, ["path"], "at", chunk, value, "sum", out, inclusive=False)
    tokens = cut(tokens.withColumns({c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("depth", "leaves", "closed")}))
    closing = tokens.where("NOT leaf AND t = ')'")
    count = tokens.groupBy("path").agg(F.sum(F.col("leaf").cast("bigint")).alias("n"))
    nodes = tokens.where("leaf").select("path", "at", "depth", "length", F.col("t").alias("name"), F.col("leaves").alias("number")).unionByName(
        closing.select("path", "at", F.col("depth") - 1, "length", F.lit(None).cast("string").alias("name"), F.col("closed").alias("number")).toDF(
            "path", "at", "depth", "length", "name", "number"))
    none = F.lit(None).cast("bigint")
    axis = nodes.withColumn("closer", none).unionByName(closing.select(
        "path", "at", "depth", F.lit(0.0).alias("length"), F.lit(None).cast("string").alias("name"), none.alias("number"), F.col("closed").alias("closer")))
    up = prefix_scan(axis, ["path", "depth"], "at", chunk, F.when(F.col("closer").isNotNull(), F.struct("at", "closer")), "min", "up",
                     inclusive=False, descending=True)
    found = up.where("number IS NOT NULL AND up IS NOT NULL").join(count, "path")
    return found.select("path", (F.col("n") + F.col("up.closer")).alias("parent"),
                        F.when(F.col("name").isNull(), F.col("n") + F.col("number")).otherwise(F.col("number")).alias("child"),
                        "length", F.col("name").alias("leaf"))
