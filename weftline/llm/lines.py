"""Exact line deduplication across documents, returning bitmaps instead of text.

A line's key is the line with white space stripped at both ends and A-Z
lower-cased.  Lines with a key of at least ``least`` code points are reduced to
two 64-bit hashes, document and position.  These narrow rows are range-partitioned
on (hash, lane) and sorted by document and position inside; a lane is a hash of
the document, so a line found in a third of all documents is spread over many
ranges.  Streaming over the sorted rows, a line whose document is not the first
of its (hash, lane) goes at once.  What is left, one document per key and lane, is
compared with the smallest document of the key.

The result per document is a sparse bitmap: 64 lines per word, and only words
that drop a line are stored (``keep`` has the bits of kept lines in those words;
words left out keep all their lines).

Defined cases: null or empty text is one empty line; key ties are decided by the
smallest id; several rows with one id count as one document (all their lines
share positions, so ids should be unique); null ids take no part and keep all
lines; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from weftline.llm.text import BLANKS, ascii_lower
from weftline.session import cut, parallelism

LANES = 32


def line_key(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(BLANKS)))


def _split(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = 10) -> DataFrame:
    """``id, pos`` of every line that an earlier document holds as well."""
    keyed = (docs.where(F.col(id_col).isNotNull() & (F.length(text) >= least))
             .select(F.col(id_col).alias("id"), F.posexplode(_split(F.col(text))).alias("pos", "_line"))
             .select("id", "pos", line_key(F.col("_line")).alias("_key"))
             .where(F.length("_key") >= least)
             .select(F.xxhash64("_key").alias("h1"), F.xxhash64(F.lit(17), "_key").alias("h2"),
                     F.pmod(F.xxhash64("id"), F.lit(LANES)).cast("tinyint").alias("lane"), "id", "pos"))
    parts = parallelism(docs.sparkSession)
    streamed = (keyed.repartitionByRange(parts, "h1", "h2", "lane")
                .withColumn("_first", F.first("id").over(
                    Window.partitionBy("h1", "h2", "lane").orderBy("id", "pos")
                    .rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    streamed = cut(streamed)
    late = streamed.where("id > _first").select("id", "pos")
    heads = streamed.where("id = _first").select("h1", "h2", "id", "pos")
    least_id = heads.groupBy("h1", "h2").agg(F.min("id").alias("_lo"), F.max("id").alias("_hi")).where("_lo < _hi")
    later = heads.join(least_id, ["h1", "h2"]).where("id > _lo").select("id", "pos")
    return late.unionByName(later)


def keep_bitmaps(dropped: DataFrame) -> DataFrame:
    """``id, n_dropped, keep``: ``keep`` is an ordered list of (word, bits of kept lines)."""
    words = (dropped.groupBy("id", F.shiftright("pos", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, pos & 63)")).alias("gone")))
    return words.groupBy("id").agg(
        F.sum(F.bit_count("gone")).cast("bigint").alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("gone").alias("bits")))).alias("keep"))


def dedup_bitmaps(docs: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = 10) -> DataFrame:
    """Bitmaps of the documents that lose a line."""
    return keep_bitmaps(dropped_lines(docs, id_col, text, least))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text: str = "text",
                  out: str = "kept_text") -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and the text of the kept lines."""
    marks = bitmaps.select(F.col("id").alias("_id"), F.col("n_dropped").alias("_gone"),
                           F.map_from_entries("keep").alias("_keep"))
    joined = docs.join(marks, docs[id_col] == marks["_id"], "left")
    lines = _split(F.col(text))
    def kept(line: Column, i: Column) -> Column:
        word = F.try_element_at(F.col("_keep"), F.shiftright(i, 6))
        return word.isNull() | (F.call_function("getbit", word, i.bitwiseAND(F.lit(63))) == 1)
    result = F.when(F.col("_keep").isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(
        F.array_join(F.filter(lines, kept), "\n"))
    new = {"n_lines": F.size(lines).cast("bigint"), "n_dropped": F.coalesce(F.col("_gone"), F.lit(0)).cast("bigint"),
           out: result}
    return joined.select(*[c for c in docs.columns if c not in new], *[v.alias(k) for k, v in new.items()])
