"""Column expressions and Arrow helpers shared by the text operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

# The white space that separates words, and the letters that are lower-cased.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def word_count(text: Column) -> Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` does just that on pure ASCII and is much faster."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower()))


def unit_hash(seed: int, key: Column) -> Column:
    """A number in [0, 1) from 52 bits of the MD5 of seed and key."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("bigint").cast("double") / F.lit(float(1 << 52))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over a 64-bit word."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def utf8_rows(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_string()).cast(pa.large_binary()).to_pylist()
