"""Base-level text functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The complement of each base, case preserved; N stays N.
BASES = "ACGTacgt"
COMPLEMENT = "TGCAtgca"


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, BASES, COMPLEMENT))


def canonical(kmer: Column) -> Column:
    """The larger of a k-mer and its reverse complement, in upper case."""
    up = F.upper(kmer)
    return F.greatest(up, reverse_complement(up))


def encode_kmer(kmer: Column) -> Column:
    """Two bits per base (A=0 C=1 G=2 T=3), so numeric order equals text order."""
    return F.conv(F.translate(F.upper(kmer), "ACGT", "0123"), 4, 10).cast("bigint")


def decode_kmer(code: Column, k: int = 31) -> Column:
    digits = F.lpad(F.conv(code.cast("string"), 10, 4), k, "0")
    return F.translate(digits, "0123", "ACGT")


def count_of(text: Column, chars: str) -> Column:
    """How many characters of ``text`` belong to ``chars``."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def gc_count(seq: Column) -> Column:
    return count_of(seq, "GC")


def gc_in_range(kmer: Column, k: int = 31, low: float = 0.3, high: float = 0.7) -> Column:
    gc = gc_count(kmer)
    return (gc > F.lit(low * k)) & (gc < F.lit(high * k))


def unique_bases(seq: Column) -> Column:
    """Upper-case (not soft-masked) letters."""
    return F.length(F.regexp_replace(seq, "[^A-Z]", ""))


def ambiguous_bases(seq: Column) -> Column:
    return count_of(F.upper(seq), "N")


def _words(seq: Column, size: int) -> Column:
    starts = F.sequence(F.lit(1), F.greatest(F.length(seq) - (size - 1), F.lit(1)))
    return F.transform(starts, lambda i: F.substring(seq, i, F.lit(size)))


def max_word_count(seq: Column, size: int) -> Column:
    """Occurrences (overlaps included) of the commonest word of ``size`` bases."""
    words = _words(seq, size)
    counts = F.transform(
        F.array_distinct(words),
        lambda w: F.size(F.filter(words, lambda x: x == w)),
    )
    return F.when(F.length(seq) >= size, F.array_max(counts)).otherwise(F.lit(0))


def low_complexity(kmer: Column, max_di: int = 9, max_tri: int = 6) -> Column:
    """True when a 2-mer occurs more than 9 times or a 3-mer more than 6 times."""
    return (max_word_count(kmer, 2) > max_di) | (max_word_count(kmer, 3) > max_tri)


def slice_bases(seq: Column, start: Column, end: Column, strand: Column) -> Column:
    """0-based half-open slice, clamped at 0, reverse-complemented on ``-``."""
    first = F.greatest(start, F.lit(0)).cast("int")
    text = F.substring(seq, first + 1, F.greatest(end.cast("int") - first, F.lit(0)))
    return F.when(strand == "-", reverse_complement(text)).otherwise(text)
