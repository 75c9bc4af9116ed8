"""Attribute strings: GFF ``k=v;`` lists and SAM tags."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def gff_attributes(text: Column) -> Column:
    """Nine-column GFF attribute text as a map; the last of repeated keys wins."""
    pairs = F.filter(F.split(text, ";"), lambda p: p.contains("="))
    entries = F.transform(
        pairs,
        lambda p: F.struct(F.trim(F.substring_index(p, "=", 1)).alias("key"),
                           F.substring(p, F.instr(p, "=") + 1, F.length(p)).alias("value")),
    )
    keys = F.transform(entries, lambda e: e["key"])
    last = F.filter(entries, lambda e, i: F.array_position(
        F.slice(keys, i + 2, F.size(keys)), e["key"]) == 0)
    once = F.size(F.array_distinct(keys)) == F.size(keys)
    return F.map_from_entries(F.when(once, entries).otherwise(last))


def single_attribute(text: Column, key: str) -> Column:
    """Value of ``key`` when it occurs exactly once, else NULL."""
    found = F.regexp_extract_all(text, F.lit(rf"(?:^|;)\s*{key}=([^;]+)"), F.lit(1))
    return F.when(F.size(found) == 1, F.element_at(found, 1))


def without_version(identifier: Column) -> Column:
    return F.regexp_replace(identifier, r"\.[^.]*$", "")


def sam_tag(line: Column, tag: str, kind: str = "i") -> Column:
    """Typed SAM tag such as ``AS:i:`` or ``PI:f:`` from the whole line."""
    return F.regexp_extract(line, rf"(?:^|\t){tag}:{kind}:([^\t]+)", 1)
