"""Residue numbering maps: parse the text form and list base positions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBERING_TYPE = "map<string,map<string,string>>"


def parse_numbering(c: Column) -> Column:
    """``{region: {position: residue}}`` text (Python-literal quoting) to a
    nested map; null or unparsable text gives null."""
    return F.from_json(F.trim(c), NUMBERING_TYPE, {"allowSingleQuotes": "true"})


def numbering_positions(m: Column) -> Column:
    """Sorted base position numbers of every key of every region: insertion
    letters and spaces dropped, duplicates kept, keys without digits skipped."""
    keys = F.flatten(F.transform(F.map_values(m), lambda region: F.map_keys(region)))
    digits = F.transform(keys, lambda k: F.regexp_replace(k, "[^0-9]", ""))
    kept = F.filter(digits, lambda d: d != F.lit(""))
    return F.array_sort(F.transform(kept, lambda d: d.cast("int")))
