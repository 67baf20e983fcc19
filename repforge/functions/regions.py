"""Antibody regions: names, concatenation and length rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The seven regions in biological order, as named in the
# sequence tables.
REGIONS = ["fwr1_aa", "cdr1_aa", "fwr2_aa", "cdr2_aa", "fwr3_aa", "cdr3_aa", "fwr4_aa"]

# Our fixed slicing of a residue string into regions for the derived view:
# (1-based start, length); length 0 = to the end of the string.
REGION_SLICES = [(1, 25), (26, 8), (34, 17), (51, 8), (59, 38), (97, 14), (111, 0)]

# Inclusive length ranges of the ingest filter (data units).
INGEST_LENGTHS = {
    "fwr1_aa": (20, 50),
    "fwr4_aa": (10, 50),
    "cdr1_aa": (5, 12),
    "cdr2_aa": (1, 10),
    "cdr3_aa": (5, 38),
}

# Inclusive length ranges of the second-round filter.
SECOND_ROUND_LENGTHS = {
    "fwr1_aa": (20, 200),
    "cdr1_aa": (5, 12),
    "cdr2_aa": (1, 10),
    "cdr3_aa": (5, 38),
    "fwr4_aa": (10, 200),
}


def concat_regions(regions: list[str] | None = None) -> Column:
    """The full sequence: the regions joined in order, missing ones as ''."""
    cols = [F.coalesce(F.col(r), F.lit("")) for r in (regions or REGIONS)]
    return F.concat(*cols)


def _and_all(preds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, preds, F.lit(True))


def ingest_length_predicate(ranges: dict | None = None) -> Column:
    """Non-blank and length within range, for every listed region."""
    preds = []
    for name, (lo, hi) in (ranges or INGEST_LENGTHS).items():
        c = F.col(name)
        preds.append(c.isNotNull() & ~c.rlike(r"^\s*$") & F.length(c).between(lo, hi))
    return _and_all(preds)


def second_round_predicate(ranges: dict | None = None,
                           required: list[str] | None = None) -> Column:
    """All regions present, and length within range for the listed ones."""
    preds = [F.col(r).isNotNull() for r in (required or REGIONS)]
    for name, (lo, hi) in (ranges or SECOND_ROUND_LENGTHS).items():
        preds.append(F.length(F.col(name)).between(lo, hi))
    return _and_all(preds)
