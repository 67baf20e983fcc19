"""Coercion and name clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(c: Column, fill: float | None = None) -> Column:
    """Text to double; invalid text becomes null (or ``fill``)."""
    v = c.try_cast("double")
    return F.coalesce(v, F.lit(float(fill))) if fill is not None else v


def to_count(c: Column, fill: int | None = None) -> Column:
    """Text to BIGINT count; invalid text becomes null (or ``fill``)."""
    v = c.try_cast("bigint")
    return F.coalesce(v, F.lit(int(fill))) if fill is not None else v


def sanitize_word(c: Column) -> Column:
    """Runs of non-word characters to one ``_``; ``(?U)`` makes ``\\W``
    Unicode-aware like Python's ``re``."""
    return F.regexp_replace(c, r"(?U)\W+", "_")


def sanitize_filename(c: Column) -> Column:
    """Space to ``_`` and drop ``,:;.`` (publication file names)."""
    return F.translate(c, " ,:;.", "_")


def bytes_to_mb(c: Column, scale: int = 4) -> Column:
    return F.round(c / F.lit(1048576.0), scale)
