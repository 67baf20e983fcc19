"""Row filters: catalogue selection, region-length rules, every n-th row."""

from __future__ import annotations

import logging
from functools import reduce
from typing import Any, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from repforge.functions.regions import (INGEST_LENGTHS, SECOND_ROUND_LENGTHS,
                                        ingest_length_predicate, second_round_predicate)

log = logging.getLogger(__name__)


def catalogue_predicate(df: DataFrame, filters: Mapping[str, Any]) -> Column:
    """AND of the configured filters, in order.

    A list means membership (an empty list keeps nothing); a mapping with
    ``min``/``max`` means an inclusive range (text columns compared as
    numbers, invalid text never matches); any other value (e.g. ``None`` when
    every entry is commented out) is ignored. An unknown column is an error.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    preds: list[Column] = []
    for key, values in filters.items():
        if key not in fields:
            raise KeyError(f"filter column {key!r} is not in the catalogue")
        c = F.col(key)
        if isinstance(values, (list, tuple)):
            preds.append(c.isin(list(values)) if values else F.lit(False))
        elif isinstance(values, Mapping):
            v = c.try_cast("double") if isinstance(fields[key], StringType) else c
            if "min" in values:
                preds.append(v >= F.lit(values["min"]))
            if "max" in values:
                preds.append(v <= F.lit(values["max"]))
    return reduce(lambda a, b: a & b, preds, F.lit(True))


def select_units(catalogue: DataFrame, filters: Mapping[str, Any],
                 warn_if_empty: bool = False) -> DataFrame:
    """Download list ``File_index, Download_Link`` of the units that pass.
    The predicate reaches the catalogue scan (Catalyst pushdown)."""
    out = (catalogue.where(catalogue_predicate(catalogue, filters))
                    .select("File_index", "Download_Link"))
    if warn_if_empty and out.isEmpty():
        log.warning("no catalogue rows match %s", dict(filters))
    return out


def write_download_list(units: DataFrame, path: str) -> None:
    """``File_index,Download_Link`` CSV with a header (unquoted values)."""
    units.write.mode("overwrite").option("header", True).option("quote", "\u0000").csv(path)


def region_length_ingest(df: DataFrame, enabled: bool = True,
                         ranges: Mapping[str, tuple[int, int]] | None = None) -> DataFrame:
    """Ingest filter: every listed region non-blank with length in range.
    ``enabled=False`` is the variant without a length filter."""
    if not enabled:
        return df
    return df.where(ingest_length_predicate(dict(ranges or INGEST_LENGTHS)))


def region_length_second(df: DataFrame,
                         ranges: Mapping[str, tuple[int, int]] | None = None) -> DataFrame:
    """Second-round filter: all seven regions present, lengths in range."""
    return df.where(second_round_predicate(dict(ranges or SECOND_ROUND_LENGTHS)))


def species_filter(df: DataFrame, species: str | list | None) -> DataFrame:
    """Equality for one species, membership for a list, nothing for None."""
    if not species:
        return df
    if isinstance(species, (list, tuple)):
        return df.where(F.col("Species").isin(list(species)))
    return df.where(F.col("Species") == species)
