"""Catalogue sources: the catalogue CSV and the raw per-unit catalogue lines
(``wget <url>, "<json>", <size> MB``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

TEXT_FIELDS = ["Download_Link", "Species", "Author", "BSource", "BType", "Longitudinal",
               "Age", "Disease", "Subject", "Vaccine", "Chain", "Isotype"]
COUNT_FIELDS = ["Unique_sequences", "Total_sequences"]

# Raw schema: counts and size stay text until coerced (they may hold 'n/a').
CATALOGUE_RAW_SCHEMA = StructType(
    [StructField("File_index", LongType())]
    + [StructField(f, StringType()) for f in TEXT_FIELDS]
    + [StructField(f, StringType()) for f in COUNT_FIELDS]
    + [StructField("Size_MB", StringType())])


def coerce_catalogue(df: DataFrame) -> DataFrame:
    """Counts to BIGINT and size to DECIMAL(18,4); invalid text -> null."""
    out = df
    for f in COUNT_FIELDS:
        out = out.withColumn(f, F.col(f).try_cast("bigint"))
    return out.withColumn("Size_MB", F.col("Size_MB").try_cast("decimal(18,4)"))


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Catalogue CSV, bound by the names in its header: columns may come in
    any order, extra ones are ignored, a missing one is an error. Quoted
    commas (``"Doe et al., 2019"``) are handled by the CSV reader. All
    columns are read as text (no inference pass) and then coerced."""
    raw = spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    missing = [f.name for f in CATALOGUE_RAW_SCHEMA.fields if f.name not in raw.columns]
    if missing:
        raise ValueError(f"the catalogue lacks the columns {missing}; it has {raw.columns}")
    return coerce_catalogue(raw.select(*[F.col(f.name).try_cast(f.dataType.simpleString()).alias(f.name)
                                         for f in CATALOGUE_RAW_SCHEMA.fields]))


def write_catalogue(catalogue: DataFrame, path: str) -> None:
    """The catalogue as CSV with a header."""
    catalogue.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def catalogue_to_csv_lines(catalogue: DataFrame) -> DataFrame:
    """Render catalogue rows as CSV text lines (``value``)."""
    cols = [F.col(f.name).cast("string").alias(f.name) for f in CATALOGUE_RAW_SCHEMA.fields]
    return catalogue.select(F.to_csv(F.struct(*cols)).alias("value"))


def catalogue_from_csv_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Parse CSV text lines with the declared schema, then coerce."""
    parsed = lines.select(F.from_csv(F.col(col), CATALOGUE_RAW_SCHEMA.simpleString()).alias("r"))
    return coerce_catalogue(parsed.select("r.*"))


# ------------------------------------------------------------ raw lines
# The raw catalogue line pattern (url, JSON, size in MB).
RAW_LINE_PATTERN = r'^wget (\S+), "(.*?)", ([\d.]+) MB$'
METADATA_FIELDS = ["Species", "Author", "Subject", "Chain", "Isotype", "Age"]
METADATA_SCHEMA = StructType([StructField(f, StringType()) for f in METADATA_FIELDS])


def _json_text(c: Column) -> Column:
    return F.regexp_replace(c, '""', '"')


def parse_catalogue_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Good raw lines as catalogue rows: ``Download_Link``, the declared
    metadata fields (extra keys ignored, missing ones null) and ``Size_MB``."""
    line = F.trim(F.col(col))
    js = _json_text(F.regexp_extract(line, RAW_LINE_PATTERN, 2))
    d = lines.select(
        line.rlike(RAW_LINE_PATTERN).alias("_ok"),
        F.regexp_extract(line, RAW_LINE_PATTERN, 1).alias("Download_Link"),
        F.from_json(js, "map<string,string>").alias("_m"),
        F.from_json(js, METADATA_SCHEMA).alias("_meta"),
        F.regexp_extract(line, RAW_LINE_PATTERN, 3).alias("_size"))
    good = d.where(F.col("_ok") & F.col("_m").isNotNull())
    return good.select("Download_Link", *[F.col(f"_meta.{f}").alias(f) for f in METADATA_FIELDS],
                       F.col("_size").try_cast("decimal(18,4)").alias("Size_MB"))


def bad_catalogue_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Lines that are skipped, with the reason."""
    line = F.trim(F.col(col))
    js = _json_text(F.regexp_extract(line, RAW_LINE_PATTERN, 2))
    ok = line.rlike(RAW_LINE_PATTERN)
    parsed = F.from_json(js, "map<string,string>")
    return (lines.select(line.alias("line"),
                         F.when(~ok, "invalid line").when(parsed.isNull(), "malformed json")
                          .alias("reason"))
                 .where(F.col("reason").isNotNull()))


def read_catalogue_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)
