"""Repertoire-shaped views derived from the driver tables.

The library itself works on any DataFrame with the documented schema; these
views give the registered queries real inputs whose size grows with the
tables. Each rule here has a twin in ``repforge.plans.oracles`` (DuckDB SQL)
written from the same definition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repforge.functions.regions import REGION_SLICES, REGIONS
from repforge.sources.tables import spread, table


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per data unit (customer joined with nation).

    Counts are text, as in the raw catalogue, and every 17th unit carries
    ``'n/a'`` so the coercion path is exercised.
    """
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    # nation is a fixed 25-row dimension: broadcasting it is size-bounded.
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "inner")
    key = F.col("c_custkey")
    count_text = F.floor(F.abs(F.col("c_acctbal"))).cast("bigint")
    na = (key % 17) == 0
    return j.select(
        key.alias("File_index"),
        F.concat(F.lit("https://units.example.org/unit_"), key.cast("string"),
                 F.lit(".csv.gz")).alias("Download_Link"),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", "human")
         .when(F.col("c_mktsegment") == "BUILDING", "mouse")
         .when(F.col("c_mktsegment") == "FURNITURE", "mouse_BALB/c")
         .when(F.col("c_mktsegment") == "HOUSEHOLD", "rat")
         .otherwise("rabbit").alias("Species"),
        F.concat(F.col("n_name"), F.lit(" et al., "),
                 (F.col("n_nationkey") + 2000).cast("string")).alias("Author"),
        F.lit("PBMC").alias("BSource"),
        F.when(key % 3 == 0, "Naive-B-Cells").when(key % 3 == 1, "Memory-B-Cells")
         .otherwise("Unsorted-B-Cells").alias("BType"),
        F.lit("no").alias("Longitudinal"),
        F.when(key % 13 == 0, "no").otherwise((key % 60 + 18).cast("string")).alias("Age"),
        F.when(key % 4 == 0, "SARS-COV-2").otherwise("None").alias("Disease"),
        F.when(key % 10 == 0, "no")
         .otherwise(F.concat(F.lit("Subject-"), (key % 40).cast("string"))).alias("Subject"),
        F.lit("None").alias("Vaccine"),
        F.when(key % 2 == 0, "Heavy").otherwise("Light").alias("Chain"),
        F.when(key % 5 == 0, "IGHG").when(key % 5 == 1, "IGHM").when(key % 5 == 2, "IGHA")
         .when(key % 5 == 3, "Bulk").alias("Isotype"),
        F.when(na, "n/a").otherwise(count_text.cast("string")).alias("Unique_sequences"),
        F.when(na, "n/a").otherwise((count_text * 2).cast("string")).alias("Total_sequences"),
        (F.abs(F.col("c_acctbal").cast("decimal(18,2)")) / 100).cast("decimal(18,4)").alias("Size_MB"),
    )


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence ids and their data unit: ``orders`` as (Sequence_ID, File_ID)."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Sequence_ID"), F.col("o_custkey").alias("File_ID"))


def residue_text(c: Column) -> Column:
    """Only the twenty standard amino-acid letters, in upper case. One pass:
    case changes nothing about which ASCII letters stay, and the others
    (whose upper case may be ASCII) go before it."""
    return F.upper(F.regexp_replace(c, "[^ACDEFGHIKLMNPQRSTVWYacdefghiklmnpqrstvwy]+", ""))


LINE_ID_STRIDE = 100000  # Sequence_ID = doc_id * stride + line number


def residues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Residue sequences: every line of every document (whole texts, no
    prefix), reduced to amino-acid letters; empty lines are dropped.

    Columns follow the sequences table: ids, ``locus``, the seven regions as
    fixed slices (the last one takes the rest), the gene calls,
    ``Redundancy``, plus the full ``sequence``.
    """
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    # The residue text is computed inside the exploded array: a generator's
    # output is never inlined by filter pushdown, so the regexes run once
    # per line instead of once per region predicate.
    lines = d.select("doc_id", "lang", "source", F.posexplode(
        F.transform(F.split(F.col("text"), "\n"), residue_text)).alias("line_no", "sequence"))
    seq = lines.where(F.length("sequence") > 0)
    regions = [F.nullif(F.substring("sequence", start, length), F.lit("")).alias(name)
               if length else F.nullif(F.expr(f"substr(sequence, {start})"), F.lit("")).alias(name)
               for name, (start, length) in zip(REGIONS, REGION_SLICES)]
    # ids stay unique only while a document has fewer lines than the
    # stride; a longer document stops the job instead of colliding ids
    line_id = F.when(F.col("line_no") < LINE_ID_STRIDE,
                     F.col("doc_id") * LINE_ID_STRIDE + F.col("line_no")).otherwise(
        F.raise_error(F.lit(f"document with {LINE_ID_STRIDE} or more lines")).cast("bigint"))
    return seq.select(
        line_id.alias("Sequence_ID"),
        F.regexp_extract("source", "([0-9]+)", 1).try_cast("bigint").alias("File_ID"),
        F.when(F.col("lang") == "en", "H").when(F.col("lang") == "fr", "K")
         .otherwise("L").alias("locus"),
        *regions,
        F.concat(F.lit("IGHV"), (F.col("doc_id") % 7 + 1).cast("string")).alias("v_call"),
        F.concat(F.lit("IGHD"), (F.col("line_no") % 5 + 1).cast("string")).alias("d_call"),
        F.concat(F.lit("IGHJ"), (F.col("doc_id") % 6 + 1).cast("string")).alias("j_call"),
        (F.col("line_no") % 20 + 1).cast("int").alias("Redundancy"),
        "sequence",
    )


def losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-batch evaluation losses: (model, test_set, rank, batch, loss)."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return e.select(
        F.col("event_type").alias("model"),
        F.concat(F.lit("set"), (F.col("user_id") % 4).cast("string")).alias("test_set"),
        (F.col("event_id") % 3).cast("int").alias("rank"),
        F.col("event_id").alias("batch"),
        F.col("value").alias("loss"),
    )


def _numbering_entries(region: str, offset: int) -> Column:
    """``'<pos><ins>': '<residue>'`` for every residue of ``region``; every
    third position carries insertion letter ``A``, the others a space."""
    c = F.col(region)
    idx = F.sequence(F.lit(0), F.length(c) - 1)
    entry = F.transform(idx, lambda i: F.concat(
        F.lit("'"), (i + offset + 1).cast("string"),
        F.when(i % 3 == 2, F.lit("A")).otherwise(F.lit(" ")),
        F.lit("': '"), F.substring(c, i + 1, 1), F.lit("'")))
    return F.when(F.length(c) > 0, F.array_join(entry, ", "))


def with_numbering_text(res: DataFrame) -> DataFrame:
    """Add ``ANARCI_numbering``: Python-literal text of
    ``{'fwh1': {...}, 'cdrh3': {...}}`` built from fwr1 and cdr3; every 11th
    sequence gets a truncated (unparsable) text."""
    text = F.concat(F.lit("{'fwh1': {"), _numbering_entries("fwr1_aa", 0),
                    F.lit("}, 'cdrh3': {"), _numbering_entries("cdr3_aa", 104), F.lit("}}"))
    broken = F.expr("substr(t, 1, length(t) - 1)")
    out = res.withColumn("t", text)
    return out.withColumn("ANARCI_numbering",
                          F.when(F.col("Sequence_ID") % 11 == 0, broken).otherwise(F.col("t"))
                          ).drop("t")
