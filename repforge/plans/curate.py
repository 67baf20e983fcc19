"""The curation chain as one function: select units -> ingest -> cluster
-> representatives -> sample -> split -> tokenise. Each stage is a
DataFrame function; the chain materialises only where ids must be stable
(after ingest) or the work is iterative (clustering)."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repforge.functions.regions import concat_regions
from repforge.operators import cluster as clu
from repforge.operators import sampling, splits
from repforge.operators.filters import select_units
from repforge.operators.groups import assign_groups
from repforge.session import materialize
from repforge.sources import corpus, fused
from repforge.sources import units as U

# Default kept columns and stage parameters of the workflow.
DEFAULT_COLUMNS = ["locus", "fwr1_aa", "cdr1_aa", "fwr2_aa", "cdr2_aa", "fwr3_aa", "cdr3_aa",
                   "fwr4_aa", "v_call", "d_call", "j_call", "Redundancy"]


@dataclass
class CurateConfig:
    filters: dict[str, Any] = field(default_factory=lambda: {"Species": ["human"],
                                                              "Chain": ["Heavy"]})
    columns_to_keep: list[str] = field(default_factory=lambda: list(DEFAULT_COLUMNS))
    filter_by_region_length: bool = True
    n_lines: int = 1
    similarity: float = 0.9
    coverage: float = 0.9
    band: int = 8  # gaps: places off a diagonal
    sampling_scheme: str = "random"
    total_sequences: int = 1110000
    split_mode: str = "numbers"
    training: float = 1000000
    validation: float = 10000
    no_seqs_to_use: int = 0
    seed: int = 42


def ingest_selected(spark: SparkSession, catalogue: DataFrame, unit_paths: DataFrame,
                    cfg: CurateConfig) -> DataFrame:
    """Read only the selected units (the filter chooses files before any
    row is read) and build the sequences table with stable ids. A selected
    unit without a path, or a file that gives no line, is an error."""
    units = select_units(catalogue, cfg.filters).join(unit_paths, "File_index", "left")
    chosen = [(r.File_index, r.path) for r in units.select("File_index", "path").collect()]  # one per unit
    if not chosen:
        raise ValueError("no data units match the filters")
    lost = [i for i, path in chosen if path is None]
    if lost:
        raise ValueError(f"{len(lost)} selected units have no path, e.g. {lost[:5]}")
    ids = spark.createDataFrame([(U.file_uri(spark, path), i) for i, path in chosen], "uri string, File_ID long")
    return fused.ingest(fused.unit_lines(spark, [path for _, path in chosen]), cfg.columns_to_keep, cfg.n_lines,
                        cfg.filter_by_region_length, ids=ids)


def curate(spark: SparkSession, catalogue: DataFrame, unit_paths: DataFrame,
           cfg: CurateConfig) -> DataFrame:
    """(Sequence_ID, split, input_ids, attention_mask, special_tokens_mask,
    text) for the curated corpus. ``unit_paths`` maps File_index -> path."""
    seqs = materialize(ingest_selected(spark, catalogue, unit_paths, cfg), "sequences")
    seqs = seqs.withColumn("sequence", concat_regions())
    assignment = clu.cluster(seqs.select("Sequence_ID", "sequence"),
                             similarity=cfg.similarity, coverage=cfg.coverage, band=cfg.band)
    reps = materialize(clu.representatives(seqs, assignment), "representatives")
    picked = sampling.sample(reps, cfg.sampling_scheme, cfg.total_sequences, catalogue, cfg.seed)
    if cfg.split_mode == "numbers":
        parts = splits.split_numbers(picked, int(cfg.training), int(cfg.validation),
                                     seed=cfg.seed, cap=cfg.no_seqs_to_use)
    elif cfg.split_mode == "fraction":
        parts = splits.split_fraction(picked, cfg.training, cfg.validation, seed=cfg.seed,
                                      cap=cfg.no_seqs_to_use)
    else:
        raise ValueError(f"unknown split mode {cfg.split_mode!r}")
    return corpus.tokenize_corpus(parts, "sequence", keep=["Sequence_ID", "split", "sequence"])
