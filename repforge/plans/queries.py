"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame
built from the views over the driver tables. Parameters are fixed here so
that the same query runs at every scale factor; none of them caps rows.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repforge.functions.coerce import sanitize_filename, sanitize_word, to_count
from repforge.operators import aggregates as agg
from repforge.operators import groups, sampling, splits
from repforge.operators.filters import select_units
from repforge.session import materialize, scratch_path
from repforge.sources import views

# The mouse strain list of the isotype statistics.
MOUSE_STRAINS = ["mouse_C57BL/6", "mouse_BALB/c", "mouse", "Kymouse", "HIS-Mouse",
                 "mouse_RAG2-GFP/129Sve", "mouse_Swiss-Webster"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# Fixed parameters of the registered queries (chosen so every query has rows
# at sf0.001 .. sf0.1; see SURVEY §7.2).
UNIT_FILTERS = {"Species": ["human", "mouse"], "Chain": ["Heavy"],
                "Unique_sequences": {"min": 1000, "max": 8000}}
MIN_SUBJECT_ROWS = 350
SAMPLE_N = 1000
BALANCED_INDIVIDUALS_TOTAL = 300
BALANCED_PUBLICATIONS_TOTAL = 500
ROUND_ROBIN_TOTAL = 5000
SPLIT_TRAIN, SPLIT_VAL = 1000, 100
SPLIT_CAP = 1200
TRAIN_FRACTION, VAL_FRACTION = 0.8, 0.1
K_FOLDS = 5


# ---------------------------------------------------------------- catalogue
@query("select_units")
def q_select_units(spark, sf):
    return select_units(views.catalogue(spark, sf), UNIT_FILTERS)


@query("rows_per_file")
def q_rows_per_file(spark, sf):
    return groups.rows_per_file(views.sequences(spark, sf))


@query("rows_per_subject")
def q_rows_per_subject(spark, sf, min_rows: int = MIN_SUBJECT_ROWS):
    return groups.rows_per_subject(views.sequences(spark, sf), views.catalogue(spark, sf), min_rows)


@query("read_catalogue")
def q_read_catalogue(spark, sf):
    """S1: the catalogue written as CSV with its columns in another order
    and one more column, read back by column name, counts coerced."""
    from repforge.sources.catalogue import read_catalogue, write_catalogue
    written = views.catalogue(spark, sf)
    path = scratch_path(spark, "catalogue-csv")
    write_catalogue(written.select(F.lit("x, y").alias("Remark"), *sorted(written.columns, reverse=True)), path)
    return read_catalogue(spark, path).select(
        "File_index", "Species", "Author", "Subject", "Chain", "Isotype", "Unique_sequences", "Total_sequences",
        F.col("Size_MB").cast("double").alias("Size_MB"))


@query("coerce_counts")
def q_coerce_counts(spark, sf):
    c = views.catalogue(spark, sf)
    return c.select("File_index",
                    to_count(F.col("Unique_sequences"), 0).alias("Unique_sequences"),
                    to_count(F.col("Total_sequences"), 0).alias("Total_sequences"),
                    F.col("Age").try_cast("double").alias("Age"))


@query("sanitize_names")
def q_sanitize_names(spark, sf):
    c = views.catalogue(spark, sf).select("Author").distinct()
    return c.select("Author", sanitize_word(F.col("Author")).alias("author_word"),
                    sanitize_filename(F.col("Author")).alias("author_file"))


@query("size_by_author")
def q_size_by_author(spark, sf):
    s = agg.grouped_sum(views.catalogue(spark, sf), ["Author"], "Size_MB")
    return s.withColumn("Size_MB", F.col("Size_MB").cast("double"))


@query("total_by_author")
def q_total_by_author(spark, sf):
    return agg.grouped_sum(views.catalogue(spark, sf), ["Author"], "Total_sequences")


@query("unique_by_author")
def q_unique_by_author(spark, sf):
    return agg.grouped_sum(views.catalogue(spark, sf), ["Author"], "Unique_sequences")


@query("unique_by_subject")
def q_unique_by_subject(spark, sf):
    return agg.grouped_sum(views.catalogue(spark, sf), ["Subject", "Author"], "Unique_sequences")


@query("unique_by_subject_human")
def q_unique_by_subject_human(spark, sf):
    c = views.catalogue(spark, sf).where(F.col("Species") == "human")
    return agg.grouped_sum(c, ["Subject", "Author"], "Unique_sequences")


@query("unique_by_species_chain")
def q_unique_by_species_chain(spark, sf):
    return agg.grouped_sum(views.catalogue(spark, sf), ["Species", "Chain"], "Unique_sequences")


@query("unique_by_species")
def q_unique_by_species(spark, sf):
    s = agg.grouped_sum(views.catalogue(spark, sf), ["Species"], "Unique_sequences")
    return s.orderBy(F.col("Unique_sequences").desc(), "Species")


@query("catalogue_report")
def q_catalogue_report(spark, sf):
    """A3, A3a-d and A9 together from one scan."""
    return agg.catalogue_report(views.catalogue(spark, sf))


@query("species_chain_pivot")
def q_species_chain_pivot(spark, sf):
    return agg.pivot_sum(views.catalogue(spark, sf), "Species", "Chain", ["Heavy", "Light"],
                         "Unique_sequences")


def _rounded(df, digits, *cols):
    """Rounded for comparison with another engine; operators do not round."""
    for c in cols:
        df = df.withColumn(c, F.round(c, digits))
    return df


def _percent(df):
    return _rounded(df, 6, "Percentage_Unique_Sequences", "Percentage_Total_Sequences")


@query("isotype_stats_all")
def q_isotype_all(spark, sf):
    return _percent(agg.isotype_stats(views.catalogue(spark, sf)))


@query("isotype_stats_human")
def q_isotype_human(spark, sf):
    return _percent(agg.isotype_stats(views.catalogue(spark, sf), "human"))


@query("isotype_stats_mouse")
def q_isotype_mouse(spark, sf):
    return _percent(agg.isotype_stats(views.catalogue(spark, sf), MOUSE_STRAINS))


@query("author_count")
def q_author_count(spark, sf):
    return agg.author_count(views.catalogue(spark, sf))


@query("authors")
def q_authors(spark, sf):
    return agg.authors(views.catalogue(spark, sf))


@query("authors_without_subject")
def q_authors_without_subject(spark, sf):
    return agg.authors_without_subject(views.catalogue(spark, sf))


@query("subjects_in_many_publications")
def q_subjects_many(spark, sf):
    return agg.subjects_in_many_publications(views.catalogue(spark, sf))


@query("total_size")
def q_total_size(spark, sf):
    return agg.total_size(views.catalogue(spark, sf))


@query("subject_size_histogram")
def q_subject_size_histogram(spark, sf):
    return agg.subject_size_histogram(views.catalogue(spark, sf))


@query("age_histogram")
def q_age_histogram(spark, sf):
    return _rounded(agg.age_histogram(views.catalogue(spark, sf)), 6, "lower", "upper")


# ------------------------------------------------------------ groups/joins
@query("sequences_per_publication")
def q_sequences_per_publication(spark, sf):
    s = groups.sequences_per_group(views.sequences(spark, sf), views.catalogue(spark, sf),
                                   "publication")
    return s.select(F.col(groups.GROUP_COL).alias("Author"), "n_sequences")


def _group_files(spark, sf, by):
    """One CSV folder per group, written and read back."""
    path = scratch_path(spark, f"groups-{by}")
    seqs = groups.assign_groups(views.sequences(spark, sf), views.catalogue(spark, sf), by)
    groups.write_groups(seqs, path, by, fmt="csv")
    return spark.read.schema("Sequence_ID bigint, File_ID bigint, group_key string, group_file string").option(
        "header", True).csv(path)


def _rows_per_file(files):
    return files.groupBy(F.col("group_file").alias("Filename")).agg(
        F.count(F.lit(1)).alias("Number_of_sequences"))


@query("partition_by_individual")
def q_partition_by_individual(spark, sf):
    """K4: rows of every individual's file, from the written files."""
    return _rows_per_file(_group_files(spark, sf, "individual"))


@query("partition_by_publication")
def q_partition_by_publication(spark, sf):
    """K5: rows of every publication's file, from the written files."""
    return _rows_per_file(_group_files(spark, sf, "publication"))


@query("publication_file_rows")
def q_publication_file_rows(spark, sf):
    """K5: the rows themselves, from the written files."""
    return _group_files(spark, sf, "publication").select("group_file", "Sequence_ID", "File_ID")


@query("units_present_all")
def q_units_present_all(spark, sf):
    """J2: catalogue rows whose unit occurs among the sequences, all of them."""
    return groups.units_present(views.catalogue(spark, sf), views.sequences(spark, sf)).select("File_index", "Author")


@query("group_size_overview")
def q_group_size_overview(spark, sf):
    return groups.group_size_overview(views.sequences(spark, sf), views.catalogue(spark, sf),
                                      "individual")


# ------------------------------------------------------- sampling / splits
@query("sample_exact")
def q_sample_exact(spark, sf):
    return sampling.sample_exact(views.sequences(spark, sf), SAMPLE_N)


@query("sample_balanced_individuals")
def q_sample_balanced_individuals(spark, sf):
    g = groups.assign_groups(views.sequences(spark, sf), views.catalogue(spark, sf), "individual")
    return sampling.sample_balanced(g, BALANCED_INDIVIDUALS_TOTAL)


@query("sample_balanced_publications")
def q_sample_balanced_publications(spark, sf):
    seqs, cat = views.sequences(spark, sf), views.catalogue(spark, sf)
    groups.publication_adequacy(seqs, cat, BALANCED_PUBLICATIONS_TOTAL, raise_on_short=True)
    g = groups.assign_groups(seqs, cat, "publication")
    return sampling.sample_balanced(g, BALANCED_PUBLICATIONS_TOTAL)


@query("publication_adequacy")
def q_publication_adequacy(spark, sf):
    return groups.publication_adequacy(views.sequences(spark, sf), views.catalogue(spark, sf),
                                       BALANCED_PUBLICATIONS_TOTAL)


def _round_robin(spark, sf):
    g = groups.assign_groups(views.sequences(spark, sf), views.catalogue(spark, sf), "individual")
    return g, sampling.sample_round_robin(g, ROUND_ROBIN_TOTAL)


@query("sample_round_robin")
def q_sample_round_robin(spark, sf):
    return _round_robin(spark, sf)[1]


@query("sampling_distribution")
def q_sampling_distribution(spark, sf):
    g, s = _round_robin(spark, sf)
    return sampling.sampling_distribution(s, g)


@query("split_numbers")
def q_split_numbers(spark, sf):
    return splits.split_numbers(views.sequences(spark, sf), SPLIT_TRAIN, SPLIT_VAL)


@query("split_fraction")
def q_split_fraction(spark, sf):
    return splits.split_fraction(views.sequences(spark, sf), TRAIN_FRACTION, VAL_FRACTION)


@query("split_capped")
def q_split_capped(spark, sf):
    return splits.split_numbers(views.sequences(spark, sf), SPLIT_TRAIN, SPLIT_VAL, cap=SPLIT_CAP)


@query("kfold")
def q_kfold(spark, sf):
    return splits.kfold(views.sequences(spark, sf), K_FOLDS)


# ------------------------------------------------- residues and encoding
from repforge.functions.numbering import numbering_positions, parse_numbering  # noqa: E402
from repforge.functions.regions import REGIONS  # noqa: E402
from repforge.operators.masking import mlm_mask  # noqa: E402
from repforge.operators.filters import region_length_ingest, region_length_second  # noqa: E402
from repforge.sources import corpus, fasta  # noqa: E402

# The columns kept from a data unit, in configured order.
COLUMNS_TO_KEEP = ["locus", "fwr1_aa", "cdr1_aa", "fwr2_aa", "cdr2_aa", "fwr3_aa", "cdr3_aa",
                   "fwr4_aa", "v_call", "d_call", "j_call", "Redundancy"]
ID_COLS = ["Sequence_ID", "File_ID"]


def _ints(c):
    """Token arrays rendered as JSON text (``[0,5,6]``) for value comparison."""
    return F.to_json(c)


@query("keep_columns")
def q_keep_columns(spark, sf):
    return views.residues(spark, sf).select(*ID_COLS, *COLUMNS_TO_KEEP)


@query("region_length_ingest")
def q_region_length_ingest(spark, sf):
    return region_length_ingest(views.residues(spark, sf)).select(*ID_COLS, *REGIONS)


@query("region_length_second")
def q_region_length_second(spark, sf):
    return region_length_second(views.residues(spark, sf)).select(*ID_COLS, *REGIONS)


@query("sequence_text")
def q_sequence_text(spark, sf):
    return corpus.sequence_text(views.residues(spark, sf), ["Sequence_ID", "File_ID"])


@query("tokenize")
def q_tokenize(spark, sf):
    text = corpus.sequence_text(views.residues(spark, sf))
    t = corpus.tokenize_corpus(text, keep=["Sequence_ID"])
    return t.select("Sequence_ID", *[_ints(F.col(c)).alias(c) for c in corpus.TOKEN_COLUMNS])


@query("mlm_mask")
def q_mlm_mask(spark, sf):
    text = corpus.sequence_text(views.residues(spark, sf))
    t = corpus.tokenize_corpus(text, keep=["Sequence_ID"])
    m = mlm_mask(t)
    return m.select("Sequence_ID", _ints(F.col("input_ids")).alias("input_ids"),
                    _ints(F.col("labels")).alias("labels"))


@query("numbering_positions")
def q_numbering_positions(spark, sf):
    """Numbering text -> sorted position list, then the second-round filter
    (the order of the reference's numbering step)."""
    r = views.with_numbering_text(views.residues(spark, sf))
    r = r.withColumn("anarci_list", numbering_positions(parse_numbering(F.col("ANARCI_numbering"))))
    r = region_length_second(r.drop("ANARCI_numbering"))
    return r.select("Sequence_ID", F.array_join(F.col("anarci_list").cast("array<string>"), ",")
                    .alias("anarci_list"), F.size("anarci_list").alias("n_positions"))


@query("fasta_records")
def q_fasta_records(spark, sf):
    return fasta.fasta_records(views.residues(spark, sf))


@query("fasta_ids")
def q_fasta_ids(spark, sf):
    lines = fasta.fasta_lines(fasta.fasta_records(views.residues(spark, sf)))
    return fasta.fasta_ids(lines)


# ------------------------------------------------------------- clustering
from repforge.operators import cluster as clu  # noqa: E402


def _residue_seqs(spark, sf):
    return views.residues(spark, sf).select("Sequence_ID", "sequence")


@query("exact_duplicates")
def q_exact_duplicates(spark, sf):
    return clu.exact_duplicates(_residue_seqs(spark, sf)).select("rep_id", "len", "n_copies")


@query("kmer_sketch")
def q_kmer_sketch(spark, sf):
    return clu.kmer_sketch(clu.exact_duplicates(_residue_seqs(spark, sf)))


@query("kmer_candidates")
def q_kmer_candidates(spark, sf):
    return clu.kmer_candidates(clu.kmer_sketch(clu.exact_duplicates(_residue_seqs(spark, sf))))


@query("verified_pairs")
def q_verified_pairs(spark, sf):
    u = materialize(clu.exact_duplicates(_residue_seqs(spark, sf)), "unique-sequences")
    return clu.verified_pairs(clu.kmer_candidates(clu.kmer_sketch(u)), u)



#: Places that a gapped alignment may leave its diagonal.
BAND = 8


@query("verified_pairs_gapped")
def q_verified_pairs_gapped(spark, sf):
    """C1d with gaps: covered candidates that fail on their diagonal are
    aligned again within BAND places of it."""
    u = materialize(clu.exact_duplicates(_residue_seqs(spark, sf)), "unique-sequences")
    return clu.verified_pairs(clu.kmer_candidates(clu.kmer_sketch(u)), u, band=BAND)

@query("cluster_assignments")
def q_cluster_assignments(spark, sf):
    return clu.cluster(_residue_seqs(spark, sf))


@query("cluster_representatives")
def q_cluster_representatives(spark, sf):
    return clu.representative_ids(clu.cluster(_residue_seqs(spark, sf)))


@query("cluster_sizes")
def q_cluster_sizes(spark, sf):
    return clu.cluster_sizes(clu.cluster(_residue_seqs(spark, sf)))


@query("representatives")
def q_representatives(spark, sf):
    """The sequences table restricted to cluster representatives (J1)."""
    res = views.residues(spark, sf)
    reps = clu.cluster(res.select("Sequence_ID", "sequence"))
    return clu.representatives(res.select(*ID_COLS, *COLUMNS_TO_KEEP), reps)


# ----------------------------------------------------------------- ingest
from repforge.sources import fused  # noqa: E402
from repforge.sources import units as U  # noqa: E402

_UNIT_DIRS: dict[tuple[str, str], str] = {}
NTH = 3


def _unit_files(spark, sf):
    """gzip data units derived from the residue view, written once per
    session to the shared checkpoint folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _UNIT_DIRS:
        path = scratch_path(spark, "units")
        U.write_units(U.residue_unit_lines(views.residues(spark, sf)), path)
        _UNIT_DIRS[key] = path
    return _UNIT_DIRS[key]


def _unit_lines(spark, sf):
    return fused.unit_lines(spark, f"{_unit_files(spark, sf)}/unit=*/*.gz")


def _unit():
    """A unit is a folder of part files."""
    return U.unit_folder(F.col("file_path"))


@query("read_units")
def q_read_units(spark, sf):
    return fused.read_units(_unit_lines(spark, sf), ["locus", "v_call", *REGIONS, "Redundancy"], _unit())


@query("assign_sequence_ids")
def q_assign_sequence_ids(spark, sf):
    return fused.ingest(_unit_lines(spark, sf), COLUMNS_TO_KEEP, unit=_unit())


@query("every_nth")
def q_every_nth(spark, sf):
    return fused.ingest(_unit_lines(spark, sf), COLUMNS_TO_KEEP, nth=NTH, unit=_unit())


@query("ingest_unfiltered")
def q_ingest_unfiltered(spark, sf):
    return fused.ingest(_unit_lines(spark, sf), COLUMNS_TO_KEEP, length_filter=False, unit=_unit())


@query("unit_manifest")
def q_unit_manifest(spark, sf):
    m = fused.manifest(_unit_lines(spark, sf), _unit())
    return m.select(U.unit_id(F.col("unit_path")).alias("File_ID"),
                    "first_line", "n_lines", "bytes", "Size_MB")


# ------------------------------------------------------- catalogue lines
from repforge.sources import catalogue as cat_src  # noqa: E402

LABEL_THRESHOLD = 250000


def _raw_catalogue_lines(spark, sf):
    """``wget <url>, "<json>", <size> MB`` per unit; every 7th unit has an
    extra key, every 23rd broken JSON, every 29th no size."""
    c = views.catalogue(spark, sf)
    q = lambda name, col: F.concat(F.lit(f'"{name}": "'), F.coalesce(col, F.lit("")), F.lit('"'))
    fields = [q(f, F.col(f)) for f in cat_src.METADATA_FIELDS]
    body = F.concat_ws(", ", *fields, F.when(F.col("File_index") % 7 == 0,
                                             F.lit('"Extra": "x"')))
    js = F.concat(F.lit("{"), body,
                  F.when(F.col("File_index") % 23 == 0, F.lit("")).otherwise(F.lit("}")))
    doubled = F.replace(js, F.lit('"'), F.lit('""'))
    size = F.when(F.col("File_index") % 29 == 0, F.lit("")).otherwise(
        F.concat(F.lit(", "), F.col("Size_MB").cast("string"), F.lit(" MB")))
    return c.select(F.concat(F.lit("wget "), F.col("Download_Link"), F.lit(', "'), doubled,
                             F.lit('"'), size).alias("value"))


@query("parse_catalogue_lines")
def q_parse_catalogue_lines(spark, sf):
    """S9: raw lines written as text, read back and parsed."""
    path = scratch_path(spark, "raw-lines")
    _raw_catalogue_lines(spark, sf).write.text(path)
    p = cat_src.parse_catalogue_lines(cat_src.read_catalogue_lines(spark, path))
    return p.withColumn("Size_MB", F.col("Size_MB").cast("double"))


@query("bad_catalogue_lines")
def q_bad_catalogue_lines(spark, sf):
    return cat_src.bad_catalogue_lines(_raw_catalogue_lines(spark, sf))


@query("labelled_groups")
def q_labelled_groups(spark, sf):
    return agg.labelled_groups(views.catalogue(spark, sf), ["Author"], "Unique_sequences",
                               LABEL_THRESHOLD)


# ------------------------------------------------------------ assessment
from repforge.operators import assess  # noqa: E402

TEST_SETS = ["set0", "set1", "set2", "set3"]


def _losses(spark, sf):
    """Loss to 6 digits and the perplexity to 10 significant digits, for
    comparison with another engine."""
    m = assess.loss_by_test_set(views.losses(spark, sf))
    return (m.withColumn("eval_loss", F.round("eval_loss", 6))
             .withColumn("perplexity", F.format_string("%.9e", F.exp("eval_loss")).cast("double")))


@query("loss_by_test_set")
def q_loss_by_test_set(spark, sf):
    return _losses(spark, sf)


@query("loss_matrix")
def q_loss_matrix(spark, sf):
    m = assess.loss_matrix(_losses(spark, sf), TEST_SETS, TEST_SETS[:3])
    return _rounded(m, 6, "macro_mean")


# ---------------------------------------------------------- corpus / tokens
_CORPUS_DIRS: dict[tuple[str, str], str] = {}


def _split_text(spark, sf):
    res = views.residues(spark, sf).select("Sequence_ID", "sequence")
    return splits.split_fraction(res, TRAIN_FRACTION, VAL_FRACTION)


def _corpus_files(spark, sf):
    """Split text files (one sequence per line, a folder per split), written
    once per session to the shared checkpoint folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _CORPUS_DIRS:
        path = scratch_path(spark, "corpus")
        splits.write_splits(_split_text(spark, sf), path, text_col="sequence")
        _CORPUS_DIRS[key] = path
    return _CORPUS_DIRS[key]


@query("read_corpus")
def q_read_corpus(spark, sf):
    path = _corpus_files(spark, sf)
    return corpus.read_corpus(spark, {s: f"{path}/split={s}" for s in ("train", "val", "test")})


TOKEN_SHARD_ROWS = 500  # small, so that every split has several shards


def _token_files(spark, sf):
    """Token shards, written once per session to the shared checkpoint folder."""
    key = (spark.sparkContext.applicationId, sf, "tokens")
    if key not in _CORPUS_DIRS:
        split = materialize(_split_text(spark, sf), "split-rows")
        rows = corpus.deal_shards(corpus.with_shards(split, TOKEN_SHARD_ROWS), split.count())
        path = scratch_path(spark, "tokens")
        corpus.write_token_shards(
            corpus.tokenize_corpus(rows, "sequence", keep=["Sequence_ID", "split", "shard"]),
            path, dealt=True)
        _CORPUS_DIRS[key] = path
    return _CORPUS_DIRS[key]


@query("tokenized_test_split")
def q_tokenized_test_split(spark, sf):
    t = corpus.read_tokenized_test(spark, _token_files(spark, sf))
    return t.select("Sequence_ID", *[_ints(F.col(c)).alias(c) for c in corpus.TOKEN_COLUMNS])


@query("token_shards")
def q_token_shards(spark, sf):
    """K8: size and id range of every shard, from the written files."""
    t = spark.read.parquet(_token_files(spark, sf))
    return t.groupBy("split", "shard").agg(F.count(F.lit(1)).alias("n_rows"),
                                           F.min("Sequence_ID").alias("first_id"),
                                           F.max("Sequence_ID").alias("last_id"))


# ------------------------------------------------------------------- sinks
# Each sink query writes through the library writer to the shared
# checkpoint folder and reads the files back with the writer's schema, so
# the check covers the written files, not the DataFrame before the write.
from repforge.sources import sinks  # noqa: E402


@query("write_sequences")
def q_write_sequences(spark, sf):
    """K2: the sequences table as CSV with one header, read back."""
    seqs = views.sequences(spark, sf)
    path = scratch_path(spark, "sequences-csv")
    sinks.write_sequences(seqs, path, fmt="csv")
    return spark.read.schema(seqs.schema).option("header", True).csv(path)


@query("metrics_json")
def q_metrics_json(spark, sf):
    """K9: per-test-set metrics as JSON lines, read back."""
    m = _losses(spark, sf)
    path = scratch_path(spark, "metrics-json")
    sinks.write_metrics(m, path)
    return spark.read.schema(m.schema).json(path)


@query("report_csv")
def q_report_csv(spark, sf):
    """K10: group sums as a CSV report, read back."""
    r = agg.grouped_sum(views.catalogue(spark, sf), ["Author"], "Unique_sequences")
    path = scratch_path(spark, "report-csv")
    sinks.write_report_csv(r, path)
    return spark.read.schema(r.schema).option("header", True).csv(path)


@query("cached_row_counts")
def q_cached_row_counts(spark, sf):
    """S10: rows per unit, computed once and reused from the written table."""
    path = scratch_path(spark, "row-counts")
    calls = []

    def compute():
        calls.append(1)
        return groups.rows_per_file(views.sequences(spark, sf))

    sinks.cached(spark, path, compute)
    again = sinks.cached(spark, path, compute)
    if len(calls) != 1:
        raise RuntimeError("the cached table was not reused")
    return again


@query("download_list")
def q_download_list(spark, sf):
    """K1: the download list written as unquoted CSV, read back."""
    from repforge.operators.filters import write_download_list
    units = select_units(views.catalogue(spark, sf), UNIT_FILTERS, warn_if_empty=True)
    path = scratch_path(spark, "download-list")
    write_download_list(units, path)
    return spark.read.schema(units.schema).option("header", True).csv(path)


@query("sample_scheme_random")
def q_sample_scheme_random(spark, sf):
    """R6: the scheme switch, random scheme."""
    return sampling.sample(views.sequences(spark, sf), "random", SAMPLE_N)


@query("sample_scheme_individuals")
def q_sample_scheme_individuals(spark, sf):
    """R6: the scheme switch, balanced by individual."""
    return sampling.sample(views.sequences(spark, sf), "balance_individuals",
                           BALANCED_INDIVIDUALS_TOTAL, views.catalogue(spark, sf))


@query("sample_scheme_publications")
def q_sample_scheme_publications(spark, sf):
    """R6: the scheme switch, balanced by publication."""
    return sampling.sample(views.sequences(spark, sf), "balance_publications",
                           BALANCED_PUBLICATIONS_TOTAL, views.catalogue(spark, sf))


@query("fasta_file_ids")
def q_fasta_file_ids(spark, sf):
    """K3, S6: FASTA written, its record ids read back."""
    path = scratch_path(spark, "fasta")
    fasta.write_fasta(fasta.fasta_records(views.residues(spark, sf)), path)
    return fasta.read_fasta_ids(spark, path)


@query("sequence_lines")
def q_sequence_lines(spark, sf):
    """K6: one sequence per line, written and read back."""
    path = scratch_path(spark, "sequence-lines")
    corpus.write_text(corpus.sequence_text(views.residues(spark, sf)), path)
    return spark.read.text(path).select(F.col("value").alias("text"))


@query("split_tables")
def q_split_tables(spark, sf):
    """K7: the table of each split, written and read back."""
    path = scratch_path(spark, "split-tables")
    splits.write_splits(_split_text(spark, sf), path)
    return spark.read.parquet(path).select("Sequence_ID", "split", "sequence")


# --------------------------------------------------------- committed tables
@query("committed_sequences")
def q_committed_sequences(spark, sf):
    """The sequences table committed twice, the second time over a write
    that failed half way; read by its newest manifest and checked."""
    from repforge.sources import committed
    path = scratch_path(spark, "committed")
    seqs = views.sequences(spark, sf)
    committed.write_committed(seqs.select("Sequence_ID"), path)
    seqs.write.parquet(f"{path}/data-failed")
    committed.write_committed(seqs, path)
    return committed.read_committed(spark, path, check=True)


@query("reused_row_counts")
def q_reused_row_counts(spark, sf):
    """S10 by the input's files: computed once, then read while they stay."""
    from repforge.sources import committed
    path, inputs = scratch_path(spark, "reused"), [f"{sf.rstrip('/')}/orders.parquet"]
    compute = lambda: groups.rows_per_file(views.sequences(spark, sf))
    committed.reused(spark, path, inputs, compute)
    return committed.reused(spark, path, inputs, compute)
