"""Corpus pipeline: documents through five of the operators, one after another.

Every stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and
returns a DataFrame; each result is written to the shared checkpoint folder
(by ``run``, or by a stage that scores texts) and read again as the next
stage's ``docs``. All but the last
stage return the columns of ``docs``, whatever they are; a null text counts
as empty, and an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repforge.llm import ngram_join, packing, quality, toxicity, trie_dedup
from repforge.llm.common import Scratch, batches_of, fresh, table
from repforge.llm.queries import vocabulary

#: A document at or above this toxicity goes.
MAX_TOXICITY = 0.5
#: A document below this quality goes.
MIN_QUALITY = 0.7
SEQUENCE, END_ID = 2048, 1
#: Texts go to the Python workers that score them in batches of so many bytes.
BATCH = "8m"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity score is below MAX_TOXICITY; the field is fitted
    on the labelled rows among ``docs``."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    score = fresh("toxicity")
    with batches_of(spark, BATCH):
        return Scratch(spark).save(docs.withColumn(score, toxicity.score_column(spark, model, F.col("text")))
                                   .filter(F.col(score) < MAX_TOXICITY).drop(score), "clean")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose quality score is at least MIN_QUALITY."""
    weights = quality.fit(docs, table(spark, sf_dir, "labels"))
    score = fresh("quality")
    with batches_of(spark, BATCH):
        return Scratch(spark).save(docs.withColumn(score, quality.score_column(spark, weights, F.col("text")))
                                   .filter(F.col(score) >= MIN_QUALITY).drop(score), "good")


def keep_owners(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows with equal text the one with the largest id; of rows that
    repeat an id with its text, one. Texts without any id keep one row."""
    owners = trie_dedup.owners(docs, keep="largest")
    key = fresh("sha256")
    keyed = docs.withColumn(key, F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
    ours = owners.select(F.col("sha256").alias("owner_key"), F.col("keep_id").alias("owner_id"))
    kept = keyed.join(ours, (F.col(key) == F.col("owner_key")) & F.col("doc_id").eqNullSafe(F.col("owner_id")),
                      "left_semi")
    repeated = (keyed.groupBy("doc_id", key).count().filter("count > 1")
                .select(F.col("doc_id").alias("repeated_id"), F.col(key).alias("repeated_key")))
    if repeated.limit(1).count() == 0:
        return kept.drop(key)
    same = (F.col(key) == F.col("repeated_key")) & F.col("doc_id").eqNullSafe(F.col("repeated_id"))
    return (kept.join(repeated, same, "left_anti")
            .unionByName(kept.join(repeated, same, "left_semi").dropDuplicates(["doc_id", key])).drop(key))


def keep_one_near_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by n-gram Jaccard 0.8 or more, directly or over others,
    the one with the smallest id (null last; of one id the smallest hash of
    id and text). Rows of another text under the same id are not touched;
    texts without an n-gram link with nothing and stay."""
    key = fresh("row")
    keyed = docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit(""))))
    scratch = Scratch(spark)
    found = scratch.save(ngram_join.joined(keyed, id_col=key).filter("n_shingles > 0")
                         .groupBy(F.col("doc_id").alias("member"), "component_id").agg(F.count("*").alias("rows")),
                         "linked")
    ids = keyed.groupBy(F.col(key).alias("member")).agg(F.min(F.col("doc_id").cast("long")).alias("id"))
    keepers = (found.join(ids, "member").groupBy("component_id")
               .agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "member")).alias("least"))
               .select(F.col("least.member").alias("member")))
    gone = found.join(keepers, "member", "left_anti")
    kept = keyed.join(gone, F.col(key) == F.col("member"), "left_anti")
    repeated = found.filter("rows > 1").select("member")
    if repeated.limit(1).count() == 0:
        return kept.drop(key)
    same = F.col(key) == F.col("member")
    return (kept.join(repeated, same, "left_anti")
            .unionByName(kept.join(repeated, same, "left_semi").dropDuplicates([key])).drop(key))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the kept documents in sequences of SEQUENCE tokens."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), SEQUENCE, END_ID)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_quality),
    ("exact_dedup", keep_owners),
    ("ngram_join", keep_one_near_copy),
    ("packing", pack),
]

#: The first two stages are trained models, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, docs = Scratch(spark), table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        found = stage(spark, docs, sf_dir)
        docs = found if hasattr(found, "_scratch") else scratch.save(found, name)
        if before is not None:
            scratch.drop(before)
        before = docs
    return docs
