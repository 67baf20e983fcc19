"""Incremental ingest of data units with Structured Streaming.

New unit files landing in a folder are picked up whole by the file source
(a gzip file is one split), ingested with the same batch operators, and
appended to the sequences table with ids continuing from the rows already
written. Each micro-batch writes its own folder with overwrite, so a retried
batch replaces its output (idempotent), plus one row with its last id in
``_offsets`` (hidden from readers of the sink), from which the next batch
continues; the checkpoint records which files were consumed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from repforge.sources import fused
from repforge.sources.tables import exists


def _offset(spark: SparkSession, sink: str, below_batch: int) -> int:
    """Last id written by the batches before ``below_batch``: read from the
    one-row-per-batch offsets table, never from the sequences themselves, so
    each micro-batch costs the same however much was ingested before."""
    if not exists(spark, f"{sink}/_offsets"):  # nothing written yet
        return 0
    v = spark.read.parquet(f"{sink}/_offsets").where(F.col("batch") < below_batch).agg(F.max("end_id")).first()[0]
    return int(v or 0)


def ingest_stream(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str,
                  columns: list[str], nth: int = 1, length_filter: bool = True,
                  max_files_per_trigger: int = 64, available_now: bool = True) -> StreamingQuery:
    lines = (spark.readStream.format("text").option("maxFilesPerTrigger", max_files_per_trigger)
                  .load(source_dir)
                  .select(F.col("_metadata.file_path").alias("file_path"),
                          F.col("_metadata.file_block_start").alias("block"), "value"))

    def batch(df: DataFrame, batch_id: int) -> None:
        rows = fused.ingest(df, columns, nth, length_filter)
        offset = _offset(spark, sink_dir, batch_id)
        out = f"{sink_dir}/batch={batch_id}"
        (rows.withColumn("Sequence_ID", F.col("Sequence_ID") + F.lit(offset))
             .write.mode("overwrite").parquet(out))
        # ids in a batch are dense from offset + 1; the count is read from
        # the written files' metadata
        end = offset + spark.read.parquet(out).count()
        # the folder name gives the ``batch`` column on read
        (spark.createDataFrame([(end,)], "end_id long")
              .write.mode("overwrite").parquet(f"{sink_dir}/_offsets/batch={batch_id}"))

    w = lines.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
