"""Repeat counts per sample kept up to date from a stream of reads."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmill.functions.lineage import checkpoint_folder
from strandmill.sources import load_table


def read_stream(spark: SparkSession, folder: str, name: str = "read_copies", files_per_batch: int = 8) -> DataFrame:
    """The table's files as a stream, whether it is one file or a folder of parts, wherever the folder is."""
    table = load_table(spark, folder, name)
    source = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files_per_batch)
    if [f.rsplit("/", 1)[-1] for f in table.inputFiles()] == [f"{name}.parquet"]:
        return source.option("pathGlobFilter", f"{name}.parquet").parquet(folder)
    return source.parquet(f"{folder}/{name}.parquet")


def counts_of(reads: DataFrame, late: str | None = None) -> DataFrame:
    """Streaming histogram: a read delivered several times counts once, as it first comes.

    With ``late`` (such as ``30 days``) a read is remembered that long by ``loaded_at``, which bounds the state; without it
    every read is, however late it comes again.
    """
    keys = ["sample_id", "read_id"]
    once = reads.dropDuplicates(keys) if late is None else reads.withWatermark("loaded_at", late).dropDuplicatesWithinWatermark(keys)
    return once.filter("copies is not null").groupBy("sample_id", "copies").agg(F.count("*").alias("n"))


def run_counts(reads: DataFrame, target: str, late: str | None = None) -> DataFrame:
    """Process what is there and return the counts; each batch rewrites ``target`` whole, so a repeated batch changes nothing."""
    spark = reads.sparkSession

    def write(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/counts")

    query = counts_of(reads, late).writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", f"{target}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(f"{target}/counts")


def new_folder(spark: SparkSession) -> str:
    """A new folder below the shared checkpoint folder of the session."""
    return f"{checkpoint_folder(spark)}/stream-{uuid.uuid4().hex}"
