"""Hits as a stream: running results per pair, and windowed counts with late data.

The state of a pair is a few numbers, kept by the streaming aggregation; what a batch adds is
aggregated before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.session import shared_dir


def source(spark: SparkSession, sf_dir: str, name: str, files_per_batch: int = 64) -> DataFrame:
    """A table's files as a stream; a table that is one file is found in its folder by name."""
    path = f"{sf_dir}/{name}.parquet"
    table = spark.read.parquet(path)
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files_per_batch)
    if any(f.rstrip("/").endswith(f"/{name}.parquet") for f in table.inputFiles()[:1]):
        return stream.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    return stream.parquet(path)


def once(rows: DataFrame, row: str, at: str | None = None, late: str = "400 days") -> DataFrame:
    """Re-delivered rows count once. With the arrival time ``at``, which copies share, what is older
    than ``late`` is left out, and the state holds the ids of that span only; without, all ids."""
    if at is None:
        return rows.dropDuplicates([row])
    return rows.withColumn("_at", F.col(at).cast("timestamp")).withWatermark("_at", late).dropDuplicates([row, "_at"])


def pair_totals(hits: DataFrame) -> DataFrame:
    """Per query and subject: hits, aligned length, smallest exponent."""
    return hits.groupBy("query_id", "subject_id").agg(F.count(F.lit(1)).alias("hits"), F.sum("total_length").alias("aligned"), F.min("evalue_exp").alias("best_exp"))


def windowed_counts(rows: DataFrame, at: str, by: str, window: str = "1 day", late: str = "30 days") -> DataFrame:
    """(window_start, by, n): rows per tumbling window; rows later than ``late`` are left out."""
    timed = rows.withColumn("_at", F.col(at).cast("timestamp")).withWatermark("_at", late)
    return timed.groupBy(F.window("_at", window).alias("w"), by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), by, "n")


def drain(stream: DataFrame, mode: str = "complete") -> DataFrame:
    """All that is available now, run through the stream and written to the shared folder."""
    spark = stream.sparkSession
    out, marks = shared_dir(spark, "stream"), shared_dir(spark, "stream-checkpoint")

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite" if mode == "complete" else "append").parquet(out)

    query = stream.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", marks).foreachBatch(keep).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)
