"""Session helpers: where shared intermediate data goes, how wide a shuffle is."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_HERE = "kinweave.shared.dir"


def _base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_HERE, None)
    if base:
        return base
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    base = "file://" + tempfile.mkdtemp(prefix="kinweave-")
    spark.conf.set(_HERE, base)
    return base


def _folder(spark: SparkSession, path: str):
    """(Hadoop's file system of ``path``, the path in it)."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate tables, below the folder that all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``. Where it is unset, a session on
    one machine (master ``local``) gets a temporary folder; any other session is refused. The
    new folder goes when the session's JVM ends, if nothing removed it before.
    """
    path = f"{_base(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    store, place = _folder(spark, path)
    store.deleteOnExit(place)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder of ``shared_dir`` that no result reads any more."""
    store, place = _folder(spark, path)
    store.delete(place, True)


def checkpointed(df: DataFrame, *spent: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read from there, its lineage cut.

    ``spent``: results of earlier calls that only ``df`` was made of, as in the rounds of a
    loop; their folders are removed once ``df`` is written."""
    spark = df.sparkSession
    path = shared_dir(spark, "stage")
    df.write.option("compression", "zstd").parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written._kinweave_path = path
    release(*spent)
    return written


def is_written(df: DataFrame) -> bool:
    """Whether ``df`` is a result of ``checkpointed``."""
    return hasattr(df, "_kinweave_path")


def release(*written: DataFrame) -> None:
    """Removes the folders of results of ``checkpointed``."""
    for df in written:
        path = getattr(df, "_kinweave_path", None)
        if path:
            remove(df.sparkSession, path)


def width(spark: SparkSession) -> int:
    """Number of shuffle partitions that the session plans with."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered_rows(df: DataFrame, order: list[Column | str], name: str, start: int = 0) -> DataFrame:
    """``df`` with consecutive numbers in a total order, without a window over all rows.

    Rows are sorted over all partitions and written with their place in the partition; the
    sizes of the partitions, a row each, sum up to offsets."""
    placed = checkpointed(df.orderBy(*order).withColumn("_m", F.monotonically_increasing_id()))
    part, place = F.shiftright("_m", 33), F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.partitionBy().orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_k")).withColumn("_before", F.coalesce(F.sum("_k").over(before), F.lit(0))).drop("_k")
    joined = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")  # a row per partition
    return joined.withColumn(name, F.col("_before") + place + start).drop("_part", "_m", "_before")
