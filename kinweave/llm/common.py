"""What the text operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """``df`` in at least two tasks per core, for work in Python that outweighs the shuffle.

    Inputs that come in enough pieces stay as they are and are not shuffled."""
    wanted = 2 * df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() * 2 >= wanted else df.repartition(wanted)
