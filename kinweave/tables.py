"""Reading the tables, and how their ids compare."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters removed from both ends of ids and taxa before they compare.
ID_PADDING = " \t\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clean_id(col: Column) -> Column:
    """``col`` without its padding; null where nothing is left."""
    bare = F.trim(col, F.lit(ID_PADDING))
    return F.when(bare != "", bare)
