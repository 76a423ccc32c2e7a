"""Finding the few keys that hold much of a table, and salting them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Entries of the frequent-items sketch. A key above 4 / TRACKED of the rows is never missed.
TRACKED = 8192


def hot_values(df: DataFrame, key: Column, share: float = 1 / 400) -> list:
    """Values of ``key`` that hold at least ``share`` of the rows of ``df``; null is none.

    One scan of one column and no shuffle of keys: a frequent-items sketch is merged. At
    most ``1 / share`` values reach the driver. The list only steers salting, so that the
    sketch's error in counts cannot change a result.
    """
    return hot_values_with(df, key, [], share)[0]


def hot_values_with(df: DataFrame, key: Column, also: list[Column], share: float = 1 / 400) -> tuple[list, list]:
    """(hot values, further aggregates over the rows with a key), in the same scan."""
    limit = int(1 / share)
    keyed = df.withColumn("_key", key).where("_key IS NOT NULL")
    row = keyed.agg(F.count(F.lit(1)).alias("_n"), F.expr(f"approx_top_k(_key, {limit}, {TRACKED})").alias("_top"), *also).first()
    return [t["item"] for t in row["_top"] or [] if t["count"] >= max(2, share * row["_n"])], list(row[2:])


def salt(key: Column, hot: list, spread: Column, salts: int) -> Column:
    """0 for ordinary keys; for hot ones a number below ``salts`` that follows ``spread``."""
    if not hot:
        return F.lit(0)
    return F.when(key.isin(hot), F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")).otherwise(0)


def every_salt(key: Column, hot: list, salts: int) -> Column:
    """The array of all salts that rows with ``key`` can have, to be exploded on the other side."""
    if not hot:
        return F.array(F.lit(0))
    return F.when(key.isin(hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))


def salted_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", salts: int = 32, hot: list | None = None) -> DataFrame:
    """Equi-join in which rows of ``left`` whose key is hot are spread over ``salts`` tasks.

    ``right`` is repeated for hot keys only, of which there are at most a few hundred. ``hot``: the
    hashes of hot keys, if known."""
    key = F.xxhash64(*on)
    hot = hot_values(left, key) if hot is None else hot
    if not hot:
        return left.join(right, on, how)
    row = F.xxhash64(*[c for c, kind in left.dtypes if not kind.startswith("map")])
    spread = left.withColumn("_salt", salt(key, hot, row, salts))
    every = right.withColumn("_salt", F.explode(every_salt(key, hot, salts)))
    return spread.join(every, [*on, "_salt"], how).drop("_salt")
