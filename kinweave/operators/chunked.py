"""Per-key results where a few keys own most rows.

Rows are cut into input partitions of about equal size by their order column. For every key
above one chunk the rows per input partition are counted, the counts are summed up to
offsets, and each row gets its exact position within its key; positions are cut into equal
chunks. A key and an input partition together are never more than that partition's rows, so
that no join on both meets a hot value. Chunks are processed on their own, and the states at their boundaries are merged in
order. Keys that fit one chunk are one chunk.

Defined results: null keys are no keys; copies of a row count once; rows are ordered by the
order column, which identifies a row; an empty table has no keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.functions.search import interval_of
from kinweave.session import width


def distinct_rows(df: DataFrame, row: Column, columns: dict[str, Column]) -> DataFrame:
    """One row per copy group: (_row, columns...), aggregated before the shuffle."""
    return df.select(row.alias("_row"), *[c.alias(n) for n, c in columns.items()]).distinct()


def chunked(rows: DataFrame, key: str, chunk_rows: int | None = None) -> DataFrame:
    """``rows`` with _chunk, the number of the equal-sized chunk within the row's key."""
    spark = rows.sparkSession
    parts = 2 * width(spark)
    keyed = rows.where(F.col(key).isNotNull())
    total, marks = keyed.agg(F.count(F.lit(1)), F.percentile_approx("_row", [i / parts for i in range(1, parts)], 20 * parts)).first()
    if not total:
        return keyed.withColumn("_chunk", F.lit(0).cast("bigint"))
    chunk_rows = chunk_rows or max(1, -(-total // (2 * parts)))
    part = interval_of(F.col("_row"), sorted(set(marks))).alias("_part")
    # keys above a chunk are fewer than total / chunk_rows, by default two per partition of the shuffle
    per_key = F.broadcast(keyed.groupBy(key).count().where(F.col("count") > chunk_rows).select(key))
    large = keyed.select("*", part).join(per_key, key, "left_semi")
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = large.groupBy(key, "_part").count().select(key, "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy(key, "_part").orderBy("_row")
    numbered = large.repartition(parts, "_part").withColumn("_n", F.row_number().over(within)).join(offsets, [key, "_part"])
    chunk = F.floor((F.col("_offset") + F.col("_n") - 1) / chunk_rows).alias("_chunk")
    rest = keyed.join(per_key, key, "left_anti").select("*", F.lit(0).cast("bigint").alias("_chunk"))
    return numbered.select(*keyed.columns, chunk).unionByName(rest)


def key_counts(rows: DataFrame, key: str, chunk_rows: int | None = None) -> DataFrame:
    """(key_value, n_records, n_chunks), merged from the chunks of each key."""
    states = chunked(rows, key, chunk_rows).groupBy(key, "_chunk").agg(F.count(F.lit(1)).alias("n"))
    return states.groupBy(F.col(key).alias("key_value")).agg(F.sum("n").alias("n_records"), F.count(F.lit(1)).alias("n_chunks"))


def key_results(rows: DataFrame, key: str, value: str, best: Column, chunk_rows: int | None = None) -> DataFrame:
    """Complete results per key: counts, first and last row, smallest ``best`` and the longest
    streak of rows in order that have the same ``value`` (null is a value of its own).

    The streak needs the order across chunks: of each chunk, the streak it opens with, the one
    it ends with and whether it is one streak throughout are kept, and merged chunk by chunk."""
    within = Window.partitionBy(key, "_chunk").orderBy("_row")
    rows = chunked(rows, key, chunk_rows).withColumn("_best", best)
    changes = F.when(F.lag(F.struct(value)).over(within).isNull() | ~F.col(value).eqNullSafe(F.lag(value).over(within)), 1).otherwise(0)
    rows = rows.withColumn("_change", changes).withColumn("_streak", F.sum("_change").over(within))
    streaks = rows.groupBy(key, "_chunk", "_streak").agg(
        F.count(F.lit(1)).alias("n"), F.first(F.struct(value)).alias("v"), F.min("_row").alias("lo"), F.max("_row").alias("hi"), F.min("_best").alias("best")
    )
    states = streaks.groupBy(key, "_chunk").agg(
        F.sum("n").alias("n"), F.max("n").alias("longest"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("best").alias("best"),
        F.min_by(F.struct("v", "n"), "_streak").alias("head"), F.max_by(F.struct("v", "n"), "_streak").alias("tail"), F.count(F.lit(1)).alias("streaks"),
    )
    merged = states.groupBy(key).agg(
        F.sum("n").alias("n_records"), F.count(F.lit(1)).alias("n_chunks"), F.min("lo").alias("first_row"), F.max("hi").alias("last_row"), F.min("best").alias("best"),
        F.array_sort(F.collect_list(F.struct("_chunk", "longest", "head", "tail", "streaks"))).alias("_states"),
    )
    start = F.struct(F.lit(0).cast("bigint").alias("longest"), F.lit(0).cast("bigint").alias("open"), F.expr("CAST(NULL AS STRING)").alias("v"))

    def step(acc: Column, s: Column) -> Column:
        same = (acc["open"] > 0) & acc["v"].eqNullSafe(s["head"]["v"][value])
        head = s["head"]["n"] + F.when(same, acc["open"]).otherwise(0)
        tail = F.when(s["streaks"] == 1, head).otherwise(s["tail"]["n"])
        return F.struct(F.greatest(acc["longest"], s["longest"], head).alias("longest"), tail.alias("open"), s["tail"]["v"][value].alias("v"))

    longest = F.aggregate("_states", start, step, lambda acc: acc["longest"])
    return merged.select(F.col(key).alias("key_value"), "n_records", "n_chunks", "first_row", "last_row", "best", longest.alias("longest_streak"))
