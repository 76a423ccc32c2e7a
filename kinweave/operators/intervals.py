"""Merging intervals per entity and listing the gaps between them.

Starts and ends are ranked independently of each other. After the i-th smallest end exactly
i intervals have closed; where the (i+1)-th smallest start lies beyond it, exactly i have
opened too, so nothing covers the space between: a gap. The boundaries around the gaps,
taken in pairs, are the merged periods.

An entity may own a third of all rows. Per start only the farthest end can matter, which
partial aggregation applies before the shuffle; large entities are cut at quantiles of their
own starts into blocks of about equal size, wherever the starts lie, and each block gets the
farthest end of the blocks before it as one more interval. No task has to hold an entity.

Defined results: rows with a null key, start or end are ignored; bounds may come in either
order; both ends are covered; repeated rows change nothing; an entity without intervals has
neither periods nor gaps; columns of other names, also of the internal ones, may exist.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.operators.skew import hot_values

#: Blocks that a large entity is cut into, in groups of so many.
BLOCKS, GROUP = 256, 16


def _block_of(bounds: Column, value: Column) -> Column:
    """How many of the BLOCKS - 1 sorted ``bounds`` are <= ``value``, in two short searches."""
    marks = F.transform(F.sequence(F.lit(GROUP), F.lit(BLOCKS - 1), F.lit(GROUP)), lambda i: F.element_at(bounds, i))
    passed = lambda xs: F.size(F.filter(xs, lambda b: b <= value))
    coarse = passed(marks) * GROUP
    return coarse + passed(F.slice(bounds, coarse + 1, F.lit(GROUP)))


def _spans(df: DataFrame, keys: dict[str, Column], start: Column, end: Column, share: float) -> tuple[DataFrame, list]:
    """(the farthest end per entity, block and start; hashes of the entities that have blocks)."""
    names = list(keys)
    spans = df.select(
        *[c.alias(k) for k, c in keys.items()],
        F.least(start, end).cast("bigint").alias("_lo"),
        F.greatest(start, end).cast("bigint").alias("_hi"),
        (start.isNotNull() & end.isNotNull()).alias("_whole"),
    ).where("_whole AND " + " AND ".join(f"`{k}` IS NOT NULL" for k in names))
    entity = F.xxhash64(*names)
    hot = hot_values(spans, entity, share)
    if not hot:
        spans = spans.withColumn("_block", F.lit(0).cast("bigint"))
        return spans.groupBy(*names, "_block", "_lo").agg(F.max("_hi").alias("_hi")), hot
    cuts = F.percentile_approx("_lo", [i / BLOCKS for i in range(1, BLOCKS)], 20 * BLOCKS).alias("_cuts")
    cuts = spans.where(entity.isin(hot)).groupBy(entity.alias("_entity")).agg(cuts)
    placed = spans.withColumn("_entity", entity).join(F.broadcast(cuts), "_entity", "left")  # at most 1 / share rows of BLOCKS numbers
    block = F.coalesce(_block_of(F.col("_cuts"), F.col("_lo")), F.lit(0)).cast("bigint")
    spans = placed.withColumn("_block", block).groupBy(*names, "_block", "_lo").agg(F.max("_hi").alias("_hi"))
    earlier = Window.partitionBy(*names).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        spans.where(F.xxhash64(*names).isin(hot))
        .groupBy(*names, "_block")
        .agg(F.min("_lo").alias("_first"), F.max("_hi").alias("_last"))
        .withColumn("_carry", F.max("_last").over(earlier))
        .where("_carry IS NOT NULL")
        .select(*names, "_block", F.least("_first", "_carry").alias("_lo"), F.col("_carry").alias("_hi"))
    )
    return spans.unionByName(carried), hot


def _boundaries(spans: DataFrame, names: list[str]) -> DataFrame:
    """(_rank, _closed, _opens) of each gap per entity and block, by the ranks of starts and of ends;
    the first start has nothing that closed before it, the last end nothing that opens after."""
    part = Window.partitionBy(*names, "_block")
    ranked = spans.withColumn("_rs", F.row_number().over(part.orderBy("_lo"))).withColumn("_re", F.row_number().over(part.orderBy("_hi")))
    nothing = F.lit(None).cast("bigint")
    sides = F.array(
        F.struct((F.col("_rs") - 1).alias("k"), F.col("_lo").alias("opens"), nothing.alias("closed")),
        F.struct(F.col("_re").alias("k"), nothing.alias("opens"), F.col("_hi").alias("closed")),
    )
    return (
        ranked.select(*names, "_block", F.explode(sides).alias("_side"))
        .groupBy(*names, "_block", F.col("_side.k").alias("_rank"))
        .agg(F.max("_side.opens").alias("_opens"), F.max("_side.closed").alias("_closed"))
        .where("_opens IS NULL OR _closed IS NULL OR _opens > _closed + 1")
    )


def gaps(df: DataFrame, keys: dict[str, Column], start: Column, end: Column, share: float = 1 / 400) -> DataFrame:
    """Longest runs that no interval of the entity covers, between two that are covered.

    Columns: the names in ``keys``, gap_start, gap_end (BIGINT, both ends in the gap).
    Entities with at least ``share`` of the rows are processed in blocks.
    """
    spans, _ = _spans(df, keys, start, end, share)
    found = _boundaries(spans, list(keys)).where("_opens > _closed + 1")
    return found.select(*keys, (F.col("_closed") + 1).alias("gap_start"), (F.col("_opens") - 1).alias("gap_end"))


def periods(df: DataFrame, keys: dict[str, Column], start: Column, end: Column, share: float = 1 / 400) -> DataFrame:
    """Merged covered stretches per entity; touching intervals (5 and 6) are one stretch.

    Columns: the names in ``keys``, period_start, period_end (BIGINT, both ends covered).
    """
    names = list(keys)
    spans, hot = _spans(df, keys, start, end, share)
    along = Window.partitionBy(*names, "_block").orderBy("_rank")
    last = F.lead("_opens").over(along).isNull()
    pieces = _boundaries(spans, names).select(*names, "_block", F.col("_opens").alias("_lo"), F.lead("_closed").over(along).alias("_hi"), (F.col("_closed").isNull() | last).alias("_edge"))
    pieces = pieces.where("_lo IS NOT NULL")
    if not hot:
        return pieces.select(*names, F.col("_lo").alias("period_start"), F.col("_hi").alias("period_end"))
    # what one block ends with, the next begins with: these two pieces per block are merged, the others stand
    lane = F.when(F.xxhash64(*names).isin(hot) & F.col("_edge"), 0).otherwise(F.col("_block") + 1)
    pieces = pieces.withColumn("_lane", lane)
    order = Window.partitionBy(*names, "_lane").orderBy("_lo", "_hi")
    before = F.max("_hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = F.when(before.isNull() | (F.col("_lo") > before + 1), 1).otherwise(0)
    runs = pieces.withColumn("_new", opened).withColumn("_run", F.sum("_new").over(order))
    return runs.groupBy(*names, "_lane", "_run").agg(F.min("_lo").alias("period_start"), F.max("_hi").alias("period_end")).drop("_lane", "_run")
