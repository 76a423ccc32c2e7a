"""References to records that do not exist, followed down the foreign-key graph.

A reference is a direct orphan if no parent row of its key was valid when the child row
arrived. Children whose parent rows are all orphans are orphans by inheritance; they are
found by semi-joins from the newest orphans down to their children, until no new ones
appear.

Defined results: null and blank keys are no reference; copies of a child row count once;
parent rows whose validity ends before it begins, or begins at a null time, are never valid;
a child time of null matches no parent; an empty parent table makes every reference a direct
orphan.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.operators.intervals import periods
from kinweave.operators.skew import every_salt, hot_values, hot_values_with, salt
from kinweave.session import checkpointed

#: Rows of a hot key go to so many tasks, for every month.
SALTS = 16


@dataclass(frozen=True)
class Entity:
    """A table of the graph. ``row``: what identifies a row; ``at``: when it arrived (timestamp)."""

    df: DataFrame
    row: Column
    at: Column


@dataclass(frozen=True)
class Reference:
    """``column`` of ``child`` names ``key`` of ``parent``, valid in [valid_from, valid_to).

    None for a bound: valid without that bound; null in ``valid_to``: still valid."""

    child: str
    field: str
    column: Column
    parent: str
    key: Column
    valid_from: Column | None = None
    valid_to: Column | None = None


_LOW, _HIGH = -(2**62), 2**62


def _micros(col: Column | None, default: int) -> Column:
    return F.lit(default).cast("bigint") if col is None else F.unix_micros(col)


def _month(micros: Column) -> Column:
    at = F.timestamp_micros(micros)
    return F.year(at) * 12 + F.month(at)


class _Edge:
    """All references from one table to one other that have the same key and validity."""

    def __init__(self, tables: dict[str, Entity], refs: list[Reference]) -> None:
        child, parent, one = tables[refs[0].child], tables[refs[0].parent], refs[0]
        named = F.explode(F.array(*[F.struct(F.lit(r.field).alias("field"), r.column.alias("ref")) for r in refs]))
        refs_df = child.df.select(child.row.alias("row"), F.unix_micros(child.at).alias("at"), named.alias("r"))
        self.refs = refs_df.select("row", "at", "r.field", "r.ref").where("ref IS NOT NULL")
        rows = parent.df.select(parent.row.alias("prow"), one.key.alias("ref"), _micros(one.valid_from, _LOW).alias("since"), F.coalesce(_micros(one.valid_to, _HIGH), F.lit(_HIGH)).alias("until"))
        self.parents = rows.where("ref IS NOT NULL AND since < until").distinct()
        self.timed = one.valid_from is not None or one.valid_to is not None
        self.many = hot_values(self.parents, F.col("ref"))
        often, (self.first, self.last) = hot_values_with(self.refs, F.col("ref"), [F.min("at"), F.max("at")])
        self.hot = sorted({*often, *self.many})

    def keyed(self) -> DataFrame:
        """References with the salt of hot keys, and with their month."""
        hot = F.col("ref").isin(self.hot)
        month = F.when(hot, _month(F.col("at"))).otherwise(0) if self.hot and self.timed else F.lit(0)
        return self.refs.withColumn("month", month).withColumn("salt", salt(F.col("ref"), self.hot, F.col("row"), SALTS))

    def valid(self, parents: DataFrame) -> DataFrame:
        """Validity of ``parents``: disjoint for hot parents, in every month and salt for hot keys."""
        spans = parents.select("ref", "since", "until")
        if self.many:
            own = spans.where(F.col("ref").isin(self.many))
            merged = periods(own, {"ref": F.col("ref")}, F.col("since"), F.col("until") - 1)
            merged = merged.select("ref", F.col("period_start").alias("since"), (F.col("period_end") + 1).alias("until"))
            spans = spans.where(~F.col("ref").isin(self.many)).unionByName(merged)
        if not self.hot:
            return spans.select("ref", "since", "until", F.lit(0).alias("month"), F.lit(0).alias("salt"))
        hot = F.col("ref").isin(self.hot)
        if self.timed and self.first is not None:
            low, high = F.lit(self.first), F.lit(self.last)
            span = F.sequence(_month(F.greatest("since", low)), _month(F.least("until", high)))
            inside = (F.col("since") <= high) & (F.col("until") > low)
            months = F.when(hot & inside, span).when(hot, F.array().cast("array<int>")).otherwise(F.array(F.lit(0)))
        else:
            months = F.array(F.lit(0))
        spans = spans.withColumn("month", F.explode(months))
        return spans.withColumn("salt", F.explode(every_salt(F.col("ref"), self.hot, SALTS)))

    def match(self, refs: DataFrame, parents: DataFrame, how: str) -> DataFrame:
        left, right = refs.alias("l"), self.valid(parents).alias("r")
        on = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("ref", "month", "salt")]
        on += [F.col("r.since") <= F.col("l.at"), F.col("l.at") < F.col("r.until")] if self.timed else []
        return left.join(right, reduce(lambda a, b: a & b, on), how)


def cascade(tables: dict[str, Entity], references: list[Reference]) -> DataFrame:
    """Every orphan reference: table, row, field, ref, at (timestamp), kind, depth.

    kind is 'direct' or 'inherited'; depth is 0 for direct orphans and the number of steps
    to the nearest direct orphan above otherwise. Only orphans of tables that are parents
    themselves are kept between rounds; what hangs off them last is left to one lazy join.
    """
    edges: dict[tuple[str, str], _Edge] = {}
    for pair in dict.fromkeys((r.child, r.parent) for r in references):
        edges[pair] = _Edge(tables, [r for r in references if (r.child, r.parent) == pair])
    parents = {parent for _, parent in edges}
    found: dict[str, list[DataFrame]] = defaultdict(list)
    dead: dict[str, DataFrame] = {}
    fresh: dict[str, DataFrame] = {}

    def add(child: str, orphans: DataFrame, kind: str, depth: int) -> DataFrame:
        once = orphans.select("row", "field", "ref", "at").distinct()
        found[child].append(once.select(F.lit(child).alias("table"), "row", "field", "ref", F.timestamp_micros("at").alias("at"), F.lit(kind).alias("kind"), F.lit(depth).alias("depth")))
        return once

    for (child, _), edge in edges.items():
        orphans = add(child, edge.match(edge.keyed(), edge.parents, "left_anti"), "direct", 0)
        if child in parents:
            rows = orphans.select("row").distinct()
            fresh[child] = fresh[child].unionByName(rows).distinct() if child in fresh else rows
    fresh = {t: checkpointed(rows) for t, rows in fresh.items()}
    fresh = {t: rows for t, rows in fresh.items() if not rows.isEmpty()}
    depth = 0
    while fresh:
        depth += 1
        for t, rows in fresh.items():
            dead[t] = dead[t].unionByName(rows) if t in dead else rows
        following: dict[str, DataFrame] = {}
        for (child, parent), edge in edges.items():
            if parent not in fresh:
                continue
            newly = edge.parents.join(fresh[parent].withColumnRenamed("row", "prow"), "prow", "left_semi")
            alive = edge.parents.join(dead[parent].withColumnRenamed("row", "prow"), "prow", "left_anti")
            orphans = edge.match(edge.match(edge.keyed(), newly, "left_semi"), alive, "left_anti")
            if len(found[child]) > 1:  # written, so that the plan does not grow with the depth
                found[child] = [checkpointed(reduce(DataFrame.unionByName, found[child]))]
            for earlier in found[child]:
                orphans = orphans.join(earlier.select("row", "field"), ["row", "field"], "left_anti")
            orphans = add(child, orphans, "inherited", depth)
            if child in parents:
                rows = orphans.select("row").distinct()
                if child in dead:
                    rows = rows.join(dead[child], "row", "left_anti")
                following[child] = following[child].unionByName(rows).distinct() if child in following else rows
        fresh = {t: checkpointed(rows) for t, rows in following.items()}
        fresh = {t: rows for t, rows in fresh.items() if not rows.isEmpty()}
    return reduce(DataFrame.unionByName, [df for dfs in found.values() for df in dfs])


def report(orphans: DataFrame) -> DataFrame:
    """Direct and inherited orphans per table, field and month of arrival."""
    month = F.date_format(F.date_trunc("month", "at"), "yyyy-MM")
    count = lambda kind: F.count(F.when(F.col("kind") == kind, 1))
    return orphans.groupBy(F.col("table").alias("table_name"), F.col("field").alias("ref_field"), month.alias("month")).agg(count("direct").alias("direct_orphans"), count("inherited").alias("inherited_orphans"))
