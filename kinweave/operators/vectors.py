"""Scores between vectors: a stated set of queries against all rows, in blocks.

Blocks of queries of bounded size go to the tasks that hold the rows, where one matrix product
per batch gives all measures; nothing is shuffled. Defined results: vectors with a null, of
another length than the first query, or without length are left out (nulls may be allowed as
gaps); a zero vector has no cosine and no correlation with anything; pairs of a row with itself
are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinweave.operators.skew import salted_join

#: Numbers of query vectors that one block holds at most.
BLOCK = 4_000_000

MEASURES = ("dot", "cosine", "sine", "half_sine", "half_cosine", "angle", "acute", "cosine_skew", "pearson", "euclid", "taxi", "chebyshev", "minkowski")


def _unit(m: np.ndarray) -> np.ndarray:
    norm = np.sqrt((m * m).sum(1, keepdims=True))
    return np.divide(m, norm, out=np.full_like(m, np.nan), where=norm > 0)


def score(q: np.ndarray, x: np.ndarray, measure: str, power: float = 2.0) -> np.ndarray:
    """Matrix of scores, queries by rows. ``power`` is that of ``minkowski``. The skewed cosine divides
    the root of the inner product by the length of the query alone, and is 0 if the product is negative."""
    if measure == "dot":
        return q @ x.T
    if measure == "cosine_skew":
        norm = np.sqrt((q * q).sum(1, keepdims=True))
        return np.divide(np.sqrt(np.maximum(q @ x.T, 0)), norm, out=np.full((len(q), len(x)), np.nan), where=norm > 0)
    if measure in ("cosine", "sine", "half_sine", "half_cosine", "angle", "acute"):
        c = np.clip(_unit(q) @ _unit(x).T, -1, 1)
        of = {"cosine": lambda: c, "sine": lambda: np.sqrt(1 - c * c), "half_sine": lambda: np.sqrt(0.5 - 0.5 * c), "half_cosine": lambda: np.sqrt(0.5 + 0.5 * c), "angle": lambda: np.arccos(c), "acute": lambda: np.arccos(np.abs(c))}
        return of[measure]()
    if measure == "pearson":
        return np.clip(_unit(q - q.mean(1, keepdims=True)) @ _unit(x - x.mean(1, keepdims=True)).T, -1, 1)
    out = np.empty((len(q), len(x)))
    for i, row in enumerate(q):
        gap = np.abs(x - row)
        of = {"euclid": lambda: np.sqrt((gap * gap).sum(1)), "taxi": lambda: gap.sum(1), "chebyshev": lambda: gap.max(1), "minkowski": lambda: (gap**power).sum(1) ** (1 / power)}
        out[i] = of[measure]()
    return out


def filled(q: np.ndarray, x: np.ndarray, measure: str) -> np.ndarray:
    """Cosine and Pearson of vectors with gaps (NaN): each pair by the places that both have."""
    a, b = (~np.isnan(q)).astype(float), (~np.isnan(x)).astype(float)
    q, x = np.nan_to_num(q), np.nan_to_num(x)
    n, ip = a @ b.T, q @ x.T
    sq, sx, qq, xx = q @ b.T, a @ x.T, (q * q) @ b.T, a @ (x * x).T
    if measure == "cosine":
        top, bottom = ip, qq * xx
    else:
        top, bottom = n * ip - sq * sx, np.maximum(n * qq - sq * sq, 0) * np.maximum(n * xx - sx * sx, 0)
    return np.clip(np.divide(top, np.sqrt(bottom), out=np.full(top.shape, np.nan), where=bottom > 1e-12), -1, 1)


def rank_transform(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Each vector replaced by the ranks of its numbers, ties sharing their mean rank."""
    cells = df.select(key, F.posexplode(vector).alias("_p", "_v"))
    per = Window.partitionBy(key)
    rank = F.rank().over(per.orderBy("_v")) + (F.count(F.lit(1)).over(Window.partitionBy(key, "_v")) - 1) / 2
    ranked = cells.withColumn("_k", rank).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_p", "_k"))).alias("_s"))
    return ranked.select(key, F.transform("_s", lambda s: s["_k"].cast("double")).alias(vector))


def against(rows: DataFrame, queries: DataFrame, key: str, vector: str, measure: str, at_least: float | None = None, power: float = 2.0, gaps: bool = False) -> DataFrame:
    """(query, row, score) of every query with every other row, or those that score enough.

    ``gaps``: nulls in a vector are places without a value, for cosine and pearson; each pair is
    judged by the places that both have."""
    spark = rows.sparkSession
    missing = lambda v: v.isNull() | F.isnan(v.cast("double"))
    clean = F.col(key).isNotNull() & (F.size(vector) > 0) & (~F.forall(vector, missing) if gaps else ~F.exists(vector, missing))
    wide = lambda df: df.where(clean).select(key, F.transform(vector, lambda v: F.coalesce(v.cast("double"), F.lit(float("nan")))).alias(vector))
    schema = "query bigint, row bigint, score double"
    passes, block = [], []

    def send(block: list) -> DataFrame:
        ids, matrix = np.array([b[0] for b in block]), np.array([b[1] for b in block])
        shared = spark.sparkContext.broadcast((ids, matrix))  # at most BLOCK numbers

        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ids, matrix = shared.value
            step = max(1, 2_000_000 // len(ids))
            for batch in batches:
                batch = batch[batch[vector].map(len) == matrix.shape[1]]
                for i in range(0, len(batch), step):
                    part = batch.iloc[i : i + step]
                    own = np.stack(part[vector].to_list())
                    s = filled(matrix, own, measure) if gaps else score(matrix, own, measure, power)
                    own = part[key].to_numpy()
                    keep = (ids[:, None] != own[None, :]) & ~np.isnan(s)
                    if at_least is not None:
                        keep &= s >= at_least
                    a, b = np.nonzero(keep)
                    yield pd.DataFrame({"query": ids[a], "row": own[b], "score": s[a, b]})

        return wide(rows).mapInPandas(scan, schema)

    length = None
    for r in wide(queries).toLocalIterator():
        length = length or len(r[1])
        if len(r[1]) == length:
            block.append((r[0], r[1]))
        if len(block) * length >= BLOCK:
            passes.append(send(block))
            block = []
    if block:
        passes.append(send(block))
    return reduce(DataFrame.unionByName, passes) if passes else spark.createDataFrame([], schema)


def set_scores(sets: DataFrame, queries: DataFrame) -> DataFrame:
    """(query, row, meet, tanimoto, cosine, cover, hamming) between sets given as (id, item), for
    sets that share an item with a query. Inverted index: a join on the item."""
    every = sets.select("id", "item").dropna().distinct()
    asked = queries.select("id").distinct()
    own = every.join(asked, "id", "left_semi").select(F.col("id").alias("query"), "item")
    # an item may be in a third of all sets
    met = salted_join(every, own, ["item"]).where("id <> query").groupBy("query", F.col("id").alias("row")).agg(F.count(F.lit(1)).alias("meet"))
    sizes = every.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    both = met.join(sizes.select(F.col("id").alias("query"), F.col("n").alias("a")), "query").join(sizes.select(F.col("id").alias("row"), F.col("n").alias("b")), "row")
    m, a, b = F.col("meet"), F.col("a"), F.col("b")
    return both.select("query", "row", "meet", (m / (a + b - m)).alias("tanimoto"), (m / F.sqrt((a * b).cast("double"))).alias("cosine"), (m / a).alias("cover"), (a + b - 2 * m).alias("hamming"))
