"""Products of graphs that fit a task: the columns of a product are made where they are handed on.

The factors are broadcast as numbers, up to ``searches.MOST`` arcs and nodes; tasks take columns in
pieces of about PATHS products, of which none is shuffled. Larger factors take ``graph.multiply``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.operators import graph as gr
from kinweave.operators import searches
from kinweave.session import checkpointed, numbered_rows

#: Products of a piece. A column is in one piece, and has at most as many as the other factor has arcs.
PATHS = 1_000_000


def _columns(n: int, u: np.ndarray, v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Arcs by where they leave from: (first arc of each node, ends, weights)."""
    order = np.argsort(u, kind="stable")
    return np.concatenate([[0], np.cumsum(np.bincount(u, minlength=n))]), v[order], w[order]


def product(n: int, a: tuple, b: tuple, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(src, dst, weight) of the product for the columns from ``low`` to before ``high``."""
    (a_at, a_to, a_w), (b_at, b_to, b_w) = a, b
    k, x = b_to[b_at[low] : b_at[high]], b_w[b_at[low] : b_at[high]]
    src = np.repeat(np.arange(high - low), np.diff(b_at[low : high + 1]))
    size = a_at[k + 1] - a_at[k]
    total = int(size.sum())
    place = np.repeat(a_at[k] - np.cumsum(size) + size, size) + np.arange(total)
    key, value = np.repeat(src, size) * n + a_to[place], np.repeat(x, size) * a_w[place]
    if (high - low) * n <= 4 * total:
        weight = np.bincount(key, value, (high - low) * n)
        key = np.flatnonzero(weight)
        weight = weight[key]
    else:
        key, which = np.unique(key, return_inverse=True)
        weight = np.bincount(which, value, len(key))
    keep = (weight != 0) & ~np.isnan(weight)
    src, dst = np.divmod(key[keep], n)
    return src + low, dst, weight[keep]


def multiply(a: DataFrame, b: DataFrame) -> DataFrame:
    """The same as ``graph.multiply``."""
    same = a is b
    a = checkpointed(a.select(*gr.ARC, "weight"))
    b = a if same else checkpointed(b.select(*gr.ARC, "weight"))
    every = checkpointed(gr.nodes(a if same else a.unionByName(b)))
    if a.count() + (0 if same else b.count()) + every.count() > searches.MOST:
        return gr.multiply(a, b)
    numbered = checkpointed(numbered_rows(every, ["node"], "k").select("node", F.col("k").cast("int").alias("k")), every)
    names = numbered.orderBy("k").select("node").toArrow()["node"].combine_chunks()
    n = len(names)
    own = lambda end, k: numbered.select(F.col("node").alias(end), F.col("k").alias(k)).hint("merge")  # noqa: E731  small as a file, not as a broadcast

    def columns(g: DataFrame) -> tuple:
        found = g.join(own("src", "u"), "src").join(own("dst", "v"), "dst").select("u", "v", F.col("weight").cast("double").alias("w")).toArrow()
        return _columns(n, *[found[c].to_numpy() for c in "uvw"])

    right = columns(a)
    left = right if same else columns(b)
    paths = np.concatenate([[0], np.cumsum(np.diff(right[0])[left[1]])])[left[0]]  # before each column
    pieces = np.unique(np.concatenate([np.searchsorted(paths, np.arange(0, paths[-1], PATHS), "right") - 1, [n]]))
    session = numbered.sparkSession
    tasks = max(1, min(session.sparkContext.defaultParallelism * 8, len(pieces) - 1))
    shared = session.sparkContext.broadcast((n, names, right, None if same else left, pieces))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, names, right, left, pieces = shared.value
        for batch in batches:
            for i in batch["id"].to_pylist():
                for low, high in zip(pieces[i:-1:tasks], pieces[i + 1 :: tasks], strict=True):
                    src, dst, weight = product(n, right, right if left is None else left, int(low), int(high))
                    yield from searches._handed({"src": (names, src), "dst": (names, dst), "weight": weight})

    kind = dict(numbered.dtypes)["node"]
    return session.range(0, tasks, 1, tasks).mapInArrow(work, f"src {kind}, dst {kind}, weight double")
