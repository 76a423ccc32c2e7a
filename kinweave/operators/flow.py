"""Clustering by simulated flow: columns are squared, pruned and inflated until they settle.

Flow never crosses between components, and pruning works column by column. So components
come first; those of at most ``small`` nodes are run to their end by array kernels (``settling``),
many per task; larger ones, and those whose columns outgrow a task, take the distributed loop, in
which a round is one join and a few aggregations over arcs. Each component stops by its own convergence.

Defined results: weights are mirrored and merged by maximum; nodes without arcs are clusters
of their own if given in ``extra``; a node drawn to several clusters joins the one with the
smallest id, the smallest node it holds.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import replace
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow.fs import FileSelector, FileSystem
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinweave.config import FlowConfig
from kinweave.operators import graph as gr
from kinweave.operators import settling
from kinweave.operators.settling import prune_column  # noqa: F401
from kinweave.session import checkpointed, numbered_rows

#: Components of at most so many nodes are settled in a task, as far as their columns fit one.
SMALL = 2_000_000
#: Arcs and loops of a graph whose components one task finds; rows of a batch that it hands on.
MOST, ROWS = 8_000_000, 50_000
#: Arcs from which on the loop takes kernels for its rounds, and entries of a matrix up to which it does (12 bytes each in a task).
FEW, HELD = 100_000, 60_000_000
#: Rounds of the distributed loop after which it looks for pieces that flow no longer joins.
LOOK = 4


def interpret(m: np.ndarray) -> np.ndarray:
    """Cluster number of each node, from the limit matrix, whose columns are m[:, i]."""
    u, v = np.nonzero(m.T)
    return settling.interpret(len(m), u, v, m[v, u])


def start(g: DataFrame, cfg: FlowConfig, extra: DataFrame | None = None) -> DataFrame:
    """The matrix that flow starts from: with loops, and columns that sum to 1."""
    looped = gr.loops_at_max(g, extra)
    scaled = F.when(F.col("src") == F.col("dst"), F.col("weight") * cfg.loop_scale).otherwise(F.col("weight"))
    looped = gr.nonzero(looped.withColumn("weight", scaled)) if cfg.loop_scale != 1 else looped
    return gr.normalize(gr.inflate(looped, cfg.pre_inflation) if cfg.pre_inflation != 1 else looped)


def _small(sized: DataFrame, cfg: FlowConfig, kind: str) -> DataFrame:
    """(cluster_id, node) by the kernel; cluster_id is null where a component was given up. Larger
    components are a task's work each, the others are dealt out together."""
    def run(table: pa.Table) -> pa.Table:
        names = pc.unique(table["src"])
        names = names.take(pc.sort_indices(names))
        code = lambda c: pc.index_in(table[c], names).to_numpy()
        u, v, w = code("src"), code("dst"), table["weight"].to_numpy()
        part = np.empty(len(names), np.int64)
        part[u] = table["component"].to_numpy()
        node = np.argsort(part, kind="stable")  # nodes by component, then by name
        place = np.empty_like(node)
        place[node] = np.arange(len(node))
        u, v = place[u], place[v]
        order = np.lexsort((v, u))
        bounds = np.concatenate([np.flatnonzero(np.diff(part[node], prepend=-1)), [len(node)]])
        lu, lv, lw, given_up = settling.settle_all(bounds, u[order], v[order], w[order], cfg)
        label = settling.interpret(len(node), lu, lv, lw)
        least = np.full(len(node), len(node))
        np.minimum.at(least, label, np.arange(len(node)))
        head = node[least[label]]
        open_ = np.repeat(given_up, np.diff(bounds))
        return pa.table({"cluster_id": names.take(pa.array(head, mask=open_)), "node": names.take(pa.array(node))})

    number = F.when(F.col("size") > settling.DENSE, F.col("component")).otherwise(-1 - F.col("component") % (8 * sized.sparkSession.sparkContext.defaultParallelism))
    return sized.withColumn("_task", number).groupBy("_task").applyInArrow(run, f"cluster_id {kind}, node {kind}")


def expand_pruned(m: DataFrame, cfg: FlowConfig, power: float = 1.0) -> DataFrame:
    """(src, dst, weight, chaos): the square of m with pruned columns, raised to ``power``, that sum to 1.

    The square is shuffled once by column; all else is done there by windows over a column, which
    has as many entries as the square gives it before pruning."""
    column, falling = Window.partitionBy("src"), Window.partitionBy("src").orderBy(F.desc("weight"))
    bar = 0.99999 / cfg.prune
    w, rank = F.col("weight"), F.col("_r")
    of = lambda rows, value, agg: agg(F.when(rows, value)).over(column)
    first, most = rank <= cfg.select, F.max("weight").over(column)
    judged = gr.multiply(m, m).withColumn("_r", F.rank().over(falling)).select(
        *gr.ARC, "weight", most.alias("most"), F.sum(w * w).over(column).alias("centre"),
        of(w >= bar, 1, F.count).alias("n"), F.coalesce(of(w >= bar, w, F.sum), F.lit(0.0)).alias("mass"),
        of(first, w, F.min).alias("select_bar"), of(first, 1, F.count).alias("select_n"), of(first, w, F.sum).alias("select_mass"), (of(first, rank, F.max) - 1).alias("above_n"),
        of(rank <= cfg.recover, w, F.min).alias("recover_bar"),
    )
    recover = (F.col("n") < cfg.recover) & (F.col("mass") < cfg.mass)
    ties = (F.col("select_n") <= cfg.select) | (F.col("select_bar") == F.col("most"))  # those at the bar stay
    chosen = (w > F.col("select_bar")) | (ties & (w >= F.col("select_bar")))
    chosen_n = F.when(ties, F.col("select_n")).otherwise(F.col("above_n"))
    chosen_mass = F.col("select_mass") - (F.col("select_n") - chosen_n) * F.col("select_bar")
    again = (chosen_n < cfg.recover) & (chosen_mass < cfg.mass)
    select = (w >= bar) & F.when(again, w >= F.col("recover_bar")).otherwise(chosen)
    keep = F.when(recover, w >= F.col("recover_bar")).when(F.col("n") > cfg.select, select).otherwise(w >= bar)
    chaos = ((F.col("most") - F.col("centre")) * F.count(F.lit(1)).over(column)).alias("chaos")
    kept = judged.where(keep).select(*gr.ARC, F.pow(w / F.sum(w).over(column), F.lit(float(power))).alias("weight"), chaos)
    return kept.select(*gr.ARC, (w / F.sum(w).over(column)).alias("weight"), "chaos")


def _read(folder: str, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first entry of each column, rows, values) of a matrix written in pieces sorted by column, of
    which none has a column of another's. Held at a time: the matrix and one piece."""
    store, inner = FileSystem.from_uri(folder)
    files = [pq.ParquetFile(store.open_input_file(f.path)) for f in store.get_file_info(FileSelector(inner)) if f.path.endswith(".parquet") and f.size]
    files = sorted((f for f in files if f.metadata.num_rows), key=lambda f: next(f.iter_batches(1, columns=["src"]))["src"][0].as_py())
    total = sum(f.metadata.num_rows for f in files)
    size, v, w, k = np.zeros(n, np.int64), np.empty(total, np.int32), np.empty(total), 0
    for f in files:
        for batch in f.iter_batches(1_000_000, columns=["src", "dst", "weight"]):
            own = slice(k, k + batch.num_rows)
            size += np.bincount(batch["src"].to_numpy(), minlength=n)
            v[own], w[own], k = batch["dst"].to_numpy(), batch["weight"].to_numpy(), own.stop
        f.close()
    return np.concatenate([[0], np.cumsum(size)]), v, w


def expand_held(m: DataFrame, n: int, cfg: FlowConfig, power: float) -> DataFrame:
    """``expand_pruned`` by array kernels: each task reads the whole matrix, which ``checkpointed`` wrote
    as ``_read`` asks for, with nodes as numbers below ``n``, and makes a range of columns, in order."""
    spark, folder = m.sparkSession, m._kinweave_path
    size = m.groupBy("src").agg(F.count(F.lit(1)).alias("k"))
    work_of = m.join(size.withColumnRenamed("src", "dst"), "dst").groupBy("src").agg(F.sum("k").alias("k")).toArrow()
    paths = np.zeros(n, np.int64)
    paths[work_of["src"].to_numpy()] = work_of["k"].to_numpy()
    before = np.concatenate([[0], np.cumsum(paths)])
    tasks = 2 * spark.sparkContext.defaultParallelism
    cuts = np.unique([0, *np.searchsorted(before, np.arange(1, tasks) * (before[-1] / tasks)), n]).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch["id"].to_pylist():
                at, v, w = _read(folder, n)
                held, rows = [], 0
                for low, high in settling.ranges(at, v, cuts[i], cuts[i + 1]):
                    u, *own, chaos = settling.expanded(at, v, w, low, high, None, cfg, power)
                    held.append((u, *own, chaos[u - low]))
                    rows += len(u)
                    if rows > ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*held, strict=True)], names=[*gr.ARC, "weight", "chaos"])
                        held, rows = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*held, strict=True)], names=[*gr.ARC, "weight", "chaos"])

    return spark.range(0, len(cuts) - 1, 1, len(cuts) - 1).mapInArrow(run, "src int, dst int, weight double, chaos double")


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arcs with the number of their component and how many nodes it has, all in one task."""
    held = list(batches)
    if not held:
        return
    table = pa.Table.from_batches(held)
    del held
    names = pc.unique(pa.chunked_array([*table["src"].chunks, *table["dst"].chunks]))
    u = pc.index_in(table["src"], names).to_numpy()
    label = settling.components(len(names), u, pc.index_in(table["dst"], names).to_numpy())
    size = np.bincount(label)
    table = table.append_column("component", pa.array(label[u])).append_column("size", pa.array(size[label[u]]))
    yield from table.to_batches(max_chunksize=ROWS)


def _by_size(m: DataFrame, small: int) -> tuple[DataFrame, DataFrame]:
    """Arcs of components of at most ``small`` nodes, with the component's number and size; and the other arcs."""
    m, kind = m.select(*gr.ARC, "weight"), dict(m.dtypes)["src"]
    if m.count() <= MOST:
        sized = checkpointed(m.coalesce(1).mapInArrow(_labelled, f"src {kind}, dst {kind}, weight double, component bigint, size bigint"))
    else:
        parts = checkpointed(gr.components(m))
        sizes = parts.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
        numbered = numbered_rows(sizes, ["component"], "_k")
        own = parts.withColumnRenamed("node", "src").join(numbered, "component").select("src", F.col("_k").cast("bigint").alias("component"), "size")
        sized = checkpointed(m.join(own, "src").select(*gr.ARC, "weight", "component", "size"))
    return sized.where(F.col("size") <= small), sized.where(F.col("size") > small).select(*gr.ARC, "weight")


def _large(m: DataFrame, cfg: FlowConfig, kind: str, small: int, trace: list | None = None) -> DataFrame:
    """(cluster_id, node) by the distributed loop. Pruning cuts large components into pieces; those
    that have become small leave the loop for the kernel, which goes on from where they are."""
    done = []
    worst = None
    named = None
    if FEW < m.count() <= MOST and m.sparkSession.conf.get("spark.checkpoint.dir", "file:").startswith("file:"):
        named = checkpointed(numbered_rows(m.select(F.col("src").alias("node")).distinct(), ["node"], "k").select("node", F.col("k").cast("int").alias("k")))
        n, kind = named.count(), "int"
        own = lambda end: named.select(F.col("node").alias(end), F.col("k").alias(f"_{end}")).hint("merge")
        m = m.join(own("src"), "src").join(own("dst"), "dst").select(F.col("_src").alias("src"), F.col("_dst").alias("dst"), "weight")
        m = checkpointed(m.repartitionByRange("src").sortWithinPartitions("src", "dst"))
    for i in range(1, cfg.most_rounds + 1):
        by_kernel = named is not None and m.count() <= HELD
        m = checkpointed(expand_held(m, n, cfg, cfg.power(i - 1)) if by_kernel else expand_pruned(m, cfg, cfg.power(i - 1)), m)
        if named is not None and not by_kernel:
            m = checkpointed(m.repartitionByRange("src").sortWithinPartitions("src", "dst"), m)
        arcs, worst = m.agg(F.count(F.lit(1)), F.max("chaos")).first()
        if trace is not None:
            trace.append({"round": i, "arcs": arcs, "chaos": worst})
        if worst is None or (worst < cfg.chaos and i > cfg.initial_rounds):
            break
        if i % LOOK == 0 and small and i >= cfg.initial_rounds and (named is None or arcs <= MOST):
            pieces, m = _by_size(m, min(small, settling.DENSE))
            done.append(_small(pieces, replace(cfg, initial_rounds=0), kind))
            m = checkpointed(m.repartitionByRange("src").sortWithinPartitions("src", "dst")) if named is not None else m
            if m.isEmpty():
                break
    else:
        warnings.warn(f"flow has not settled after {cfg.most_rounds} rounds: {worst}", stacklevel=2)
    found = reduce(DataFrame.unionByName, [*done, interpret_graph(m)])
    for c in ("cluster_id", "node") if named is not None else ():
        found = found.withColumnRenamed(c, "k").join(named.withColumnRenamed("node", c).hint("merge"), "k").drop("k")
    return found.select("cluster_id", "node")


def interpret_graph(m: DataFrame) -> DataFrame:
    """(cluster_id, node) of a limit matrix: attractors and what flows to them."""
    own = F.coalesce(F.max(F.when(F.col("src") == F.col("dst"), F.col("weight"))), F.lit(0.0))
    bars = m.groupBy("src").agg(own.alias("own"), F.max("weight").alias("most"))
    bar = F.when(F.col("own") >= F.col("most"), F.col("own") / 1.01).otherwise(0.999 * F.col("own") + 0.001 * F.col("most"))
    dag = checkpointed(m.join(bars, "src").where(F.col("weight") >= bar).select(*gr.ARC, "weight"))
    heads = dag.where("src = dst").select(F.col("src").alias("node"))
    label = gr.components(gr.sub_graph(dag, heads), heads).select("node", F.col("component").alias("cluster_id"))
    attractors = label = checkpointed(label)
    open_arcs = dag.join(heads.withColumnRenamed("node", "src"), "src", "left_anti")
    seen = None
    while True:  # the others take the smallest cluster that any of their arcs leads to, until nothing changes
        more = open_arcs.join(label.withColumnRenamed("node", "dst"), "dst").groupBy(F.col("src").alias("node")).agg(F.min("cluster_id").alias("cluster_id"))
        label = checkpointed(attractors.unionByName(more), *([] if label is attractors else [label]))
        now = label.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("node", "cluster_id"))).first()
        if now == seen:
            break
        seen = now
    rest = m.select(F.col("src").alias("node")).distinct().join(label, "node", "left_anti")
    found = label.select("cluster_id", "node").unionByName(rest.select(F.col("node").alias("cluster_id"), "node"))
    least = found.groupBy("cluster_id").agg(F.min("node").alias("least"))
    return found.join(least, "cluster_id").select(F.col("least").alias("cluster_id"), "node")


def flow_clusters(arcs: DataFrame, cfg: FlowConfig = FlowConfig(), extra: DataFrame | None = None, small: int = SMALL, trace: list | None = None) -> DataFrame:
    """(cluster_id, node): a partition of the nodes of ``arcs`` (src, dst, weight).

    ``small`` only chooses between kernel and loop, which follow the same rules. ``trace`` gets the
    number of arcs and the largest chaos of each round of the loop."""
    g = gr.drop_loops(gr.load(arcs.select("src", "dst", "weight")))
    first = checkpointed(start(g, cfg, extra))
    little, large = _by_size(first, small)
    kind = dict(first.dtypes)["src"]
    found = checkpointed(_small(little, cfg, kind))
    given_up = found.where("cluster_id IS NULL").select(F.col("node").alias("src"))
    if not given_up.isEmpty():
        large = large.unionByName(little.join(given_up, "src", "left_semi").select(*gr.ARC, "weight"))
    done = found.where("cluster_id IS NOT NULL")
    return done if large.isEmpty() else done.unionByName(_large(checkpointed(large), cfg, kind, small, trace))


def keep_clusters(g: DataFrame, cfg: FlowConfig = FlowConfig()) -> DataFrame:
    """The arcs of a graph that lie within its own flow clusters."""
    g = checkpointed(g)
    return gr.blocks(g, checkpointed(flow_clusters(g, cfg)))


def split_connected(clusters: DataFrame, g: DataFrame) -> DataFrame:
    """Clusters cut into the pieces that are connected within them; named by their smallest node."""
    return gr.components(gr.blocks(g, clusters), clusters.select("node")).select(F.col("component").alias("cluster_id"), "node")


def sub_cluster(g: DataFrame, clusters: DataFrame, cfg: FlowConfig = FlowConfig()) -> DataFrame:
    """Clusters of a clustering: flow is kept within the given blocks."""
    return flow_clusters(gr.blocks(g, clusters), cfg, clusters.select("node"))


def hierarchy(arcs: DataFrame, cfg: FlowConfig = FlowConfig(), levels: int = 3) -> DataFrame:
    """(level, cluster_id, node): clusters, then clusters of the graph of clusters, and so on."""
    arcs = checkpointed(arcs.select("src", "dst", "weight"))
    level = checkpointed(flow_clusters(arcs, cfg))
    out = [level.withColumn("level", F.lit(1))]
    g = gr.load(arcs)
    for i in range(2, levels + 1):
        above = flow_clusters(gr.drop_loops(gr.contract(g, level)), cfg, level.select(F.col("cluster_id").alias("node")).distinct())
        joined = level.join(above.select(F.col("node").alias("cluster_id"), F.col("cluster_id").alias("up")), "cluster_id")
        level = checkpointed(joined.select(F.col("up").alias("cluster_id"), "node"))
        out.append(level.withColumn("level", F.lit(i)))
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result.select("level", "cluster_id", "node")


