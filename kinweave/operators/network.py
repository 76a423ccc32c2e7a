"""Statistics of networks: clustering coefficients, histograms, sweeps, distances, paths.

Searches start from a stated set of sources. Graphs of bounded size take the kernels of
``searches``; larger ones go forward by one join per step over rows (source, node), so that
sources are processed side by side (``kernel=False`` asks for that). Defined results: loops are
ignored; nodes without triangles have coefficient 0, those of degree below 2 too; sources
that are no nodes reach nothing; an empty graph gives empty results.
"""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.operators import graph as gr
from kinweave.operators import searches
from kinweave.session import checkpointed


def clustering_coefficient(g: DataFrame) -> DataFrame:
    """(node, degree, triangles, coefficient): joined pairs of neighbours over all pairs."""
    found = gr.triangles(g).select(F.explode(F.array("a", "b", "c")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("t"))
    d = F.col("degree")
    t = F.coalesce("t", F.lit(0))
    value = F.when(d > 1, 2 * t / (d * (d - 1))).otherwise(0.0)
    return gr.degrees(g).join(found, "node", "left").select("node", "degree", t.alias("triangles"), value.alias("coefficient"))


def weight_histogram(g: DataFrame, width: float) -> DataFrame:
    """(bin_start, arcs)."""
    return g.groupBy((F.floor(F.col("weight") / width) * F.lit(float(width))).alias("bin_start")).agg(F.count(F.lit(1)).alias("arcs"))


def degree_histogram(g: DataFrame) -> DataFrame:
    """(degree, nodes)."""
    return gr.degrees(g).groupBy("degree").agg(F.count(F.lit(1)).alias("nodes"))


def scale_free_fit(g: DataFrame) -> DataFrame:
    """One row: slope and R2 of log nodes over log degree."""
    h = degree_histogram(g).select(F.log("degree").alias("x"), F.log("nodes").alias("y"))
    return h.agg(F.regr_slope("y", "x").alias("slope"), F.regr_r2("y", "x").alias("r2"))


def threshold_sweep(g: DataFrame, thresholds: list[float]) -> DataFrame:
    """Per threshold: edges, nodes with edges, mean degree of what is at least that heavy.

    One pass: an edge counts for the thresholds up to its weight, which are aggregated first."""
    marks = F.array(*[F.lit(float(t)) for t in sorted(thresholds)])
    pairs = g.where("src <> dst").select(F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v"), "weight").groupBy("u", "v").agg(F.max("weight").alias("weight"))
    passed = lambda df: df.select("*", F.explode(F.filter(marks, lambda t: t <= F.col("weight"))).alias("threshold"))
    edges = passed(pairs).groupBy("threshold").agg(F.count(F.lit(1)).alias("edges"))
    strongest = pairs.select(F.explode(F.array("u", "v")).alias("node"), "weight").groupBy("node").agg(F.max("weight").alias("weight"))
    nodes = passed(strongest).groupBy("threshold").agg(F.count(F.lit(1)).alias("nodes"))
    return edges.join(nodes, "threshold").select("threshold", "edges", "nodes", (2 * F.col("edges") / F.col("nodes")).alias("mean_degree"))


#: How a sweep reduces the graph for one of its values.
REDUCTIONS = {
    "threshold": lambda g, x: g.where(F.col("weight") >= x),
    "knn": lambda g, x: gr.knn(g, int(x)),
    "knn_union": lambda g, x: gr.knn(g, int(x), False),
    "cap": lambda g, x: gr.cap_degrees(g, int(x)),
    "power": lambda g, x: gr.power_threshold(g, x),
}


def sweep(g: DataFrame, values: list[float], by: str = "threshold") -> DataFrame:
    """Per value: edges and nodes of what the reduction leaves of the graph, its components, the
    largest, nodes alone with one other, mean degree, mean clustering coefficient and mean weight."""
    found = []
    whole = checkpointed(gr.load(gr.drop_loops(g)))
    for x in values:  # a parameter, not data
        part = checkpointed(REDUCTIONS[by](whole, x))
        sizes = gr.components(part).groupBy("component").agg(F.count(F.lit(1)).alias("s"))
        count = F.count(F.lit(1))
        parts = sizes.agg(count.alias("components"), F.coalesce(F.max("s"), F.lit(0)).alias("largest"), F.count(F.when(F.col("s") == 2, 1)).alias("couples"))
        one = clustering_coefficient(part).agg(count.alias("nodes"), F.avg("degree").alias("mean_degree"), F.avg("coefficient").alias("coefficient"))
        edges = part.agg(F.count(F.when(F.col("src") < F.col("dst"), 1)).alias("edges"), F.avg("weight").alias("mean_weight"))
        found.append(edges.join(one).join(parts).withColumn("value", F.lit(float(x))))  # one row each
    return reduce(DataFrame.unionByName, found).select("value", "edges", "nodes", "components", "largest", "couples", "mean_degree", "coefficient", "mean_weight")


def distances(g: DataFrame, sources: DataFrame, most: int | None = None) -> DataFrame:
    """(source, node, depth, paths): fewest arcs from each source, up to ``most`` (None: until nothing
    new is reached), and the number of shortest paths; the source itself at depth 0."""
    arcs = g.where("src <> dst").select("src", "dst").distinct()
    known = gr.nodes(g).join(sources.select("node").distinct(), "node", "left_semi")
    front = checkpointed(known.select(F.col("node").alias("source"), "node", F.lit(0).alias("depth"), F.lit(1.0).alias("paths")))
    reached = front
    for depth in count(1) if most is None else range(1, most + 1):
        forward = front.join(arcs.withColumnRenamed("src", "node"), "node").groupBy("source", F.col("dst").alias("node")).agg(F.sum("paths").alias("paths"))
        fresh = forward.join(reached.select("source", "node"), ["source", "node"], "left_anti")
        front = checkpointed(fresh.select("source", "node", F.lit(depth).alias("depth"), "paths"))
        if front.isEmpty():
            break
        reached = checkpointed(reached.unionByName(front), reached, front) if depth % 8 == 0 else reached.unionByName(front)
        front = reached.where(F.col("depth") == depth) if depth % 8 == 0 else front
    return reached


def depths(g: DataFrame, sources: DataFrame, most: int | None = None, kernel: bool = True) -> DataFrame:
    """(source, node, depth): ``distances`` without the number of paths."""
    if kernel and (p := searches.packed(g)):
        return searches.depths(p, sources, most)
    return distances(g, sources, most).select("source", "node", "depth")


def eccentricity(g: DataFrame, sources: DataFrame, most: int | None = None, kernel: bool = True) -> DataFrame:
    """(node, eccentricity, reached): depth of the farthest node, within ``most`` arcs if given."""
    if kernel and (p := searches.packed(g)):
        return searches.eccentricity(p, sources, most)
    return distances(g, sources, most).groupBy(F.col("source").alias("node")).agg(F.max("depth").alias("eccentricity"), F.count(F.lit(1)).alias("reached"))


def _flows(g: DataFrame, sources: DataFrame, most: int | None) -> list[DataFrame]:
    """Per depth from the deepest up: (source, node, dst, flow), how much of one unit for each node that
    a source reaches goes over the arc from node to dst on shortest paths, and the nodes' depth."""
    arcs = g.where("src <> dst").select("src", "dst").distinct()
    reached = checkpointed(distances(g, sources, most))
    deepest = reached.agg(F.max("depth")).first()[0] or 0
    level = lambda k: reached.where(F.col("depth") == k).select("source", "node", "paths")
    below = level(deepest).withColumn("share", F.lit(0.0))
    found = []
    for k in range(deepest - 1, -1, -1):
        carried = below.select("source", F.col("node").alias("dst"), ((1 + F.col("share")) / F.col("paths")).alias("unit"))
        passed = level(k).join(arcs.withColumnRenamed("src", "node"), "node").join(carried, ["source", "dst"])
        flow = checkpointed(passed.select("source", "node", "dst", (F.col("paths") * F.col("unit")).alias("flow"), F.lit(k).alias("depth")))
        shares = flow.groupBy("source", "node").agg(F.sum("flow").alias("share"))
        below = level(k).join(shares, ["source", "node"], "left").select("source", "node", "paths", F.coalesce("share", F.lit(0.0)).alias("share"))
        found.append(flow)
    return found


def betweenness(g: DataFrame, sources: DataFrame, most: int | None = None, kernel: bool = True) -> DataFrame:
    """(node, score): shortest paths from the sources that pass through a node, each node pair
    sharing one unit among its paths. Depths are gone through backwards, a join each."""
    if kernel and (p := searches.packed(g)):
        return searches.betweenness(p, sources, most)
    found = _flows(g, sources, most)
    if not found:
        return gr.nodes(g).select("node", F.lit(0.0).alias("score")).limit(0)
    return reduce(DataFrame.unionByName, found).where("depth > 0").groupBy("node").agg(F.sum("flow").alias("score")).where("score > 0")


def edge_betweenness(g: DataFrame, sources: DataFrame, most: int | None = None, kernel: bool = True) -> DataFrame:
    """(src, dst, weight): the same for arcs, those that leave a source included."""
    if kernel and (p := searches.packed(g)):
        return searches.edge_betweenness(p, sources, most)
    found = _flows(g, sources, most)
    if not found:
        return g.select("src", "dst", F.lit(0.0).alias("weight")).limit(0)
    return reduce(DataFrame.unionByName, found).groupBy(F.col("node").alias("src"), "dst").agg(F.sum("flow").alias("weight"))


def shortest_path_nodes(g: DataFrame, pairs: DataFrame, most: int | None = None, kernel: bool = True) -> DataFrame:
    """(source, target, node, depth): nodes on any shortest path of each pair (source, target)."""
    if kernel and (p := searches.packed(g)):
        return searches.shortest_path_nodes(p, pairs, most)
    out = checkpointed(distances(g, pairs.select(F.col("source").alias("node")), most))
    back = checkpointed(distances(gr.transpose(g), pairs.select(F.col("target").alias("node")), most))
    length = pairs.join(out.select("source", F.col("node").alias("target"), F.col("depth").alias("length")), ["source", "target"])
    from_source = length.join(out.select("source", "node", "depth"), "source").where("depth <= length")
    to_target = back.select(F.col("source").alias("target"), "node", F.col("depth").alias("rest"))
    return from_source.join(to_target, ["target", "node"]).where("depth + rest = length").select("source", "target", "node", "depth")
