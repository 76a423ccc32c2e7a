"""Comparing and repairing clusterings, given as (cluster_id, node).

All measures follow from the sizes of clusters and of their meets, one aggregation over a
join on the node. Defined results: nodes in one clustering only take part in no meet; rows
with a null are ignored; repeated rows count once; empty clusterings give empty results or
nulls; single nodes are clusters like others.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations, pairwise

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinweave.operators.graph import nodes
from kinweave.operators.ranks import quantiles
from kinweave.session import numbered_rows


def _bare(c: DataFrame) -> DataFrame:
    return c.select("cluster_id", "node").dropna().distinct()


def contingency(a: DataFrame, b: DataFrame) -> DataFrame:
    """(a, b, meet): shared nodes of every two clusters that share any."""
    left, right = _bare(a).withColumnRenamed("cluster_id", "a"), _bare(b).withColumnRenamed("cluster_id", "b")
    return left.join(right, "node").groupBy("a", "b").agg(F.count(F.lit(1)).alias("meet"))


def _sized(a: DataFrame, b: DataFrame) -> DataFrame:
    size = lambda c, k: _bare(c).groupBy(F.col("cluster_id").alias(k)).agg(F.count(F.lit(1)).alias(f"n{k}"))
    return contingency(a, b).join(size(a, "a"), "a").join(size(b, "b"), "b")


def distances(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: split-join, variation of information (natural logarithm) and Mirkin, each as what lies
    between either clustering and the meet; Rand, adjusted Rand, Jaccard.

    For partitions of the same nodes."""
    cells = contingency(a, b)
    n = F.col("n").cast("double")
    pairs = lambda x: x * (x - 1) / 2

    def side(key: str) -> DataFrame:
        sizes = cells.groupBy(key).agg(F.sum("meet").alias("s"), F.max("meet").alias("m"))
        s = F.col("s").cast("double")
        return sizes.agg(F.sum("s").alias("n"), F.sum("m").alias(f"proj_{key}"), F.sum(s * F.log(s)).alias(f"ent_{key}"), F.sum(pairs(s)).alias(f"pair_{key}"), F.sum(s * s).alias(f"sq_{key}"))

    m = F.col("meet").cast("double")
    joint = cells.agg(F.sum(m * F.log(m)).alias("ent"), F.sum(pairs(m)).alias("pair"), F.sum(m * m).alias("sq"))
    row = side("a").join(side("b").drop("n")).join(joint)  # one row each
    expected = F.col("pair_a") * F.col("pair_b") / pairs(n)
    agree = pairs(n) + 2 * F.col("pair") - F.col("pair_a") - F.col("pair_b")
    return row.select(
        F.col("n").alias("nodes"), (F.col("n") - F.col("proj_a")).alias("split_join_a"), (F.col("n") - F.col("proj_b")).alias("split_join_b"),
        F.greatest(F.lit(0.0), (F.col("ent_a") - F.col("ent")) / n).alias("vi_a"), F.greatest(F.lit(0.0), (F.col("ent_b") - F.col("ent")) / n).alias("vi_b"),
        (F.col("sq_a") - F.col("sq")).alias("mirkin_a"), (F.col("sq_b") - F.col("sq")).alias("mirkin_b"),
        (agree / pairs(n)).alias("rand"), ((F.col("pair") - expected) / ((F.col("pair_a") + F.col("pair_b")) / 2 - expected)).alias("adjusted_rand"),
        (F.col("pair") / (F.col("pair_a") + F.col("pair_b") - F.col("pair"))).alias("jaccard"),
    )


def all_distances(clusterings: dict[str, DataFrame], chain: bool = False) -> DataFrame:
    """(first, second, distances...) of every two clusterings, or with ``chain`` of neighbours only."""
    names = list(clusterings)
    pairs = list(pairwise(names)) if chain else list(combinations(names, 2))
    rows = [distances(clusterings[a], clusterings[b]).select(F.lit(a).alias("first"), F.lit(b).alias("second"), "*") for a, b in pairs]  # of a few names
    return reduce(DataFrame.unionByName, rows)


def parts(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row of two sets of (node): how many are left only, in both, right only, and how they relate:
    equal, sub (all of the left are in the right), super, disjoint or overlap."""
    own = lambda df, side: df.select("node", F.lit(side).alias("side")).dropna().distinct()
    both = own(a, 1).unionByName(own(b, 2)).groupBy("node").agg(F.sum("side").alias("s"))
    n = both.agg(*[F.count(F.when(F.col("s") == k, 1)).alias(c) for k, c in ((1, "left_only"), (3, "shared"), (2, "right_only"))])
    left, shared, right = F.col("left_only") == 0, F.col("shared") == 0, F.col("right_only") == 0
    return n.select("*", F.when(left & right, "equal").when(left, "sub").when(right, "super").when(shared, "disjoint").otherwise("overlap").alias("relation"))


def meet(*clusterings: DataFrame) -> DataFrame:
    """(cluster_id, node): the coarsest clustering that refines all; the id is the smallest node."""
    joined = _bare(clusterings[0]).withColumnRenamed("cluster_id", "c0")
    keys = ["c0"]
    for i, c in enumerate(clusterings[1:], 1):
        joined = joined.join(_bare(c).withColumnRenamed("cluster_id", f"c{i}"), "node")
        keys.append(f"c{i}")
    least = joined.groupBy(*keys).agg(F.min("node").alias("cluster_id"))
    return joined.join(least, keys).select("cluster_id", "node")


def mate(a: DataFrame, b: DataFrame, at_least: int = 1) -> DataFrame:
    """Every two clusters that share nodes: Dice score, meet, what is left on either side.

    ``at_least`` 2 keeps clusters of ``a`` that meet several of ``b``."""
    rows = _sized(a, b).select("a", "b", (2 * F.col("meet") / (F.col("na") + F.col("nb"))).alias("dice"), "meet", (F.col("na") - F.col("meet")).alias("left_only"), (F.col("nb") - F.col("meet")).alias("right_only"), F.col("na").alias("size_a"), F.col("nb").alias("size_b"))
    if at_least < 2:
        return rows
    several = rows.groupBy("a").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= at_least).select("a")
    return rows.join(several, "a", "left_semi")


def volatility(a: DataFrame, b: DataFrame, part: float = 0.5) -> DataFrame:
    """(node, score): 1 / shared nodes of its two clusters, where these are less than ``part`` of either
    cluster. Nodes whose clusters agree better are not volatile and have no row."""
    left, right = _bare(a).withColumnRenamed("cluster_id", "a"), _bare(b).withColumnRenamed("cluster_id", "b")
    torn = _sized(a, b).where((F.col("meet") < part * F.col("na")) & (F.col("meet") < part * F.col("nb")))
    return left.join(right, "node").join(torn, ["a", "b"]).select("node", (1 / F.col("meet")).alias("score"))


def granularity(c: DataFrame) -> DataFrame:
    """One row: clusters, extreme, mean and centre sizes, single and small clusters; how many of the
    smallest clusters hold as many nodes as the largest (``dg_index``); and, going up from the
    smallest to the one that completes half of the nodes, its size and how many are listed above it."""
    sizes = _bare(c).groupBy("cluster_id").agg(F.count(F.lit(1)).alias("s"))
    # clusters of one size are one row, so the running sums have few rows
    per_size = sizes.groupBy("s").agg(F.count(F.lit(1)).alias("k"))
    smaller, every = Window.partitionBy().orderBy("s").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    s, k, n = F.col("s"), F.col("k"), F.col("n")
    nodes, number = F.coalesce(F.sum(s * k).over(smaller), F.lit(0)), F.coalesce(F.sum(k).over(smaller), F.lit(0))
    cum = per_size.select("s", "k", nodes.alias("below"), number.alias("before"), F.max("s").over(every).alias("most"), F.sum(s * k).over(every).alias("n"), F.sum("k").over(every).alias("c"))
    reached = lambda goal: F.when(F.col("below") + s * k >= goal, F.col("before") + F.greatest(F.lit(1), F.ceil((goal - F.col("below")) / s)))
    half = F.floor((n + 1) / 2)
    return cum.agg(
        F.sum(k).alias("clusters"), F.max(s).alias("largest"), F.min(s).alias("smallest"), (F.sum(s * k) / F.sum(k)).alias("mean_size"), (F.sum(s * s * k) / F.sum(s * k)).alias("centre"),
        F.sum(F.when(s == 1, k).otherwise(0)).alias("singletons"), F.sum(F.when(s <= 4, k).otherwise(0)).alias("up_to_four"), F.min(reached(F.col("most"))).alias("dg_index"),
        F.min(F.when(F.col("below") + s * k >= half, s)).alias("half_size"), (F.max("c") - F.min(reached(half))).alias("half_index"),
    )


def node_coverage(g: DataFrame, c: DataFrame) -> DataFrame:
    """(node, cluster_id, mass, coverage, most_coverage) of the clustered nodes of a graph.

    mass: the part of the node's weight that stays in its cluster. coverage: with d nodes in the
    cluster, u in the cluster or among the neighbours, and the weights scaled to sum 1, it is
    1 - (d - (inside - outside) / sum of squares) / u; most_coverage has the largest weight in
    place of the sum of squares. A node without arcs of its own has 0 in all three."""
    own = _bare(c)
    every = nodes(g).join(own, "node")
    arcs = g.join(own.select(F.col("node").alias("src"), F.col("cluster_id").alias("_c")), "src").join(own.select(F.col("node").alias("dst"), F.col("cluster_id").alias("_d")), "dst", "left")
    inside = F.coalesce(F.col("_c") == F.col("_d"), F.lit(False))
    w = F.col("weight")
    sums = arcs.groupBy(F.col("src").alias("node"), F.col("_c").alias("cluster_id")).agg(
        F.sum(w).alias("sum"), F.sum(w * w).alias("ssq"), F.max(w).alias("most"), F.sum(F.when(inside, w).otherwise(0.0)).alias("in"), F.count(F.when(~inside, 1)).alias("out")
    )
    sizes = own.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("d"))
    judged = every.join(sums, ["node", "cluster_id"], "left").join(sizes, "cluster_id")
    gain = (2 * F.col("in") - F.col("sum")) / F.col("sum")
    of = lambda centre: F.coalesce(F.when((F.col("sum") != 0) & (centre != 0), 1 - (F.col("d") - gain / centre) / (F.col("d") + F.col("out"))), F.lit(0.0))
    mass = F.coalesce(F.when(F.col("sum") != 0, F.col("in") / F.col("sum")), F.lit(0.0))
    return judged.select("node", "cluster_id", mass.alias("mass"), of(F.col("ssq") / (F.col("sum") * F.col("sum"))).alias("coverage"), of(F.col("most") / F.col("sum")).alias("most_coverage"))


def coverage(g: DataFrame, c: DataFrame) -> DataFrame:
    """One row: means over the clustered nodes of the graph of mass and of both coverages
    (efficiency), and the pairs within clusters over the pairs of the graph's nodes."""
    pairs = _bare(c).groupBy("cluster_id").agg(F.count(F.lit(1)).alias("s")).agg(F.sum(F.col("s") * (F.col("s") - 1)).alias("_pairs"))
    n = nodes(g).agg(F.count(F.lit(1)).alias("_n"))
    means = node_coverage(g, c).agg(F.avg("mass").alias("mass"), F.avg("coverage").alias("efficiency"), F.avg("most_coverage").alias("most_efficiency"))
    return means.join(pairs).join(n).select("mass", (F.col("_pairs") / (F.col("_n") * (F.col("_n") - 1))).alias("area"), "efficiency", "most_efficiency")  # one row each


def cluster_coverage(g: DataFrame, c: DataFrame) -> DataFrame:
    """(cluster_id, nodes, mass, efficiency): the same means per cluster."""
    return node_coverage(g, c).groupBy("cluster_id").agg(F.count(F.lit(1)).alias("nodes"), F.avg("mass").alias("mass"), F.avg("coverage").alias("efficiency"))


def residue(g: DataFrame, c: DataFrame) -> DataFrame:
    """Clusters extended to nodes of the graph in none: to the cluster with the largest sum of
    weights from the node, of equal ones the smallest id. Nodes without such arcs stay out."""
    own = _bare(c)
    open_nodes = g.select(F.col("src").alias("node")).distinct().join(own, "node", "left_anti")
    pull = g.join(open_nodes.withColumnRenamed("node", "src"), "src", "left_semi").join(own.withColumnRenamed("node", "dst"), "dst")
    sums = pull.groupBy("src", "cluster_id").agg(F.sum("weight").alias("w"))
    best = sums.groupBy("src").agg(F.min(F.struct((-F.col("w")).alias("w"), "cluster_id")).alias("b"))
    return own.unionByName(best.select(F.col("b.cluster_id").alias("cluster_id"), F.col("src").alias("node")))


def enstrict(c: DataFrame, every: DataFrame, overlap: str = "cut") -> DataFrame:
    """A partition of the nodes of ``every``, clusters being named by their smallest node.

    Nodes in several clusters stay in the one with the smallest id ('cut'), or form clusters of
    those that are in the same several ('split'); with 'keep' they stay in all, which is no
    partition, and ids stay as they are. Nodes in none are clusters of their own; others are dropped."""
    held = _bare(c).join(every.select("node").distinct(), "node", "left_semi")
    alone = every.select("node").distinct().join(held, "node", "left_anti")
    if overlap == "keep":
        kind = dict(c.dtypes)["cluster_id"]
        return held.select("cluster_id", "node").unionByName(alone.select(F.col("node").cast(kind).alias("cluster_id"), "node"))
    pick = {"cut": F.min("cluster_id"), "split": F.array_sort(F.collect_set("cluster_id"))}[overlap]  # the clusters of one node
    placed = held.groupBy("node").agg(pick.alias("_c"))
    least = placed.groupBy("_c").agg(F.min("node").alias("cluster_id"))
    return placed.join(least, "_c").select("cluster_id", "node").unionByName(alone.select(F.col("node").alias("cluster_id"), "node"))


def project(c: DataFrame, nodes: DataFrame) -> DataFrame:
    """The clustering restricted to ``nodes``."""
    return _bare(c).join(nodes.select("node").distinct(), "node", "left_semi")


def numbered(c: DataFrame, prefix: str = "OG", start: int = 1000) -> DataFrame:
    """(group_id, node): clusters named by size, largest first, of equal ones by smallest node."""
    sizes = _bare(c).groupBy("cluster_id").agg(F.count(F.lit(1)).alias("s"), F.min("node").alias("least"))
    ids = numbered_rows(sizes, [F.desc("s"), "least"], "place", start)
    return _bare(c).join(ids.select("cluster_id", "place"), "cluster_id").select(F.concat(F.lit(prefix), F.col("place").cast("string")).alias("group_id"), "node")


def nested_order(levels: list[DataFrame]) -> DataFrame:
    """(node, place): nodes in an order that keeps the clusters of each level together, the coarsest
    level first; larger clusters before smaller ones, then by id, last by node."""
    rows, order = None, []
    for i, level in enumerate(levels):
        own = _bare(level).withColumnRenamed("cluster_id", f"_c{i}")
        own = own.join(own.groupBy(f"_c{i}").agg(F.count(F.lit(1)).alias(f"_s{i}")), f"_c{i}")
        rows = own if rows is None else rows.join(own, "node")
        order += [F.desc(f"_s{i}"), f"_c{i}"]
    return numbered_rows(rows, [*order, "node"], "place").select("node", "place")


def node_weights(g: DataFrame, c: DataFrame) -> DataFrame:
    """(node, cluster_id, weight, share): what each node sends to each cluster, and its part of
    all that the node sends to clusters."""
    sums = g.where("src <> dst").join(_bare(c).withColumnRenamed("node", "dst"), "dst").groupBy(F.col("src").alias("node"), "cluster_id").agg(F.sum("weight").alias("weight"))
    totals = sums.groupBy("node").agg(F.sum("weight").alias("_t"))
    return sums.join(totals, "node").select("node", "cluster_id", "weight", (F.col("weight") / F.col("_t")).alias("share"))


def absorb_small(g: DataFrame, c: DataFrame, most: int) -> DataFrame:
    """Clusters of at most ``most`` nodes dissolved: their nodes go to the larger cluster that pulls
    them most, of equal ones the smallest id, or stay where they are if none does."""
    own = _bare(c)
    large = own.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("s")).where(F.col("s") > most).select("cluster_id")
    kept = own.join(large, "cluster_id", "left_semi")
    small = own.join(large, "cluster_id", "left_anti")
    pulled = node_weights(g, kept).join(small.select("node"), "node", "left_semi")
    best = pulled.groupBy("node").agg(F.min(F.struct((-F.col("weight")).alias("w"), "cluster_id")).alias("b"))
    moved = small.join(best, "node", "left").select(F.coalesce("b.cluster_id", "cluster_id").alias("cluster_id"), "node")
    return kept.unionByName(moved)


def collected(results: dict[str, DataFrame], key: str, value: str) -> DataFrame:
    """(key, n, least, most, mean, median) of one value over several result tables."""
    rows = None
    for df in results.values():
        one = df.select(key, F.col(value).cast("double").alias("v"))
        rows = one if rows is None else rows.unionByName(one)
    sums = rows.groupBy(key).agg(F.count("v").alias("n"), F.min("v").alias("least"), F.max("v").alias("most"), F.avg("v").alias("mean"))
    return sums.join(quantiles(rows, key, "v", {"median": 0.5}), key, "left")


def lines(named: DataFrame) -> DataFrame:
    """(line): ``NAME: a b c`` per group. A line holds a whole group, as the text format wants it."""
    return named.groupBy("group_id").agg(F.array_sort(F.collect_list("node")).alias("m")).select(F.concat("group_id", F.lit(": "), F.array_join("m", " ")).alias("line"))
