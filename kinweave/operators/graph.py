"""Weighted graphs as (src, dst, weight) rows: the arcs that leave ``src`` are its column.

Every operator is a join, an aggregation or a window over arcs, so a graph never has to fit
one task. Joins over paths of length two go through triangles whose arcs point from the
node of smaller degree to the larger one, which bounds the paths through a hub.

Defined results: arcs with a null end or weight are dropped by ``load``; an absent arc is a
zero and zeros are dropped; an empty graph gives empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.operators.ranks import quantiles
from kinweave.operators.skew import hot_values, salted_join
from kinweave.session import checkpointed

ARC = ["src", "dst"]

#: How two weights of one arc are merged.
MERGES: dict[str, Callable[[Column], Column]] = {"max": F.max, "min": F.min, "add": F.sum, "mul": F.product}

#: Value transforms by name. ``ceil`` and ``floor`` clamp; comparisons keep or drop.
VALUES: dict[str, Callable[[Column, float], Column]] = {
    "const": lambda v, x: F.lit(float(x)),
    "scale": lambda v, x: v / x,
    "mul": lambda v, x: v * x,
    "add": lambda v, x: v + x,
    "pow": lambda v, x: F.pow(v, F.lit(float(x))),
    "log": lambda v, x: F.log(v) / F.log(F.lit(float(x))) if x else F.log(v),
    "neglog": lambda v, x: -(F.log(v) / F.log(F.lit(float(x)))) if x else -F.log(v),
    "exp": lambda v, x: F.pow(F.lit(float(x)), v) if x else F.exp(v),
    "abs": lambda v, x: F.abs(v),
    "acos": lambda v, x: F.acos(v),
    "ceil": lambda v, x: F.least(v, F.lit(float(x))),
    "floor": lambda v, x: F.greatest(v, F.lit(float(x))),
    "gq": lambda v, x: F.when(v >= x, v).otherwise(0.0),
    "gt": lambda v, x: F.when(v > x, v).otherwise(0.0),
    "lq": lambda v, x: F.when(v <= x, v).otherwise(0.0),
    "lt": lambda v, x: F.when(v < x, v).otherwise(0.0),
}


def _zero(c: str) -> Column:
    return F.coalesce(c, F.lit(0.0))


def nonzero(g: DataFrame) -> DataFrame:
    return g.where("weight <> 0 AND NOT isnan(weight)")


def load(arcs: DataFrame, merge: str = "max", mirror: bool = True) -> DataFrame:
    """A graph from raw arcs: missing weights are 1, arcs of the same ends are merged, and with
    ``mirror`` every arc counts both ways."""
    whole = arcs.where("src IS NOT NULL AND dst IS NOT NULL").select(*ARC, F.coalesce(F.nanvl(F.col("weight").cast("double"), F.lit(1.0)), F.lit(1.0)).alias("weight"))
    if mirror:
        whole = whole.unionByName(transpose(whole))
    return nonzero(whole.groupBy(*ARC).agg(MERGES[merge]("weight").alias("weight")))


def merge_ordered(arcs: DataFrame, order: tuple[str, ...], last: bool = False) -> DataFrame:
    """Arcs of the same ends reduced to the first, or last, in ``order``; of those equal in it any."""
    pick = F.max_by if last else F.min_by
    return arcs.groupBy(*ARC).agg(pick("weight", F.struct(*order)).alias("weight"))


def apply_values(g: DataFrame, steps: list[tuple[str, float]]) -> DataFrame:
    """Value transforms in order; an arc whose weight becomes zero at any step is dropped."""
    value = reduce(lambda v, step: F.when(v != 0, VALUES[step[0]](v, step[1])), steps, F.col("weight"))
    return nonzero(g.select(*ARC, value.alias("weight")))


def transpose(g: DataFrame) -> DataFrame:
    return g.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")


def paired(g: DataFrame) -> DataFrame:
    """(src, dst, w, r): every arc or reverse arc with the weights of both, absent ones 0.

    One aggregation over arcs and reverse arcs takes the place of a full outer join."""
    own = g.select(*ARC, F.col("weight").alias("w"), F.lit(0.0).alias("r"))
    back = g.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.lit(0.0).alias("w"), F.col("weight").alias("r"))
    return own.unionByName(back).groupBy(*ARC).agg(F.sum("w").alias("w"), F.sum("r").alias("r"))


_both = lambda w, r: (w != 0) & (r != 0)

#: Functions of two weights, of which an absent one is 0; of an arc and its reverse, or of
#: the arcs of two graphs.
BINARY: dict[str, Callable[[Column, Column], Column]] = {
    "left": lambda w, r: w,
    "right": lambda w, r: r,
    "max": F.greatest,
    "min": F.least,
    "add": lambda w, r: w + r,
    "subtract": lambda w, r: w - r,
    "mul": lambda w, r: w * r,
    "cross": lambda w, r: F.when(_both(w, r), w * r).when(w != 0, w).otherwise(r),
    "min_nonzero": lambda w, r: F.when(_both(w, r), F.least(w, r)).otherwise(0.0),
    "max_nonzero": lambda w, r: F.when(_both(w, r), F.greatest(w, r)).otherwise(0.0),
    "left_or_right": lambda w, r: F.when(w != 0, w).otherwise(r),
    "left_and_not_right": lambda w, r: F.when(r == 0, w).otherwise(0.0),
    "left_and_right": lambda w, r: F.when(_both(w, r), w).otherwise(0.0),
    "arcmax": lambda w, r: F.when(_both(w, r) & (w < r), 0.0).otherwise(w),
    "arcsub": lambda w, r: w - r,
}


def combine_transpose(g: DataFrame, how: str) -> DataFrame:
    return nonzero(paired(g).select(*ARC, BINARY[how](F.col("w"), F.col("r")).alias("weight")))


def filter_arc_pairs(g: DataFrame, measure: str, compare: str, bound: float) -> DataFrame:
    """Arcs of which one direction ('max'), both ('min') or the absolute difference ('diff') compares as asked."""
    test = {"gq": lambda v: v >= bound, "gt": lambda v: v > bound, "lq": lambda v: v <= bound, "lt": lambda v: v < bound}[compare]
    w, r = F.col("w"), F.col("r")
    keep = {"max": test(w) | test(r), "min": test(w) & test(r), "diff": test(F.abs(w - r))}[measure]
    return paired(g).where(keep & (w != 0)).select(*ARC, w.alias("weight"))


def combine(a: DataFrame, b: DataFrame, f: Callable[[Column, Column], Column]) -> DataFrame:
    """Element by element, absent arcs being 0: sums, products, maxima, differences."""
    rows = a.select(*ARC, F.col("weight").alias("x"), F.lit(0.0).alias("y")).unionByName(b.select(*ARC, F.lit(0.0).alias("x"), F.col("weight").alias("y")))
    both = rows.groupBy(*ARC).agg(F.sum("x").alias("x"), F.sum("y").alias("y"))
    return nonzero(both.select(*ARC, f(F.col("x"), F.col("y")).alias("weight")))


def drop_loops(g: DataFrame) -> DataFrame:
    return g.where("src <> dst")


def nodes(g: DataFrame) -> DataFrame:
    return g.select(F.explode(F.array(*ARC)).alias("node")).distinct()


def loops_at_max(g: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """Loops replaced by the largest weight of the node; 1 for nodes (of ``extra`` too) without arcs."""
    bare = drop_loops(g)
    every = nodes(g) if extra is None else nodes(g).unionByName(extra.select("node")).distinct()
    most = every.join(bare.groupBy(F.col("src").alias("node")).agg(F.max("weight").alias("m")), "node", "left")
    return bare.unionByName(most.select(F.col("node").alias("src"), F.col("node").alias("dst"), F.coalesce("m", F.lit(1.0)).alias("weight")))


def normalize_self(g: DataFrame) -> DataFrame:
    """Weights divided by the node's loop, or by its largest weight where it has none."""
    base = g.groupBy("src").agg(F.coalesce(F.max(F.when(F.col("src") == F.col("dst"), F.col("weight"))), F.max("weight")).alias("m"))
    return g.join(base, "src").select(*ARC, (F.col("weight") / F.col("m")).alias("weight"))


def normalize(g: DataFrame) -> DataFrame:
    """Columns that sum to 1."""
    return inflate(g, 1.0)


def inflate(g: DataFrame, power: float) -> DataFrame:
    """Columns raised to ``power`` and normalised."""
    raised = g.withColumn("weight", F.pow("weight", F.lit(float(power))) if power != 1 else F.col("weight"))
    sums = raised.groupBy("src").agg(F.sum("weight").alias("s"))
    return raised.join(sums, "src").select(*ARC, (F.col("weight") / F.col("s")).alias("weight"))


def multiply(a: DataFrame, b: DataFrame) -> DataFrame:
    """The column of each ``src`` of ``b`` sent on through ``a``: weight(src, dst) = sum over k of
    b(src, k) x a(k, dst). The arcs into a hub k are spread over tasks that each have what leaves it."""
    left = b.select("src", F.col("dst").alias("k"), F.col("weight").alias("x"))
    right = a.select(F.col("src").alias("k"), "dst", F.col("weight").alias("y"))
    return nonzero(salted_join(left, right, ["k"]).groupBy(*ARC).agg(F.sum(F.col("x") * F.col("y")).alias("weight")))


def step(g: DataFrame, squarings: int = 1) -> DataFrame:
    return reduce(lambda m, _: multiply(m, m), range(squarings), g)


def column_stats(g: DataFrame) -> DataFrame:
    """Per node: degree, sum, power sum, mean, extremes, and quartiles of its weights."""
    sums = g.groupBy(F.col("src").alias("node")).agg(
        F.count(F.lit(1)).alias("degree"), F.sum("weight").alias("total"), F.sum(F.col("weight") * F.col("weight")).alias("power_sum"),
        F.avg("weight").alias("mean"), F.min("weight").alias("least"), F.max("weight").alias("most"),
    )
    quarters = quantiles(g.select(F.col("src").alias("node"), "weight"), "node", "weight", {"_q1": 0.25, "median": 0.5, "_q3": 0.75})
    return sums.join(quarters, "node").select(*sums.columns, "median", (F.col("_q3") - F.col("_q1")).alias("iqr"))


def top_k(g: DataFrame, k: int) -> DataFrame:
    """The ``k`` heaviest arcs of each node; of arcs tied at the last place, those with the smallest ``dst``."""
    order = Window.partitionBy("src").orderBy(F.desc("weight"), "dst")
    return g.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k).drop("_r")


def top_k_ties(g: DataFrame, k: int) -> DataFrame:
    """Arcs at least as heavy as the k-th; if these are more than k, only those strictly heavier
    than it, unless that leaves none."""
    order = Window.partitionBy("src").orderBy(F.desc("weight"))
    ranked = g.withColumn("_r", F.rank().over(order)).where(F.col("_r") <= k)
    kth = ranked.groupBy("src").agg(F.max("_r").alias("_last"), F.count(F.lit(1)).alias("_n"), F.min("_r").alias("_first"))
    keep = (F.col("_n") <= k) | (F.col("_r") < F.col("_last")) | (F.col("_last") == 1)
    return ranked.join(kth, "src").where(keep).select(*ARC, "weight")


def knn(g: DataFrame, k: int, mutual: bool = True) -> DataFrame:
    """Arcs among the k heaviest of both ends; or of either end, with the larger weight."""
    kept = top_k(g, k)
    if mutual:
        return kept.join(transpose(kept).select(*ARC), ARC, "left_semi")
    return combine_transpose(kept, "max")


def quantile(g: DataFrame, q: float) -> DataFrame:
    """The heaviest ``round(q x degree)`` arcs of each node."""
    sizes = g.groupBy("src").agg(F.count(F.lit(1)).alias("_n"))
    order = Window.partitionBy("src").orderBy(F.desc("weight"), "dst")
    ranked = g.withColumn("_r", F.row_number().over(order)).join(sizes, "src")
    return ranked.where(F.col("_r") <= F.floor(F.lit(q) * F.col("_n") + 0.5)).select(*ARC, "weight")


def power_threshold(g: DataFrame, x: float) -> DataFrame:
    """Arcs above x times sum of squares over sum of the node's weights, loops aside. A loop has to be
    above that too; a node that has nothing but its loop keeps it."""
    other = F.when(F.col("src") != F.col("dst"), F.col("weight"))
    bars = g.groupBy("src").agg((F.lit(float(x)) * F.sum(other * other) / F.nullif(F.sum(other), F.lit(0.0))).alias("_bar"))
    return g.join(bars, "src").where("_bar IS NULL OR weight > _bar").select(*ARC, "weight")


def cap_degrees(g: DataFrame, k: int) -> DataFrame:
    """Hubs cut to k arcs: the lightest arcs of a node above k go in both directions. All hubs
    are judged on the graph as given; an arc that either end drops is gone."""
    kept = top_k(drop_loops(g), k)
    return kept.join(transpose(kept).select(*ARC), ARC, "left_semi")


def draw(seed: int) -> Column:
    """A number in [0, 1) for each pair of nodes, the same in every run and for both directions."""
    ends = F.least(*ARC).cast("string"), F.greatest(*ARC).cast("string")
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *ends)), 1, 8), 16, 10).cast("double") / float(1 << 32)


def sampled(g: DataFrame, keep: float, seed: int = 1) -> DataFrame:
    """A part of the arcs, the same in every run, an arc and its reverse together."""
    return g.where(draw(seed) < keep)


def arc_cosine(g: DataFrame) -> DataFrame:
    """Existing arcs, loops aside, weighted by the cosine of the columns of their ends.

    What both ends lead to is looked up from the end with fewer arcs, so that a hub is not paired
    with itself for each of its neighbours."""
    size = g.groupBy("src").agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col("weight") * F.col("weight")).alias("_q"))
    own = lambda end, k: size.select(F.col("src").alias(end), F.col("_n").alias(f"_n{k}"), F.col("_q").alias(f"_q{k}"))
    pairs = drop_loops(g).select(F.least(*ARC).alias("_a"), F.greatest(*ARC).alias("_b")).distinct()
    pairs = salted_join(pairs, own("_a", 1), ["_a"]).join(own("_b", 2), "_b")
    fewer = F.struct("_n1", "_a") < F.struct("_n2", "_b")
    ends = pairs.select("_a", "_b", F.sqrt(F.col("_q1") * F.col("_q2")).alias("_norm"), F.when(fewer, F.col("_a")).otherwise(F.col("_b")).alias("_x"), F.when(fewer, F.col("_b")).otherwise(F.col("_a")).alias("_y"))
    leads = lambda end, w: g.select(F.col("src").alias(end), F.col("dst").alias("_k"), F.col("weight").alias(w))
    met = salted_join(ends, leads("_x", "_w1"), ["_x"]).join(leads("_y", "_w2"), ["_y", "_k"])
    cosine = met.groupBy("_a", "_b").agg((F.sum(F.col("_w1") * F.col("_w2")) / F.max("_norm")).alias("_c"))
    arcs = drop_loops(g).select(*ARC, F.least(*ARC).alias("_a"), F.greatest(*ARC).alias("_b"))
    return nonzero(arcs.join(cosine, ["_a", "_b"]).select(*ARC, F.col("_c").alias("weight")))


def perturbed(g: DataFrame, radius: float, by: str = "draw", seed: int = 1) -> DataFrame:
    """Weights multiplied by 1 + radius x f; f is a number in [-1, 1) drawn for each pair of nodes
    ('draw'), or the cosine of the columns of both ends, 0 where they share nothing ('cosine')."""
    if by == "draw":
        return g.withColumn("weight", F.col("weight") * (1 + radius * (2 * draw(seed) - 1)))
    own = arc_cosine(g).select(*ARC, F.col("weight").alias("_c"))
    factor = 1 + radius * F.when(F.col("src") == F.col("dst"), 1.0).otherwise(_zero("_c"))
    return g.join(own, ARC, "left").select(*ARC, (F.col("weight") * factor).alias("weight"))


def diagonal(g: DataFrame, value: float = 1.0) -> DataFrame:
    """A loop of ``value`` for every node."""
    return nodes(g).select(F.col("node").alias("src"), F.col("node").alias("dst"), F.lit(float(value)).alias("weight"))


def upper(g: DataFrame) -> DataFrame:
    return g.where("src < dst")


def lower(g: DataFrame) -> DataFrame:
    return g.where("src > dst")


def sub_graph(g: DataFrame, columns: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """Arcs from the nodes of ``columns`` to those of ``rows`` (default: the same)."""
    left = columns.select(F.col("node").alias("src")).distinct()
    right = (columns if rows is None else rows).select(F.col("node").alias("dst")).distinct()
    return g.join(left, "src", "left_semi").join(right, "dst", "left_semi").select(*ARC, "weight")


def neighbourhood(g: DataFrame, start: DataFrame, hops: int = 1) -> DataFrame:
    """(node): ``start`` and what is at most ``hops`` arcs away."""
    reached = start.select("node").distinct()
    for _ in range(hops):
        further = g.join(reached.withColumnRenamed("node", "src"), "src", "left_semi").select(F.col("dst").alias("node"))
        reached = reached.unionByName(further).distinct()
    return reached


def ring(g: DataFrame, start: DataFrame, hops: int) -> DataFrame:
    """(node): what is exactly ``hops`` arcs away from the nearest of ``start``."""
    nearer = neighbourhood(g, start, hops - 1)
    return neighbourhood(g, nearer, 1).join(nearer, "node", "left_anti")


def select(
    g: DataFrame, columns: DataFrame | None = None, rows: DataFrame | None = None, around: int = 0, least_degree: int | None = None, most_degree: int | None = None,
    steps: list[tuple[str, float]] = (),
) -> DataFrame:
    """A part of a graph: arcs from ``columns`` (node), with what lies ``around`` arcs from them, to
    ``rows`` (default: the same nodes), between nodes whose degree in that part is within bounds,
    with values transformed."""
    part = g
    if columns is not None:
        chosen = neighbourhood(g, columns, around)
        part = sub_graph(g, chosen, rows)
    if least_degree is not None or most_degree is not None:
        d = F.col("degree")
        fit = (d >= least_degree if least_degree is not None else F.lit(True)) & (d <= most_degree if most_degree is not None else F.lit(True))
        part = sub_graph(part, degrees(part).where(fit))
    return apply_values(part, list(steps)) if steps else part


#: Graph transforms by name, each of a graph and a number (ignored where none is needed).
GRAPHS: dict[str, Callable[[DataFrame, float], DataFrame]] = {
    **{how: lambda g, x, how=how: combine_transpose(g, how) for how in ("max", "min", "add", "mul", "arcmax", "arcsub")},
    **{f"arc{m}{c}": lambda g, x, m=m, c=c: filter_arc_pairs(g, m, c, x) for m in ("max", "min", "diff") for c in ("gq", "gt", "lq", "lt")},
    "transpose": lambda g, x: transpose(g),
    "drop_loops": lambda g, x: drop_loops(g),
    "loops_at_max": lambda g, x: loops_at_max(g),
    "normalize_self": lambda g, x: normalize_self(g),
    "normalize": lambda g, x: normalize(g),
    "inflate": lambda g, x: inflate(g, x),
    "knn": lambda g, x: knn(g, int(x)),
    "knn_union": lambda g, x: knn(g, int(x), False),
    "rank": lambda g, x: top_k(g, int(x)),
    "cap_degrees": lambda g, x: cap_degrees(g, int(x)),
    "power_threshold": lambda g, x: power_threshold(g, x),
    "quantile": lambda g, x: quantile(g, x),
    "step": lambda g, x: step(g, int(x)),
    "common_neighbours": lambda g, x: common_neighbours(g),
    "upper": lambda g, x: upper(g),
    "lower": lambda g, x: lower(g),
    "sampled": lambda g, x: sampled(g, x),
    "perturbed": lambda g, x: perturbed(g, x),
    "perturbed_by_cosine": lambda g, x: perturbed(g, x, "cosine"),
    "diagonal": lambda g, x: diagonal(g, x),
}


def transform(g: DataFrame, steps: list[tuple[str, float]]) -> DataFrame:
    """Value and graph transforms in order, by name; of a name in both, the value transform is ``value:name``."""
    for name, x in steps:  # a parameter, not data
        bare = name.removeprefix("value:")
        g = GRAPHS[name](g, x) if name in GRAPHS else apply_values(g, [(bare, x)])
    return g


def blocks(g: DataFrame, clusters: DataFrame, inside: bool = True) -> DataFrame:
    """Arcs within one cluster, or between two; nodes of no cluster have no arcs in either."""
    own = lambda end: clusters.select(F.col("node").alias(end), F.col("cluster_id").alias(f"_{end}"))
    both = g.join(own("src"), "src").join(own("dst"), "dst")
    same = F.col("_src") == F.col("_dst")
    return both.where(same if inside else ~same).select(*ARC, "weight")


def contract(g: DataFrame, clusters: DataFrame) -> DataFrame:
    """The graph of clusters: weights between two clusters are summed."""
    own = lambda end: clusters.select(F.col("node").alias(end), F.col("cluster_id").alias(f"_{end}"))
    both = g.join(own("src"), "src").join(own("dst"), "dst")
    return both.groupBy(F.col("_src").alias("src"), F.col("_dst").alias("dst")).agg(F.sum("weight").alias("weight"))


def rename(g: DataFrame, names: DataFrame, how: str = "max") -> DataFrame:
    """Nodes replaced by ``alias`` of (node, alias); arcs that coincide are merged."""
    own = lambda end: names.select(F.col("node").alias(end), F.col("alias").alias(f"_{end}"))
    both = g.join(own("src"), "src").join(own("dst"), "dst")
    return both.groupBy(F.col("_src").alias("src"), F.col("_dst").alias("dst")).agg(MERGES[how]("weight").alias("weight"))


def undirected(g: DataFrame) -> DataFrame:
    """(u, v), u < v: each pair of nodes with an arc either way, once."""
    return drop_loops(g).select(F.least(*ARC).alias("u"), F.greatest(*ARC).alias("v")).distinct()


def degrees(g: DataFrame) -> DataFrame:
    """(node, degree): neighbours in either direction, loops aside."""
    return undirected(g).select(F.explode(F.array("u", "v")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))


def triangles(g: DataFrame) -> DataFrame:
    """(a, b, c), each triangle once. Arcs point to the larger degree, so that a node has at most
    about the square root of twice the edges to pair up, hub or not."""
    deg = degrees(g)
    pairs = undirected(g).join(deg.select(F.col("node").alias("u"), F.col("degree").alias("du")), "u").join(deg.select(F.col("node").alias("v"), F.col("degree").alias("dv")), "v")
    first = F.struct("du", "u") < F.struct("dv", "v")
    arcs = pairs.select(F.when(first, F.col("u")).otherwise(F.col("v")).alias("x"), F.when(first, F.col("v")).otherwise(F.col("u")).alias("y"), F.greatest("du", "dv").alias("d"))
    wedge = arcs.select(F.col("x").alias("a"), F.col("y").alias("b")).join(arcs.select(F.col("x").alias("a"), F.col("y").alias("c")), "a").where("b < c")
    closing = undirected(g).select(F.col("u").alias("b"), F.col("v").alias("c"))
    return wedge.join(closing, ["b", "c"]).select("a", "b", "c")


def common_neighbours(g: DataFrame) -> DataFrame:
    """Existing arcs weighted by the sum of 1 / log2(degree) over the neighbours both ends share."""
    deg = degrees(g)
    corner = F.explode(F.array(*[F.struct(F.least(p, q).alias("u"), F.greatest(p, q).alias("v"), r.alias("node")) for p, q, r in _corners()]))
    shared = triangles(g).select(corner.alias("t")).select("t.*").join(deg, "node")
    scores = shared.groupBy("u", "v").agg(F.sum(1 / F.log2(F.col("degree").cast("double"))).alias("weight"))
    return drop_loops(g).withColumn("u", F.least(*ARC)).withColumn("v", F.greatest(*ARC)).drop("weight").join(scores, ["u", "v"]).select(*ARC, "weight")


def _corners() -> list[tuple[Column, Column, Column]]:
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    return [(a, b, c), (a, c, b), (b, c, a)]


def components(g: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """(node, component): component is the smallest node it holds. ``extra``: nodes without arcs.

    Alternating stars: first every node hangs its larger neighbours on the smallest node it
    knows, then its smaller ones; the rounds grow with the logarithm of the longest path."""
    edges = checkpointed(undirected(g).select(F.col("v").alias("u"), F.col("u").alias("v")))
    seen = None
    while True:
        sym = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = sym.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # the centre of a star may own a third of all edges: its rows are salted in both joins; a node has
        # no more rows in the second than here
        hot = hot_values(sym, F.xxhash64("u"), 1 / 800)
        large = salted_join(sym.where("v > u"), least, ["u"], hot=hot).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))))
        edges = checkpointed(salted_join(large, lowest, ["u"], hot=hot).select(hung.alias("e")).select("e.u", "e.v").where("u <> v").distinct(), edges)
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == seen:
            break
        seen = now
    # an edge is now a node and its component
    every = nodes(g) if extra is None else nodes(g).unionByName(extra.select("node")).distinct()
    return every.join(edges.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))
