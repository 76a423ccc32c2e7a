"""Queries of graphs, networks, clusterings and flow; and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.config import RunConfig
from kinweave.operators import clusters as cl
from kinweave.operators import flow, network, products
from kinweave.operators import graph as gr
from kinweave.plans import pipeline, relations
from kinweave.plans.adapters import GENES_SQL, GRAPH_SQL, SEARCHED_SQL, gene_clusters, part_clusters, searched, similarity_graph
from kinweave.session import numbered_rows
from kinweave.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

_G = f"WITH RECURSIVE {GRAPH_SQL}"
_GC = f"{_G}, {GENES_SQL}"
_W = "round(w, 6) weight"


def _add(name: str, query: Callable[[SparkSession, str], DataFrame], sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql:
        SQL[name] = sql


def rounded(df: DataFrame) -> DataFrame:
    """Doubles as both engines are compared by."""
    return df.select(*[F.round(c, 6).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


def _on_graph(name: str, f: Callable[[DataFrame], DataFrame], sql: str | None = None) -> None:
    """A query on the graph of similarities."""
    _add(name, lambda spark, d: rounded(f(similarity_graph(spark, d))), sql and _G + sql)


def _with_genes(name: str, f: Callable[[DataFrame, DataFrame], DataFrame], by: str, sql: str | None = None) -> None:
    """A query on that graph and a clustering of all genes."""
    _add(name, lambda spark, d: rounded(f(similarity_graph(spark, d), gene_clusters(spark, d, by))), sql and _GC + sql)


# Values of arcs, and of arcs and their reverse.
_PAIRED = """, b AS (SELECT coalesce(x.src, y.dst) src, coalesce(x.dst, y.src) dst, coalesce(x.w, 0) w, coalesce(y.w, 0) r
FROM g x FULL JOIN g y ON x.src = y.dst AND x.dst = y.src) """
for _how, _expr in {
    "max": "greatest(w, r)",
    "min": "least(w, r)",
    "add": "w + r",
    "mul": "w * r",
    "arcmax": "CASE WHEN w <> 0 AND r <> 0 AND w < r THEN 0 ELSE w END",
    "arcsub": "w - r",
    "cross": "CASE WHEN w <> 0 AND r <> 0 THEN w * r WHEN w <> 0 THEN w ELSE r END",
    "min_nonzero": "CASE WHEN w <> 0 AND r <> 0 THEN least(w, r) ELSE 0 END",
    "max_nonzero": "CASE WHEN w <> 0 AND r <> 0 THEN greatest(w, r) ELSE 0 END",
    "left_or_right": "CASE WHEN w <> 0 THEN w ELSE r END",
    "left_and_not_right": "CASE WHEN r = 0 THEN w ELSE 0 END",
    "left_and_right": "CASE WHEN w <> 0 AND r <> 0 THEN w ELSE 0 END",
}.items():
    _on_graph(f"transpose_{_how}", lambda g, h=_how: gr.combine_transpose(g, h), _PAIRED + f"SELECT src, dst, round({_expr}, 6) weight FROM b WHERE ({_expr}) <> 0")
for _name, _m, _c, _e in (
    ("arc_max_filter", "max", "gq", "(w >= 60 OR r >= 60)"),
    ("arc_min_filter", "min", "gq", "(w >= 20 AND r >= 20)"),
    ("arc_diff_filter", "diff", "gq", "abs(w - r) >= 60"),
    ("arc_max_below", "max", "lq", "(w <= 60 OR r <= 60)"),
    ("arc_min_below", "min", "lt", "(w < 60 AND r < 60)"),
):
    _on_graph(_name, lambda g, m=_m, c=_c, b=20 if _name == "arc_min_filter" else 60: gr.filter_arc_pairs(g, m, c, b), _PAIRED + f"SELECT src, dst, {_W} FROM b WHERE {_e} AND w <> 0")
_on_graph(
    "value_transforms",
    lambda g: gr.apply_values(g, [("gq", 40), ("log", 2), ("mul", 3), ("ceil", 18), ("add", 1)]),
    "SELECT src, dst, round(least(log2(w) * 3, 18) + 1, 6) weight FROM g WHERE w >= 40",
)
_on_graph("value_power", lambda g: gr.apply_values(g, [("scale", 50), ("pow", 1.5), ("exp", 0)]), "SELECT src, dst, round(exp(power(w / 50, 1.5)), 6) weight FROM g")
_on_graph(
    "value_angles",
    lambda g: gr.apply_values(g, [("scale", 200), ("acos", 0), ("neglog", 10), ("abs", 0)]),
    "SELECT src, dst, round(abs(-log10(acos(w / 200))), 6) weight FROM g WHERE acos(w / 200) <> 0",
)
_on_graph(
    "mirror_merge", lambda g: gr.load(g, "max"), ", m AS (SELECT src, dst, w FROM g UNION ALL SELECT dst, src, w FROM g) SELECT src, dst, round(max(w), 6) weight FROM m GROUP BY src, dst"
)
_on_graph("column_normalize", gr.normalize, "SELECT src, dst, round(w / sum(w) OVER (PARTITION BY src), 6) weight FROM g")
_on_graph("inflate_once", lambda g: gr.inflate(g, 2), "SELECT src, dst, round(w * w / sum(w * w) OVER (PARTITION BY src), 6) weight FROM g")
_on_graph(
    "loops_at_max",
    gr.loops_at_max,
    f""", h AS (SELECT * FROM g WHERE src <> dst), n AS (SELECT src node FROM g UNION SELECT dst FROM g)
SELECT src, dst, {_W} FROM h UNION ALL SELECT node, node, round(coalesce(m, 1.0), 6) FROM n LEFT JOIN (SELECT src, max(w) m FROM h GROUP BY src) ON src = node""",
)
_on_graph("normalize_self", gr.normalize_self, "SELECT src, dst, round(w / coalesce(max(w) FILTER (WHERE src = dst) OVER (PARTITION BY src), max(w) OVER (PARTITION BY src)), 6) weight FROM g")
_N = ", n AS (SELECT src, dst, w / sum(w) OVER (PARTITION BY src) w FROM g) "
_add(  # weights are above 0 and at most 1: they are rounded as SQL does, at a fraction of the time of decimals
    "expand_once",
    lambda spark, d: products.multiply(*[gr.normalize(similarity_graph(spark, d))] * 2).withColumn("weight", F.floor(F.col("weight") * 1e6 + 0.5) / 1e6),
    _G + _N + "SELECT a.src, b.dst, round(sum(a.w * b.w), 6) weight FROM n a JOIN n b ON a.dst = b.src GROUP BY a.src, b.dst"
)
_on_graph("hadamard", lambda g: gr.combine(g, gr.transpose(g), lambda x, y: x * y), "SELECT x.src, x.dst, round(x.w * y.w, 6) weight FROM g x JOIN g y ON x.src = y.dst AND x.dst = y.src")
_on_graph(
    "transform_chain",
    lambda g: gr.transform(g, [("gq", 30.0), ("drop_loops", 0), ("value:pow", 0.5), ("knn_union", 3), ("max", 0), ("normalize_self", 0)]),
    """, a AS (SELECT src, dst, sqrt(w) w FROM g WHERE w >= 30 AND src <> dst), k AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY w DESC, dst) k FROM a),
u AS (SELECT src, dst, max(w) w FROM (SELECT src, dst, w FROM k WHERE k <= 3 UNION ALL SELECT dst, src, w FROM k WHERE k <= 3) GROUP BY src, dst)
SELECT src, dst, round(w / max(w) OVER (PARTITION BY src), 6) weight FROM u""",
)

# What each node keeps.
_on_graph("top_k", lambda g: gr.top_k(g, 3), f", k AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY w DESC, dst) k FROM g) SELECT src, dst, {_W} FROM k WHERE k <= 3")
_on_graph(
    "top_k_ties",
    lambda g: gr.top_k_ties(g, 3),
    f""", k AS (SELECT *, rank() OVER (PARTITION BY src ORDER BY w DESC) k FROM g),
t AS (SELECT *, max(k) OVER (PARTITION BY src) l, count(*) OVER (PARTITION BY src) n FROM k WHERE k <= 3) SELECT src, dst, {_W} FROM t WHERE n <= 3 OR k < l OR l = 1""",
)
_K = ", k AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY w DESC, dst) k, count(*) OVER (PARTITION BY src) n FROM g), t AS (SELECT src, dst, w FROM k WHERE k <= 5) "
_MUTUAL = "SELECT t.src, t.dst, round(t.w, 6) weight FROM t JOIN t u ON t.src = u.dst AND t.dst = u.src"
_on_graph("knn_mutual", lambda g: gr.knn(g, 5), _K + _MUTUAL)
_on_graph(
    "knn_union", lambda g: gr.knn(g, 5, False), _K + "SELECT src, dst, round(max(w), 6) weight FROM (SELECT src, dst, w FROM t UNION ALL SELECT dst, src, w FROM t) GROUP BY src, dst"
)
_on_graph("cap_degrees", lambda g: gr.cap_degrees(g, 40), _K.replace("k <= 5", "k <= 40").replace("FROM g)", "FROM g WHERE src <> dst)") + _MUTUAL)
_on_graph("quantile_arcs", lambda g: gr.quantile(g, 0.5), _K + f"SELECT src, dst, {_W} FROM k WHERE k <= floor(0.5 * n + 0.5)")
_on_graph(
    "power_threshold",
    lambda g: gr.power_threshold(g, 0.9),
    f""", s AS (SELECT *, 0.9 * sum(w * w) FILTER (WHERE src <> dst) OVER (PARTITION BY src) / nullif(sum(w) FILTER (WHERE src <> dst) OVER (PARTITION BY src), 0) b FROM g)
SELECT src, dst, {_W} FROM s WHERE b IS NULL OR w > b""",
)
_on_graph(
    "column_stats",
    lambda g: gr.column_stats(g).withColumns({c: F.round(c, 3) for c in ("total", "power_sum")}),  # sums have the noise of their order
    """SELECT src node, count(*) degree, round(sum(w), 3) total, round(sum(w * w), 3) power_sum, round(avg(w), 6) mean, round(min(w), 6) least, round(max(w), 6) most,
round(quantile_cont(w, 0.5), 6) median, round(quantile_cont(w, 0.75) - quantile_cont(w, 0.25), 6) iqr FROM g GROUP BY src""",
)
_on_graph("upper_triangle", gr.upper, f"SELECT src, dst, {_W} FROM g WHERE src < dst")
_on_graph("lower_triangle", gr.lower, f"SELECT src, dst, {_W} FROM g WHERE src > dst")

def _path_ends(g: DataFrame) -> DataFrame:
    """(source, target): each searched node and the next, in order of their ids."""
    placed = numbered_rows(searched(g), ["node"], "place")
    following = placed.select((F.col("place") - 1).alias("place"), F.col("node").alias("target"))
    return placed.join(following, "place").select(F.col("node").alias("source"), "target")


_DRAW = "(('0x' || substr(md5('1|' || least(src, dst) || '|' || greatest(src, dst)), 1, 8))::UBIGINT / 4294967296.0)"
_on_graph("sampled_arcs", lambda g: gr.sampled(g, 0.3), f"SELECT src, dst, {_W} FROM g WHERE {_DRAW} < 0.3")
_on_graph("perturbed_by_draw", lambda g: gr.perturbed(g, 0.2), f"SELECT src, dst, round(w * (1 + 0.2 * (2 * {_DRAW} - 1)), 6) weight FROM g")
_COSINE = """, q AS (SELECT src, sum(w * w) q FROM g GROUP BY src), p AS (SELECT DISTINCT least(src, dst) a, greatest(src, dst) b FROM g WHERE src <> dst),
c AS (SELECT a, b, sum(x.w * y.w) / sqrt(any_value(s.q) * any_value(t.q)) c FROM p JOIN g x ON x.src = a JOIN g y ON y.src = b AND y.dst = x.dst JOIN q s ON s.src = a JOIN q t ON t.src = b GROUP BY a, b) """
_on_graph("arc_cosine", gr.arc_cosine, _COSINE + "SELECT src, dst, round(c, 6) weight FROM g JOIN c ON a = least(src, dst) AND b = greatest(src, dst)")
_on_graph(
    "perturbed_by_cosine",
    lambda g: gr.perturbed(g, 0.2, "cosine"),
    _COSINE + "SELECT src, dst, round(w * (1 + 0.2 * CASE WHEN src = dst THEN 1 ELSE coalesce(c, 0) END), 6) weight FROM g LEFT JOIN c ON a = least(src, dst) AND b = greatest(src, dst)",
)
_on_graph("diagonal", gr.diagonal, "SELECT src, src dst, 1.0::DOUBLE weight FROM (SELECT src FROM g UNION SELECT dst FROM g)")


# Networks.
_U = """, u AS (SELECT DISTINCT least(src, dst) u, greatest(src, dst) v FROM g WHERE src <> dst), d AS (SELECT node, count(*) degree FROM (SELECT u node FROM u UNION ALL SELECT v FROM u) GROUP BY node),
t AS (SELECT x.u a, x.v b, y.v c FROM u x JOIN u y ON x.v = y.u JOIN u z ON z.u = x.u AND z.v = y.v) """
_on_graph(
    "triangle_coefficient",
    network.clustering_coefficient,
    _U + """, c AS (SELECT node, count(*) t FROM (SELECT a node FROM t UNION ALL SELECT b FROM t UNION ALL SELECT c FROM t) GROUP BY node)
SELECT d.node, degree, coalesce(t, 0) triangles, round(CASE WHEN degree > 1 THEN 2.0 * coalesce(t, 0) / (degree * (degree - 1)) ELSE 0 END, 6) coefficient FROM d LEFT JOIN c USING (node)""",
)
_on_graph(
    "common_neighbours",
    gr.common_neighbours,
    _U + """, s AS (SELECT u, v, sum(1 / log2(degree)) w FROM (SELECT a u, b v, c node FROM t UNION ALL SELECT a, c, b FROM t UNION ALL SELECT b, c, a FROM t) JOIN d USING (node) GROUP BY u, v)
SELECT src, dst, round(s.w, 6) weight FROM g JOIN s ON u = least(src, dst) AND v = greatest(src, dst)""",
)
_on_graph("degree_histogram", network.degree_histogram, _U + "SELECT degree, count(*) nodes FROM d GROUP BY degree")
_on_graph("scale_free_fit", network.scale_free_fit, _U + ", h AS (SELECT ln(degree) x, ln(count(*)) y FROM d GROUP BY degree) SELECT round(regr_slope(y, x), 6) slope, round(regr_r2(y, x), 6) r2 FROM h")
_on_graph("weight_histogram", lambda g: network.weight_histogram(g, 10), "SELECT floor(w / 10) * 10 bin_start, count(*) arcs FROM g GROUP BY 1")
_on_graph(
    "threshold_sweep",
    lambda g: network.threshold_sweep(g, [10.0, 50.0, 100.0, 150.0]),
    """, p AS (SELECT least(src, dst) u, greatest(src, dst) v, max(w) w FROM g WHERE src <> dst GROUP BY 1, 2), t AS (SELECT unnest([10.0, 50.0, 100.0, 150.0])::DOUBLE threshold),
e AS (SELECT threshold, count(*) edges FROM p JOIN t ON w >= threshold GROUP BY 1),
n AS (SELECT threshold, count(DISTINCT node) nodes FROM (SELECT u node, w FROM p UNION ALL SELECT v, w FROM p) JOIN t ON w >= threshold GROUP BY 1)
SELECT threshold, edges, nodes, round(2.0 * edges / nodes, 6) mean_degree FROM e JOIN n USING (threshold)""",
)
_SWEPT = """, m AS (SELECT src, dst, max(w) w FROM (SELECT src, dst, w FROM g WHERE src <> dst UNION ALL SELECT dst, src, w FROM g WHERE src <> dst) GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY w DESC, dst) k FROM m), x AS (SELECT unnest([{values}])::DOUBLE value),
r AS (SELECT value, src, dst, w, least(src, dst) u, greatest(src, dst) v FROM {reduced}),
a AS (SELECT value, src node, count(*) degree FROM r GROUP BY 1, 2), h AS (SELECT DISTINCT value, u, v FROM r),
t AS (SELECT x.value, unnest([x.u, x.v, y.v]) node FROM h x JOIN h y ON x.value = y.value AND x.v = y.u JOIN h z ON z.value = x.value AND z.u = x.u AND z.v = y.v),
tc AS (SELECT value, node, count(*) t FROM t GROUP BY 1, 2),
f AS (SELECT a.value, count(*) nodes, avg(degree) mean_degree, avg(CASE WHEN degree > 1 THEN 2.0 * coalesce(t, 0) / (degree * (degree - 1)) ELSE 0 END) coefficient FROM a LEFT JOIN tc USING (value, node) GROUP BY 1),
e AS (SELECT value, count(*) FILTER (WHERE src < dst) edges, avg(w) mean_weight FROM r GROUP BY 1),
cc(value, node, c) USING KEY (value, node) AS (SELECT value, node, node FROM a
  UNION SELECT r.value, r.dst, min(cc.c) FROM cc JOIN r ON r.value = cc.value AND r.src = cc.node JOIN recurring.cc o ON o.value = r.value AND o.node = r.dst WHERE cc.c < o.c GROUP BY 1, 2),
s AS (SELECT value, c, count(*) s FROM cc GROUP BY 1, 2), z AS (SELECT value, count(*) components, max(s) largest, count(*) FILTER (WHERE s = 2) couples FROM s GROUP BY 1)
SELECT value, edges, nodes, components, largest, couples, round(mean_degree, 6) mean_degree, round(coefficient, 6) coefficient, round(mean_weight, 6) mean_weight
FROM e JOIN f USING (value) JOIN z USING (value)"""
_on_graph("component_sweep", lambda g: network.sweep(g, [100.0, 170.0]), _SWEPT.format(values="100.0, 170.0", reduced="m JOIN x ON w >= value"))
_on_graph(
    "neighbour_sweep",
    lambda g: network.sweep(g, [2.0, 4.0], "knn"),
    _SWEPT.format(values="2.0, 4.0", reduced="(SELECT value, k.src, k.dst, k.w FROM k JOIN k j ON j.src = k.dst AND j.dst = k.src JOIN x ON k.k <= value AND j.k <= value)"),
)
_CC = """, sy AS (SELECT src, dst FROM g UNION SELECT dst, src FROM g), cc(node, c) USING KEY (node) AS (SELECT DISTINCT src, src FROM sy
  UNION SELECT sy.dst, min(cc.c) FROM cc JOIN sy ON sy.src = cc.node JOIN recurring.cc o ON o.node = sy.dst WHERE cc.c < o.c GROUP BY 1) """
_on_graph("components", gr.components, _CC + "SELECT node, c component FROM cc")
_D = f""", {SEARCHED_SQL}, r(source, node, depth) USING KEY (source, node) AS (SELECT node, node, 0 FROM q
  UNION SELECT DISTINCT r.source, g.dst, r.depth + 1 FROM r JOIN g ON g.src = r.node WHERE NOT EXISTS (SELECT 1 FROM recurring.r o WHERE o.source = r.source AND o.node = g.dst)) """
_on_graph("bfs_depth", lambda g: network.depths(g, searched(g)), _D + "SELECT source, node, depth FROM r")
_on_graph("eccentricity", lambda g: network.eccentricity(g, searched(g)), _D + "SELECT source node, max(depth) eccentricity, count(*) reached FROM r GROUP BY source")
_BETWEEN = _D + """, p(source, node, depth, paths) AS (SELECT source, node, 0, 1.0::DOUBLE FROM r WHERE depth = 0
  UNION ALL SELECT p.source, r.node, p.depth + 1, sum(p.paths) FROM p JOIN g ON g.src = p.node JOIN r ON r.source = p.source AND r.node = g.dst AND r.depth = p.depth + 1 GROUP BY 1, 2, 3),
b(lev, source, node, paths, share) AS (SELECT depth, source, node, paths, 0.0::DOUBLE FROM p WHERE depth = (SELECT max(depth) FROM p)
  UNION ALL SELECT p.depth, p.source, p.node, p.paths, sum(CASE WHEN c.node IS NULL THEN 0 ELSE p.paths / c.paths * (1 + c.share) END)
  FROM (SELECT max(lev) - 1 lev FROM b) l JOIN p ON p.depth = l.lev LEFT JOIN g ON g.src = p.node LEFT JOIN b c ON c.source = p.source AND c.node = g.dst WHERE l.lev > 0 GROUP BY 1, 2, 3, 4) """
_on_graph("betweenness", lambda g: network.betweenness(g, searched(g)), _BETWEEN + "SELECT node, round(sum(share), 6) score FROM b WHERE lev > 0 GROUP BY node HAVING sum(share) > 0")
_on_graph(
    "edge_betweenness",
    lambda g: network.edge_betweenness(g, searched(g)),
    _BETWEEN + """SELECT g.src, g.dst, round(sum(x.paths / y.paths * (1 + y.share)), 6) weight FROM p x JOIN g ON g.src = x.node AND g.dst <> g.src
JOIN b y ON y.source = x.source AND y.node = g.dst AND y.lev = x.depth + 1 GROUP BY 1, 2""",
)
_on_graph(
    "shortest_path_nodes",
    lambda g: network.shortest_path_nodes(g, _path_ends(g), None),
    f""", {SEARCHED_SQL}, ends AS (SELECT node source, lead(node) OVER (ORDER BY node) target FROM q),
r(source, node, depth) USING KEY (source, node) AS (SELECT node, node, 0 FROM q
  UNION SELECT DISTINCT r.source, g.dst, r.depth + 1 FROM r JOIN g ON g.src = r.node WHERE NOT EXISTS (SELECT 1 FROM recurring.r o WHERE o.source = r.source AND o.node = g.dst)),
t(target, node, depth) USING KEY (target, node) AS (SELECT node, node, 0 FROM q
  UNION SELECT DISTINCT t.target, g.src, t.depth + 1 FROM t JOIN g ON g.dst = t.node WHERE NOT EXISTS (SELECT 1 FROM recurring.t o WHERE o.target = t.target AND o.node = g.src))
SELECT e.source, e.target, a.node, a.depth FROM ends e JOIN r l ON l.source = e.source AND l.node = e.target JOIN r a ON a.source = e.source
JOIN t b ON b.target = e.target AND b.node = a.node WHERE a.depth + b.depth = l.depth""",
)
_on_graph(
    "neighbourhood",
    lambda g: gr.neighbourhood(g, searched(g), 2),
    f", {SEARCHED_SQL}, a AS (SELECT node FROM q UNION SELECT dst FROM g WHERE src IN (SELECT node FROM q)) SELECT node FROM a UNION SELECT dst FROM g WHERE src IN (SELECT node FROM a)",
)
_on_graph(
    "ring",
    lambda g: gr.ring(g, searched(g), 2),
    f""", {SEARCHED_SQL}, a AS (SELECT node FROM q UNION SELECT dst FROM g WHERE src IN (SELECT node FROM q)), b AS (SELECT DISTINCT dst node FROM g WHERE src IN (SELECT node FROM a))
SELECT node FROM b WHERE node NOT IN (SELECT node FROM a)""",
)
_on_graph(
    "select_part",
    lambda g: gr.select(g, searched(g), around=1, least_degree=2, steps=[("gq", 20.0), ("pow", 0.5)]),
    f""", {SEARCHED_SQL}, a AS (SELECT node FROM q UNION SELECT dst FROM g WHERE src IN (SELECT node FROM q)),
p AS (SELECT * FROM g WHERE src IN (SELECT node FROM a) AND dst IN (SELECT node FROM a)), u AS (SELECT DISTINCT least(src, dst) u, greatest(src, dst) v FROM p WHERE src <> dst),
f AS (SELECT node FROM (SELECT u node FROM u UNION ALL SELECT v FROM u) GROUP BY node HAVING count(*) >= 2)
SELECT src, dst, round(sqrt(w), 6) weight FROM p WHERE src IN (SELECT node FROM f) AND dst IN (SELECT node FROM f) AND w >= 20""",
)


# Graphs and clusterings.
_with_genes("block_inside", gr.blocks, "taxon", "SELECT src, dst, round(w, 6) weight FROM g JOIN c a ON a.node = src JOIN c b ON b.node = dst WHERE a.taxon = b.taxon")
_with_genes("block_across", lambda g, c: gr.blocks(g, c, False), "taxon", "SELECT src, dst, round(w, 6) weight FROM g JOIN c a ON a.node = src JOIN c b ON b.node = dst WHERE a.taxon <> b.taxon")
_with_genes("contract_clusters", gr.contract, "taxon", "SELECT a.taxon src, b.taxon dst, round(sum(w), 6) weight FROM g JOIN c a ON a.node = src JOIN c b ON b.node = dst GROUP BY 1, 2")
_with_genes(
    "rename_nodes",
    lambda g, c: gr.rename(g, c.select("node", F.col("cluster_id").alias("alias"))),
    "taxon",
    "SELECT a.taxon src, b.taxon dst, round(max(w), 6) weight FROM g JOIN c a ON a.node = src JOIN c b ON b.node = dst GROUP BY 1, 2",
)
_with_genes(
    "sub_graph",
    lambda g, c: gr.sub_graph(g, c.where("cluster_id IN ('4', '5')")),
    "band",
    "SELECT src, dst, round(w, 6) weight FROM g WHERE src IN (SELECT node FROM c WHERE band IN ('4', '5')) AND dst IN (SELECT node FROM c WHERE band IN ('4', '5'))",
)
_NODE_COVER = """, n AS (SELECT src node FROM g UNION SELECT dst FROM g), z AS (SELECT {by}, count(*) d FROM c GROUP BY 1), e AS (SELECT n.node, {by} k, d FROM n JOIN c ON c.node = n.node JOIN z USING ({by})),
a AS (SELECT g.src, g.w, coalesce(x.{by} = y.{by}, false) i FROM g JOIN c x ON x.node = g.src LEFT JOIN c y ON y.node = g.dst),
v AS (SELECT src node, sum(w) s, sum(w * w) q, max(w) m, coalesce(sum(w) FILTER (WHERE i), 0) inn, count(*) FILTER (WHERE NOT i) o FROM a GROUP BY 1),
f AS (SELECT e.node, e.k, coalesce(inn / s, 0) mass, coalesce(1 - (d - ((2*inn - s)/s) / (q/(s*s))) / (d + o), 0) coverage, coalesce(1 - (d - ((2*inn - s)/s) / (m/s)) / (d + o), 0) most_coverage FROM e LEFT JOIN v USING (node)) """
_with_genes("node_coverage", cl.node_coverage, "band", _NODE_COVER.format(by="band") + "SELECT node, k cluster_id, round(mass, 6) mass, round(coverage, 6) coverage, round(most_coverage, 6) most_coverage FROM f")
_with_genes("cluster_coverage", cl.cluster_coverage, "taxon", _NODE_COVER.format(by="taxon") + "SELECT k cluster_id, count(*) nodes, round(avg(mass), 6) mass, round(avg(coverage), 6) efficiency FROM f GROUP BY 1")
_with_genes(
    "coverage",
    cl.coverage,
    "taxon",
    _NODE_COVER.format(by="taxon")
    + """SELECT round(avg(mass), 6) mass, round((SELECT sum(d * (d - 1)) FROM z) / (SELECT count(*) * (count(*) - 1) FROM n)::DOUBLE, 6) area,
round(avg(coverage), 6) efficiency, round(avg(most_coverage), 6) most_efficiency FROM f""",
)
_with_genes(
    "residue",
    lambda g, c: cl.residue(gr.load(g, "add"), c.where("cluster_id <> '5'")),
    "band",
    """, k AS (SELECT node, band b FROM c WHERE band <> '5'), m AS (SELECT src, dst, sum(w) w FROM (SELECT src, dst, w FROM g UNION ALL SELECT dst, src, w FROM g) GROUP BY 1, 2),
p AS (SELECT src, b, sum(w) w FROM m JOIN k ON k.node = dst WHERE src NOT IN (SELECT node FROM k) GROUP BY 1, 2), o AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY round(w, 6) DESC, b) i FROM p)
SELECT b cluster_id, node FROM k UNION ALL SELECT b, src FROM o WHERE i = 1""",
)
_with_genes(
    "node_cluster_weights",
    cl.node_weights,
    "taxon",
    """, k AS (SELECT src node, taxon cluster_id, sum(w) weight FROM g JOIN c ON c.node = dst WHERE src <> dst GROUP BY 1, 2)
SELECT node, cluster_id, round(weight, 6) weight, round(weight / sum(weight) OVER (PARTITION BY node), 6) share FROM k""",
)
_with_genes(
    "absorb_small",
    lambda g, c: cl.absorb_small(g, c, 200),
    "band",
    """, s AS (SELECT *, count(*) OVER (PARTITION BY band) s FROM c),
p AS (SELECT g.src, y.band, sum(w) w FROM g JOIN s x ON x.node = g.src AND x.s <= 200 JOIN s y ON y.node = g.dst AND y.s > 200 GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY round(w, 6) DESC, band) k FROM p)
SELECT coalesce(k.band, s.band) cluster_id, node FROM s LEFT JOIN k ON k.src = node AND k.k = 1""",
)
_on_graph(
    "collected_weights",
    lambda g: cl.collected({"arcs": g, "back": gr.transpose(g)}, "src", "weight"),
    ", a AS (SELECT src, w FROM g UNION ALL SELECT dst, w FROM g) SELECT src, count(*) n, round(min(w), 6) least, round(max(w), 6) most, round(avg(w), 6) mean, round(quantile_cont(w, 0.5), 6) median FROM a GROUP BY src",
)
_with_genes(
    "split_connected",
    lambda g, c: flow.split_connected(c, g),
    "band",
    """, sy AS (SELECT g.src, g.dst FROM g JOIN c a ON a.node = g.src JOIN c b ON b.node = g.dst WHERE a.band = b.band), s2 AS (SELECT src, dst FROM sy UNION SELECT dst, src FROM sy),
cc(node, k) USING KEY (node) AS (SELECT node, node FROM c UNION SELECT s2.dst, min(cc.k) FROM cc JOIN s2 ON s2.src = cc.node JOIN recurring.cc o ON o.node = s2.dst WHERE cc.k < o.k GROUP BY 1)
SELECT k cluster_id, node FROM cc""",
)


# Clusterings.
def _two(f: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda s, d: rounded(f(part_clusters(s, d, "p_brand"), part_clusters(s, d, "p_type")))


_M = """WITH m AS (SELECT {x} a, {y} b, count(*) meet FROM part GROUP BY 1, 2), x AS (SELECT a, sum(meet) na, max(meet) ma FROM m GROUP BY a), y AS (SELECT b, sum(meet) nb, max(meet) mb FROM m GROUP BY b) """
_MEET = _M.format(x="p_brand", y="p_type")
_DISTANCES = """, s AS (SELECT (SELECT sum(na) FROM x)::DOUBLE n, (SELECT sum(ma) FROM x) pa, (SELECT sum(mb) FROM y) pb, (SELECT sum(na*ln(na)) FROM x) ea, (SELECT sum(nb*ln(nb)) FROM y) eb, (SELECT sum(meet*ln(meet)) FROM m) ej,
(SELECT sum(na*(na-1)/2.0) FROM x) ca, (SELECT sum(nb*(nb-1)/2.0) FROM y) cb, (SELECT sum(meet*(meet-1)/2.0) FROM m) cj, (SELECT sum(na*na) FROM x) qa, (SELECT sum(nb*nb) FROM y) qb, (SELECT sum(meet*meet) FROM m) qj)
SELECT {names}n::BIGINT nodes, (n - pa)::BIGINT split_join_a, (n - pb)::BIGINT split_join_b, round(greatest(0, (ea - ej)/n), 6) vi_a, round(greatest(0, (eb - ej)/n), 6) vi_b,
round((qa - qj)::DOUBLE, 6) mirkin_a, round((qb - qj)::DOUBLE, 6) mirkin_b, round((n*(n-1)/2 + 2*cj - ca - cb)/(n*(n-1)/2), 6) rand,
round((cj - ca*cb/(n*(n-1)/2)) / ((ca+cb)/2 - ca*cb/(n*(n-1)/2)), 6) adjusted_rand, round(cj/(ca+cb-cj), 6) jaccard FROM s"""
_add("contingency", _two(cl.contingency), _MEET + "SELECT a, b, meet FROM m")
_add("cluster_distances", _two(cl.distances), _MEET + _DISTANCES.format(names=""))
_THREE = ("p_brand", "p_type", "p_size")
_add(
    "all_cluster_distances",
    lambda s, d: rounded(cl.all_distances({c: part_clusters(s, d, c) for c in _THREE})),
    " UNION ALL ".join(f"({_M.format(x=a, y=b)}{_DISTANCES.format(names=f"'{a}' AS first, '{b}' AS second, ")})" for i, a in enumerate(_THREE) for b in _THREE[i + 1 :]),
)
_add(
    "cluster_mate",
    _two(cl.mate),
    _MEET + "SELECT a, b, round(2.0*meet/(na+nb), 6) dice, meet, (na-meet)::BIGINT left_only, (nb-meet)::BIGINT right_only, na::BIGINT size_a, nb::BIGINT size_b FROM m JOIN x USING (a) JOIN y USING (b)",
)
_add("cluster_volatility", _two(cl.volatility), _MEET + "SELECT p_partkey node, round(1.0 / meet, 6) score FROM part JOIN m ON a = p_brand AND b = p_type JOIN x USING (a) JOIN y USING (b) WHERE meet < 0.5 * na AND meet < 0.5 * nb")
_add(
    "set_parts",
    lambda s, d: cl.parts(part_clusters(s, d, "p_type").where("cluster_id = 'SMALL'"), part_clusters(s, d, "p_size").where("cluster_id <= '25'")),
    """WITH a AS (SELECT p_partkey n FROM part WHERE p_type = 'SMALL'), b AS (SELECT p_partkey n FROM part WHERE p_size::VARCHAR <= '25'),
k AS (SELECT count(*) FILTER (WHERE b.n IS NULL) l, count(*) FILTER (WHERE a.n = b.n) m, count(*) FILTER (WHERE a.n IS NULL) r FROM a FULL JOIN b ON a.n = b.n)
SELECT l left_only, m shared, r right_only, CASE WHEN l = 0 AND r = 0 THEN 'equal' WHEN l = 0 THEN 'sub' WHEN r = 0 THEN 'super' WHEN m = 0 THEN 'disjoint' ELSE 'overlap' END relation FROM k""",
)
_add("cluster_meet", lambda s, d: cl.meet(*[part_clusters(s, d, c) for c in _THREE]), "SELECT min(p_partkey) OVER (PARTITION BY p_brand, p_type, p_size) cluster_id, p_partkey node FROM part")
_add(
    "granularity",
    lambda s, d: rounded(cl.granularity(cl.meet(part_clusters(s, d, "p_brand"), part_clusters(s, d, "p_size")))),
    """WITH z AS (SELECT count(*) s FROM part GROUP BY p_brand, p_size), o AS (SELECT s, sum(s) OVER u cum, row_number() OVER u i, count(*) OVER () c, max(s) OVER () mx, sum(s) OVER () n FROM z WINDOW u AS (ORDER BY s ROWS UNBOUNDED PRECEDING))
SELECT count(*) clusters, max(s) largest, min(s) smallest, round(avg(s), 6) mean_size, round(sum(s*s)/sum(s), 6) centre, count(*) FILTER (WHERE s = 1) singletons, count(*) FILTER (WHERE s <= 4) up_to_four,
min(i) FILTER (WHERE cum >= mx) dg_index, arg_min(s, i) FILTER (WHERE cum >= (n + 1) // 2) half_size, any_value(c) - min(i) FILTER (WHERE cum >= (n + 1) // 2) half_index FROM o""",
)
_OVERLAP = """WITH h AS (SELECT p_partkey node, p_brand k FROM part WHERE p_partkey % 5 <> 0 UNION SELECT p_partkey, p_type FROM part WHERE p_partkey % 7 = 0),
s AS (SELECT node, {pick} k FROM h GROUP BY node), l AS (SELECT node, min(node) OVER (PARTITION BY k) cluster_id FROM s)
SELECT coalesce(cluster_id, p_partkey) cluster_id, p_partkey node FROM part LEFT JOIN l ON node = p_partkey"""


def _overlapping(s: SparkSession, d: str) -> DataFrame:
    return part_clusters(s, d, "p_brand").where("node % 5 <> 0").unionByName(part_clusters(s, d, "p_type").where("node % 7 = 0"))


_add("enstrict", lambda s, d: cl.enstrict(_overlapping(s, d), part_clusters(s, d, "p_brand")), _OVERLAP.format(pick="min(k)"))
_add("enstrict_split", lambda s, d: cl.enstrict(_overlapping(s, d), part_clusters(s, d, "p_brand"), "split"), _OVERLAP.format(pick="list(k ORDER BY k)"))
_add(
    "project_clusters",
    lambda s, d: cl.project(part_clusters(s, d, "p_brand"), table(s, d, "lineitem").select(F.col("l_partkey").alias("node"))),
    "SELECT p_brand cluster_id, p_partkey node FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem)",
)
_add(
    "groups_numbered",
    lambda s, d: cl.numbered(part_clusters(s, d, "p_brand")),
    """WITH z AS (SELECT p_brand c, count(*) s, min(p_partkey) l FROM part GROUP BY 1), k AS (SELECT c, row_number() OVER (ORDER BY s DESC, l) + 999 i FROM z)
SELECT 'OG' || i group_id, p_partkey node FROM part JOIN k ON c = p_brand""",
)

# Flow. flow_clusters takes all arcs; the others reduce the graph to mutual nearest neighbours first, as networks are before they are clustered.
_NEIGHBOURS = 4


def _near(g: DataFrame) -> DataFrame:
    return gr.knn(gr.load(gr.drop_loops(g)), _NEIGHBOURS)


_on_graph("flow_clusters", lambda g: flow.flow_clusters(g, extra=gr.nodes(g)))
_on_graph("flow_hierarchy", lambda g: flow.hierarchy(_near(g), levels=2))
_on_graph("keep_flow_clusters", lambda g: flow.keep_clusters(_near(g)))
_with_genes("sub_cluster", lambda g, c: flow.sub_cluster(_near(g), c), "taxon")


def gene_groups(spark: SparkSession, d: str) -> DataFrame:
    """The whole run over the order hits: relations, clustering and numbered groups."""
    return pipeline.from_similarities(relations._needed(spark, d), RunConfig(relations.CFG))["groups"]


_add("gene_groups", gene_groups)
