import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinweave.config import FlowConfig
from kinweave.operators import clusters as cl
from kinweave.operators import flow, network, products, searches, settling, vectors
from kinweave.operators import graph as gr
from kinweave.operators.ranks import quantiles
from kinweave.plans import graphs

ARCS = "src bigint, dst bigint, weight double"


def graph(spark, arcs):
    return spark.createDataFrame(arcs, ARCS)


def random_arcs(seed, n, m):
    draw = random.Random(seed)
    return list({(a, b): (a, b, float(draw.randrange(1, 9))) for a, b in ((draw.randrange(n), draw.randrange(n)) for _ in range(m))}.values())


def as_set(df):
    return {(r.src, r.dst, round(r.weight, 9)) for r in df.collect()}


def union_find(arcs):
    parent = {x: x for a, b, _ in arcs for x in (a, b)}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b, _ in arcs:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {(x, root(x)) for x in parent}


@pytest.mark.parametrize("arcs", [random_arcs(1, 200, 150), [(i, i + 1, 1.0) for i in range(60)], [(0, i, 1.0) for i in range(1, 50)], [(4, 4, 1.0)], []])
def test_components(spark, arcs):
    assert {tuple(r) for r in gr.components(graph(spark, arcs)).collect()} == union_find(arcs)


def test_load_merges_mirrors_and_mends(spark):
    g = graph(spark, [(1, 2, None), (2, 1, 5.0), (1, 3, float("nan")), (4, None, 1.0), (3, 4, 0.0)])
    assert as_set(gr.load(g)) == {(1, 2, 5.0), (2, 1, 5.0), (1, 3, 1.0), (3, 1, 1.0)}


def test_triangles_and_coefficients(spark):
    arcs = random_arcs(2, 25, 160)
    near = {}
    for a, b, _ in arcs:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want = {t for t in itertools.combinations(sorted(near), 3) if all(y in near[x] for x, y in itertools.combinations(t, 2))}
    g = graph(spark, arcs)
    assert {tuple(sorted(r)) for r in gr.triangles(g).collect()} == want
    got = {r.node: r.triangles for r in network.clustering_coefficient(g).collect()}
    assert got == {x: sum(x in t for t in want) for x in near}


def test_top_k_with_ties(spark):
    g = graph(spark, [(1, 2, 5.0), (1, 3, 4.0), (1, 4, 4.0), (1, 5, 4.0), (2, 3, 1.0), (2, 4, 1.0), (2, 5, 1.0)])
    assert as_set(gr.top_k_ties(g, 2)) == {(1, 2, 5.0), (2, 3, 1.0), (2, 4, 1.0), (2, 5, 1.0)}
    assert as_set(gr.top_k(g, 2)) == {(1, 2, 5.0), (1, 3, 4.0), (2, 3, 1.0), (2, 4, 1.0)}


def test_products_match_dense_ones(spark):
    arcs = random_arcs(3, 12, 60)
    m = np.zeros((12, 12))
    for a, b, w in arcs:
        m[b, a] = w
    sq = m @ m
    assert as_set(gr.step(graph(spark, arcs))) == {(j, i, sq[i, j]) for i, j in zip(*np.nonzero(sq), strict=True)}


def test_value_steps_drop_zeros_at_once(spark):
    g = graph(spark, [(1, 2, 3.0), (1, 3, 8.0)])
    assert as_set(gr.apply_values(g, [("gq", 5), ("ceil", 6), ("log", 2), ("add", 1)])) == {(1, 3, round(np.log2(6) + 1, 9))}


def cliques(k, size, bridge):
    arcs = [(c * size + i, c * size + j, 1.0) for c in range(k) for i, j in itertools.combinations(range(size), 2)]
    return arcs + [(c * size, (c + 1) * size, bridge) for c in range(k - 1)]


def test_flow_finds_cliques_in_the_kernel_and_in_the_loop(spark):
    arcs = cliques(4, 6, 0.1)
    want = {(i // 6 * 6, i) for i in range(24)}
    for small in (500, 0):
        got = {(r.cluster_id, r.node) for r in flow.flow_clusters(graph(spark, arcs), FlowConfig(2.0), small=small).collect()}
        assert got == want


def test_kernel_and_loop_agree_on_random_graphs_with_pruning(spark):
    cfg = FlowConfig(1.8, prune=50, select=6, recover=5)
    g = graph(spark, [(a, b, w) for a, b, w in random_arcs(5, 40, 90)])
    found = [{(r.cluster_id, r.node) for r in flow.flow_clusters(g, cfg, small=s).collect()} for s in (500, 0)]
    assert len({n for _, n in found[0]}) == len(found[0]) == len(found[1])
    assert found[0] == found[1]


def column_supports(spark, arcs, cfg):
    """What each column keeps of the square, by the kernel and by the loop."""
    m = gr.normalize(graph(spark, arcs))
    size = 1 + max(max(a, b) for a, b, _ in arcs)
    dense = np.zeros((size, size))
    for r in m.collect():
        dense[r.dst, r.src] = r.weight
    kernel = np.apply_along_axis(flow.prune_column, 0, dense @ dense, cfg)
    loop = {(r.src, r.dst) for r in flow.expand_pruned(m, cfg).collect()}
    return {(j, i) for i, j in zip(*np.nonzero(kernel), strict=True)}, loop


@pytest.mark.parametrize("select, recover, prune", [(8, 14, 1000), (8, 30, 1000), (8, 30, 60), (12, 14, 10_000)])
def test_loop_recovers_after_selection_like_the_kernel(spark, select, recover, prune):
    draw = random.Random(17)
    arcs = [(a, b, draw.uniform(0.5, 2.0)) for a in range(40) for b in draw.sample(range(40), 9)]
    kernel, loop = column_supports(spark, arcs, FlowConfig(2.0, prune=prune, select=select, recover=recover))
    assert loop == kernel and len(kernel) > 40 * select


def test_loop_selects_only_the_largest_if_too_many_tie_there(spark):
    arcs = [(0, 1, 1.0), *[(1, i, 8.0) for i in range(2, 8)], (1, 8, 1.0), (1, 9, 1.0)]
    kernel, loop = column_supports(spark, arcs, FlowConfig(2.0, select=4, recover=4, mass=0.5))
    assert loop == kernel == {(0, i) for i in range(2, 8)}


def test_flow_of_kernel_and_loop_with_recovery(spark):
    draw = random.Random(18)
    arcs = [(a, b, draw.uniform(0.5, 2.0)) for a in range(40) for b in draw.sample(range(40), 9)]
    cfg = FlowConfig(2.0, select=8, recover=14)
    found = [{(r.cluster_id, r.node) for r in flow.flow_clusters(graph(spark, arcs), cfg, small=s).collect()} for s in (500, 0)]
    assert found[0] == found[1]


@pytest.mark.parametrize("more", [{"initial_rounds": 2, "initial_inflation": 1.3}, {"loop_scale": 2.5}, {"pre_inflation": 1.7}, {"inflation": 1.5}, {"prune": 60, "select": 9, "recover": 15}])
def test_kernel_and_loop_follow_the_same_rules(spark, more):
    draw = random.Random(21)
    arcs = [(a, b, draw.uniform(0.5, 2.0)) for a in range(36) for b in draw.sample(range(36), 5)]
    cfg = FlowConfig(**{"inflation": 2.0, **more})
    trace = []
    found = [{(r.cluster_id, r.node) for r in flow.flow_clusters(graph(spark, arcs), cfg, small=s, trace=trace).collect()} for s in (500, 0)]
    assert found[0] == found[1] and len(found[0]) == 36 and trace[-1]["chaos"] < cfg.chaos


def test_large_components_settle_in_a_task(spark):
    trace = []
    got = {(r.cluster_id, r.node) for r in flow.flow_clusters(graph(spark, cliques(450, 5, 0.1)), FlowConfig(2.0), trace=trace).collect()}
    assert got == {(i // 5 * 5, i) for i in range(2250)} and trace == []


def counted(spark, arcs):
    """A graph, and how many of its rows were made so far."""
    made = spark.sparkContext.accumulator(0)

    def make(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    g = graph(spark, arcs)
    return g.mapInArrow(make, g.schema), made


def test_hierarchy_makes_its_graph_once(spark):
    g, made = counted(spark, cliques(4, 5, 0.1))
    rows = flow.hierarchy(g, FlowConfig(2.0), 2).collect()
    assert {(r.cluster_id, r.node) for r in rows if r.level == 1} == {(i // 5 * 5, i) for i in range(20)} and made.value == len(cliques(4, 5, 0.1))


def test_arcs_within_clusters_make_their_graph_once(spark):
    arcs = cliques(4, 5, 0.1)
    g, made = counted(spark, arcs)
    assert {(a, b) for a, b, _ in as_set(flow.keep_clusters(g))} == {(a, b) for a, b, _ in arcs if a // 5 == b // 5} and made.value == len(arcs)


def test_components_that_outgrow_a_task_take_the_loop(spark, monkeypatch):
    bounds, ends = np.array([0, 3, 5]), [(0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 2), (3, 3), (3, 4), (4, 4)]
    u, v = np.array(ends).T
    w = 1 / np.bincount(u)[u]
    monkeypatch.setattr(settling, "ENTRIES", 5)
    assert list(settling.settle_all(bounds, u, v, w, FlowConfig())[3]) == [True, False]
    settled = flow._small

    def given_up(sized, cfg, kind):
        monkeypatch.setattr(flow, "_small", settled)
        return sized.selectExpr("CAST(NULL AS BIGINT) cluster_id", "src node").distinct()

    monkeypatch.setattr(flow, "_small", given_up)
    trace = []
    got = {(r.cluster_id, r.node) for r in flow.flow_clusters(graph(spark, cliques(4, 6, 0.1)), FlowConfig(2.0), small=500, trace=trace).collect()}
    assert got == {(i // 6 * 6, i) for i in range(24)} and trace


def test_interpretation_takes_the_smallest_cluster_on_any_way(spark):
    arcs = [(0, 0, 1.0), (5, 5, 1.0), (1, 0, 0.9), (2, 1, 0.5), (2, 5, 0.5), (3, 2, 1.0), (6, 7, 1.0), (7, 6, 1.0)]
    dense = np.zeros((8, 8))
    for a, b, w in arcs:
        dense[b, a] = w
    dense[4, 4] = 1.0
    label = flow.interpret(dense)
    got = {r.node: r.cluster_id for r in flow.interpret_graph(graph(spark, arcs + [(4, 4, 1.0)])).collect()}
    assert got == {i: int(c) for i, c in enumerate(label)} and got[3] == got[2] == got[1] == 0 and got[5] == 5 and got[6] == 6


def test_rounds_that_do_not_suffice_are_told(spark):
    with pytest.warns(UserWarning, match="not settled"):
        flow.flow_clusters(graph(spark, cliques(3, 5, 0.4)), FlowConfig(1.2, most_rounds=1), small=0).count()


def test_only_arcs_within_flow_clusters_stay(spark):
    arcs = cliques(3, 5, 0.1)
    assert {(a, b) for a, b, _ in as_set(flow.keep_clusters(graph(spark, arcs)))} == {(a, b) for a, b, _ in arcs if a // 5 == b // 5}


def test_isolated_nodes_and_empty_graph(spark):
    extra = spark.createDataFrame([(7,), (1,)], "node bigint")
    assert {tuple(r) for r in flow.flow_clusters(graph(spark, [(1, 2, 1.0)]), extra=extra).select("cluster_id", "node").collect()} == {(1, 1), (1, 2), (7, 7)}
    assert flow.flow_clusters(graph(spark, [])).count() == 0


def test_cluster_measures(spark):
    one = spark.createDataFrame([(i % 3, i) for i in range(30)] + [(0, 0)], "cluster_id bigint, node bigint")
    row = cl.distances(one, one).first()
    assert (row.split_join_a, row.split_join_b, row.mirkin_a, row.mirkin_b) == (0, 0, 0, 0) and max(row.vi_a, row.vi_b) < 1e-12 and row.rand == row.jaccard == row.adjusted_rand == 1
    other = spark.createDataFrame([(i // 15, i) for i in range(30)], "cluster_id bigint, node bigint")
    assert cl.contingency(one, other).count() == 6 and cl.mate(one, other, 2).count() == 6
    assert cl.meet(one, other).select("cluster_id").distinct().count() == 6
    overlap = one.unionByName(spark.createDataFrame([(9, 1), (9, 99)], one.schema))
    nodes = spark.createDataFrame([(i,) for i in range(31)], "node bigint")
    fixed = {r.node: r.cluster_id for r in cl.enstrict(overlap, nodes).collect()}
    assert len(fixed) == 31 and fixed[1] == 1 and fixed[30] == 30 and {fixed[i] for i in range(30)} == {0, 1, 2}
    split = {r.node: r.cluster_id for r in cl.enstrict(overlap, nodes, "split").collect()}
    assert len(split) == 31 and split[1] == 1 and split[4] == split[7] == 4
    assert cl.enstrict(overlap, nodes, "keep").count() == 32
    assert cl.volatility(one, one).count() == 0
    assert [r.line for r in cl.lines(cl.numbered(one.where("node < 5"), "OG", 7)).orderBy("line").collect()] == ["OG7: 0 3", "OG8: 1 4", "OG9: 2"]


def clustering(spark, *groups):
    return spark.createDataFrame([(i, n) for i, g in enumerate(groups) for n in g], "cluster_id int, node bigint")


def test_distances_by_hand(spark):
    row = cl.distances(clustering(spark, [1, 2], [3, 4]), clustering(spark, [1, 2, 3], [4])).first()
    assert (row.split_join_a, row.split_join_b, row.mirkin_a, row.mirkin_b) == (1, 1, 2, 4)
    assert abs(row.vi_a - np.log(2) / 2) < 1e-12 and abs(row.vi_b - (3 * np.log(3) - 2 * np.log(2)) / 4) < 1e-12


def test_volatility_by_hand(spark):
    a, b = clustering(spark, [1, 2, 3, 4, 5], [6, 7, 8, 9, 10]), clustering(spark, [1, 2, 3, 6, 7], [4, 5, 8, 9, 10])
    assert {(r.node, r.score) for r in cl.volatility(a, b).collect()} == {(n, 0.5) for n in (4, 5, 6, 7)}


def test_granularity_by_hand(spark):
    row = cl.granularity(clustering(spark, range(5), range(5, 9), [9])).first()
    assert (row.clusters, row.largest, row.smallest, row.singletons, row.up_to_four, row.dg_index, row.half_size, row.half_index) == (3, 5, 1, 1, 2, 2, 4, 1)
    row = cl.granularity(clustering(spark, *[[i] for i in range(6)], range(6, 10))).first()
    assert (row.dg_index, row.half_size, row.half_index) == (4, 1, 2)


def test_coverage_by_hand(spark):
    g, c = graph(spark, [(1, 2, 1.0), (2, 1, 1.0), (1, 3, 1.0), (3, 1, 1.0)]), clustering(spark, [1, 2], [3])
    per = {r.node: (round(r.mass, 6), round(r.coverage, 6)) for r in cl.node_coverage(g, c).collect()}
    assert per == {1: (0.5, 0.333333), 2: (1.0, 0.5), 3: (0.0, 0.0)}
    row = cl.coverage(g, c).first()
    assert [round(x, 6) for x in (row.mass, row.area, row.efficiency)] == [0.5, 0.333333, 0.277778]
    row = cl.coverage(graph(spark, [(1, 2, 1.0), (2, 1, 1.0), (3, 3, 1.0)]), c).first()
    assert row.mass == 1.0 and abs(row.efficiency - (0.5 + 0.5 + 1) / 3) < 1e-12


def test_sets_of_nodes(spark):
    own = lambda *n: spark.createDataFrame([(x,) for x in n], "node bigint")
    for a, b, want in (((1, 2), (2, 1, 1), "equal"), ((1,), (1, 2), "sub"), ((1, 2), (2,), "super"), ((1,), (2,), "disjoint"), ((1, 2), (2, 3), "overlap"), ((), (), "equal")):
        row = cl.parts(own(*a), own(*b)).first()
        assert row.relation == want and (row.left_only, row.shared, row.right_only) == (len({*a} - {*b}), len({*a} & {*b}), len({*b} - {*a}))


def test_nested_order(spark):
    rows = cl.nested_order([clustering(spark, [1, 2], [3, 4, 5]), clustering(spark, [1], [2, 4], [3, 5])]).collect()
    assert [r.node for r in sorted(rows, key=lambda r: r.place)] == [4, 3, 5, 2, 1]


def test_power_threshold_is_strict_and_keeps_lone_loops(spark):
    g = graph(spark, [(1, 2, 2.0), (1, 3, 2.0), (1, 1, 9.0), (2, 2, 1.0), (3, 1, 1.0), (3, 2, 3.0)])
    assert as_set(gr.power_threshold(g, 1.0)) == {(1, 1, 9.0), (2, 2, 1.0), (3, 2, 3.0)}


def test_functions_of_two_weights(spark):
    g = graph(spark, [(1, 2, 3.0), (2, 1, 5.0), (1, 3, 4.0)])
    for how, want in {
        "left_or_right": {(1, 2, 3.0), (2, 1, 5.0), (1, 3, 4.0), (3, 1, 4.0)}, "left_and_not_right": {(1, 3, 4.0)}, "left_and_right": {(1, 2, 3.0), (2, 1, 5.0)},
        "min_nonzero": {(1, 2, 3.0), (2, 1, 3.0)}, "max_nonzero": {(1, 2, 5.0), (2, 1, 5.0)}, "cross": {(1, 2, 15.0), (2, 1, 15.0), (1, 3, 4.0), (3, 1, 4.0)}, "arcmax": {(2, 1, 5.0), (1, 3, 4.0)},
    }.items():
        assert as_set(gr.combine_transpose(g, how)) == want
    assert as_set(gr.filter_arc_pairs(g, "max", "lq", 3)) == {(1, 2, 3.0), (2, 1, 5.0), (1, 3, 4.0)}
    assert as_set(gr.filter_arc_pairs(g, "min", "gq", 3)) == {(1, 2, 3.0), (2, 1, 5.0)}


def test_rings_and_parts_of_a_graph(spark):
    g = graph(spark, [(1, 2, 1.0), (2, 3, 4.0), (3, 4, 9.0), (1, 5, 1.0), (5, 1, 1.0), (9, 9, 1.0)])
    one = spark.createDataFrame([(1,)], "node bigint")
    assert {r.node for r in gr.ring(g, one, 2).collect()} == {3} and {r.node for r in gr.ring(g, one, 1).collect()} == {2, 5}
    assert as_set(gr.select(g, one, around=1)) == {(1, 2, 1.0), (1, 5, 1.0), (5, 1, 1.0)}
    assert as_set(gr.select(g, least_degree=2, steps=[("pow", 0.5)])) == {(1, 2, 1.0), (2, 3, 2.0)}
    assert as_set(gr.transform(g, [("drop_loops", 0), ("value:mul", 2), ("gq", 5), ("transpose", 0)])) == {(3, 2, 8.0), (4, 3, 18.0)}


def test_a_star_that_owns_most_edges_is_one_component(spark):
    arcs = [(0, i, 1.0) for i in range(1, 700)] + [(i, i + 1, 1.0) for i in range(1000, 1005)] + [(5, 1000, 1.0)]
    assert {tuple(r) for r in gr.components(graph(spark, arcs)).collect()} == union_find(arcs)


def test_quantiles(spark):
    draw = random.Random(12)
    groups = {k: [float(draw.randrange(6)) for _ in range(draw.randrange(1, 30))] for k in range(12)}
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [(0, None), (0, float("nan")), (77, None)]
    got = quantiles(spark.createDataFrame(rows, "k int, v double"), "k", "v", {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}).collect()
    assert len(got) == 12
    for r in got:
        assert np.allclose([r.a, r.b, r.c, r.d, r.e], np.quantile(groups[r.k], [0, 0.25, 0.5, 0.9, 1]))


def test_arc_cosines_and_perturbed_weights(spark):
    arcs = [(0, i, float(1 + i % 5)) for i in range(1, 300)] + [(1, 2, 2.0), (1, 3, 1.0), (2, 3, 4.0), (2, 0, 1.0), (3, 3, 2.0), (0, 1, 2.0)]
    arcs = [(a, b, w) for (a, b), w in {(a, b): w for a, b, w in arcs}.items()]
    g, m = graph(spark, arcs), np.zeros((300, 300))
    for a, b, w in arcs:
        m[a, b] = w
    norm = np.sqrt((m * m).sum(1))
    want = {(a, b): m[a] @ m[b] / norm[a] / norm[b] for a, b, _ in arcs if a != b and norm[a] * norm[b] and m[a] @ m[b]}
    got = {(r.src, r.dst): r.weight for r in gr.arc_cosine(g).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - w) < 1e-12 for k, w in want.items())
    moved = {(r.src, r.dst): r.weight for r in gr.perturbed(g, 0.1, "cosine").collect()}
    assert all(abs(moved[a, b] - w * (1 + 0.1 * (1 if a == b else want.get((a, b), 0)))) < 1e-12 for a, b, w in arcs)
    drawn = as_set(gr.perturbed(g, 0.1))
    assert len(drawn) == len(arcs) and drawn == as_set(gr.perturbed(g, 0.1)) and all(abs(x / m[a, b] - 1) <= 0.1 for a, b, x in drawn)
    assert as_set(gr.diagonal(graph(spark, [(1, 2, 1.0)]))) == {(1, 1, 1.0), (2, 2, 1.0)}


def brandes(arcs, sources):
    nodes = {x for a, b, _ in arcs for x in (a, b)}
    near = {x: {b for a, b, _ in arcs if a == x and b != x} for x in nodes}
    score = dict.fromkeys(nodes, 0.0)
    for s in sources:
        order, paths, depth, back = [s], {s: 1.0}, {s: 0}, {}
        for x in order:
            for y in near[x]:
                if y not in depth:
                    depth[y], paths[y] = depth[x] + 1, 0.0
                    order.append(y)
                if depth[y] == depth[x] + 1:
                    paths[y] += paths[x]
                    back.setdefault(y, []).append(x)
        share = dict.fromkeys(order, 0.0)
        for y in reversed(order):
            for x in back.get(y, []):
                share[x] += paths[x] / paths[y] * (1 + share[y])
            if y != s:
                score[y] += share[y]
    return {x: round(v, 9) for x, v in score.items() if v > 0}


def test_betweenness_and_shortest_paths(spark):
    arcs = random_arcs(8, 30, 70)
    g = graph(spark, arcs)
    sources = spark.createDataFrame([(i,) for i in (0, 3, 7, 500)], "node bigint")
    assert {r.node: round(r.score, 9) for r in network.betweenness(g, sources, 30).collect()} == brandes(arcs, (0, 3, 7))
    assert {tuple(r) for r in network.edge_betweenness(graph(spark, [(0, 1, 1.0), (0, 2, 1.0), (1, 3, 1.0), (2, 3, 1.0)]), sources).collect()} == {(0, 1, 1.5), (0, 2, 1.5), (1, 3, 0.5), (2, 3, 0.5)}
    line = graph(spark, [(1, 2, 1.0), (2, 3, 1.0), (1, 4, 1.0), (4, 3, 1.0), (3, 5, 1.0)])
    asked = spark.createDataFrame([(1, 5)], "source bigint, target bigint")
    assert {(r.node, r.depth) for r in network.shortest_path_nodes(line, asked, 9).collect()} == {(1, 0), (2, 1), (4, 1), (3, 2), (5, 3)}


def test_searches_go_on_until_nothing_new_is_reached(spark):
    arcs = [(i, i + 1, 1.0) for i in range(7)] + [(7, 0, 1.0), (2, 9, 1.0)]
    g, sources = graph(spark, arcs), spark.createDataFrame([(0,), (9,)], "node bigint")
    assert {tuple(r) for r in network.eccentricity(g, sources).collect()} == {(0, 7, 9), (9, 0, 1)}
    assert {r.node: round(r.score, 9) for r in network.betweenness(g, sources).collect()} == brandes(arcs, (0, 9))


def test_betweenness_query_takes_paths_of_any_length(spark, monkeypatch):
    arcs = [(50, 1, 1.0), *[(i, i + 1, 1.0) for i in range(1, 6)]]
    monkeypatch.setattr(graphs, "similarity_graph", lambda s, d: graph(s, arcs))
    monkeypatch.setattr(graphs, "searched", lambda g: g.sparkSession.createDataFrame([(50,)], "node bigint"))
    assert {r.node: r.score for r in graphs.QUERIES["betweenness"](spark, "").collect()} == brandes(arcs, (50,))


def test_vectors_with_nulls_and_zeros(spark):
    rows = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 2.0]), (2, [3.0, 3.0]), (3, [0.0, 0.0]), (4, None), (5, [1.0]), (6, [1.0, None])], "id bigint, v array<double>")
    got = {(r.query, r.row): round(r.score, 6) for r in vectors.against(rows, rows.where("id = 0"), "id", "v", "cosine").collect()}
    assert got == {(0, 1): 0.0, (0, 2): 0.707107}
    got = {(r.query, r.row): r.score for r in vectors.against(rows, rows.where("id = 0"), "id", "v", "taxi", 3).collect()}
    assert got == {(0, 1): 3.0, (0, 2): 5.0}
    assert vectors.against(rows, rows.where("id > 90"), "id", "v", "dot").count() == 0


def test_measures_against_plain_ones(spark):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(12, 5))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, v array<double>")
    for measure, f in {
        "minkowski": lambda a, b: (abs(a - b) ** 3).sum() ** (1 / 3), "acute": lambda a, b: np.arccos(abs(a @ b) / np.linalg.norm(a) / np.linalg.norm(b)),
        "cosine_skew": lambda a, b: np.sqrt(max(a @ b, 0)) / np.linalg.norm(a), "half_sine": lambda a, b: np.sqrt(0.5 - 0.5 * (a @ b) / np.linalg.norm(a) / np.linalg.norm(b)),
    }.items():
        got = {(r.query, r.row): r.score for r in vectors.against(rows, rows, "id", "v", measure, power=3.0).collect()}
        assert len(got) == 132 and all(abs(s - f(x[a], x[b])) < 1e-9 for (a, b), s in got.items())


def test_gaps_in_vectors(spark):
    rows = spark.createDataFrame([(0, [1.0, 2.0, None, 5.0]), (1, [2.0, None, 7.0, 3.0]), (2, [None, None, None, None]), (3, [None, 1.0, 2.0, None])], "id bigint, v array<double>")
    got = {(r.query, r.row): r.score for r in vectors.against(rows, rows.where("id = 0"), "id", "v", "cosine", gaps=True).collect()}
    assert set(got) == {(0, 1), (0, 3)} and abs(got[0, 1] - (2 + 15) / np.sqrt(26 * 13)) < 1e-12 and got[0, 3] == 1


def test_a_popular_item_in_sets(spark):
    sets = [(i, 0) for i in range(900)] + [(i, 1 + i % 7) for i in range(900)]
    df = spark.createDataFrame(sets, "id bigint, item bigint")
    got = {(r.query, r.row): r.meet for r in vectors.set_scores(df, spark.createDataFrame([(0,), (3,)], "id bigint")).collect()}
    assert got == {(q, r): 1 + (q % 7 == r % 7) for q in (0, 3) for r in range(900) if r != q}


def test_blocks_of_queries(spark, monkeypatch):
    rows = spark.range(40).select(F.col("id"), F.array(F.col("id") % 7 + 1.0, F.col("id") % 3 + 1.0).alias("v"))
    whole = {tuple(r) for r in vectors.against(rows, rows, "id", "v", "euclid").collect()}
    monkeypatch.setattr(vectors, "BLOCK", 10)
    assert {tuple(r) for r in vectors.against(rows, rows, "id", "v", "euclid").collect()} == whole and len(whole) == 40 * 39


def test_numbers_in_a_total_order_over_partitions(spark):
    from kinweave.session import numbered_rows

    rows = numbered_rows(spark.range(1000).repartition(7), [F.desc("id")], "place", 5).collect()
    assert sorted((r.place, r.id) for r in rows) == [(5 + i, 999 - i) for i in range(1000)]
    assert numbered_rows(spark.range(0), ["id"], "place").count() == 0


def test_samples_keep_both_directions(spark):
    g = gr.load(graph(spark, random_arcs(4, 60, 900)))
    kept = as_set(gr.sampled(g, 0.3))
    assert kept == as_set(gr.sampled(g, 0.3)) and {(b, a, w) for a, b, w in kept} == kept and 0.15 < len(kept) / g.count() < 0.45


def test_small_clusters_are_absorbed(spark):
    c = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (9, 4), (8, 5)], "cluster_id bigint, node bigint")
    g = gr.load(graph(spark, [(4, 1, 2.0), (4, 5, 9.0), (1, 2, 1.0)]))
    assert {tuple(r) for r in cl.absorb_small(g, c, 1).collect()} == {(1, 1), (1, 2), (1, 3), (1, 4), (8, 5)}


def test_search_kernels_and_joins_agree(spark, monkeypatch):
    arcs = [*random_arcs(8, 60, 150), (70, 70, 1.0), (100, 101, 1.0), (101, 102, 1.0), *[(0, i, 1.0) for i in range(1, 50)]]
    g = graph(spark, arcs)
    sources = spark.createDataFrame([(i,) for i in (*range(0, 58, 3), 70, 100, 500)], "node bigint")
    asked = spark.createDataFrame([(0, 5), (3, 9), (3, 9), (100, 102), (5, 100), (9, 9), (4, None)], "source bigint, target bigint")
    monkeypatch.setattr(searches, "CELLS", 400)  # several batches
    for f, given, most in ((network.edge_betweenness, sources, None), (network.betweenness, sources, 3), (network.shortest_path_nodes, asked, 4), (network.depths, sources, 3), (network.eccentricity, sources, 3)):
        one, other = (sorted(tuple(round(x, 9) for x in r) for r in f(g, given, most, kernel).collect()) for kernel in (True, False))
        assert one == other != [], f
    for f in (network.depths, network.eccentricity, network.betweenness, network.edge_betweenness):
        assert f(g.limit(0), sources).collect() == []


@pytest.mark.parametrize("name", ["edge_betweenness", "betweenness", "shortest_path_nodes", "bfs_depth", "eccentricity"])
def test_a_search_query_takes_no_join_per_level(spark, monkeypatch, name):
    line = [(i, i + 1, 1.0) for i in range(400)]
    monkeypatch.setattr(graphs, "similarity_graph", lambda s, d: graph(s, line))
    monkeypatch.setattr(graphs, "searched", lambda g: g.sparkSession.createDataFrame([(0,), (400,)], "node bigint"))
    monkeypatch.setattr(graphs, "_path_ends", lambda g: g.sparkSession.createDataFrame([(0, 400)], "source bigint, target bigint"))
    monkeypatch.setattr(network, "distances", lambda *_: pytest.fail("searched by joins"))
    assert graphs.QUERIES[name](spark, "").count() == {"bfs_depth": 402, "eccentricity": 2, "betweenness": 399, "edge_betweenness": 400, "shortest_path_nodes": 401}[name]


def test_products_by_kernel_and_by_join_agree(spark, monkeypatch):
    monkeypatch.setattr(products, "PATHS", 20)  # several pieces
    arcs = [*random_arcs(4, 30, 90), *[(0, i, 0.5) for i in range(1, 30)], (40, 41, 1.0)]
    cancelled = graph(spark, [(1, 2, 1.0), (1, 3, 1.0), (2, 4, 1.0), (3, 4, -1.0), (2, 5, 2.0)])
    g = gr.load(graph(spark, arcs), mirror=False)
    for a, b in ((g, g), (g, gr.transpose(g)), (cancelled, cancelled), (g.limit(0), g.limit(0))):
        one, other = (sorted((r.src, r.dst, round(r.weight, 9)) for r in f(a, b).collect()) for f in (products.multiply, gr.multiply))
        assert one == other


def test_the_expansion_query_shuffles_no_products(spark, monkeypatch):
    monkeypatch.setattr(graphs, "similarity_graph", lambda s, d: graph(s, [(0, 1, 1.0), (1, 2, 3.0), (1, 3, 1.0)]))
    monkeypatch.setattr(gr, "multiply", lambda *_: pytest.fail("multiplied by a join"))
    assert {tuple(r) for r in graphs.QUERIES["expand_once"](spark, "").collect()} == {(0, 2, 0.75), (0, 3, 0.25)}


def looked_at(index, search):
    """How many arcs a search of ``searches.Index`` looks at, and its result."""
    seen, own = [], index.arcs_of
    index.arcs_of = lambda *a: seen.append(own(*a)) or seen[-1]
    found = search()
    return sum(map(len, seen)), found


def test_path_nodes_are_searched_from_both_ends():
    """0 -> 1 -> 2 -> 3 and 1 -> 4 -> 3; 0 also leads to a hub of 1,000 arcs that is not on the way."""
    arcs = [(0, 1), (1, 2), (2, 3), (1, 4), (4, 3), (0, 5), *((5, k) for k in range(6, 1006))]
    u, v = (np.array(x, np.int32) for x in zip(*sorted(arcs, key=lambda a: a[1]), strict=True))
    index = searches.Index(searches.Ends(1006, u, v))
    out, back = np.full(1006, -1, np.int32), np.full(1006, -1, np.int32)
    looked, (nodes, depth) = looked_at(index, lambda: index.between(0, 3, None, out, back))
    assert sorted(zip(nodes.tolist(), depth.tolist(), strict=True)) == [(0, 0), (1, 1), (2, 2), (3, 3), (4, 2)]
    assert looked < 50 and (out == -1).all() and (back == -1).all()
    assert not len(index.between(0, 3, 2, out, back)[0]) and not len(index.between(3, 0, None, out, back)[0])
    assert index.between(1, 1, None, out, back)[0].tolist() == [1]


def test_flows_look_at_what_leads_to_the_few_nodes_left():
    """0 leads to 100 nodes, each of which leads to all of them and one to 101: only the last needs a look."""
    arcs = [(0, k) for k in range(1, 101)] + [(a, b) for a in range(1, 101) for b in range(1, 101) if a != b] + [(7, 101)]
    u, v = (np.array(x, np.int32) for x in zip(*sorted(arcs, key=lambda a: a[1]), strict=True))
    index, total = searches.Index(searches.Ends(102, u, v)), np.zeros(len(arcs))
    looked, share = looked_at(index, lambda: index.flows(0, None, np.empty(102, np.int32), np.empty(102), total))
    assert looked < 300
    assert share[7] == 1 and share[0] == 101 and share[1] == 0
    assert {(int(a), int(b)): x for a, b, x in zip(index.src, index.dst, total, strict=True) if x} == {(0, k): 2.0 if k == 7 else 1.0 for k in range(1, 101)} | {(7, 101): 1.0}


def test_flow_clusters_takes_all_arcs_of_the_graph(spark, monkeypatch):
    star = graph(spark, [(0, k, 1.0 + k) for k in range(1, 13)])
    monkeypatch.setattr(graphs, "similarity_graph", lambda *_: star)
    assert {tuple(r) for r in graphs.QUERIES["flow_clusters"](spark, "").select("cluster_id", "node").collect()} == {(0, k) for k in range(13)}


def test_rounds_dealt_out_to_tasks_follow_the_rules_of_the_loop(spark, monkeypatch):
    cfg = FlowConfig(1.6, prune=30, select=8, recover=10)
    arcs, found, traces = random_arcs(5, 60, 240), [], ([], [])
    for few, trace in zip((10**9, 0), traces, strict=True):
        monkeypatch.setattr(flow, "FEW", few)
        found.append({(r.cluster_id, r.node) for r in flow.flow_clusters(graph(spark, arcs), cfg, small=0, trace=trace).select("cluster_id", "node").collect()})
    assert found[0] == found[1] and len(found[0]) == len({x for a, b, _ in arcs for x in (a, b)})
    assert [t["arcs"] for t in traces[0]] == [t["arcs"] for t in traces[1]]


def test_components_of_much_work_are_given_up_to_the_tasks(monkeypatch):
    bounds, ends = np.array([0, 4]), [(a, b) for a in range(4) for b in range(4)]
    u, v = np.array(ends).T
    monkeypatch.setattr(settling, "DENSE", 2)
    assert not settling.settle_all(bounds, u, v, np.full(16, 0.25), FlowConfig())[3].any()
    monkeypatch.setattr(settling, "WORK", 63)
    assert settling.settle_all(bounds, u, v, np.full(16, 0.25), FlowConfig())[3].all()


def test_rows_of_a_level_come_node_by_node():
    """Two starts that reach the same two nodes: each node's rows are together, so that files repeat its name."""
    v, u = np.repeat(np.arange(2, 4), 2).astype(np.int32), np.array([0, 1, 0, 1], np.int32)
    levels = list(searches.Index(searches.Ends(4, u, v)).levels(np.array([0, 1]), None))
    assert [(d, which.tolist(), node.tolist()) for d, which, node in levels] == [(0, [0, 1], [0, 1]), (1, [0, 1, 0, 1], [2, 2, 3, 3])]
