"""Relations against a plain re-statement of their definitions, on random small inputs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from kinweave.config import Cutoff, PairConfig
from kinweave.functions.evalue import edge_score, ordered_evalue, repair_zero_exponents, score_text, split_evalue
from kinweave.operators import hsp, pairs
from kinweave.schemas import SIMILARITY

CFG = PairConfig(30.0, Cutoff(1.0, -5))


def similarities(seed):
    draw = random.Random(seed)
    genes = [(f"{t}|{i}", t) for t in "ABC" for i in range(5)]
    rows = []
    for q, qt in genes:
        for s, st in genes:
            if draw.random() < 0.8:
                mant = draw.choice([0.0, 1.0, 2.5, 9.99])
                rows.append((q, s, qt, st, mant, draw.randrange(-12, -2), 50.0, draw.choice([20.0, 40.0, 90.0])))
    return rows


def brute(rows):
    sim = {(r[0], r[1]): r for r in rows}
    ok = lambda r: r[7] >= 30 and (r[4] == 0 or r[5] < -5 or (r[5] == -5 and r[4] <= 1))
    ev = lambda r: (r[5], r[4])
    best, other = {}, {}
    for r in rows:
        if r[2] != r[3]:
            best[r[0], r[3]] = min(best.get((r[0], r[3]), (99, 0)), ev(r))
            other[r[0]] = min(other.get(r[0], (99, 0)), ev(r))
    bh = {k for k, r in sim.items() if r[2] != r[3] and ok(r) and (r[4] < 0.01 or ev(r) == best[r[0], r[3]])}
    ic = {k for k, r in sim.items() if r[2] == r[3] and r[0] != r[1] and ok(r) and (r[0] not in other or r[4] < 0.001 or ev(r) <= other[r[0]])}

    def score(a, b, zero):
        x, y = sim[a, b], sim[b, a]
        return (x[5] + y[5]) / -2 if x[4] < zero or y[4] < zero else (math.log10(x[4] * y[4]) + x[5] + y[5]) / -2

    def by_pair(raw):
        groups = {}
        for (a, b), v in raw.items():
            groups.setdefault(tuple(sorted((a[0], b[0]))), []).append(v)
        return {k: v / (sum(g := groups[tuple(sorted((k[0][0], k[1][0])))]) / len(g)) for k, v in raw.items()}

    ortho = by_pair({(a, b): score(a, b, 0.01) for a, b in bh if a < b and (b, a) in bh})
    raw = {(a, b): score(a, b, 0.01) for a, b in ic if a < b and (b, a) in ic}
    ids = {x for p in ortho for x in p}
    para = {}
    for (a, b), v in raw.items():
        own = [(k, w) for k, w in raw.items() if k[0][0] == a[0]]
        touching = [w for k, w in own if k[0] in ids or k[1] in ids] or [w for _, w in own]
        para[a, b] = v / (sum(touching) / len(touching))
    ip = set(para) | {(b, a) for a, b in para}
    orth = set(ortho) | {(b, a) for a, b in ortho}
    reach = {(x, z) for x, y in ip for y2, z in orth if y == y2}
    ends = reach | {(x, w) for x, z in reach for z2, w in ip if z == z2}
    cand = {tuple(sorted(p)) for p in ends if p[0] != p[1]} - set(ortho)
    co = by_pair({(a, b): score(a, b, 0.00001) for a, b in cand if (a, b) in sim and (b, a) in sim and ok(sim[a, b]) and ok(sim[b, a])})
    return ortho, para, co


def edges(df):
    return {(r.seq_a, r.seq_b): round(r.normalized_score, 9) for r in df.collect()}


@pytest.mark.parametrize("seed", range(4))
def test_relations(spark, seed):
    rows = similarities(seed)
    sim = spark.createDataFrame([(*r, "x") for r in rows], SIMILARITY + ", best string").drop("best") if seed else spark.createDataFrame(rows, SIMILARITY)
    found = pairs.build(sim, CFG)
    for name, want in zip(("orthologs", "inparalogs", "coorthologs"), brute(rows), strict=True):
        assert edges(found[name]) == {k: round(v, 9) for k, v in want.items()}, name
    assert not set(edges(found["coorthologs"])) & set(edges(found["orthologs"]))
    means = found["orthologs"].groupBy("taxon_a", "taxon_b").agg(F.avg("normalized_score").alias("m")).collect()
    assert all(abs(r.m - 1) < 1e-9 for r in means)


def test_ties_keep_orthologs_but_no_strict_pair(spark):
    rows = [("A|1", "B|1", "A", "B", 1.0, -50, 90.0, 90.0), ("A|1", "B|2", "A", "B", 1.0, -50, 90.0, 90.0), ("B|1", "A|1", "B", "A", 1.0, -50, 90.0, 90.0), ("B|2", "A|1", "B", "A", 1.0, -50, 90.0, 90.0)]
    sim = spark.createDataFrame(rows, SIMILARITY)
    assert set(edges(pairs.orthologs(sim, CFG))) == {("A|1", "B|1"), ("A|1", "B|2")}
    assert pairs.strict_reciprocal(sim, CFG).count() == 0


def test_last_record_wins_and_incomplete_ones_are_dropped(spark):
    rows = [("a", "b", "A", "B", 1.0, -5, 1.0, 9.0, 1), ("a", "b", "A", "B", 2.0, -6, 1.0, 9.0, 2), ("a", None, "A", "B", 1.0, -5, 1.0, 9.0, 3), ("a", "c", "A", "B", None, -5, 1.0, 9.0, 4), ("a", "b", "A", "B", 2.0, -6, 1.0, 9.0, 2)]
    out = pairs.last_records(spark.createDataFrame(rows, SIMILARITY + ", n int"), ["n"]).collect()
    assert [(r.query_id, r.subject_id, r.evalue_mant) for r in out] == [("a", "b", 2.0)]


def test_conflicting_scores_are_an_error(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 2.0)], "k string, v double")
    assert sorted(map(tuple, pairs.raw_dedupe(df, ["k"], "v").collect())) == [("a", 1.0), ("b", 2.0)]
    with pytest.raises(Exception, match="differ"):
        pairs.raw_dedupe(df.unionByName(spark.createDataFrame([("a", 1.1)], "k string, v double")), ["k"], "v").collect()


def test_cutoffs():
    assert Cutoff.parse("1e-5") == Cutoff(1.0, -5) and Cutoff.parse("-7") == Cutoff(1.0, -7) and Cutoff.parse("2.5e-30") == Cutoff(2.5, -30)
    with pytest.raises(ValueError):
        Cutoff.parse("0")


def test_evalues_and_scores(spark):
    df = spark.createDataFrame([(1e-30,), (0.0,), (9.999e-5,), (9.9996e-5,), (0.7574,)], "v double")
    mant, exp = split_evalue(F.col("v"))
    assert [tuple(r) for r in df.select(mant, exp).collect()] == [(1.0, -30), (0.0, 0), (10.0, -5), (1.0, -4), (7.57, -1)]
    zero = spark.createDataFrame([(0.0, 0), (1.0, -80), (2.0, -3)], "evalue_mant double, evalue_exp int")
    assert sorted(r.evalue_exp for r in repair_zero_exponents(zero).collect()) == [-81, -80, -3]
    scores = spark.createDataFrame([(1.0,), (1.23449,), (-0.2,), (0.0005,)], "x double")
    assert [tuple(r) for r in scores.select(score_text(F.col("x")), edge_score(F.col("x"))).collect()] == [("1", 1.0), ("1.234", 1.234), ("-0.199", -0.199), ("0.001", 0.001)]


def test_collapse_counts_covered_residues_of_the_shorter_side(spark):
    schema = "line_id bigint, query_id string, subject_id string, query_taxon string, subject_taxon string, query_length int, subject_length int, evalue_mant double, evalue_exp int, percent_identity double, length bigint, q_start bigint, q_end bigint, s_start bigint, s_end bigint, _a int"
    rows = [
        (1, "q", "s", "Q", "S", 100, 50, 1.0, -9, 90.0, 10, 1, 99, 20, 11, 0), (2, "q", "s", "Q", "S", 100, 50, 1.0, -20, 80.0, 30, 1, 99, 15, 25, 0), (3, "q", "s", "Q", "S", 100, 50, 1.0, -3, 80.0, 10, 1, 99, 40, 44, 0),
        (4, "p", "s", "P", "S", 50, 50, 2.0, -7, 70.0, 10, 1, 50, 1, 5, 0),
    ]
    out = {r.query_id: r for r in hsp.collapse(spark.createDataFrame(rows, schema)).collect()}
    assert (out["q"].evalue_exp, out["q"].percent_match, out["q"].percent_identity) == (-9, 40.0, 82.0)
    assert out["p"].percent_match == 10.0  # equal lengths: the subject's coordinates


def test_unknown_genes(spark):
    hits = spark.createDataFrame([("a", "b"), ("a", "x")], "query_id string, subject_id string")
    genes = spark.createDataFrame([("a", "A", 10), ("b", "B", 20)], "gene_id string, taxon string, length int")
    assert hsp.with_genes(hits, genes).count() == 1
    with pytest.raises(Exception, match="unknown gene"):
        hsp.with_genes(hits, genes, strict=True).collect()


def test_separate_runs(spark):
    rows = [(1, "f", "a", "b"), (2, "f", "a", "b"), (3, "f", "a", "c"), (4, "f", "a", "b")]
    out = hsp.runs(spark.createDataFrame(rows, "line_id bigint, file_name string, query_id string, subject_id string"))
    assert [r.run for r in out.orderBy("line_id").collect()] == [1, 1, 2, 3]


def test_empty(spark):
    sim = spark.createDataFrame([], SIMILARITY)
    assert all(df.count() == 0 for df in pairs.build(sim, CFG).values())


def test_zero_is_the_best_evalue(spark):
    exp, mant = ordered_evalue(F.col("m"), F.col("e"))
    df = spark.createDataFrame([(0.0, 0), (0.0, -7), (5.0, -200)], "m double, e int").select(exp.alias("a"), mant.alias("b"))
    assert [tuple(r) for r in df.orderBy("a", "b").collect()] == [(-(2**31), 0.0), (-(2**31), 0.0), (-200, 5.0)]


def test_conflicting_raw_scores_are_an_error(spark):
    df = lambda *rows: spark.createDataFrame(rows, "a string, b string, s double")
    assert [tuple(r) for r in pairs.raw_dedupe(df(("x", "y", 1.0), ("x", "y", 1.0 + 1e-12)), ["a", "b"], "s").collect()] == [("x", "y", 1.0)]
    with pytest.raises(Exception, match="differ"):
        pairs.raw_dedupe(df(("x", "y", 1.0), ("x", "y", 1.1)), ["a", "b"], "s").collect()


@pytest.mark.parametrize("chunk", [1, 3, 20, None])
def test_runs_in_chunks(spark, chunk):
    draw = random.Random(4)
    rows = [(i * 2, draw.choice(["f", "f", "f", "g", None]), draw.choice("ab"), draw.choice("xy"), "z") for i in range(120)]
    got = {r.line_id: r.run for r in hsp.runs(spark.createDataFrame(rows, "line_id bigint, file_name string, query_id string, subject_id string, _chunk string").drop("_chunk"), chunk_rows=chunk).collect()}
    want, last = {}, {}
    for line, file, q, s, _ in rows:
        if file:
            number, pair = last.get(file, (0, None))
            last[file] = (number + (pair != (q, s)), (q, s))
            want[line] = last[file][0]
    assert got == want


def test_covered_residues(spark):
    spans = [[], [(1, 5)], [(1, 5), (5, 9)], [(1, 20), (3, 4)], [(2, 3), (7, 9)], [(-4, 0), (0, 0)]]
    df = spark.createDataFrame([(i, [(min(s), max(s)) for s in x]) for i, x in enumerate(spans)], "i int, s array<struct<lo bigint, hi bigint>>")
    got = {r.i: r.n for r in df.select("i", hsp.covered(F.array_sort("s")).alias("n")).collect()}
    assert got == {i: len({y for a, b in x for y in range(a, b + 1)}) for i, x in enumerate(spans)}
