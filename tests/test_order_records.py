"""Records kept by array kernels, against all records of the order hits."""

import random

import numpy as np
import pytest

from kinweave.config import Cutoff, PairConfig
from kinweave.plans import graphs, order_records, relations

CFG = PairConfig(10.0, Cutoff(1.0, -10))
LINE = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_quantity double, l_extendedprice double, l_discount double"


def lines(spark, path, seed, odd=()):
    draw = random.Random(seed)
    rows = [(draw.randrange(-3, 150), draw.randrange(1, 12), draw.randrange(90), float(draw.randrange(0, 51)), draw.randrange(0, 10**7) / 100, draw.randrange(11) / 100) for _ in range(1200)]
    spark.createDataFrame([*rows, *odd], LINE).repartition(3).write.parquet(f"{path}/lineitem.parquet")
    return str(path)


def same(got, want):
    fixed = lambda df: sorted(repr([round(x, 9) + 0.0 if isinstance(x, float) else x for x in r]) for r in df.collect())
    assert fixed(got) == fixed(want)


@pytest.mark.parametrize("most", [1_000_000, 700])
def test_relations_are_those_of_all_records(spark, tmp_path, monkeypatch, most):
    d = lines(spark, tmp_path, most)
    for kernel in ("by_query", "of_queries"):  # shares of a task's subjects, and pieces of an order
        whole = getattr(order_records, kernel)
        monkeypatch.setattr(order_records, kernel, lambda *a, whole=whole: whole(*a, most=most))
    all_of = relations.pairs.build(relations._sim(spark, d), CFG)
    kept = order_records.records(spark, d, CFG, True)
    found = relations.pairs.build(kept, CFG)
    for name in ("orthologs", "inparalogs", "coorthologs", "reciprocal"):
        assert all_of[name].count()
        same(found[name].select(*all_of[name].columns), all_of[name])
    few = order_records.records(spark, d, CFG, False)
    same(relations.pairs.build(few, CFG)["inparalogs"], all_of["inparalogs"])
    columns = ["query_id", "subject_id", "query_taxon", "subject_taxon", "evalue_mant", "evalue_exp", "percent_match"]
    assert not few.select(columns).exceptAll(relations._sim(spark, d).select(columns)).count()


@pytest.mark.parametrize("odd", [(5, 3, None, 2.0, 9.0, 0.1), (5, 3, 7, 2.5, 9.0, 0.1), (5, 3, -7, 2.0, 9.0, 0.1), (5, 3, 7, 2.0, float("nan"), 0.1)])
def test_other_numbers_take_the_joins(spark, tmp_path, odd):
    assert order_records.records(spark, lines(spark, tmp_path, 1, [odd]), CFG, False) is None


def test_lines_without_order_or_number_are_no_hits(spark, tmp_path):
    d = lines(spark, tmp_path, 2, [(None, 3, None, 2.0, 9.0, 0.1), (5, None, 7, 2.0, 9.0, 0.1)])
    same(relations.pairs.build(order_records.records(spark, d, CFG, False), CFG)["inparalogs"], relations.pairs.build(relations._sim(spark, d), CFG)["inparalogs"])


def test_arrays_come_back():
    columns = [np.array([-5, 0, 3, 2**40]), np.array([0, 255, 256, 70_000]), np.array([-1, -128, 5, 200]), np.array([0, 0, 0, 0])]
    for back, x in zip(order_records.unpack(order_records.pack(*columns)), columns, strict=True):
        assert back.tolist() == x.tolist()
    assert [len(x) for x in order_records.unpack(order_records.pack(*[np.zeros(0, np.int64)] * 2))] == [0, 0]


@pytest.mark.parametrize(("query", "rows"), [("inparalogs", 144), ("edge_union", 688)])
def test_queries_do_not_write_all_records(spark, monkeypatch, query, rows):
    monkeypatch.setattr(relations, "order_hits", lambda *a: pytest.fail("all hits are shuffled"))
    assert relations.QUERIES[query](spark, "/root/testdata/sf0.01").count() == rows


@pytest.mark.parametrize("few", [0, 1_000_000])
def test_coorthologs_with_and_without_hashes(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(relations.pairs, "FEW", few)
    d = lines(spark, tmp_path, 3)
    whole = relations.pairs.relations(relations._sim(spark, d), CFG)["coorthologs"]
    assert whole.count()
    same(relations.pairs.relations(order_records.records(spark, d, CFG, True), CFG)["coorthologs"], whole)


def test_gene_groups_are_those_of_all_records_which_are_not_written(spark, monkeypatch):
    d = "/root/testdata/sf0.01"
    whole = graphs.pipeline.from_similarities(relations._sim(spark, d), graphs.RunConfig(relations.CFG))["groups"].collect()
    monkeypatch.setattr(relations, "order_hits", lambda *a: pytest.fail("all hits are shuffled"))
    found = graphs.gene_groups(spark, d).collect()
    assert len(found) == 436 and sorted(found) == sorted(whole)
