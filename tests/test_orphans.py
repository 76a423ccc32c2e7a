import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from kinweave.operators.orphans import Entity, Reference, cascade, report

T0 = datetime(2024, 1, 1)


def found(df):
    rows = [(r.table, r.row, r.field, r.kind, r.depth) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_cascade_down_a_chain_and_a_self_reference(spark):
    top = spark.createDataFrame([("t1",)], "id string")
    mid = spark.createDataFrame([("m1", "t1", None), ("m2", "gone", None), ("m3", None, "m2"), ("m4", "t1", "m3"), ("m5", "t1", "nowhere")], "id string, top string, up string")
    low = spark.createDataFrame([(1, "m1"), (2, "m2"), (3, "m4"), (4, "zzz"), (5, None), (4, "zzz")], "id bigint, mid string")
    at = F.lit(T0)
    tables = {"top": Entity(top, F.col("id"), at), "mid": Entity(mid, F.col("id"), at), "low": Entity(low, F.col("id").cast("string"), at)}
    refs = [Reference("mid", "top", F.col("top"), "top", F.col("id")), Reference("mid", "up", F.col("up"), "mid", F.col("id")), Reference("low", "mid", F.col("mid"), "mid", F.col("id"))]
    out = cascade(tables, refs)
    assert found(out) == {
        ("mid", "m2", "top", "direct", 0), ("mid", "m5", "up", "direct", 0), ("low", "4", "mid", "direct", 0),
        ("mid", "m3", "up", "inherited", 1), ("low", "2", "mid", "inherited", 1), ("mid", "m4", "up", "inherited", 2), ("low", "3", "mid", "inherited", 3),
    }
    counts = {(r.table_name, r.ref_field): (r.direct_orphans, r.inherited_orphans) for r in report(out).collect()}
    assert counts == {("mid", "top"): (1, 0), ("mid", "up"): (1, 2), ("low", "mid"): (1, 2)}


def test_validity_against_brute_force_with_hot_keys(spark):
    draw = random.Random(5)
    day = lambda: T0 + timedelta(days=draw.randrange(400), hours=draw.randrange(24))
    genes = []
    for _ in range(300):
        since = day()
        until = None if draw.random() < 0.3 else since + timedelta(days=draw.randrange(-5, 60))
        genes.append((f"g{draw.choice([0] * 20 + list(range(40)))}", since, until))
    genes += [genes[0], (None, T0, None)]
    records = [(i, draw.choice(["g1"] * 30 + [f"g{k}" for k in range(45)] + [None]), day()) for i in range(800)]
    records += records[:20] + [(9999, "g1", None)]
    tables = {"genes": Entity(spark.createDataFrame(genes, "id string, since timestamp, until timestamp"), F.concat_ws("|", "id", "since"), F.col("since")), "records": Entity(spark.createDataFrame(records, "n bigint, id string, at timestamp"), F.col("n").cast("string"), F.col("at"))}
    refs = [Reference("records", "id", F.col("id"), "genes", F.col("id"), F.col("since"), F.col("until"))]
    want = {str(n) for n, k, at in records if k and not any(g == k and at and s <= at and (u is None or u > at) for g, s, u in genes)}
    out = cascade(tables, refs)
    assert {row for _, row, _, kind, _ in found(out) if kind == "direct"} == want


def test_a_parent_row_without_a_start_is_never_valid(spark):
    genes = spark.createDataFrame([("a", None, None), ("b", T0, None)], "id string, since timestamp, until timestamp")
    records = spark.createDataFrame([(1, "a"), (2, "b")], "n bigint, id string")
    tables = {"genes": Entity(genes, F.col("id"), F.col("since")), "records": Entity(records, F.col("n").cast("string"), F.lit(T0))}
    out = cascade(tables, [Reference("records", "id", F.col("id"), "genes", F.col("id"), F.col("since"), F.col("until"))])
    assert found(out) == {("records", "1", "id", "direct", 0)}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "id string")
    some = spark.createDataFrame([("a",), (None,)], "id string")
    entity = lambda df: Entity(df, F.coalesce("id", F.lit("-")), F.lit(T0))
    ref = [Reference("c", "id", F.col("id"), "p", F.col("id"))]
    assert found(cascade({"p": entity(none), "c": entity(some)}, ref)) == {("c", "a", "id", "direct", 0)}
    assert found(cascade({"p": entity(some), "c": entity(none)}, ref)) == set()
