import random
from itertools import groupby

from pyspark.sql import functions as F

from kinweave.operators import chunked

SCHEMA = "id bigint, k string, v string, x double, _chunk string"


def results(spark, rows, chunk):
    df = spark.createDataFrame(rows, SCHEMA)
    once = chunked.distinct_rows(df, F.col("id"), {c: F.col(c) for c in ("k", "v", "x")})
    out = chunked.key_results(once, "k", "v", F.col("x"), chunk)
    return {r.key_value: (r.n_records, r.first_row, r.last_row, r.best, r.longest_streak) for r in out.collect()}, {r.key_value: (r.n_records, r.n_chunks) for r in chunked.key_counts(once, "k", chunk).collect()}


def brute(rows):
    out = {}
    for r in sorted(set(rows)):
        if r[1] is not None:
            out.setdefault(r[1], []).append(r)
    return {k: (len(v), v[0][0], v[-1][0], min((r[3] for r in v if r[3] is not None), default=None), max(len(list(g)) for _, g in groupby(r[2] for r in v))) for k, v in out.items()}


def test_chunks_of_any_size_give_the_same_results(spark):
    draw = random.Random(2)
    rows = [(i * 3, draw.choice(["hot"] * 10 + ["a", "b", "c", None]), draw.choice(["x", "x", "y", None]), draw.choice([None, draw.random()]), "z") for i in range(700)]
    rows += rows[:100]
    want = brute(rows)
    for chunk in (1, 7, 50, 10_000, None):
        got, counts = results(spark, rows, chunk)
        assert got == want
        assert {k: n for k, (n, _) in counts.items()} == {k: v[0] for k, v in want.items()}
        if chunk:
            assert all(c == -(-n // chunk) for n, c in counts.values())


def test_empty_and_null_keys(spark):
    assert results(spark, [], 3) == ({}, {})
    assert results(spark, [(1, None, None, None, None)], 3) == ({}, {})
