import random

from pyspark.sql import functions as F

from kinweave.operators import intervals

SCHEMA = "a string, b string, s int, e int, _lo string, gap_start string"


def brute(rows):
    cover = {}
    for a, b, s, e, *_ in rows:
        if None not in (a, b, s, e):
            cover.setdefault((a, b), set()).update(range(min(s, e), max(s, e) + 1))
    gaps, periods = set(), set()
    for key, points in cover.items():
        points = sorted(points)
        start = points[0]
        for x, y in zip(points, points[1:]):
            if y > x + 1:
                gaps.add((*key, x + 1, y - 1))
                periods.add((*key, start, x))
                start = y
        periods.add((*key, start, points[-1]))
    return gaps, periods


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    gaps, periods = brute(rows)
    found = [tuple(r) for r in intervals.gaps(df, {k: F.col(k) for k in 'ab'}, F.col("s"), F.col("e")).collect()]
    assert len(found) == len(set(found)) and set(found) == gaps
    found = [tuple(r) for r in intervals.periods(df, {k: F.col(k) for k in 'ab'}, F.col("s"), F.col("e")).collect()]
    assert len(found) == len(set(found)) and set(found) == periods


def test_against_brute_force_with_hot_pairs_cut_into_blocks(spark):
    draw = random.Random(3)
    rows = []
    for _ in range(1500):
        pair = ("q", "s") if draw.random() < 0.4 else (f"q{draw.randrange(30)}", f"s{draw.randrange(4)}")
        at = draw.randrange(20_000 if pair == ("q", "s") else 300)
        rows.append((*pair, at, at + draw.randrange(-40, 40), "x", "y"))
    rows += [("q", "s", 5, 9000, "x", "y"), rows[0], rows[0]]  # one over many blocks; copies
    check(spark, rows)


def test_an_outlier_start_leaves_a_hot_entity_in_many_blocks(spark):
    draw = random.Random(8)
    rows = [("q", "s", at, at + draw.randrange(3), "x", "y") for at in (draw.randrange(5000) for _ in range(2000))]
    rows += [("q", "s", -(10**9), -(10**9) + 5, "x", "y")] + [("r", str(i), i, i, "x", "y") for i in range(600)]
    spans, hot = intervals._spans(spark.createDataFrame(rows, SCHEMA), {k: F.col(k) for k in "ab"}, F.col("s"), F.col("e"), 1 / 400)
    sizes = [r["count"] for r in spans.where("a = 'q'").groupBy("_block").count().collect()]
    assert len(hot) == 1 and len(sizes) > 200 and max(sizes) < 0.02 * sum(sizes)
    keys = {k: F.col(k) for k in "ab"}
    cover = {x for a, _, s, e, *_ in rows if a == "q" for x in range(s, e + 1)}
    found = {(r.period_start, r.period_end) for r in intervals.periods(spark.createDataFrame(rows, SCHEMA), keys, F.col("s"), F.col("e")).where("a = 'q'").collect()}
    assert found == {(x, next(y for y in range(x, x + 10**6) if y + 1 not in cover)) for x in cover if x - 1 not in cover}


def test_nulls_touching_reversed_nested(spark):
    rows = [
        ("p", "q", 1, 5, None, None), ("p", "q", 10, 6, None, None), ("p", "q", 12, 20, None, None), ("p", "q", 14, 15, None, None),
        ("p", "q", None, 40, None, None), ("p", "q", 50, None, None, None), (None, "q", 1, 9, None, None), ("r", "q", 7, 7, None, None),
    ]
    check(spark, rows)


def test_empty(spark):
    check(spark, [])
