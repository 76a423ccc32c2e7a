import random

import pyarrow.parquet as pq

from kinweave.llm import topn

SCHEMA = "g string, h string, e int, m double, s string, id bigint, rank string"


def run(spark, rows, n=3):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted((r.g, r.h, r["rank"], r.id) for r in topn.top_n(df, n, ["g", "h"], ["e", "m"], ["s", "id"]).collect())


def brute(rows, n=3):
    groups = {}
    for r in set(rows):
        if None not in r[:6]:
            groups.setdefault(r[:2], []).append((r[2], r[3], r[4], r[5]))
    return sorted((*g, i + 1, v[3]) for g, rs in groups.items() for i, v in enumerate(sorted(rs)[:n]))


def make(seed, size):
    draw = random.Random(seed)
    rows = []
    for i in range(size):
        hot = draw.random() < 0.4
        rows.append(("hot" if hot else f"g{draw.randrange(40)}", draw.choice(["t", "u", None]) if not hot else "t", draw.choice([-5, -4, -3, None]), draw.choice([1.0, 2.0, None]), draw.choice(["a", "b"]), i, "x"))
    return rows + rows[: size // 4] + [rows[1]] * size  # many copies of one row


def test_against_brute_force_with_ties_copies_and_nulls(spark):
    rows = make(1, 900)
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, 1) == brute(rows, 1)


def test_row_groups_below_the_nth_score_are_skipped(spark, monkeypatch):
    monkeypatch.setattr(topn, "ROW_GROUP", 50)
    rows = [("hot", "t", i % 200, 1.0, "s", i, "x") for i in range(20_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    path = topn.cluster(df.select("g", "h", "e", "m", "s", "id"), ["g", "h"], ["e", "m"], ["s", "id"])
    files = sorted(spark.read.parquet(path).inputFiles())
    blocks = sum(pq.ParquetFile(f.removeprefix("file://")).num_row_groups for f in files)
    assert blocks > 100
    read = []
    real = pq.ParquetFile.read_row_group
    monkeypatch.setattr(pq.ParquetFile, "read_row_group", lambda self, i, *a, **k: read.append(i) or real(self, i, *a, **k))
    import pyarrow as pa

    reader = topn._reader(files, 3, ["g", "h"], ["e", "m"])
    kept = sum(b.num_rows for b in reader([pa.RecordBatch.from_pydict({"id": list(range(len(files)))})]))
    assert kept >= 3 and len(read) < blocks / 4
    assert run(spark, rows) == brute(rows)


def test_many_copies_of_one_row_lie_in_many_files(spark, monkeypatch):
    rows = [("hot", "t", -5, 1.0, "s", 7, "x")] * 3000 + [(f"g{i}", "t", -5, 1.0, "s", 100 + i, "x") for i in range(900)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(40)
    path = topn.cluster(df.select("g", "h", "e", "m", "s", "id"), ["g", "h"], ["e", "m"], ["s", "id"])
    copies = spark.read.parquet(path).where("g = 'hot'")
    assert 10 < copies.select("_salt").distinct().count() == copies.count() <= topn.SALTS
    assert sorted((r.g, r.h, r["rank"], r.id) for r in topn.top_n(df, 3, ["g", "h"], ["e", "m"], ["s", "id"]).collect()) == brute(rows)


def test_stores(spark, monkeypatch):
    assert [topn.arrow_uri(p) for p in ("file:///a/b", "s3a://bucket/x", "/a/b", "odd://x")] == ["file:///a/b", "s3://bucket/x", "/a/b", None]
    rows = make(2, 300)
    monkeypatch.setattr(topn, "arrow_uri", lambda p: None)
    assert run(spark, rows) == brute(rows)


def test_empty_and_incomplete(spark):
    assert run(spark, []) == []
    assert run(spark, [("g", None, 1, 1.0, "s", 1, "x")]) == []
