from datetime import datetime, timedelta

from kinweave.streaming import hits

T0 = datetime(2024, 1, 1)
SCHEMA = "acc_id bigint, query_id string, subject_id string, total_length int, evalue_exp int, loaded_at timestamp_ntz"


def rows():
    some = [(i, f"q{i % 3}", "s", 10 + i, -i, T0 + timedelta(hours=i)) for i in range(12)]
    return some + some[:5] + [some[0]] * 4 + [(99, None, "s", None, None, T0)]


def streamed(spark, tmp_path, **how):
    spark.createDataFrame(rows(), SCHEMA).repartition(3).write.parquet(str(tmp_path / "t.parquet"))
    return hits.once(hits.source(spark, str(tmp_path), "t", 1), "acc_id", **how)


def test_copies_in_a_stream_count_once(spark, tmp_path):
    got = {(r.query_id, r.subject_id): (r.hits, r.aligned, r.best_exp) for r in hits.drain(hits.pair_totals(streamed(spark, tmp_path))).collect()}
    want = {(q, "s"): [r for r in set(rows()) if r[1] == q] for q in ("q0", "q1", "q2", None)}
    assert got == {k: (len(v), sum(r[3] for r in v) if k[0] else None, min(r[4] for r in v) if k[0] else None) for k, v in want.items()}


def test_copies_within_a_span_of_time(spark, tmp_path):
    got = [r.acc_id for r in hits.drain(streamed(spark, tmp_path, at="loaded_at"), "append").collect()]
    assert sorted(got) == [*range(12), 99]
