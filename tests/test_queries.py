"""Every query with SQL gives the same rows as the SQL, on the smallest tables."""

import datetime
from pathlib import Path

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables here")


def fixed(v):
    if isinstance(v, float):
        return round(v, 5) + 0.0
    return v.isoformat() if isinstance(v, datetime.datetime) else v


@pytest.fixture(scope="module")
def tables():
    import duckdb

    con = duckdb.connect()
    for t in entry.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def test_sql_has_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", [n for n in entry.oracle_sql()])
def test_query(spark, tables, name):
    df = entry.queries()[name](spark, DATA)
    cur = tables.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(repr([fixed(r[names.index(c)]) for c in sorted(names)]) for r in cur.fetchall())
    got = sorted(repr([fixed(r[c]) for c in sorted(names)]) for r in df.collect())
    assert got == want


@pytest.mark.parametrize("name", ["flow_clusters", "flow_hierarchy", "keep_flow_clusters", "sub_cluster", "gene_groups"])
def test_query_without_sql_runs(spark, name):
    assert entry.queries()[name](spark, DATA).count() >= 0


def test_gene_groups_keeps_what_the_flow_keeps_by_default(spark, monkeypatch):
    from kinweave.config import FlowConfig
    from kinweave.plans import graphs

    seen = []
    monkeypatch.setattr(graphs.pipeline, "from_similarities", lambda sim, cfg: seen.append(cfg.flow) or {"groups": sim})
    entry.queries()["gene_groups"](spark, DATA)
    assert [(c.prune, c.select, c.recover) for c in seen] == [(c.prune, c.select, c.recover) for c in (FlowConfig(),)]
