from types import SimpleNamespace

import pytest

from kinweave import session


def test_no_folder_of_one_machine_on_a_cluster():
    class Settings(dict):
        def set(self, key, value):
            self[key] = value

    fake = SimpleNamespace(conf=Settings(), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session._base(fake)
    fake.conf["spark.checkpoint.dir"] = "hdfs://shared/x"
    assert session._base(fake) == "hdfs://shared/x"
    alone = SimpleNamespace(conf=Settings(), sparkContext=SimpleNamespace(master="local[4]"))
    assert session._base(alone).startswith("file:///") and session._base(alone) == session._base(alone)


def test_spent_tables_are_removed(spark):
    from pathlib import Path

    first = session.checkpointed(spark.range(50))
    where = Path(first._kinweave_path.removeprefix("file://"))
    assert where.exists() and "parquet" in first.inputFiles()[0]
    second = session.checkpointed(first.where("id > 9"), first)
    assert not where.exists() and second.count() == 40
    session.release(second)
    assert session.checkpointed(spark.range(0)).count() == 0
