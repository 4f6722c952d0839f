from types import SimpleNamespace

import pytest

from strata import session
from tests.conftest import rows


class Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)

    def set(self, key, value):
        self[key] = value


def fake(master, **conf):
    return SimpleNamespace(
        conf=Conf({k.replace("_", "."): v for k, v in conf.items()}),
        sparkContext=SimpleNamespace(master=master),
    )


def test_scratch_folder_comes_from_the_session():
    shared = fake("spark://host:7077", spark_checkpoint_dir="hdfs://nn/scratch/")
    assert session.scratch_root(shared) == "hdfs://nn/scratch"
    first, second = session.scratch_path(shared, "x"), session.scratch_path(shared, "x")
    assert first != second and first.startswith("hdfs://nn/scratch/strata-x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(fake("spark://host:7077"))
    local = fake("local[2]")
    assert session.scratch_root(local) == session.scratch_root(local)


def test_cut_lineage_keeps_rows_and_types(spark):
    frame = spark.sql("SELECT id, CAST(id AS DECIMAL(10,2)) AS d, array(id) AS a FROM range(5)")
    cut = session.cut_lineage(frame)
    assert cut.schema.simpleString() == frame.schema.simpleString()
    assert rows(cut) == rows(frame)
    assert "Range" not in cut._jdf.queryExecution().executedPlan().toString()


def test_tune_sets_utc(spark):
    assert session.tune(spark).conf.get("spark.sql.session.timeZone") == "UTC"


def test_scratch_of_this_process_is_removed(spark, monkeypatch):
    monkeypatch.setattr(session, "_MADE", [])
    kept = session.cut_lineage(spark.range(3), "kept")
    path = session._MADE[0]
    assert kept.count() == 3 and path.startswith(session.scratch_root(spark))
    session.scratch_path(spark, "never-written")
    assert session.remove_scratch(spark) == 1 and session._MADE == []
    assert session.remove_scratch(spark) == 0
