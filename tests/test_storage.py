from types import SimpleNamespace

import pytest

from seqloom import storage


def session(master, named=None, checkpoint=None):
    context = SimpleNamespace(
        master=master, applicationId=f"app-{master}", getCheckpointDir=lambda: checkpoint
    )
    conf = SimpleNamespace(get=lambda key, default: named)
    return SimpleNamespace(sparkContext=context, conf=conf)


def test_the_named_folder_is_used():
    assert storage.scratch_root(session("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert storage.scratch_root(session("yarn", None, "hdfs:///c")) == "hdfs:///c"


def test_only_a_local_session_may_name_none():
    local = session("local[2]")
    assert storage.scratch_root(local) == storage.scratch_root(local)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.scratch_root(session("yarn"))


def test_stage_reads_back_what_it_wrote(spark):
    df = spark.range(10).selectExpr("id", "id % 3 as part", "array(id) as items")
    staged = storage.stage(df, "t", partition_by=("part",))
    assert staged.schema.names and sorted(staged.select(*df.columns).collect()) == sorted(
        df.collect()
    )
    assert storage.stage(df.filter("id < 0"), "empty").isEmpty()


def test_clear_scratch_removes_what_was_staged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "scratch_root", lambda _: str(tmp_path))
    storage.stage(spark.range(3), "t")
    assert list(tmp_path.rglob("*.parquet"))
    storage.clear_scratch(spark)
    assert not list(tmp_path.rglob("*.parquet"))
