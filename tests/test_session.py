"""Scratch folders and cluster settings."""

import types

import pytest

from tallymart import session


class FakeConf(dict):
    def set(self, key, value):
        self[key] = value


def fake(master, **conf):
    context = types.SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda p: None)
    return types.SimpleNamespace(sparkContext=context, conf=FakeConf(conf))


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://https://host", "local-cluster[3,2,1024]"])
def test_a_cluster_without_a_shared_folder_is_an_error(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(fake(master))
    assert session.ensure_checkpoint_dir(fake(master, **{session.CHECKPOINT_CONF: "s3://b/ckpt"})) == "s3://b/ckpt"


def test_a_local_session_gets_a_folder():
    for master in ("local", "local[4]", "local[*]"):
        assert "tallymart-ckpt-" in session.ensure_checkpoint_dir(fake(master))


def test_scratch_tables_can_be_dropped(spark):
    df = spark.range(3)
    session.materialize(df, "drop-me", unique=False)
    path = session.scratch_path(spark, "drop-me", unique=False)
    assert spark.read.parquet(path).count() == 3
    session.drop_scratch(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError):
        session.drop_scratch(spark, "/somewhere/else")


def test_reducers_stay_in_bounds():
    small = session.scale_conf(1 << 20, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    large = session.scale_conf(100 << 40, 8000)
    assert int(large["spark.sql.shuffle.partitions"]) == session.MAX_REDUCERS
    assert int(large["spark.sql.files.maxPartitionBytes"]) * 4 * session.MAX_REDUCERS >= 100 << 40


def test_input_bytes(spark, tmp_dir):
    with open(f"{tmp_dir}/a.txt", "w") as f:
        f.write("x" * 1234)
    assert session.input_bytes(spark, tmp_dir) == 1234
