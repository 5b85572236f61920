"""Where intermediate tables go."""

import os

import pytest

from starflow.session import scratch, scratch_path, stage, together


class Session:
    def __init__(self, **settings):
        self.settings = {k.replace("__", "."): v for k, v in settings.items()}

    @property
    def conf(self):
        return self

    def get(self, name, default=None):
        return self.settings.get(name, default)


def test_shared_folder_is_used():
    path = scratch_path(Session(spark__checkpoint__dir="s3a://bucket/x/"), "t")
    assert path.startswith("s3a://bucket/x/starflow/t-")


def test_else_the_warehouse_folder():
    path = scratch_path(Session(spark__sql__warehouse__dir="hdfs:/wh"), "t")
    assert path.startswith("hdfs:/wh/starflow/t-")


def test_some_shared_folder_is_needed():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(Session(), "t")


@pytest.mark.parametrize("master, allowed", [("local[8]", True), ("local", True), ("local-cluster[2,1,1024]", False), ("yarn", False)])
def test_a_folder_of_the_drivers_machine_is_no_shared_one(master, allowed):
    session = Session(spark__sql__warehouse__dir="file:/root/spark-warehouse")
    session.sparkContext = type("Context", (), {"master": master})
    if allowed:
        assert scratch_path(session, "t").startswith("file:/root/spark-warehouse/starflow/t-")
    else:
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            scratch_path(session, "t")


def test_scratch_is_removed(spark):
    with scratch(spark):
        inside, = together(spark, lambda: stage(spark.range(3), "t"))
        path = inside.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
        assert os.path.isdir(path) and inside.count() == 3
    assert not os.path.exists(path)
    outside = stage(spark.range(3), "t")
    assert outside.count() == 3


def test_stage_keeps_rows_and_types(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    stored = stage(df, "t")
    assert stored.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(tuple, stored.collect())) == [(1, None), (2, "x")]
    base = spark.conf.get("spark.checkpoint.dir")
    assert all(base in f for f in stored.inputFiles())
