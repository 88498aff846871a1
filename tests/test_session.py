from types import SimpleNamespace

import pytest

from medalstar.session import LAUNCH_SETTINGS, SETTINGS, configure, new_shared_folder, shared_dir, size_for


class Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


def session(master, conf=None, current=None):
    state = {"dir": current}
    context = SimpleNamespace(
        master=master, getCheckpointDir=lambda: state["dir"], setCheckpointDir=lambda d: state.update(dir=d)
    )
    return SimpleNamespace(sparkContext=context, conf=Conf(conf or {})), state


def test_the_configured_folder_is_used():
    spark, state = session("spark://host:7077", {"spark.checkpoint.dir": "hdfs:///shared"})
    assert shared_dir(spark) == "hdfs:///shared"
    assert state["dir"] == "hdfs:///shared"


def test_an_existing_checkpoint_folder_stays():
    spark, state = session("yarn", current="hdfs:///already")
    assert shared_dir(spark) == "hdfs:///already"
    assert state["dir"] == "hdfs:///already"


def test_a_cluster_without_a_shared_folder_is_an_error():
    spark, _ = session("yarn")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(spark)


def test_only_local_sessions_fall_back_to_a_temporary_folder():
    spark, state = session("local[4]")
    assert shared_dir(spark) == state["dir"]


def test_new_folders_differ():
    spark, _ = session("yarn", {"spark.checkpoint.dir": "s3a://bucket/tmp/"})
    first, second = new_shared_folder(spark, "x"), new_shared_folder(spark, "x")
    assert first != second and first.startswith("s3a://bucket/tmp/x-")


def test_configure_sets_every_setting(spark):
    configure(spark)
    assert all(spark.conf.get(key) == value for key, value in SETTINGS.items())
    assert all(spark.sparkContext.getConf().get(key) == value for key, value in LAUNCH_SETTINGS.items())


def test_partitions_follow_the_size_of_the_shuffle(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_for(spark, 0) == int(before)
        assert size_for(spark, 192 * 1024**3) == 1024
        assert size_for(spark, 100 * 1024**4) == 50_000
        assert spark.conf.get("spark.sql.shuffle.partitions") == "50000"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
