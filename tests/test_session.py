"""Session helpers: sizing and the shared scratch folder."""

import pytest

from sluice.session import checkpoint_root, scratch_dir, sized_conf


def test_sized_conf_scales_with_the_shuffle():
    small = sized_conf(1 << 30)
    assert small["spark.sql.shuffle.partitions"] == "200"
    big = sized_conf(10 * (1 << 40))
    assert big["spark.sql.shuffle.partitions"] == str(10 * (1 << 40) // (256 << 20))
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 << 20)


def test_scratch_dirs_are_fresh_and_under_the_checkpoint_root(spark):
    root = checkpoint_root(spark)
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a != b and a.startswith(root.rstrip("/")) and b.startswith(root.rstrip("/"))


def test_no_local_fallback_off_local_masters(monkeypatch, spark):
    class Ctx:
        master = "yarn"

        @staticmethod
        def getConf():
            class C:
                @staticmethod
                def get(key, default=None):
                    return default
            return C

    class Conf:
        @staticmethod
        def get(key, default=None):
            return default

    class FakeSession:
        conf = Conf
        sparkContext = Ctx

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(FakeSession)


def test_one_scratch_folder_can_go_before_the_others(spark):
    from sluice import session
    before = session.scratch_folders()
    paths = [session.scratch_dir(spark, "gone") for _ in range(3)]
    for p in paths:
        spark.range(3).write.parquet(p)
    assert session.drop_scratch(spark, paths[0]) and not session.drop_scratch(spark, paths[0])
    assert session.scratch_folders() == [*before, *paths[1:]]
    session.release_scratch(spark, keep=[*before, paths[2]])
    assert spark.read.parquet(paths[2]).count() == 3 and session.scratch_folders() == [*before, paths[2]]
    session.drop_scratch(spark, paths[2])
