import pytest

from sitegauge.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default


class _Ctx:
    def __init__(self, master):
        self.master, self.dir = master, None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, master, configured=None):
        self.sparkContext, self.conf = _Ctx(master), _Conf(configured)


def test_cluster_without_checkpoint_dir_refuses_local_folder():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Session("yarn"))


def test_configured_checkpoint_dir_is_used():
    s = _Session("yarn", "hdfs://nn/shared/ckpt")
    assert ensure_checkpoint_dir(s) == "hdfs://nn/shared/ckpt"


def test_local_master_gets_a_scratch_folder():
    s = _Session("local[2]")
    assert ensure_checkpoint_dir(s).startswith("/")


def test_concurrently_keeps_order_and_raises(spark):
    from sitegauge.session import concurrently
    spark.sparkContext.setJobGroup("grp", "test group")
    assert concurrently(lambda: spark.range(5).count(), lambda: 7) == [5, 7]
    with pytest.raises(ValueError):
        concurrently(lambda: 1, lambda: (_ for _ in ()).throw(ValueError("boom")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
