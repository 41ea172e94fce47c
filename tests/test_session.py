"""Session helpers: shuffle sizing and the shared checkpoint folder."""

from marketlake.session import ensure_checkpoint_dir, scale_conf


def test_scale_conf_sizes_from_shuffle_bytes():
    conf = scale_conf(35 * 10**12)
    assert int(conf["spark.sql.shuffle.partitions"]) == -(-35 * 10**12 // (256 << 20))
    assert conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == \
        conf["spark.sql.shuffle.partitions"]
    assert scale_conf(1)["spark.sql.shuffle.partitions"] == "16"


def test_checkpoint_dir_prefers_the_cluster_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    got = ensure_checkpoint_dir(spark)
    if configured:
        assert got == configured
    assert spark.sparkContext.getCheckpointDir() is not None
    assert ensure_checkpoint_dir(spark) == got          # stable, nothing reconfigured


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        assert key == "spark.checkpoint.dir"
        return self.value if self.value is not None else default

    def set(self, key, value):  # a core config: must never be changed at run time
        raise AssertionError("spark.checkpoint.dir must not be set at run time")


class _Context:
    def __init__(self, master="local[2]"):
        self.dir = None
        self.master = master

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, value, master="local[2]"):
        self.conf = _Conf(value)
        self.sparkContext = _Context(master)


def test_checkpoint_dir_unset_uses_private_folder_without_touching_conf():
    s = _Session(None)
    got = ensure_checkpoint_dir(s)
    assert got and s.sparkContext.dir == got
    assert ensure_checkpoint_dir(s) == got


def test_checkpoint_dir_set_is_registered():
    s = _Session("/shared/ckpt")
    assert ensure_checkpoint_dir(s) == "/shared/ckpt" and s.sparkContext.dir == "/shared/ckpt"


def test_checkpoint_dir_unset_on_a_cluster_is_an_error():
    import pytest
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(_Session(None, master="yarn"))
    assert ensure_checkpoint_dir(_Session("/shared/ckpt", master="yarn")) == "/shared/ckpt"
