"""The shared folder: taken from the session, a scratch folder only when unset."""

import os

from cdcmart.session import scratch_path, shared_dir


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default


class _Context:
    def __init__(self, current, configured):
        self.current, self.configured = current, configured

    def getCheckpointDir(self):
        return self.current

    def getConf(self):
        return _Conf(self.configured)

    def setCheckpointDir(self, path):
        self.current = "file:" + path


class _Session:
    def __init__(self, current=None, configured=None):
        self.sparkContext = _Context(current, configured)


def test_uses_the_session_checkpoint_dir():
    assert shared_dir(_Session(current="hdfs://nn/shared/ckpt")) == "hdfs://nn/shared/ckpt"
    assert shared_dir(_Session(configured="/mnt/shared/ckpt")) == "file:/mnt/shared/ckpt"


def test_scratch_folder_only_when_unset():
    s = _Session()
    path = shared_dir(s)
    assert path.startswith("file:") and os.path.isdir(path[len("file:"):])
    a, b = scratch_path(s, "lake"), scratch_path(s, "lake")
    assert a != b and a.startswith(path)
