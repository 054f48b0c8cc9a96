"""The shared folder comes from spark.checkpoint.dir; a local temp folder is
only chosen under a local master; a cluster without the setting is refused."""

import pytest

from docshred.session import scratch_path, shared_dir


class _Opt:
    def __init__(self, v):
        self.v = v

    def isDefined(self):
        return self.v is not None

    def get(self):
        return self.v


class _Fake:
    def __init__(self, conf_dir, master, ctx_dir=None):
        self._conf = {"spark.checkpoint.dir": conf_dir} if conf_dir else {}
        outer = self

        class Conf:
            def get(self, k, default=None):
                return outer._conf.get(k, default)

            def set(self, k, v):
                outer._conf[k] = v

        class Sc:
            def __init__(self):
                self.master = master
                self.set_to = None
                sc_self = self

                class J:
                    def sc(self):
                        class S:
                            def getCheckpointDir(self):
                                return _Opt(ctx_dir)
                        return S()
                self._jsc = J()
                self.setCheckpointDir = lambda d: setattr(sc_self, "set_to", d)

        self.conf = Conf()
        self.sparkContext = Sc()


def test_reads_the_session_setting():
    assert shared_dir(_Fake("hdfs://nn/ckpt/", "yarn")) == "hdfs://nn/ckpt"
    assert shared_dir(_Fake(None, "yarn", ctx_dir="s3a://b/ck")) == "s3a://b/ck"


def test_cluster_without_setting_is_refused():
    with pytest.raises(RuntimeError):
        shared_dir(_Fake(None, "spark://master:7077"))


def test_local_master_gets_its_own_folder():
    fake = _Fake(None, "local[4]")
    d = shared_dir(fake)
    assert fake.sparkContext.set_to == d and fake.conf.get("spark.checkpoint.dir") == d
    assert scratch_path(fake, "x").startswith(d + "/x-")
