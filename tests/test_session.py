"""The shared folder: read from the session, replaced only on a single machine."""

import pytest

from deltaq import session as S


class Conf(dict):
    def set(self, key, value):
        self[key] = value


class FakeContext:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class FakeSession:
    def __init__(self, master, **conf):
        self.sparkContext, self.conf = FakeContext(master), Conf(conf)


def test_a_cluster_without_a_shared_folder_is_an_error():
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(ValueError):
            S.work_dir(FakeSession(master), "x")


def test_the_given_folder_is_used_on_any_file_system():
    s = FakeSession("yarn", **{S.CHECKPOINT_CONF: "/user/me/ckpt"})
    assert S.work_dir(s, "job").startswith("/user/me/ckpt/deltaq/app/job-")


def test_a_single_machine_gets_a_temporary_folder():
    s = FakeSession("local[4]")
    assert S.work_dir(s, "job").startswith(s.conf[S.CHECKPOINT_CONF])


def test_work_folders_are_retired_together(spark):
    from deltaq.sources.storage import exists

    class Other:
        """The same session under another application id, so that its folders stand alone."""
        sparkContext = spark.sparkContext
        conf = Conf({S.CHECKPOINT_CONF: S.ensure_checkpoint_dir(spark), "spark.app.id": "retired"})

    path = S.work_dir(Other, "job")
    spark.range(3).write.parquet(path)
    assert exists(spark, path)
    S.retire_work(Other)
    assert not exists(spark, path)
