import pytest

from millrace import scratch_path
from millrace import session as session_module
from millrace.session import SESSION_DEFAULTS, scratch_root, shuffle_partitions


class FakeSession:
    class Conf(dict):
        def set(self, key, value):
            self[key] = value

    def __init__(self, **conf):
        self.conf = self.Conf({k.replace("__", "."): v for k, v in conf.items()})


def test_scratch_is_where_the_cluster_says():
    assert scratch_root(FakeSession(spark__checkpoint__dir="hdfs:///shared/")) == "hdfs:///shared"


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(FakeSession(spark__master="yarn"))


def test_a_local_session_gets_a_folder_once(monkeypatch):
    removed = []
    monkeypatch.setattr(session_module, "delete_on_exit", lambda spark, path: removed.append(path))
    session = FakeSession(spark__master="local[2]")
    session.sparkContext = type("Context", (), {"applicationId": "local-x"})
    root = scratch_root(session)
    assert scratch_root(session) == root and removed == [root]
    assert "spark.checkpoint.dir" not in session.conf


def test_paths_are_new_each_time(spark):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    root = scratch_root(spark)
    assert first != second and first.startswith(f"{root}/millrace/x-")


def test_defaults_leave_the_cluster_alone():
    assert not [k for k in SESSION_DEFAULTS if "master" in k or "memory" in k or "cores" in k]


def test_shuffle_partitions_grow_with_the_data():
    assert shuffle_partitions(0) == 200
    assert shuffle_partitions(100 * 2**40) == 819_200
