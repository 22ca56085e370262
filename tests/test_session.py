"""Settings that depend on where the session runs."""

from types import SimpleNamespace

import pytest

from lodestone.session import shared_folder, tune


class Conf(dict):
    def set(self, key, value):
        self[key] = value


def session(master, parallelism=8, core=None, **conf):
    conf = Conf({"spark.sql.shuffle.partitions": "200", **{k.replace("__", "."): v for k, v in conf.items()}})
    context = SimpleNamespace(master=master, defaultParallelism=parallelism, getConf=lambda: core or {})
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_local_session_keeps_its_partitions():
    assert tune(session("local[8]")).conf["spark.sql.shuffle.partitions"] == "200"


def test_cluster_gets_partitions_for_the_cores_it_may_grow_to():
    core = {"spark.dynamicAllocation.maxExecutors": "1000", "spark.executor.cores": "4"}
    assert tune(session("yarn", core=core)).conf["spark.sql.shuffle.partitions"] == "16000"
    assert tune(session("yarn", parallelism=100)).conf["spark.sql.shuffle.partitions"] == "400"
    own = session("yarn", parallelism=100, spark__sql__shuffle__partitions="5000")
    assert tune(own).conf["spark.sql.shuffle.partitions"] == "5000"


def test_shared_folder_is_the_one_the_cluster_names():
    named = session("yarn", spark__checkpoint__dir="hdfs:///shared/")
    first, second = shared_folder(named, "delivery"), shared_folder(named, "delivery")
    assert first.startswith("hdfs:///shared/delivery-") and first != second
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn"), "delivery")
    assert "delivery-" in shared_folder(session("local[2]"), "delivery")
