"""The shared work folder, and the size of settled frames."""

from types import SimpleNamespace

import pytest

from tallyloom.session import settle, shared_folder


def session(master, checkpoint, warehouse):
    settings = {"spark.checkpoint.dir": checkpoint, "spark.sql.warehouse.dir": warehouse}
    conf = SimpleNamespace(get=lambda key, default=None: settings.get(key) or default, set=settings.__setitem__)
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda path: None)
    return SimpleNamespace(conf=conf, sparkContext=context)


@pytest.mark.parametrize("warehouse", ["file:/home/driver/spark-warehouse", "file:///tmp/w"])
def test_a_local_work_folder_is_refused_on_a_cluster(warehouse):
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(session(master, None, warehouse))
        assert shared_folder(session(master, "hdfs:///work", warehouse)) == "hdfs:///work"
    assert shared_folder(session("local[8]", None, warehouse)) == f"{warehouse}/_work"
    assert shared_folder(session("yarn", None, "hdfs:///warehouse/")) == "hdfs:///warehouse/_work"


def test_settled_frames_have_no_more_partitions_than_their_rows_fill(spark):
    rows = spark.range(1_000).repartition(40)
    small = settle(rows, 1_000)
    assert small.rdd.getNumPartitions() == 8 and sorted(r.id for r in small.collect()) == list(range(1_000))
    assert settle(rows, 1_000_000).rdd.getNumPartitions() == 20
    assert settle(rows).rdd.getNumPartitions() == 40
