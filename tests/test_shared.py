from types import SimpleNamespace

import pytest

from omnibus.sources.shared import shared_folder


def session(master, warehouse, named=None):
    settings, chosen = {"spark.checkpoint.dir": named, "spark.sql.warehouse.dir": warehouse}, []
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: chosen[0] if chosen else None, setCheckpointDir=chosen.append)
    conf = SimpleNamespace(get=lambda key, default=None: settings.get(key) or default)
    return SimpleNamespace(sparkContext=context, conf=conf)


def test_a_cluster_needs_a_folder_that_is_shared():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("spark://host:7077", "file:/data/spark-warehouse"))
    assert shared_folder(session("spark://host:7077", "hdfs://name/warehouse/")) == "hdfs://name/warehouse/_interim"
    assert shared_folder(session("spark://host:7077", "file:/data/spark-warehouse", "file:/shared/x")) == "file:/shared/x"
    assert shared_folder(session("local[4]", "file:/data/spark-warehouse")) == "file:/data/spark-warehouse/_interim"
