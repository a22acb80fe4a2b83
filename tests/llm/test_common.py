from pathlib import Path
from types import SimpleNamespace

import pytest

import tabscope as ts
from tabscope.llm import common


def session(master, folder=None):
    settings = {"spark.checkpoint.dir": folder} if folder else {}
    conf = SimpleNamespace(get=lambda k, d=None: settings.get(k, d), set=settings.__setitem__)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, _conf=conf)), settings


@pytest.mark.parametrize("master", ["yarn", "k8s://host", "spark://a:7077", "local-cluster[3,2,1000]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(ts.AnalysisError) as error:
        common.shared_folder(session(master)[0])
    assert error.value.code == "no_shared_folder"
    assert common.shared_folder(session(master, "hdfs://x/y/")[0]).startswith("hdfs://x/y/tabscope-")


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]", "local[4,2]"])
def test_one_process_makes_its_own(master):
    spark, settings = session(master)
    assert common.shared_folder(spark).startswith(settings["spark.checkpoint.dir"]) and settings["spark.checkpoint.dir"].startswith("file:///")


def test_discard_removes_the_folder_of_a_stored_frame_alone(spark, tmp_path):
    frame = common.stored(spark.range(10).repartition(3))
    assert frame.count() == 10
    (folder,) = {Path(f.removeprefix("file:")).parent for f in frame.inputFiles()}
    assert folder.is_dir() and folder.parent.is_dir()
    common.discard(frame)
    assert not folder.exists() and folder.parent.is_dir()
    spark.range(3).write.parquet(str(tmp_path / "other"))
    common.discard(spark.read.parquet(str(tmp_path / "other")))
    assert spark.read.parquet(str(tmp_path / "other")).count() == 3
