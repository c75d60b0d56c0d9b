from types import SimpleNamespace

import pytest

from newsloom.scratch import child_names, remove, scratch_root, touch


def session(master, checkpoint=None, other=None):
    settings = {"spark.sql.warehouse.dir": "/w/house/"} | ({"spark.checkpoint.dir": checkpoint} if checkpoint else {})
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: other)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: settings.get(k, d)), sparkContext=context)


def test_a_cluster_needs_a_shared_folder():
    assert scratch_root(session("spark://x:1", "/shared/")) == "/shared"
    assert scratch_root(session("yarn", None, "/other")) == "/other"
    assert scratch_root(session("local[4]")) == "/w/house-scratch"
    with pytest.raises(ValueError):
        scratch_root(session("yarn"))


def test_marks(spark, tmp_path):
    folder = str(tmp_path / "marks")
    assert child_names(spark, folder) == []
    touch(spark, f"{folder}/b")
    touch(spark, f"{folder}/a")
    assert child_names(spark, folder) == ["a", "b"]
    remove(spark, f"{folder}/a")
    assert child_names(spark, folder) == ["b"]
