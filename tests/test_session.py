"""The shared folder: an error without one on a cluster, commit markers, clean-up."""

from pathlib import Path
from types import SimpleNamespace

import pytest

from custlens import session


def fake(master):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: default),
        sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None),
    )


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://host", "local-cluster[2,1,1024]"])
def test_a_cluster_without_a_shared_folder_is_an_error(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(fake(master))


def test_staged_tables_are_read_back_and_cleaned_up(spark):
    staged = session.stage(spark.range(10), "numbers")
    assert staged.count() == 10
    folders = [p for p in session._made[spark.sparkContext.applicationId] if "/numbers-" in p]
    assert folders and all(Path(p.removeprefix("file:")).exists() for p in folders)
    session.clean_up(spark)
    assert not any(Path(p.removeprefix("file:")).exists() for p in folders)


def test_no_commit_marker_is_an_error(spark):
    key = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    conf = spark._jsc.hadoopConfiguration()
    conf.set(key, "false")
    try:
        with pytest.raises(OSError, match="no finished table"):
            session.stage(spark.range(3), "unmarked")
    finally:
        conf.unset(key)
