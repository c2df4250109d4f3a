from __future__ import annotations

from types import SimpleNamespace

import pytest

from gradeframe.session import shared_folder


def session(folder, master):
    conf = SimpleNamespace(get=lambda key, default: folder)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"))


def test_the_folder_that_the_cluster_names_is_used():
    assert shared_folder(session("hdfs://x/shared", "yarn")) == "hdfs://x/shared"


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[3,2,1024]"])
def test_a_cluster_without_one_is_an_error(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session(None, master))


def test_local_mode_makes_one_for_the_application():
    local = session(None, "local[2]")
    assert shared_folder(local) == shared_folder(local)
