from types import SimpleNamespace

import pytest

from tablepact.llm.shared import shared_folder


def session(master, folder=None):
    held = []
    context = SimpleNamespace(
        master=master,
        getConf=lambda: {"spark.checkpoint.dir": folder},
        getCheckpointDir=lambda: held[-1] if held else None,
        setCheckpointDir=held.append,
    )
    return SimpleNamespace(sparkContext=context)


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://host", "local-cluster[2,1,1024]"])
def test_a_cluster_must_name_its_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session(master))
    assert shared_folder(session(master, "s3a://shared")) == "s3a://shared"


@pytest.mark.parametrize("master", ["local", "local[*]", "local[8]"])
def test_a_local_session_gets_a_folder(master):
    assert "checkpoint-" in shared_folder(session(master))
