"""Shared folders and temporary tables."""

import os
from types import SimpleNamespace

import pytest

from tests.conftest import SF001
from tillroll import session


class FakeSession:
    """Only what ``ensure_checkpoint_dir`` asks a session for."""

    def __init__(self, master, folder=None):
        self.conf = SimpleNamespace(get=lambda key, default=None: folder, set=lambda key, value: None)
        self.sparkContext = SimpleNamespace(master=master, getCheckpointDir=lambda: "set", setCheckpointDir=lambda p: None)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://x", "local-cluster[3,2,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(FakeSession(master))
    assert session.ensure_checkpoint_dir(FakeSession(master, "/shared/x")) == "/shared/x"


def test_one_machine_gets_a_scratch_folder():
    assert os.path.isdir(session.ensure_checkpoint_dir(FakeSession("local[2]")))


def test_no_temporary_table_is_left(spark):
    import __spark_entry__ as entry
    assert entry.queries()["roc_auc"](spark, SF001).count() == 1
    folder = session.scratch_table_path(spark, "tmp").removeprefix("file:")
    mine = {os.path.basename(p) for p in session._TEMPORARY}  # the folder is shared with other sessions
    assert mine & set(os.listdir(folder))
    session.drop_temporary(spark)
    assert not mine & set(os.listdir(folder))
