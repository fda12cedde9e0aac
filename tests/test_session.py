import pytest

from docledger.session import CHECKPOINT_KEY, ensure_checkpoint_dir


class Settings(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class Session:
    """Only what choosing a checkpoint folder looks at."""

    def __init__(self, master, folder=None, chosen=None):
        self.master, self.chosen = master, chosen
        self.conf = Settings({CHECKPOINT_KEY: folder} if folder else {})
        self.sparkContext = self

    def getCheckpointDir(self):
        return self.chosen

    def setCheckpointDir(self, folder):
        self.chosen = folder

    def getConf(self):
        return self.conf


def test_named_folder_is_used():
    session = Session("yarn", "hdfs:///shared")
    ensure_checkpoint_dir(session)
    assert session.chosen == "hdfs:///shared"


def test_folder_already_set_is_kept():
    session = Session("yarn", "hdfs:///other", chosen="hdfs:///kept")
    ensure_checkpoint_dir(session)
    assert session.chosen == "hdfs:///kept"


def test_cluster_without_a_folder_is_refused():
    with pytest.raises(ValueError, match=CHECKPOINT_KEY):
        ensure_checkpoint_dir(Session("spark://host:7077"))


def test_local_run_falls_back_to_scratch():
    session = Session("local[2]")
    ensure_checkpoint_dir(session)
    assert "docledger-checkpoint-" in session.chosen
