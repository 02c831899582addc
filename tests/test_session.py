"""The shared folder is the cluster's, or the session fails."""

import pytest

from kiosklake import session


class _Session:
    def __init__(self, **settings):
        self.settings = settings
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key, default)

    def set(self, key, value):
        self.settings[key] = value


def test_unset_folder_raises():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(_Session())


def test_only_one_machine_gets_its_own_folder():
    cluster = session.with_local_dir(_Session(**{"spark.master": "local-cluster[3,2,1024]"}))
    with pytest.raises(RuntimeError):
        session.shared_dir(cluster)
    alone = session.with_local_dir(_Session(**{"spark.master": "local[8]"}))
    assert session.shared_dir(alone)
    named = session.with_local_dir(_Session(**{"spark.master": "local[8]", "spark.checkpoint.dir": "/shared"}))
    assert session.shared_dir(named) == "/shared"


def test_shares_of_tables_are_small_whatever_the_session_has():
    kept = session.prepare(_Session(**{"spark.sql.shuffle.partitions": "12"})).settings
    assert kept["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "16m"
    assert int(kept["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]) >= 320  # 5 GB shuffled, 16 MB each
    assert "spark.sql.adaptive.advisoryPartitionSizeInBytes" not in session.prepare(_Session(), shares=False).settings
