import os

import pytest

from quire.llm import common


def test_stages_of_an_application(spark):
    """Stages lie in the shared folder under the application's own name; only those are removed."""
    other = f"{common.shared_dir(spark)}/quire-other/x"
    os.makedirs(other)
    df = common.staged(spark.range(3), "some")
    assert df.count() == 3 and os.listdir(common.stage_dir(spark))
    common.clear_stages(spark)
    assert not os.path.exists(common.stage_dir(spark)) and os.path.isdir(other)


class Cluster:
    """A session of a cluster that names no shared folder."""

    master = "spark://host:7077"

    def __init__(self):
        self.conf = self.sparkContext = self

    def get(self, name, default):
        return default

    def getCheckpointDir(self):
        return None


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="checkpoint"):
        common.shared_dir(Cluster())


@pytest.mark.parametrize("share", [1, 3, 1 << 40])
def test_joined_by_key(spark, monkeypatch, share):
    monkeypatch.setattr(common, "HOT_SHARE", share)
    rows = [(k, "a" if k % 2 else chr(98 + k % 5)) for k in range(50)] + [(50, "z"), (51, None)]
    keys = [(c, ord(c), sum(r[1] == c for r in rows)) for c in "abcdefg"]
    got = common.joined_by_key(spark.createDataFrame(rows, "id long, key string"), spark.createDataFrame(keys, "key string, of int, members long"), "key", "members", len(rows))
    assert sorted((r.id, r.key, r.of) for r in got.collect()) == sorted((k, c, ord(c)) for k, c in rows if c and c != "z")
