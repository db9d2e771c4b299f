"""Batches merged into versions: what readers see, what reading costs, reruns and cleaning."""

import random

import pytest

from quire.streaming.ingest import Snapshot, latest


def table(spark, rows):
    return spark.createDataFrame(rows, "page_id long, text string, n int").coalesce(1)


def test_merges_same_as_a_dictionary(spark, tmp_path):
    rng = random.Random(1)
    target, want = str(tmp_path / "t"), {}
    snapshot = Snapshot(spark, target)
    with pytest.raises(FileNotFoundError):
        snapshot.read()
    for batch in range(12):
        rows = [(rng.randrange(60), f"b{batch}", rng.randrange(3)) for _ in range(rng.choice([0, 1, 3, 20]))]
        snapshot.merge(table(spark, rows), "page_id", batch)
        best = {}
        for r in rows:
            best[r[0]] = max(best.get(r[0], r), r)
        want |= best
        assert sorted(map(tuple, latest(spark, target).collect())) == sorted(want.values())
        # A batch that runs again changes nothing.
        assert snapshot.merge(table(spark, [(0, "again", 9)]), "page_id", batch) == batch
    assert snapshot.versions() == list(range(12))
    folders = len(snapshot.manifest()["folders"])
    assert folders <= 16 and len(latest(spark, target).inputFiles()) == folders  # one file a bucket, after any number of batches
    old = sorted(map(tuple, snapshot.read(10).collect()))
    assert snapshot.clean(keep=2) > 0 and snapshot.versions() == [10, 11]
    assert sorted(map(tuple, snapshot.read(10).collect())) == old and sorted(map(tuple, snapshot.read().collect())) == sorted(want.values())


def test_half_a_batch_is_not_seen(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    snapshot = Snapshot(spark, target)
    snapshot.merge(table(spark, [(k, "a", 0) for k in range(50)]), "page_id", 0)
    held = Snapshot.commit
    monkeypatch.setattr(Snapshot, "commit", lambda self, manifest: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        snapshot.merge(table(spark, [(k, "b", 0) for k in range(25)]), "page_id", 1)
    assert {r.text for r in latest(spark, target).collect()} == {"a"}
    monkeypatch.setattr(Snapshot, "commit", held)
    snapshot.merge(table(spark, [(k, "b", 0) for k in range(25)]), "page_id", 1)
    got = {r.page_id: r.text for r in latest(spark, target).collect()}
    assert got == {k: "b" if k < 25 else "a" for k in range(50)}
    # Another writer of the same version is told.
    with pytest.raises(RuntimeError):
        snapshot.commit(snapshot.manifest())
