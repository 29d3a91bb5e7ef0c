import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fieldtally.streaming import sinks
from fieldtally.streaming.manifest import KEPT_LISTS, SnapshotTable


def snapshot(spark, n):
    return spark.range(n + 1).select(F.lit("gbif").alias("topic"), F.lit(n).alias("total"))


def folders(path):
    return {p.name for p in Path(path, "data").iterdir() if not p.name.startswith(".")}


def filled(spark, path, epochs, **options):
    table = SnapshotTable(spark, path, **options)
    for epoch in epochs:
        table.commit(snapshot(spark, epoch), epoch)
    return table


def counts(table):
    return {row["epoch_id"]: row["count"] for row in table.read().groupBy("epoch_id").count().collect()}


def test_all_epochs_are_kept_unless_told(spark, tmp_path):
    table = filled(spark, str(tmp_path), range(4))
    assert counts(table) == {n: n + 1 for n in range(4)}
    assert table.latest().columns == ["topic", "total"]
    assert [row["total"] for row in table.latest().collect()] == [3] * 4
    assert table.epochs() == [(n, n) for n in range(4)] and len(folders(tmp_path)) == 4


def test_the_latest_snapshot_opens_one_folder(spark, tmp_path):
    filled(spark, str(tmp_path), range(3))
    files = sinks.latest_snapshot(spark, str(tmp_path)).inputFiles()
    assert files and {Path(file).parent.name.split("-")[0] for file in files} == {"2"}


def test_a_crash_between_data_and_list_is_not_seen(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    table = filled(spark, path, range(2))
    def crash(*_):
        raise OSError("out of reach")

    monkeypatch.setattr(SnapshotTable, "_publish", crash)
    with pytest.raises(OSError, match="out of reach"):
        table.commit(snapshot(spark, 7), 2)
    monkeypatch.undo()
    assert len(folders(path)) == 3
    assert counts(SnapshotTable(spark, path)) == {0: 1, 1: 2}
    # The batch is handed over again, and what the first attempt left is removed.
    SnapshotTable(spark, path).commit(snapshot(spark, 2), 2)
    assert counts(SnapshotTable(spark, path)) == {0: 1, 1: 2, 2: 3}
    assert len(folders(path)) == 3


def test_a_crash_while_the_list_is_written_is_not_seen(spark, tmp_path):
    table = filled(spark, str(tmp_path), range(2))
    (tmp_path / "manifest" / ".half").write_text('["0-0-x", 0')
    assert counts(table) == {0: 1, 1: 2}


def test_a_repeated_epoch_replaces_its_rows(spark, tmp_path):
    table = filled(spark, str(tmp_path), (0, 1))
    table.commit(snapshot(spark, 5), 1)
    table.commit(snapshot(spark, 5), 1)
    assert counts(table) == {0: 1, 1: 6}
    # What a reader may be reading stays until the commit after.
    assert len(folders(tmp_path)) == 3
    table.commit(snapshot(spark, 2), 2)
    assert counts(table) == {0: 1, 1: 6, 2: 3} and len(folders(tmp_path)) <= 4


def test_retention(spark, tmp_path):
    table = filled(spark, str(tmp_path), range(6), keep=2)
    assert counts(table) == {4: 5, 5: 6}
    assert len(folders(tmp_path)) <= 3


def test_compaction_merges_single_epochs(spark, tmp_path):
    table = filled(spark, str(tmp_path), range(8), compact=3)
    assert table.epochs() == [(0, 2), (3, 5), (6, 6), (7, 7)]
    assert counts(table) == {n: n + 1 for n in range(8)}
    assert counts(SnapshotTable(spark, str(tmp_path))) == counts(table)
    assert [row["total"] for row in table.latest().collect()] == [7] * 8
    with pytest.raises(ValueError, match="merged"):
        table.commit(snapshot(spark, 1), 1)


def test_compaction_and_retention_together(spark, tmp_path):
    table = filled(spark, str(tmp_path), range(9), keep=4, compact=2)
    assert counts(table) == {n: n + 1 for n in range(5, 9)}


def test_lists_of_long_ago_are_removed(spark, tmp_path):
    filled(spark, str(tmp_path), range(KEPT_LISTS + 3), keep=1)
    lists = sorted(p.name for p in (tmp_path / "manifest").glob("*.json"))
    assert len(lists) == KEPT_LISTS
    last = [json.loads(line) for line in (tmp_path / "manifest" / lists[-1]).read_text().splitlines()]
    assert [entry[1:] for entry in last] == [[KEPT_LISTS + 2, KEPT_LISTS + 2]]


def test_nothing_committed_and_wrong_bounds(spark, tmp_path):
    with pytest.raises(ValueError, match="no snapshot"):
        sinks.read_snapshots(spark, str(tmp_path))
    for options in ({"keep": 0}, {"compact": 1}):
        with pytest.raises(ValueError, match="at least"):
            SnapshotTable(spark, str(tmp_path), **options)


def test_an_empty_snapshot_is_a_snapshot(spark, tmp_path):
    table = filled(spark, str(tmp_path), (0,))
    table.commit(snapshot(spark, 0).limit(0), 1)
    assert table.latest().collect() == [] and counts(table) == {0: 1}
