"""A table of snapshots with a list of what has been committed.

Every snapshot is written to a folder of its own under ``data``. What counts is the list: a small file per
commit under ``manifest``, numbered, holding all folders with the first and last epoch of each. It is written
under another name and renamed, so a reader sees the list of before or of after. Data without an entry,
as a crash leaves it between the two, is seen by nobody and removed by a later commit.

There is one writer at a time, which a streaming query is.
"""

from __future__ import annotations

import json
from typing import NamedTuple
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

# Lists of earlier commits that are kept, for readers that have just looked them up.
KEPT_LISTS = 10


class Folder(NamedTuple):
    name: str
    first: int
    last: int


class SnapshotTable:
    """Snapshots under ``path``; ``keep`` epochs are kept (all if None), ``compact`` single ones are merged into one
    folder as soon as there are that many (never if None)."""

    def __init__(self, spark: SparkSession, path: str, keep: int | None = None, compact: int | None = None):
        if (keep is not None and keep < 1) or (compact is not None and compact < 2):
            raise ValueError("keep at least one epoch, and compact at least two")
        self.spark, self.path, self.keep, self.compact = spark, path.rstrip("/"), keep, compact
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._files = self._place("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def commit(self, rows: DataFrame, epoch_id: int) -> None:
        """Add the rows as the snapshot of ``epoch_id``; a repeated epoch replaces its rows."""
        new = self._written(rows, epoch_id, epoch_id)
        version, folders = self._current()
        kept = [folder for folder in folders if folder.first != epoch_id or folder.last != epoch_id]
        if any(folder.first <= epoch_id <= folder.last for folder in kept):
            raise ValueError(f"epoch {epoch_id} of {self.path} is merged with others and cannot be replaced")
        kept = sorted([*kept, new], key=lambda folder: folder.first)
        if self.keep is not None:
            lowest = kept[-1].last - self.keep + 1
            kept = [folder for folder in kept if folder.last >= lowest]
        self._publish(version + 1, self._compacted(kept))
        self._clean({folder.name for folder in self._current()[1]}, {folder.name for folder in folders}, version + 1)

    def read(self) -> DataFrame:
        """All snapshots, with ``epoch_id``."""
        rows = self._open(self._folders())
        if self.keep is None:
            return rows
        # A merged folder may begin before the epochs that are kept.
        return rows.where(F.col("epoch_id") > self._folders()[-1].last - self.keep)

    def latest(self) -> DataFrame:
        """The last snapshot alone, without ``epoch_id``; no other folder is opened."""
        last = self._folders()[-1]
        return self._open([last]).where(F.col("epoch_id") == last.last).drop("epoch_id")

    def epochs(self) -> list[tuple[int, int]]:
        """First and last epoch of each folder."""
        return [(folder.first, folder.last) for folder in self._current()[1]]

    def _folders(self) -> list[Folder]:
        folders = self._current()[1]
        if not folders:
            raise ValueError(f"no snapshot has been committed under {self.path}")
        return folders

    def _open(self, folders: list[Folder]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path}/data/{folder.name}" for folder in folders])

    def _written(self, rows: DataFrame, first: int, last: int) -> Folder:
        name = f"{first}-{last}-{uuid4().hex}"
        if "epoch_id" not in rows.columns:
            rows = rows.withColumn("epoch_id", F.lit(first).cast("bigint"))
        rows.write.parquet(f"{self.path}/data/{name}")
        return Folder(name, first, last)

    def _compacted(self, folders: list[Folder]) -> list[Folder]:
        # The last epoch may be handed over again and stays alone.
        single = [folder for folder in folders[:-1] if folder.first == folder.last]
        if self.compact is None or len(single) < self.compact:
            return folders
        merged = self._written(self._open(single).coalesce(1), single[0].first, single[-1].last)
        return sorted([merged, *(folder for folder in folders if folder not in single)], key=lambda folder: folder.first)

    # The list

    def _place(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}".rstrip("/"))

    def _names(self, folder: str) -> list[str]:
        place = self._place(folder)
        if not self._files.exists(place):
            return []
        return [status.getPath().getName() for status in self._files.listStatus(place)]

    def _versions(self) -> list[int]:
        return sorted(int(name.removesuffix(".json")) for name in self._names("manifest") if name[0].isdigit())

    def _current(self) -> tuple[int, list[Folder]]:
        versions = self._versions()
        if not versions:
            return -1, []
        lines = self.spark.read.text(f"{self.path}/manifest/{versions[-1]:020d}.json").collect()
        return versions[-1], [Folder(*json.loads(line["value"])) for line in lines]

    def _publish(self, version: int, folders: list[Folder]) -> None:
        draft = self._place(f"manifest/.{uuid4().hex}")
        stream = self._files.create(draft)
        try:
            stream.write(bytearray("".join(json.dumps(folder) + "\n" for folder in folders), "utf-8"))
        finally:
            stream.close()
        if not self._files.rename(draft, self._place(f"manifest/{version:020d}.json")):
            raise OSError(f"commit {version} of {self.path} could not be made; is there another writer?")

    def _clean(self, live: set[str], before: set[str], version: int) -> None:
        """Remove data that neither this list nor the one before names, and lists of long ago."""
        for name in self._names("data"):
            if name not in live and name not in before:
                self._files.delete(self._place(f"data/{name}"), True)
        for old in self._versions():
            if old <= version - KEPT_LISTS:
                self._files.delete(self._place(f"manifest/{old:020d}.json"), False)
