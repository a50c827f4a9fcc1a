"""
Commits of a stream: one small file for each batch, which makes all its rows visible at once.

A batch writes its tables first, each into a folder of its own number and attempt. Its commit names
that attempt and carries the cursor; it appears by one rename, which fails if another run has
committed the batch. Readers look only at what commits name, so a batch that died half way shows
nothing, and the next one reads one file of its predecessor's, however many there are.
"""

from __future__ import annotations

import datetime
import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.schemas import PROGRESS
from rollcall.sources import tables

# first_block and through: the blocks of the batch's stored events; top_block: the highest block of all
# events up to this batch.
COMMITS = PROGRESS + ", attempt string, first_block bigint, through bigint, top_block bigint"
# Commits of so many batches share a folder.
GROUP = 256


class Commits:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._files = self._hadoop.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, batch: int, kind: str = "json"):
        return self._hadoop.Path(f"{self.root}/group={batch // GROUP}/{batch}.{kind}")

    def _store(self, path, values: dict) -> None:
        out = self._files.create(path, True)
        out.write(bytearray(json.dumps(values).encode()))
        out.close()

    def get(self, batch: int) -> dict | None:
        """The commit of a batch, if there is one."""
        if batch < 0 or not self._files.exists(self._path(batch)):
            return None
        stream = self._files.open(self._path(batch))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(
                stream, "UTF-8"))
        finally:
            stream.close()

    def last(self) -> int:
        """The number of the last commit, -1 before the first: the newest folder tells it."""
        for group in reversed(self._numbers(self.root, "group=", "")):
            found = self._numbers(f"{self.root}/group={group}", "", ".json")
            if found:
                return found[-1]
        return -1

    def _numbers(self, folder: str, before: str, after: str) -> list[int]:
        path = self._hadoop.Path(folder)
        if not self._files.exists(path):
            return []
        names = [f.getPath().getName() for f in self._files.listStatus(path)]
        inner = [n.removeprefix(before).removesuffix(after) for n in names
                 if n.startswith(before) and n.endswith(after)]
        return sorted(int(n) for n in inner if n.isdigit())

    def add(self, batch: int, values: dict) -> None:
        """Commit a batch. Raises RuntimeError if another run has done so."""
        own = self._hadoop.Path(f"{self.root}/_{batch}-{uuid.uuid4().hex}")
        self._store(own, {"batch_id": batch, "status": "ok", "run_at": _now(), **values})
        self._files.mkdirs(self._path(batch).getParent())
        context = self._hadoop.FileContext.getFileContext(
            self._files.getUri(), self.spark._jsc.hadoopConfiguration())
        modes = self.spark._sc._gateway.new_array(self._hadoop.Options.Rename, 0)
        try:
            context.rename(own, self._path(batch), modes)
        except Exception as failure:
            self._files.delete(own, False)
            if self._files.exists(self._path(batch)):
                raise RuntimeError(f"another run has committed batch {batch}") from failure
            raise
        self._files.delete(self._path(batch, "error"), False)

    def fail(self, batch: int, values: dict) -> None:
        """Leave the error of a batch that was not committed."""
        self._store(self._path(batch, "error"),
                    {"batch_id": batch, "status": "error", "run_at": _now(), **values})

    def rows(self) -> DataFrame:
        """One row for each commit, and for each batch that failed last."""
        if not tables.exists(self.spark, self.root):
            return self.spark.createDataFrame([], COMMITS)
        return self.spark.read.schema(COMMITS + ", group int").json(self.root).drop("group")

    def named(self, low: int | None = None, high: int | None = None) -> DataFrame:
        """(batch_id, attempt) of the commits that stored events, of blocks low to high if given."""
        rows = self.rows().where("status = 'ok' and inserted > 0")
        if low is not None:
            rows = rows.where((F.col("first_block") <= high) & (F.col("through") >= low))
        return rows.select("batch_id", "attempt")


def _now() -> str:
    return datetime.datetime.now(datetime.UTC).isoformat().replace("+00:00", "Z")
