"""A stream of block ranges: offsets are block numbers, and a run admits only so many."""

from __future__ import annotations

import time
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader


class BlockRanges(DataSource):
    """
    One row (from_block, to_block) for each batch. Options: start, the first block of the first run;
    target, the last block of this one; chunk, blocks of a batch; deadline, the second of the epoch
    after which no more ranges come. A later run goes on behind the last range of the checkpoint.
    """

    @classmethod
    def name(cls) -> str:
        return "block_ranges"

    def schema(self) -> str:
        return "from_block bigint, to_block bigint"

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return RangeReader(self.options)


class RangeReader(SimpleDataSourceStreamReader):
    def __init__(self, options):
        self.start, self.target = int(options["start"]), int(options["target"])
        self.chunk = int(options["chunk"])
        self.deadline = float(options.get("deadline", "inf"))

    def initialOffset(self) -> dict:
        return {"block": self.start - 1}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        done = start["block"]
        if done >= self.target or time.time() > self.deadline:
            return iter(()), start
        end = {"block": min(self.target, done + self.chunk)}
        return self.readBetweenOffsets(start, end), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter([(start["block"] + 1, end["block"])])
