"""Tables that a stream writes one folder a batch, and that stay few folders.

A folder ``batches-<first>-<last>`` holds what those micro-batches wrote and
counts once it has its success marker. After every ``fan`` batches their
folders are merged into one, after ``fan`` of those the next level, so n
batches leave about ``fan * log(n)`` folders and each row is rewritten once a
level. A folder that a wider complete one covers is not read any more; it is
deleted before the next merge, so readers have that long to finish, and a
merge that was cut short is simply done again.
"""

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

FAN = 16
_NAME = re.compile(r"batches-(\d+)-(\d+)$")
_MARKER = "_SUCCESS"


class EpochTable:
    """One such table below ``path``; ``merge`` may make the rows of several batches fewer."""

    def __init__(self, spark: SparkSession, path: str, schema, merge: Callable[[DataFrame], DataFrame] | None = None, fan: int = FAN):
        self.spark, self.path, self.schema, self.fan = spark, path.rstrip("/"), schema, fan
        self.merge = merge or (lambda rows: rows.hint("rebalance"))
        self._root = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self._files = self._root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _folder(self, first: int, last: int) -> str:
        return f"{self.path}/batches-{first:012d}-{last:012d}"

    def _hadoop(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _ranges(self) -> tuple[set[tuple[int, int]], set[tuple[int, int]]]:
        """Batch ranges of all folders, and of those that count."""
        if not self._files.exists(self._root):
            return set(), set()
        names = [_NAME.search(s.getPath().getName()) for s in self._files.listStatus(self._root)]
        found = {(int(m[1]), int(m[2])) for m in names if m}
        done = {r for r in found if self._files.exists(self._hadoop(f"{self._folder(*r)}/{_MARKER}"))}
        covered = {r for r in done for w in done if r != w and w[0] <= r[0] and r[1] <= w[1]}
        return found, done - covered

    def folders(self) -> list[str]:
        """Folders a reader needs."""
        return [self._folder(*r) for r in sorted(self._ranges()[1])]

    def read(self, before: int | None = None) -> DataFrame:
        """Rows of all batches, or of those before one."""
        ranges = sorted(r for r in self._ranges()[1] if before is None or r[1] < before)
        return self._rows(ranges)

    def newest(self, before: int) -> DataFrame:
        """Rows of the last batch before one."""
        return self._rows(sorted(r for r in self._ranges()[1] if r[1] < before)[-1:])

    def _rows(self, ranges: list[tuple[int, int]]) -> DataFrame:
        if not ranges:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[self._folder(*r) for r in ranges])

    def write(self, rows: DataFrame, epoch: int) -> None:
        """Write one batch; a batch that comes again replaces itself unless it is merged already."""
        if not any(first <= epoch <= last and first < last for first, last in self._ranges()[1]):
            rows.write.mode("overwrite").parquet(self._folder(epoch, epoch))

    def compact(self, epoch: int) -> None:
        """Merge the levels that end with this batch."""
        size = self.fan
        while (epoch + 1) % size == 0:
            target = (epoch + 1 - size, epoch)
            found, needed = self._ranges()
            for r in found - needed:
                if any(w[0] <= r[0] and r[1] <= w[1] for w in needed):
                    self._delete(r)
            if target not in needed:
                inside = sorted(r for r in needed if target[0] <= r[0] and r[1] <= target[1])
                self.merge(self._rows(inside)).write.mode("overwrite").parquet(self._folder(*target))
            size *= self.fan

    def forget(self, before: int) -> None:
        """Delete batches before one, for a table of which only the newest counts."""
        for r in self._ranges()[0]:
            if r[1] < before:
                self._delete(r)

    def _delete(self, batches: tuple[int, int]) -> None:
        self._files.delete(self._hadoop(self._folder(*batches)), True)
