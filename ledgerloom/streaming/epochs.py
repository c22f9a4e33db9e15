"""Keyed results of a stream as a table of epochs that is folded together as it goes.

Each micro-batch writes what it alone contributes, one row per key, so the
stream itself keeps no state per key. After some epochs the table is folded:
the current rows and the epochs so far are merged into a new current table,
which counts from the moment it is committed; epochs it holds are dropped one
folding later, so that readers of the one before finish undisturbed. The number
of folders is bounded, and so is what a reader has to merge.

A retried epoch writes its folder again, or does nothing if it has been folded,
so each epoch counts once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from ..session import discard
from ..sources.files import path_exists


class EpochTable:
    """``merge`` has an aggregate for each column but the keys; applied to its own results it must give the same as applied once."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], merge: Callable[[], Sequence[Column]], fold_after: int = 8) -> None:
        self.spark, self.path, self.keys, self.merge, self.fold_after = spark, path, list(keys), merge, fold_after

    def _numbers(self, kind: str) -> list[int]:
        """Committed folders of a kind, oldest first."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        numbers = sorted(int(n.removeprefix(f"{kind}-")) for n in names if n.startswith(f"{kind}-"))
        return [n for n in numbers if path_exists(self.spark, f"{self.path}/{kind}-{n}/_SUCCESS")]

    def folded(self) -> int:
        """The last epoch that the current table holds; -1 before the first folding."""
        return max(self._numbers("current"), default=-1)

    def holds(self, epoch: int) -> bool:
        """Whether an epoch counts already."""
        return epoch <= self.folded() or epoch in self._numbers("epoch")

    def started(self) -> bool:
        """Whether any epoch counts."""
        return bool(self._parts())

    def _parts(self, upto: int | None = None) -> list[str]:
        at = self.folded()
        epochs = [n for n in self._numbers("epoch") if n > at and (upto is None or n <= upto)]
        return [f"{self.path}/current-{at}"] * (at >= 0) + [f"{self.path}/epoch-{n}" for n in epochs]

    def _merged(self, paths: Sequence[str]) -> DataFrame:
        return self.spark.read.parquet(*paths).groupBy(*self.keys).agg(*self.merge())

    def save(self, part: DataFrame, epoch: int) -> None:
        """Write one epoch's rows (keys and partial results) and fold the table if it is time."""
        if epoch <= self.folded():
            return
        part.write.mode("overwrite").parquet(f"{self.path}/epoch-{epoch}")
        if len([n for n in self._numbers("epoch") if n > self.folded()]) >= self.fold_after:
            self.fold(epoch)

    def fold(self, epoch: int) -> None:
        before = self.folded()
        self._merged(self._parts(epoch)).write.mode("overwrite").parquet(f"{self.path}/current-{epoch}")
        # what the table before this one had folded; nobody starts to read it any more
        for n in self._numbers("epoch"):
            if n <= before:
                discard(self.spark, f"{self.path}/epoch-{n}")
        for n in self._numbers("current"):
            if n < before:
                discard(self.spark, f"{self.path}/current-{n}")

    def read(self) -> DataFrame:
        """One row per key over all epochs so far."""
        return self._merged(self._parts())
