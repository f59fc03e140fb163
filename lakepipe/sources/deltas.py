"""A table of merged rows that is put together when it is read: a base and small deltas, newest version per key.

A part is a folder named by the first and last change it holds.  It counts once Spark has marked it complete, so an
unfinished write is as if it had not begun.  Merging adds a part and touches no other; compaction writes a part that covers
some earlier ones, which readers then pass over.  A change is numbered, by the batch or day it comes from, and a number
that is there already is not written again.  One writer at a time is assumed.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.operators.dedupe import keep_latest

_NAME = re.compile(r"(\d{12})-(\d{12})$")
CHANGE = "_change"


@dataclass(frozen=True)
class Part:
    first: int
    last: int
    path: str


@dataclass
class DeltaTable:
    """``order`` says which row of a key wins, such as ["version DESC"]; ties go to the later change."""

    spark: SparkSession
    path: str
    keys: Sequence[str]
    order: Sequence[str]
    schema: T.StructType

    def _folder(self, first: int, last: int) -> str:
        return f"{self.path}/{first:012d}-{last:012d}"

    def _stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(CHANGE, T.LongType())])

    def parts(self, before: int | None = None) -> list[Part]:
        """The complete parts that make up the table, oldest first; ``before``: only changes of smaller numbers."""
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = []
        for status in fs.listStatus(root) if fs.exists(root) else ():
            m = _NAME.search(status.getPath().getName())
            if m and fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                found.append(Part(int(m[1]), int(m[2]), self._folder(int(m[1]), int(m[2]))))
        found = [p for p in found if before is None or p.last < before]
        found.sort(key=lambda p: (p.first, -p.last))
        out, upto = [], -1
        for p in found:
            if p.first > upto:  # else a wider part holds it already
                out.append(p)
                upto = p.last
        return out

    def _rows(self, parts: Sequence[Part]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self._stored())
        return self.spark.read.schema(self._stored()).parquet(*[p.path for p in parts])

    def _merged(self, parts: Sequence[Part]) -> DataFrame:
        rows = self._rows(parts)
        if len(parts) < 2:
            return rows  # a part holds a key once
        return keep_latest(rows, self.keys, [*self.order, F.col(CHANGE).desc()])

    def merge(self, rows: DataFrame, number: int) -> bool:
        """Add a change; False if its number is there already. Several rows of a key become one."""
        if any(p.first <= number <= p.last for p in self.parts()):
            return False
        one = keep_latest(rows.select(*self.schema.names), self.keys, self.order).withColumn(CHANGE, F.lit(number).cast("long"))
        one.write.mode("overwrite").parquet(self._folder(number, number))
        return True

    def read(self, before: int | None = None) -> DataFrame:
        """One row per key; ``before``: as it was before the change of that number, while the parts up to it are kept."""
        return self._merged(self.parts(before)).drop(CHANGE)

    def compact(self, most: int = 100) -> None:
        """Put the newest deltas together where there are more than ``most`` parts; the base is rewritten only when the
        deltas hold as many rows as it does, so the work stays in proportion to what was added."""
        parts = self.parts()
        if len(parts) <= most:
            return
        base, deltas = parts[0], parts[1:]
        if self._rows(deltas).count() >= self._rows([base]).count():
            deltas = parts
        self._merged(deltas).write.mode("overwrite").parquet(self._folder(deltas[0].first, deltas[-1].last))
