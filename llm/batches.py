"""Documents in bounded batches, each with the sorted list of its distinct keys, and what the corpus says of those keys.

A batch is what one task reads until its texts hold `limit` bytes, so a key that all documents hold is written once per
batch.  The corpus-wide value of a key reaches a batch by a join on the key; documents never travel key by key.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.frames import map_batches, shared_folder, shipped
from llm.words import pieces, raw

#: Bytes of text in a batch; one longer text is a batch of its own.
BATCH_BYTES = 24 << 20
#: Bytes of text that are worked on at once.
PIECE_BYTES = 1 << 20


def written(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder; small row groups bound what a reader holds."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").option("parquet.block.size", 16 << 20).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_pieces(batch: pa.RecordBatch, limit: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array, int]]:
    """Rows, texts and bytes of text of consecutive parts of a batch."""
    column = batch.column(batch.schema.get_field_index("text"))
    for at, texts in pieces(column, limit):
        yield batch.slice(at, len(texts)), texts, int(raw(texts)[1][-1])


class Numbering:
    """Numbers for the batches of a task, different in each task and the same when it is run again."""

    def __init__(self):
        self.next = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 24

    def __call__(self) -> int:
        self.next += 1
        return self.next


def summed(keys: list[np.ndarray], weights: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, in order, and the sum of its weights."""
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key, weight = np.concatenate(keys), np.concatenate(weights)
    order = np.argsort(key, kind="stable")
    key, weight = key[order], weight[order]
    cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return key[cut], np.add.reduceat(weight, cut) if len(cut) else weight


def record(schema: pa.Schema, rows: int, **columns) -> pa.RecordBatch:
    """A record batch whose other columns are null."""
    arrays = [columns[f.name] if f.name in columns else pa.nulls(rows, f.type) for f in schema]
    arrays = [a if isinstance(a, pa.Array) else pa.array(a, type=f.type) for a, f in zip(arrays, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def make_batches(docs: DataFrame, start: Callable, schema, limit: int | None = None) -> DataFrame:
    """A written table of the rows that batches give.

    start(number) makes an object with add(rows, texts), called for pieces of at most PIECE_BYTES or one text, and done(),
    which yields record batches; a new object starts once the texts added hold `limit` bytes.
    """

    def run(batches):
        number, held, now = Numbering(), 0, None
        for batch in batches:
            for rows, texts, size in text_pieces(batch):
                if now is not None and held + size > cap:
                    yield from now.done()
                    now, held = None, 0
                if now is None:
                    now = start(number())
                now.add(rows, texts)
                held += size
        if now is not None:
            yield from now.done()

    cap = limit or BATCH_BYTES
    return written(map_batches(docs, run, schema))


def finish(texts: DataFrame, values: DataFrame, fn: Callable, schema) -> DataFrame:
    """fn(batch's document rows, batch's (key, ...) rows) for each batch; both sides are bounded by the batch."""
    shipped(texts.sparkSession)
    names = texts.columns
    own = texts.toDF(*[f"own_{c}" for c in names])  # both sides stem from one table

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return fn(left.rename_columns(names), right)

    return own.groupBy("own_batch").cogroup(values.groupBy("batch")).applyInArrow(run, schema)


def long_key(c: str = "doc_id"):
    return F.col(c).cast("long").alias(c)
