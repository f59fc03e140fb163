"""DataFrame helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from llm.words import pieces


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def shipped(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that they find it wherever they run."""
    context = spark.sparkContext
    folder = os.path.dirname(os.path.abspath(__file__))
    if getattr(context, "_llm_shipped", False) or not os.path.isdir(folder):
        return
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="run-")), "llm_package.zip")
    with zipfile.ZipFile(path, "w") as out:
        for name in sorted(os.listdir(folder)):
            if name.endswith(".py"):
                out.write(os.path.join(folder, name), f"llm/{name}")
    context.addPyFile(path)
    context._llm_shipped = True


def map_batches(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """df.mapInArrow with this package at hand on the workers."""
    shipped(df.sparkSession)
    return df.mapInArrow(fn, schema)


def apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with all columns but doc_id and text renamed so that none clashes with a working column, and their new names."""
    names = {c: c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def map_texts(
    df: DataFrame,
    fn: Callable,
    fields: list[T.StructField],
    keep: list[str],
    also: tuple[str, ...] = (),
    text: str = "text",
    limit: int = 1 << 20,
) -> DataFrame:
    """Columns `keep` and those that fn makes, row by row in place; fn sees the columns `also` too.

    fn(rows, texts) gets a record batch and its texts (large_string) for a piece of at most `limit` bytes of text or one
    row, and returns one Arrow array or list per field.
    """
    schema = T.StructType([df.schema[c] for c in keep] + fields)
    names = [f.name for f in schema.fields]
    types = [_arrow(f.dataType) for f in fields]

    def run(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for at, texts in pieces(column, limit):
                rows = batch.slice(at, len(texts))
                made = [c if isinstance(c, pa.Array) else pa.array(c, type=t) for c, t in zip(fn(rows, texts), types)]
                kept = [rows.column(rows.schema.get_field_index(c)) for c in keep]
                yield pa.RecordBatch.from_arrays([*kept, *made], names=names)

    need = list(dict.fromkeys([*keep, text, *also]))
    return map_batches(df.select(*[f"`{c}`" for c in need]), run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    return {
        T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.DoubleType: pa.float64(), T.StringType: pa.string(),
        T.BooleanType: pa.bool_(), T.BinaryType: pa.binary(),
    }[type(kind)]


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Where it is unset a local master (tests) makes one; a cluster raises."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="run-")
        context.setCheckpointDir(named)
    return named.rstrip("/")


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that this package wrote, in whatever file system it lies."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)


def saved(df: DataFrame) -> DataFrame:
    """df computed once and kept in the shared folder; its lineage ends there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
