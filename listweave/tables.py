"""Durable intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from listweave.session import shared_dir


def stash(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a Parquet table into the shared folder and read back: it
    cuts the lineage and outlives a lost executor."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stash(*tables: DataFrame) -> None:
    """Deletes tables of ``stash`` that nothing reads any more."""
    for df in tables:
        jvm = df.sparkSession.sparkContext._jvm
        for file in df.inputFiles()[:1]:
            folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
            folder.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


#: A batch of ``streamed`` holds at most so many rows, and few more than so many
#: characters.
STREAM_ROWS, STREAM_CHARS = 1024, 1 << 23


def streamed(df: DataFrame, of: Callable[[Iterator[tuple]], Iterator[tuple]], schema: str) -> DataFrame:
    """The rows of each partition, in their order, through the generator ``of``.
    It sees one row at a time and may carry state from row to row, so sorted
    partitions can be worked on as streams: memory follows the state."""
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches):
        rows = (row for b in batches for at in range(0, b.num_rows, 256) for row in zip(*(c.to_pylist() for c in b.slice(at, 256).columns), strict=True))
        held, size = [], 0
        for row in of(rows):
            held.append(row)
            size += sum(len(v) for v in row if isinstance(v, (str, bytes)))
            if len(held) >= STREAM_ROWS or size >= STREAM_CHARS:
                yield batch(held)
                held, size = [], 0
        if held:
            yield batch(held)

    def batch(rows):
        columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=arrow.names)

    return df.mapInArrow(run, schema)
