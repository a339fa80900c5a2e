"""What the operators of this folder share: tables, durable intermediate data."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from listweave.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stash(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a Parquet table into the shared folder and read back.

    It cuts the lineage and outlives a lost executor, and later readers take
    only the columns they need."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stash(df: DataFrame) -> None:
    """Deletes a table of ``stash`` that nothing reads any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for file in df.inputFiles()[:1]:
        folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def bounded_sample(df: DataFrame, label: str, key: str, bound: int) -> DataFrame:
    """About ``bound`` rows of each value of ``label`` (all, if there are no
    more), chosen by a hash of ``key``: the same rows on every run."""
    share = df.groupBy(F.col(label).alias("_l")).agg((F.lit(float(bound)) / F.count("*")).alias("_share"))
    u = F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 30)) / float(1 << 30)
    return df.join(F.broadcast(share), F.col(label) == F.col("_l")).filter(u < F.col("_share")).drop("_l", "_share")


def mapped(df: DataFrame, rows_of, schema: str, rows: int = 256) -> DataFrame:
    """``df`` through ``rows_of``, which turns a slice of at most ``rows`` rows
    (an Arrow record batch) into record batches: memory follows the slice."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield from rows_of(batch.slice(at, rows))

    return df.mapInArrow(run, schema)


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
