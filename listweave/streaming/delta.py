"""The delta view as a stream: arriving raw listings, each told once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from listweave.config import Settings
from listweave.operators import normalize, state
from listweave.tables import stash

LEDGER = "id string, t string, d date, s date, u date, batch long"


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What earlier batches wrote, none at first."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def delta_stream(spark: SparkSession, arriving: str, schema: T.StructType, folder: str, settings: Settings, now: Column) -> StreamingQuery:
    """Files of raw listings in ``arriving``, normalized, without what the ledger
    already holds, to ``folder``/delta; what was shown goes to ``folder``/ledger.

    Each micro-batch reads only the ledger of earlier batches and overwrites its
    own partition of both tables, so a batch that is repeated after a failure or a
    restart gives the same rows; within a batch the first listing of an id counts.
    Runs until what has arrived is done and goes on from its checkpoint when
    started again."""

    def batch(rows: DataFrame, number: int) -> None:
        today = now.cast("date")
        listings = stash(normalize.kept(normalize.normalized(rows, settings, now)), "arrived")
        ledger = _table(spark, f"{folder}/ledger", LEDGER).filter(F.col("batch") < number)
        first = Window.partitionBy("id").orderBy("ord")
        fresh = state.unsent(listings, state.sent_ids(listings, state.purged(ledger, today)))
        fresh = stash(fresh.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n"), "fresh")
        none = spark.createDataFrame([], LEDGER).drop("batch")
        for name, out in (("ledger", state.recorded(none, fresh, today)), ("delta", fresh)):
            out.write.mode("overwrite").parquet(f"{folder}/{name}/batch={number}")

    stream = spark.readStream.schema(schema).parquet(arriving)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()


def delivered(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """All rows that the stream has delivered, with their batch."""
    return spark.read.schema(schema.add("batch", "long")).parquet(f"{folder}/delta")
