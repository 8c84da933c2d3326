"""Generalise a stream at a node that was chosen beforehand.

The labels are a stateless projection. Class sizes over event-time windows use a
watermark, so late rows still count until it passes and state stays bounded. A class
is released by :func:`publish` only when the counts of all rows seen so far allow it;
k per batch would be another guarantee.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from veilspark.operators.anonymise import generalise
from veilspark.operators.qi import QI
from veilspark.session import cut


def labels(stream: DataFrame, qis: Sequence[QI], node: Sequence[int]) -> DataFrame:
    """The stream with its quasi-identifiers generalised."""
    return generalise(stream, qis, node)


def window_classes(stream: DataFrame, qis: Sequence[QI], node: Sequence[int], time: str, window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Class sizes by event-time window; rows later than ``late`` are left out."""
    out = labels(stream, qis, node).withWatermark(time, late)
    return out.groupBy(F.window(time, window).alias("span"), *[q.name for q in qis]).agg(F.count("*").alias("size"))


def publish_classes(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the class sizes that changed in each batch, as ``path/batch=<n>``; :func:`latest_classes` reads the present ones.

    In update mode the watermark lets go of windows that are over, so state stays bounded
    and nothing but changes is written; a batch that is run again replaces itself.
    """

    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return counts.writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_classes(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """The last size written of each window and class."""
    return spark.read.parquet(path).groupBy("span", *names).agg(F.max_by("size", "batch").alias("size"))


#: Folders that labelled rows are kept in by a hash of their class, so a class that reaches k is found without reading all rows.
BUCKETS = 64


def publish(stream: DataFrame, qis: Sequence[QI], node: Sequence[int], k: int, path: str, checkpoint: str) -> StreamingQuery:
    """Release the rows of each class as soon as the rows of all batches so far hold k of it.

    ``path/rows`` holds the labelled rows by batch and hash of the class, ``path/counts``
    the class sizes of each batch. A batch adds ``path/released/batch=<n>``: its own rows
    of classes that have k, and the earlier rows of classes that reach k with it. Nothing
    released is read or written again, and a batch that is run again replaces itself.
    """
    names = [q.name for q in qis]

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        bucket = F.pmod(F.xxhash64(*names), F.lit(BUCKETS)).cast("int")
        batch.withColumn("__bucket", bucket).write.mode("overwrite").partitionBy("__bucket").parquet(f"{path}/rows/batch={number}")
        batch.groupBy(*names).agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{path}/counts/batch={number}")
        earlier = F.sum(F.when(F.col("batch") < number, F.col("n")).otherwise(0))
        sizes = spark.read.parquet(f"{path}/counts").filter(F.col("batch") <= number).groupBy(*names).agg(earlier.alias("before"), F.sum("n").alias("after")).filter(F.col("after") >= k).withColumn("__bucket", bucket)
        rows = spark.read.parquet(f"{path}/rows").filter(F.col("batch") <= number)
        new = cut(sizes.filter(F.col("before") < k))
        touched = [r[0] for r in new.select("__bucket").distinct().collect()]  # at most BUCKETS
        key = ["__bucket", *names]
        mine = rows.filter(F.col("batch") == number).join(sizes, key, "left_semi")
        caught_up = rows.filter((F.col("batch") < number) & F.col("__bucket").isin(touched)).join(new, key, "left_semi")
        mine.unionByName(caught_up).select(batch.columns).write.mode("overwrite").parquet(f"{path}/released/batch={number}")

    return labels(stream, qis, node).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
