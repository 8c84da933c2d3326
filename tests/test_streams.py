"""Streams over several batches against the whole tables."""
from collections import Counter

from pyspark.sql import functions as F

from veilspark.operators import qi
from veilspark.streaming import release as st


def batches(spark, root, parts):
    """A stream that takes one file a batch."""
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, "id long, g string, ts timestamp_ntz").withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.parquet(f"{root}/in/{i}")
    schema = spark.read.parquet(f"{root}/in/0").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{root}/in")


def test_classes_are_released_once_they_reach_k(spark, tmp_path):
    from datetime import datetime

    t = datetime(2025, 1, 1)
    parts = [[(i * 10 + j, "abc"[(i + j) % 3] if j else f"rare{i % 2}", t) for j in range(4)] for i in range(5)]
    stream = batches(spark, tmp_path, parts).select("id", "g")
    out = str(tmp_path / "out")
    st.publish(stream, [qi.categorical("g")], [1], 3, out, str(tmp_path / "c")).awaitTermination()
    rows = [r for p in parts for r in p]
    many = Counter(g for _, g, _ in rows)
    got = sorted((r.id, r.g) for r in spark.read.parquet(f"{out}/released").collect())
    assert got == sorted((i, g) for i, g, _ in rows if many[g] >= 3) and len({r.batch for r in spark.read.parquet(f"{out}/released").collect()}) > 1


def test_window_sizes_are_the_latest(spark, tmp_path):
    from datetime import datetime, timedelta

    t = datetime(2025, 1, 1)
    parts = [[(i * 10 + j, "ab"[j % 2], t + timedelta(hours=j)) for j in range(5)] for i in range(3)]
    stream = batches(spark, tmp_path, parts)
    counts = st.window_classes(stream, [qi.categorical("g")], [1], "ts", "1 day", "10 days")
    st.publish_classes(counts, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    got = {(r.g, r.size) for r in st.latest_classes(spark, str(tmp_path / "out"), ["g"]).collect()}
    assert got == {("a", 9), ("b", 6)}
