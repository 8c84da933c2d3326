"""Files through the Hadoop file system: paths that tasks can read, and one file out of many parts.

A path with a scheme is taken as it is. A plain path is one of the driver's machine: on
a cluster it is copied to the shared folder before tasks read it, tasks never write
there, and one-file outputs reach it from the shared folder through the driver.
"""
from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from veilspark.plans.errors import RunError
from veilspark.session import on_one_machine, shared_dir


def has_scheme(path: str | Path) -> bool:
    return isinstance(path, str) and re.match(r"[A-Za-z][A-Za-z0-9+.-]+:", path) is not None


def place(spark: SparkSession, path: str | Path):
    """The file system of a path, and the path on it."""
    jvm, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    if has_scheme(path):
        p = jvm.Path(str(path))
        return p.getFileSystem(conf), p
    fs = jvm.FileSystem.getLocal(conf).getRawFileSystem()
    return fs, fs.makeQualified(jvm.Path(str(Path(path).resolve())))


def for_tasks(spark: SparkSession, path: str | Path) -> str:
    """A path that every task can read: a plain path is copied to the shared folder on a cluster."""
    fs, p = place(spark, path)
    if has_scheme(path) or on_one_machine(spark):
        return p.toString()
    shared = f"{shared_dir(spark)}/input-{uuid.uuid4().hex}/{Path(path).name}"
    to_fs, to = place(spark, shared)
    to_fs.copyFromLocalFile(False, True, p, to)
    return to.toString()


def by_tasks(spark: SparkSession, path: str | Path) -> str:
    """A path that every task can write; a plain one only where all tasks are on this machine."""
    if not has_scheme(path) and not on_one_machine(spark):
        raise RunError("CONFIG_INVALID_VALUE", "what all tasks write needs a path with a scheme that they share", str(path))
    return place(spark, path)[1].toString()


def write_joined(lines: DataFrame, path: str | Path, head: bytes = b"", tail: bytes = b"", skip: int = 0) -> None:
    """One file of the rows of a text column, in the order of the frame, between ``head`` and ``tail``.

    Tasks write parts to the shared folder; the driver joins their bytes, but for the first
    ``skip``, in a draft beside the target and moves it there. The bytes joined must be
    those of the rows written, or it fails.
    """
    spark = lines.sparkSession
    value, seen = F.col(lines.columns[0]), Observation()
    parts = f"{shared_dir(spark)}/parts-{uuid.uuid4().hex}"
    lines.observe(seen, F.coalesce(F.sum(F.octet_length(value) + 1), F.lit(0)).alias("bytes")).write.text(parts)
    from_fs, folder = place(spark, parts)
    to_fs, target = place(spark, path)
    io, draft = spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils, target.getParent().suffix(f"/.draft-{uuid.uuid4().hex}")
    to_fs.mkdirs(target.getParent())
    out, total = to_fs.create(draft, True), 0
    try:
        out.write(bytearray(head))
        for s in sorted((s for s in from_fs.listStatus(folder) if s.getPath().getName().startswith("part-")), key=lambda s: s.getPath().getName()):
            if s.getLen():
                stream = from_fs.open(s.getPath())
                if not total and skip:
                    stream.seek(skip)
                io.copyBytes(stream, out, 1 << 20, False)
                stream.close()
                total += s.getLen()
        out.write(bytearray(tail))
    finally:
        out.close()
    if total != seen.get["bytes"]:
        to_fs.delete(draft, False)
        raise RunError("INTERNAL_ERROR", "parts of the output are missing", f"{total} of {seen.get['bytes']} bytes")
    to_fs.delete(target, False)
    if not to_fs.rename(draft, target):
        raise RunError("INTERNAL_ERROR", "the output could not be moved to its place", str(path))
    from_fs.delete(folder, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A new path in the shared folder; what was written there is removed in the end."""
    folder = f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        fs, p = place(spark, folder)
        fs.delete(p, True)


def table_at(df: DataFrame, folder: str) -> DataFrame:
    """``df`` written once by all tasks, and read from there."""
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


#: Bytes of small files in one packed file, about what Spark reckons for opening a file: as many as fit the cores go into one task.
PACK = 4 << 20


def _packs(found: Iterable[str]) -> Iterator[pa.Table]:
    names, texts, size = [], [], 0
    for f in found:
        with open(f, "rb", buffering=0) as file:
            names.append(os.path.basename(f)), texts.append(file.readall())
        size += len(texts[-1])
        if size >= PACK:
            yield pa.table({"file_name": names, "content": pa.array(texts, pa.binary())})
            names, texts, size = [], [], 0
    if names:
        yield pa.table({"file_name": names, "content": pa.array(texts, pa.binary())})


def packed(spark: SparkSession, found: Iterable[str], folder: str) -> DataFrame:
    """``(file_name, content)`` of files of the driver, a row for each, empty ones too.

    The driver copies them into Parquet files of ``PACK`` bytes in ``folder``, so that
    neither the files to list nor the tasks are as many as the small files.
    """
    to_fs, to = place(spark, folder)
    to_fs.mkdirs(to)
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    with tempfile.TemporaryDirectory(prefix="veilspark-") as at:
        for n, table in enumerate(_packs(found)):
            pq.write_table(table, draft := f"{at}/part-{n:06d}.parquet", compression="zstd")
            to_fs.copyFromLocalFile(True, True, jvm.Path(f"file://{draft}"), to)
    return spark.read.schema("file_name string, content binary").parquet(to.toString())


def streamed(df: DataFrame) -> Iterator[tuple]:
    """The rows of ``df`` on the driver: all tasks write at once, then part after part is read, a few rows at a time."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    with scratch(spark) as folder, tempfile.TemporaryDirectory(prefix="veilspark-") as at:
        df.write.option("compression", "zstd").parquet(folder)
        fs, p = place(spark, folder)
        for part in sorted(s.getPath().toString() for s in fs.listStatus(p) if s.getPath().getName().startswith("part-")):
            fs.copyToLocalFile(False, jvm.Path(part), jvm.Path(f"file://{at}/part"), True)
            with pq.ParquetFile(f"{at}/part") as f:
                for b in f.iter_batches(256):
                    yield from zip(*(c.to_pylist() for c in b.columns))
