"""Frequency of every distinct value or term, kept up to date by signed deltas.

Only added, changed or deleted records are read for an update: each gives its terms
with sign +1 or -1, these are summed to per-term changes of occurrences and records,
and the changes are merged into persistent counts that are partitioned by a hash of
the term, so an update rewrites only the partitions it touches. Within a record the
distinct terms are found in the row itself; only (column, term) sums are shuffled,
after map-side combining, so a hot term costs one row per task.

Defined results: null cells, and terms that are empty after trimming, do not count;
repeated rows count each; an empty table gives no terms; very long terms are terms;
columns not named are ignored.
"""
from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.functions.text import let, nfc, trim_unicode
from veilspark.session import cut, shared_dir

COUNTS = "column_name string, term_text string, occurrences long, records long"


def terms_of(df: DataFrame, columns: Mapping[str, str | None], sign: Column | int = 1) -> DataFrame:
    """``(column_name, term_text, occurrences, records)`` of each record, times ``sign``.

    ``columns`` maps a column to the separator of its terms, or None for one term.
    """
    s = F.lit(sign) if isinstance(sign, int) else sign
    parts = []
    for name, sep in columns.items():
        cell = F.col(name).cast("string")
        # a whole cell is brought to NFC only after it was split: NFC can turn other characters into the separator
        pieces = F.array(cell) if sep is None else F.split(cell, rf"\Q{sep}\E")
        parts.append(F.struct(F.lit(name).alias("column_name"), pieces.alias("pieces")))
    rows = df.select(s.cast("long").alias("sign"), F.explode(F.array(*parts)).alias("p")).filter(F.col("p.pieces").isNotNull())
    cells = rows.select("sign", F.col("p.column_name").alias("column_name"), F.filter("p.pieces", lambda x: x.isNotNull() & (x != "")).alias("pieces"))
    counted = let(F.transform("pieces", lambda x: trim_unicode(nfc(x))), lambda t: F.transform(F.array_distinct(t), lambda x: F.struct(x.alias("term_text"), F.size(F.filter(t, lambda y: y == x)).alias("n"))))
    return (
        cells.select("sign", "column_name", F.explode(counted).alias("t"))
        .filter(F.col("t.term_text") != "")
        .select("column_name", "t.term_text", (F.col("sign") * F.col("t.n")).alias("occurrences"), F.col("sign").alias("records"))
    )


def changes(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Signed records between two states: -1 for what went or changed, +1 for what came."""
    o = old.select(F.col(key).alias("__k"), F.struct(*columns).alias("__o"), F.lit(True).alias("__ho"))
    n = new.select(F.col(key).alias("__k2"), F.struct(*columns).alias("__n"), F.lit(True).alias("__hn"))
    both = o.join(n, F.col("__k").eqNullSafe(F.col("__k2")), "full").filter(~F.col("__o").eqNullSafe(F.col("__n")) | F.col("__ho").isNull() | F.col("__hn").isNull())
    signed = F.array(F.when(F.col("__ho"), F.struct(F.lit(-1).alias("sign"), F.col("__o").alias("r"))), F.when(F.col("__hn"), F.struct(F.lit(1).alias("sign"), F.col("__n").alias("r"))))
    return both.select(F.explode(F.filter(signed, lambda x: x.isNotNull())).alias("c")).select("c.sign", "c.r.*")


def summed(terms: DataFrame) -> DataFrame:
    return terms.groupBy("column_name", "term_text").agg(F.sum("occurrences").alias("occurrences"), F.sum("records").alias("records"))


#: Rows of a bucket on average, beyond which a store is divided into more buckets.
BUCKET_ROWS = 1_000_000


class TermStore:
    """Persistent counts in ``path``: one folder per update, in it one per bucket, and a manifest per update.

    A manifest names the folder of every bucket, their number and their rows. It is
    written beside its place and moved there, so a reader sees an update whole or not at
    all, a crash leaves the state before, and of two writers of one update the second
    fails. Buckets grow with the data: beyond ``bucket_rows`` rows each, the next update
    divides all of them. Each is written by many tasks.

    Updates commute: a deletion that comes before its addition is kept as a debt, which
    :meth:`counts` does not show; what comes to nothing is dropped.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = 16, bucket_rows: int = BUCKET_ROWS):
        self.spark, self.bucket_rows = spark, bucket_rows
        self.path = path or f"{shared_dir(spark)}/terms-{uuid.uuid4().hex}"
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.manifest: dict = {"update": 0, "buckets": buckets, "at": {}, "rows": {}}
        if self._fs.exists(self._at("")):
            names = [s.getPath().getName() for s in self._fs.listStatus(self._at(""))]
            if updates := [int(n[9:-5]) for n in names if n.startswith("manifest-") and n.endswith(".json")]:
                stream = self._fs.open(self._at(f"manifest-{max(updates)}.json"))
                self.manifest = json.loads(bytes(stream.readAllBytes()).decode())
                stream.close()

    @property
    def buckets(self) -> int:
        return self.manifest["buckets"]

    def _at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def _read(self, buckets: list[str]) -> DataFrame:
        at = [f"{self.path}/{self.manifest['at'][b]}/bucket={b}" for b in buckets if b in self.manifest["at"]]
        if not at:
            return self.spark.createDataFrame([], COUNTS)
        return self.spark.read.schema(COUNTS).parquet(*at)

    def counts(self) -> DataFrame:
        """The current counts of every term."""
        return self._read(sorted(self.manifest["at"], key=int)).filter("occurrences > 0")

    def apply(self, terms: DataFrame) -> TermStore:
        """Merge signed terms of changed records; only touched buckets are read and rewritten."""
        update, rows = self.manifest["update"] + 1, sum(self.manifest["rows"].values())
        buckets = self.buckets
        while rows > buckets * self.bucket_rows:
            buckets *= 2
        bucket = F.pmod(F.xxhash64("column_name", "term_text"), F.lit(buckets)).cast("int")
        delta = summed(terms)
        if buckets != self.buckets or not self.manifest["at"]:
            merged = summed(delta.unionByName(self._read(list(self.manifest["at"]))))
            touched = [str(b) for b in range(buckets)]
        else:
            # only buckets holding a changed term are merged; their numbers are at most ``buckets``
            delta = cut(delta.withColumn("bucket", bucket))
            touched = [str(r[0]) for r in delta.select("bucket").distinct().collect()]
            merged = summed(delta.drop("bucket").unionByName(self._read(touched)))
        folder = f"update-{update}-{uuid.uuid4().hex[:8]}"
        kept = merged.filter((F.col("occurrences") != 0) | (F.col("records") != 0)).withColumn("bucket", bucket)
        kept.write.partitionBy("bucket").parquet(f"{self.path}/{folder}")
        there = {s.getPath().getName().partition("=")[2] for s in self._fs.listStatus(self._at(folder)) if s.isDirectory()}
        at = {b: f for b, f in self.manifest["at"].items() if b not in touched} | {b: folder for b in touched if b in there}
        # one number per bucket
        found = dict(self.spark.read.parquet(f"{self.path}/{folder}").groupBy(F.col("bucket").cast("string")).count().collect()) if there else {}
        self._publish({"update": update, "buckets": buckets, "at": at, "rows": {b: found[b] if b in found else self.manifest["rows"][b] for b in at}})
        return self

    def _publish(self, manifest: dict) -> None:
        final, draft = self._at(f"manifest-{manifest['update']}.json"), self._at(f".draft-{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            raise RuntimeError(f"update {manifest['update']} of {self.path} was made by another writer")
        self.manifest = manifest


def verdicts(counts: DataFrame, rare_records: int = 3, common_share: float = 0.1) -> DataFrame:
    """``(column_name, term_text, verdict, occurrences, records)``: one row per verdict of a term."""
    total = counts.groupBy("column_name").agg(F.sum("occurrences").alias("total"))
    marks = F.filter(F.array(F.when(F.col("records") <= rare_records, F.lit("rare")), F.when(F.col("occurrences") > F.col("total") * F.lit(common_share), F.lit("common"))), lambda x: x.isNotNull())
    # the totals are one row per configured column
    return counts.join(F.broadcast(total), "column_name").select("column_name", "term_text", F.explode(marks).alias("verdict"), "occurrences", "records")
