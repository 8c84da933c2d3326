"""Reading tables as all-text frames with a row number, whatever their format."""
from __future__ import annotations

import csv
import io
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.functions.text import is_blank
from veilspark.operators.documents import dump_json, load_json
from veilspark.operators.sheets import ROW, Sheet
from veilspark.plans.errors import RunError
from veilspark.session import cut
from veilspark.sources import files, xlsx

KINDS = {".csv": "csv", ".json": "json", ".xlsx": "excel", ".xls": "excel"}


def sniff(path: str | Path) -> str | None:
    """csv, json or excel by the first bytes; the contents go before the name."""
    with open(path, "rb") as f:
        head = f.read(64)
    if head.startswith((b"PK\x03\x04", b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1")):
        return "excel"
    start = head.lstrip(b" \t\r\n\xef\xbb\xbf")
    if start[:1] in (b"[", b"{"):
        return "json"
    return "csv" if start else None


def discover(folder: str | Path) -> Path:
    """The one input file of a folder."""
    folder = Path(folder)
    if not folder.is_dir():
        raise RunError("DATA_DIR_MISSING", "the input folder does not exist", str(folder))
    found = sorted(f for f in folder.iterdir() if f.is_file() and f.suffix.lower() in KINDS and not f.name.startswith((".", "_")) and f.stat().st_size)
    if not found:
        raise RunError("DATA_NO_CSV", "there is no input file", str(folder))
    if len(found) > 1:
        raise RunError("DATA_AMBIGUOUS_INPUT", "there is more than one input file", ", ".join(f.name for f in found))
    return found[0]


def _header(path: Path) -> list[str]:
    with open(path, "rb") as f:
        text = io.TextIOWrapper(f, "utf-8", newline="")
        try:
            row = next((r for r in csv.reader(text, strict=True) if r and any(c.strip() for c in r)), None)
        except (UnicodeDecodeError, csv.Error):
            raise RunError("DATA_MALFORMED_ROW", "the header cannot be read", path.name) from None
    if row is None:
        raise RunError("DATA_EMPTY", "the input file is empty", path.name)
    return row


def read_csv(spark: SparkSession, path: str | Path) -> DataFrame:
    """A CSV file as text columns, null as ``""``, with the row number.

    One file is one partition, since a quoted cell may hold line breaks: tables too large
    for that come as Parquet. Rows are read as Latin-1 and decoded as strict UTF-8, so invalid bytes fail. Blank
    records are skipped; a record of another width, or with broken quotes, fails.
    """
    path = Path(path)
    header = _header(path)
    at = files.for_tasks(spark, path)
    # quotes come in pairs; the parser would take what follows an open one up to the end as its cell
    if (spark.read.text(at).agg(F.sum(F.length("value") - F.length(F.replace("value", F.lit('"'))))).first()[0] or 0) % 2:
        raise RunError("DATA_MALFORMED_ROW", "a quoted cell is not closed", path.name)
    names = [f"c{i}" for i in range(len(header))]
    raw = (
        spark.read.schema(", ".join(f"{n} string" for n in names) + ", broken string")
        .options(header=False, multiLine=True, quote='"', escape='"', encoding="ISO-8859-1", mode="PERMISSIVE", columnNameOfCorruptRecord="broken", emptyValue="", nullValue="\x00none", maxCharsPerColumn=-1, unescapedQuoteHandling="RAISE_ERROR")
        .csv(at)
        .withColumn("__n", F.monotonically_increasing_id())
        .filter(F.col("__n") > 0)
    )  # one file without splits is one partition, so the numbers follow the file
    fail = F.raise_error(F.lit(f"DATA_MALFORMED_ROW: a record of {path.name} does not fit the header")).cast("boolean")
    kept = raw.filter(F.when(F.col("broken").isNotNull() & ~is_blank(F.col("broken")), fail).otherwise(F.col("broken").isNull()))
    if len(names) == 1:
        kept = kept.filter(~is_blank(F.col("c0")))
    text = [F.coalesce(F.decode(F.encode(n, "ISO-8859-1"), "UTF-8"), F.lit("")).alias(n) for n in names]
    return _named(kept.select(*text, F.array("__n").alias(ROW)), header)


def _named(df: DataFrame, header: list[str]) -> DataFrame:
    if len(set(header)) < len(header):
        raise RunError("DATA_MALFORMED_ROW", "a column name occurs twice", next(h for h in header if header.count(h) > 1))
    return df.toDF(*header, ROW)


def cell_text(v) -> str:
    """A JSON value as a cell."""
    if v is None:
        return ""
    if isinstance(v, bool):
        return "True" if v else "False"
    return v if isinstance(v, str) else dump_json(v, None, (",", ":"))


def _json_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for text in b.column(0).to_pylist():
            try:
                data = load_json(text)
            except ValueError:
                data = None
            if not isinstance(data, list) or any(not isinstance(x, dict) for x in data):
                raise RunError("DATA_JSON_INVALID", "the input is not an array of objects")
            for at in range(0, len(data), 4096):
                part = data[at : at + 4096]
                cells = [[(k, cell_text(v)) for k, v in x.items()] for x in part]
                yield pa.RecordBatch.from_arrays([pa.array(range(at, at + len(part)), pa.int64()), pa.array(cells, pa.map_(pa.string(), pa.string()))], names=["n", "cells"])


def read_json(spark: SparkSession, path: str | Path) -> DataFrame:
    """A JSON array of objects; columns in the order they first appear, missing keys as ``""``."""
    rows = cut(spark.read.text(files.for_tasks(spark, path), wholetext=True).mapInArrow(_json_rows, "n bigint, cells map<string,string>"))
    keys = rows.select("n", F.posexplode(F.map_keys("cells")).alias("i", "k")).groupBy("k").agg(F.min(F.struct("n", "i")).alias("at")).orderBy("at").limit(20_001)
    header = [r[0] for r in keys.collect()]
    if len(header) > 20_000:
        raise RunError("DATA_JSON_INVALID", "the table has too many columns", str(path))
    if not header:
        raise RunError("DATA_EMPTY", "the table is empty", str(path))
    return rows.select(*[F.coalesce(F.element_at("cells", F.lit(h)), F.lit("")).alias(h) for h in header], F.array("n").alias(ROW))


def read_excel(spark: SparkSession, path: str | Path) -> list[Sheet]:
    """Every sheet of a workbook (at most 2^20 rows each by the format)."""
    out = []
    for name, header, rows in xlsx.read(str(path)):
        columns = [pa.array([r[i] for r in rows], pa.string()) for i in range(len(header))]
        table = pa.table([*columns, pa.array([[i] for i in range(len(rows))], pa.list_(pa.int64()))], names=[*(f"c{i}" for i in range(len(header))), ROW])
        out.append(Sheet(name, _named(spark.createDataFrame(table), header)))
    if not out:
        raise RunError("DATA_EMPTY", "the workbook has no sheet", str(path))
    return out


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet as text columns; the row number is Spark's running id."""
    df = spark.read.parquet(path)
    return df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns], F.array(F.monotonically_increasing_id()).alias(ROW))
