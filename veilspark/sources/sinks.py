"""Writing a table: one CSV file, a JSON array, workbooks, documents, reports."""
from __future__ import annotations

import csv
import io
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilspark.operators.sheets import ROW
from veilspark.sources import files, xlsx


def _columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != ROW]


def ordered(df: DataFrame) -> DataFrame:
    return df.orderBy(ROW) if ROW in df.columns else df


def csv_text(c: str):
    """A CSV field: quoted only where it must be."""
    v = F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    return F.when(F.regexp_like(v, F.lit('[",\r\n]')), F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(v)


def write_csv(df: DataFrame, path: str | Path) -> None:
    """One file with minimal quotes and LF line ends, in row order, sorted and written in parallel."""
    head = io.StringIO()
    csv.writer(head, lineterminator="\n").writerow(_columns(df))
    files.write_joined(ordered(df).select(F.concat_ws(",", *[csv_text(c) for c in _columns(df)]).alias("value")), path, head.getvalue().encode())


def write_parquet(df: DataFrame, path: str | Path) -> None:
    """Parquet, written by all tasks at once; the way out for tables that no single file should hold."""
    df.select(*[f"`{c}`" for c in _columns(df)]).write.mode("overwrite").parquet(files.by_tasks(df.sparkSession, path))


def _texts(df: DataFrame):
    for r in ordered(df).select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in _columns(df)]).toLocalIterator(prefetchPartitions=True):
        yield list(r)


def write_json(df: DataFrame, path: str | Path) -> None:
    """An array of objects, all values text, one object a line, written in parallel."""
    cells = F.struct(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in _columns(df)])
    files.write_joined(ordered(df).select(F.concat(F.lit(","), F.to_json(cells)).alias("value")), path, b"[\n", b"]\n", skip=1)


def write_xlsx(df: DataFrame, path: str | Path, sheet: str = "Sheet1") -> None:
    xlsx.write(str(path), [(sheet, _columns(df), _texts(df))])


def write_workbook(tables: Mapping[str, DataFrame], path: str | Path) -> None:
    """One sheet for each table, in order."""
    xlsx.write(str(path), ((name, _columns(df), _texts(df)) for name, df in tables.items()))


def write_like(df: DataFrame, kind: str, stem: str | Path) -> Path | None:
    """The output again in the input's format, where that is not CSV."""
    stem = Path(stem)
    if kind == "json":
        write_json(df, p := stem.with_suffix(".json"))
    elif kind == "excel":
        write_xlsx(df, p := stem.with_suffix(".xlsx"))
    else:
        return None
    return p


def sample(df: DataFrame, rows: int = 10) -> list[dict[str, str]]:
    """The first rows as objects."""
    return [dict(zip(_columns(df), map(str, r))) for r in ordered(df).select(*[f"`{c}`" for c in _columns(df)]).limit(rows).collect()]


def write_documents(done: DataFrame, folder: str | Path, suffix: str = ".json") -> int:
    """One file a document, named after its input, written by the driver; into a ``.parquet`` folder all tasks write rows."""
    if str(folder).endswith(".parquet"):
        rows = done.filter("document IS NOT NULL")
        rows.select("file_name", "document").write.mode("overwrite").parquet(files.by_tasks(done.sparkSession, folder))
        return rows.count()
    folder = Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    n = 0
    for name, doc in files.streamed(done.select("file_name", "document").filter("document IS NOT NULL")):
        with open(f"{folder}/{Path(name).stem}{suffix}", "wb") as f:
            f.write(f"{doc}\n".encode())
        n += 1
    return n


def write_census(census: DataFrame, path: str | Path) -> None:
    """The census, most often seen paths first."""
    rows = census.select("path", "documents_seen", "non_empty", "action", "matched_by", "example_value").orderBy(F.desc("documents_seen"), "path")
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        w = csv.writer(f, lineterminator="\n")
        w.writerow(rows.columns)
        for r in rows.toLocalIterator():
            w.writerow(["" if v is None else v for v in r])
