"""Separate raw CSV records that do not load, with the reason, from the valid rows.

Parsed cells become rows ``(record, column, value)``, are joined with a rule table,
every rule is evaluated, the errors are aggregated per record, and the valid rows
are what an anti-join with the failed records leaves. Only failing cells and failed
records are shuffled for the errors; parsing uses built-in functions only.

Defined results: a null or white-space-only record is skipped (neither valid nor
failed); records with equal id and equal text are judged alike and each is kept; an
empty table gives empty results; a null id is an id like any other; columns of the
input other than id and record are ignored unless named in ``keep``, and one that
clashes with a parsed column comes out as ``<name>_src``. A line break outside
quotes inside a record counts as ``quoting``.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilspark.functions.text import is_blank, let, trim_unicode
from veilspark.session import spread

RECORD = "#record"
_SEP, _ESC = "\u0001", "\u0002"


@dataclass(frozen=True)
class Rule:
    """One row of the rule table; ``fails`` says of a cell's value whether it is bad."""

    column: str
    name: str
    reason: str
    precedence: int
    fails: Callable[[Column], Column]


@dataclass(frozen=True)
class Loaded:
    valid: DataFrame
    failed: DataFrame
    errors: DataFrame


def intake_rules() -> list[Rule]:
    """The rules of the intake records: structure first, then ``PatientId`` and ``Note``."""
    return [
        Rule(RECORD, "quoting", "quoting", 1, lambda v: v == "quoting"),
        Rule(RECORD, "column_count", "column_count", 2, lambda v: v == "column_count"),
        Rule("PatientId", "patient_id_form", "bad_value", 3, lambda v: ~F.regexp_like(trim_unicode(v), F.lit(r"\AP[0-9]{6,12}\z"))),
        Rule("Note", "note_characters", "bad_value", 4, lambda v: F.regexp_like(v, F.lit(r"[\x{FFFD}[\p{Cc}&&[^\t\n\r]]]"))),
    ]


INTAKE_COLUMNS = ("PatientId", "Name", "Age", "Gender", "Pincode", "Diagnosis", "Note")


def parse_record(raw: Column) -> Column:
    """``struct(ok, fields)`` of one raw CSV record under RFC 4180.

    The text is split at quotes: pieces at odd places are inside quotes. An empty
    piece outside, between two quoted ones, is a doubled quote; any other piece
    outside must meet its quoted neighbours with a comma.
    """

    def outside_bad(x: Column, i: Column, n: Column) -> Column:
        starts, ends = x.startswith(","), x.endswith(",")
        edge = F.when(n == 1, F.lit(False)).when(i == 0, ~ends).when(i == n - 1, ~starts).otherwise(~(starts & ends))
        return (x != "") & (edge | F.regexp_like(x, F.lit(r"[\r\n]")))

    def guard(x: Column) -> Column:
        return F.replace(F.replace(x, F.lit(_ESC), F.lit(_ESC + "b")), F.lit(_SEP), F.lit(_ESC + "a"))

    def unguard(x: Column) -> Column:
        return F.replace(F.replace(x, F.lit(_ESC + "a"), F.lit(_SEP)), F.lit(_ESC + "b"), F.lit(_ESC))

    def body(segs: Column) -> Column:
        n = F.size(segs)
        bad = F.exists(F.transform(segs, lambda x, i: (i % 2 == 0) & outside_bad(x, i, n)), lambda b: b)
        pieces = F.transform(
            segs,
            lambda x, i: F.when(i % 2 == 1, guard(x)).when((x == "") & (i > 0) & (i < n - 1), F.lit('"')).otherwise(F.replace(guard(x), F.lit(","), F.lit(_SEP))),
        )
        fields = F.transform(F.split(F.array_join(pieces, ""), _SEP), unguard)
        ok = (n % 2 == 1) & ~bad
        return F.struct(ok.alias("ok"), F.when(ok, fields).alias("fields"))

    return let(F.split(F.regexp_replace(raw, r"[\r\n]+\z", ""), '"'), body)


def load(df: DataFrame, id_col: str, raw_col: str, columns: Sequence[str] = INTAKE_COLUMNS, rules: Sequence[Rule] | None = None, keep: Sequence[str] = ()) -> Loaded:
    """Split ``df`` into valid rows, failed records (id, record, reason, errors) and single errors."""
    rules = list(intake_rules() if rules is None else rules)
    spark = df.sparkSession
    raw = (
        spread(df.select(F.col(id_col).alias("__id"), F.col(raw_col).alias("__raw"), *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keep)]), "__raw")
        .filter(~is_blank(F.col("__raw")))
    )
    parsed = raw.withColumn("__p", parse_record(F.col("__raw")))
    ruled = [c for c in columns if any(r.column == c for r in rules)]
    cell = lambda c, v: F.struct(F.lit(c).alias("column"), v.alias("value"))
    fields = F.col("__p.fields")
    cells = (
        F.when(~F.col("__p.ok"), F.array(cell(RECORD, F.lit("quoting"))))
        .when(F.size(fields) != len(columns), F.array(cell(RECORD, F.lit("column_count"))))
        .otherwise(F.array(cell(RECORD, F.lit("")), *[cell(c, fields[list(columns).index(c)]) for c in ruled]))
    )
    table = spark.createDataFrame([(r.column, i, r.name, r.reason, r.precedence) for i, r in enumerate(rules)], "column string, rule int, rule_name string, reason string, precedence int")
    verdict = F.lit(False)
    for i, r in enumerate(rules):
        verdict = F.when(F.col("rule") == i, r.fails(F.col("value"))).otherwise(verdict)
    errors = (
        parsed.select("__id", "__raw", F.explode(cells).alias("c"))
        .select("__id", "__raw", "c.column", "c.value")
        .join(F.broadcast(table), "column")  # the rule table is a parameter of a few rows
        .filter(verdict)
    )
    # a record's key is its id and 128 bits of its text; only failing records are shuffled for it
    key = [F.xxhash64("__raw").alias("__h1"), F.xxhash64(F.lit(1), F.col("__raw")).alias("__h2")]
    failed = errors.select("*", *key).groupBy("__id", "__h1", "__h2").agg(
        F.first("__raw").alias("__raw"),
        F.min_by("reason", "precedence").alias("reason"),
        F.array_sort(F.collect_set(F.concat_ws(":", "column", "rule_name"))).alias("failed_rules"),
    )
    gone = failed.select(F.col("__id").alias("__fid"), F.col("__h1").alias("__f1"), F.col("__h2").alias("__f2"))
    same = F.col("__id").eqNullSafe(F.col("__fid")) & (F.col("__h1") == F.col("__f1")) & (F.col("__h2") == F.col("__f2"))
    # records are joined as they are stored and parsed afterwards, so no text is shuffled twice
    clean = raw.select("*", *key).join(gone, same, "left_anti").withColumn("__p", parse_record(F.col("__raw")))
    kept = [F.col(f"__k{i}").alias(f"{k}_src" if k in columns or k == id_col else k) for i, k in enumerate(keep)]
    ident = f"{id_col}_src" if id_col in columns else id_col
    valid = clean.select(F.col("__id").alias(ident), *kept, *[fields[i].alias(c) for i, c in enumerate(columns)])
    # parsed rows with equal id and text stay separate; a failed record is one row per (id, text)
    return Loaded(
        valid=valid,
        failed=failed.select(F.col("__id").alias(id_col), F.col("__raw").alias("raw_record"), "reason", "failed_rules"),
        errors=errors.select(F.col("__id").alias(id_col), "column", "value", "rule_name", "reason"),
    )
