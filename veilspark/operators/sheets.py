"""Combining the sheets of a workbook: joins, unions, concatenation, and taking them apart again.

Cells are text and a missing cell is ``""``, so empty keys match each other. Row order
is data: ``__row`` holds the row numbers a row came from, and orders as an array.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilspark.plans.errors import RunError
from veilspark.session import cut

ROW = "__row"
LAST = 2**62
HOW = ("inner", "left", "right", "outer", "cross")


@dataclass(frozen=True)
class Sheet:
    """A named table; ``origin`` says of each column which sheet and column it came from."""

    name: str
    df: DataFrame
    origin: Mapping[str, tuple[str, str]] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [c for c in self.df.columns if c != ROW]

    def source(self, column: str) -> tuple[str, str]:
        return self.origin.get(column, (self.name, column))


@dataclass(frozen=True)
class Join:
    left: str
    right: str
    on: tuple[str, ...]
    how: str = "left"


def parse_joins(section: Sequence) -> list[Join]:
    """The ``sheet_joins`` of a configuration."""
    out = []
    for i, e in enumerate(section or [], 1):
        if not isinstance(e, Mapping) or not isinstance(e.get("left"), str) or not isinstance(e.get("right"), str):
            raise RunError("CONFIG_INVALID_VALUE", "a sheet join needs left and right", f"step {i}")
        on = e.get("on")
        on = [on] if isinstance(on, str) else on
        if not isinstance(on, list) or not on or any(not isinstance(x, str) for x in on):
            raise RunError("CONFIG_INVALID_VALUE", "a sheet join needs the columns of 'on'", f"step {i}")
        how = str(e.get("how", "left")).lower()
        if how not in HOW:
            raise RunError("CONFIG_INVALID_VALUE", "unknown kind of sheet join", f"step {i}: {how}")
        out.append(Join(e["left"], e["right"], tuple(on), how))
    return out


def join(left: Sheet, right: Sheet, on: Sequence[str], how: str = "left") -> Sheet:
    """Equi-join of two sheets; equal names other than keys get ``_x`` and ``_y``.

    The cross join (the one kind whose result is all pairs) is the user's own request.
    """
    for s in (left, right):
        if gone := [c for c in on if c not in s.columns]:
            raise RunError("DATA_COLUMN_MISSING", "a join column is not in a sheet", f"{s.name}: {gone[0]}")
    keys = [] if how == "cross" else list(on)
    shared = (set(left.columns) & set(right.columns)) - set(keys)
    new_l = {c: f"{c}_x" if c in shared else c for c in left.columns}
    new_r = {c: f"{c}_y" if c in shared else c for c in right.columns if c not in keys}
    a = left.df.select(*[F.col(f"`{c}`").alias(new_l[c]) for c in left.columns], F.col(ROW).alias("__l"))
    b = right.df.select(*[F.col(f"`{c}`").alias(f"__k{keys.index(c)}" if c in keys else new_r[c]) for c in right.columns], F.col(ROW).alias("__r"))
    if how == "cross":
        both = a.crossJoin(b)
    else:
        match = reduce(lambda x, y: x & y, [F.col(f"`{k}`") == F.col(f"__k{i}") for i, k in enumerate(keys)])
        both = a.join(b, match, "full" if how == "outer" else how)
    text = lambda c: F.coalesce(F.col(f"`{c}`"), F.lit(""))
    columns = [(F.coalesce(F.col(f"`{c}`"), F.col(f"__k{keys.index(c)}"), F.lit("")) if c in keys else text(new_l[c])).alias(new_l[c]) for c in left.columns]
    columns += [text(n).alias(n) for n in new_r.values()]
    order = F.concat(F.coalesce("__l", F.array(F.lit(LAST))), F.coalesce("__r", F.array().cast("array<bigint>")))
    origin = {new_l[c]: left.source(c) for c in left.columns} | {n: right.source(c) for c, n in new_r.items()}
    return Sheet(left.name, both.select(*columns, order.alias(ROW)), origin)


def chain(sheets: Sequence[Sheet], steps: Sequence[Join]) -> Sheet:
    """Joins one after the other; each result takes the place of its left sheet, the first left sheet is the result."""
    at = {s.name: s for s in sheets}
    for i, j in enumerate(steps, 1):
        for n in (j.left, j.right):
            if n not in at:
                raise RunError("DATA_XLSX_INVALID", "a sheet join names an unknown sheet", f"step {i}: {n}")
        at[j.left] = join(at[j.left], at[j.right], j.on, j.how)
    return at[steps[0].left]


def numbered(df: DataFrame, order: str = ROW) -> DataFrame:
    """``df`` with ``__at``: the dense place of each row in the order, without one task seeing all rows."""
    sorted_parts = cut(df.repartitionByRange(order).sortWithinPartitions(order).withColumn("__id", F.monotonically_increasing_id()))
    counts = dict(sorted_parts.groupBy(F.shiftright("__id", 33).alias("p")).count().collect())  # one row per partition
    offsets, run = [], 0
    for p in sorted(counts):
        offsets += [F.lit(p), F.lit(run)]
        run += counts[p]
    if not offsets:
        return df.withColumn("__at", F.lit(0).cast("bigint"))
    place = F.element_at(F.create_map(*offsets), F.shiftright("__id", 33)) + F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    return sorted_parts.withColumn("__at", place.cast("bigint")).drop("__id")


def beside(left: Sheet, right: Sheet) -> Sheet:
    """Two sheets side by side by row number, the shorter one filled with ``""``."""
    a, b = numbered(left.df).drop(ROW), numbered(right.df).drop(ROW).withColumnRenamed("__at", "__at2")
    both = a.join(b, F.col("__at") == F.col("__at2"), "full")
    text = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in (*left.columns, *right.columns)]
    return Sheet(left.name, both.select(*text, F.array(F.coalesce("__at", "__at2")).alias(ROW)))


def below(sheets: Sequence[Sheet]) -> Sheet:
    """All rows of sheets with the same columns, in the first one's order of columns."""
    columns = sheets[0].columns
    parts = [s.df.select(*[f"`{c}`" for c in columns], F.concat(F.array(F.lit(i).cast("bigint")), F.col(ROW)).alias(ROW)) for i, s in enumerate(sheets)]
    return Sheet(sheets[0].name, reduce(lambda x, y: x.unionByName(y), parts))


def auto_join(sheets: Sequence[Sheet]) -> Sheet:
    """Left joins on all shared names, one after the other; side by side where none is shared."""
    out = sheets[0]
    for s in sheets[1:]:
        shared = [c for c in out.columns if c in set(s.columns)]
        out = join(out, s, shared) if shared else beside(out, s)
    return out


def combine(sheets: Sequence[Sheet], steps: Sequence[Join] = ()) -> tuple[Sheet, dict[str, list[tuple[str, str]]] | None]:
    """One table out of all sheets, and how to take it apart (only for named joins)."""
    if len(sheets) == 1:
        return sheets[0], None
    if steps:
        merged = chain(sheets, steps)
        plan: dict[str, list[tuple[str, str]]] = {s.name: [] for s in sheets}
        for c in merged.columns:
            sheet, original = merged.source(c)
            plan[sheet].append((c, original))
        for j in steps:  # the keys stand once in the table but belong to both sheets
            if j.how != "cross":
                here = {o for _, o in plan[j.right]}
                plan[j.right] = [(c, k) for k in j.on for c, o in plan[j.left] if o == k and k not in here] + plan[j.right]
        return merged, {s: cols for s, cols in plan.items() if cols}
    if all(set(s.columns) == set(sheets[0].columns) for s in sheets):
        return below(sheets), None
    return auto_join(sheets), None


def restore(df: DataFrame, plan: Mapping[str, Sequence[tuple[str, str]]]) -> dict[str, DataFrame]:
    """The sheets again: their columns under their own names, each row once, in order of first place."""
    out = {}
    for sheet, columns in plan.items():
        there = [(c, o) for c, o in columns if c in df.columns]
        if there:
            part = df.select(*[F.col(f"`{c}`").alias(o) for c, o in there], ROW)
            out[sheet] = part.groupBy(*[f"`{o}`" for _, o in there]).agg(F.min(ROW).alias(ROW))
    return out
