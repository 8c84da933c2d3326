"""Quasi-identifiers: how a cell becomes a coordinate, and a coordinate a bin at each level.

A quasi-identifier is described on the driver and compiled to Column expressions.
Uniform numeric ones have bin widths as levels, interval and categorical ones have
levels 1 (finest) to n. Coordinate -1 stands for "no bin" and is published as ``*``.
"""
from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilspark.functions.text import nfc, trim_unicode
from veilspark.plans.errors import RunError

#: Largest whole number that a double holds exactly.
EXACT = 2**53
#: Up to this many distinct values are looked up in the expression, beyond it they are joined.
INLINE = 256

Ladders = Mapping[str, Mapping[str, Sequence[str]]]


def _rounded(d: Column) -> Column:
    """A double as a whole number, half away from zero; exact, since the fraction of a double is."""
    a = F.abs(d)
    whole = F.floor(a)
    up = whole + F.when(a - whole >= 0.5, 1).otherwise(0)
    return F.when(a <= EXACT, F.when(d < 0, -up).otherwise(up).cast("bigint"))


def number(c: Column, kind: str = "string") -> Column:
    """The whole number of a numeric quasi-identifier cell, or null.

    Trimmed, parsed as a finite decimal number, rounded half away from zero, at most
    2^53 in size. Forms that only some parsers take (``1d``, ``0x1``, ``1_0``) are none.
    Columns of a numeric type (``kind``) are taken as they are.
    """
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.when(F.abs(c.cast("bigint")) <= EXACT, c.cast("bigint"))
    if kind in ("float", "double") or kind.startswith("decimal"):
        d = c.cast("double")
        return F.when(~F.isnan(d), _rounded(d))
    # digits, signs, point and exponent only: what Java parses of these is a decimal number
    plain = F.lit(r"\A[0-9.eE+-]+\z")
    text = c.cast("string")
    trimmed = trim_unicode(text)
    return _rounded(F.when(F.regexp_like(text, plain), text.try_cast("double")).when(F.regexp_like(trimmed, plain), trimmed.try_cast("double")))


def category(c: Column) -> Column:
    """The compared form of a categorical cell: trimmed, NFC; null is the empty text."""
    return F.coalesce(nfc(trim_unicode(c.cast("string"))), F.lit(""))


@dataclass(frozen=True)
class Intervals:
    """Levels of intervals: ``levels[0]`` is the finest, ``up[fine][level]`` the place above."""

    levels: tuple[tuple[tuple[int, int], ...], ...]
    up: tuple[tuple[int, ...], ...]

    @property
    def depth(self) -> int:
        return len(self.levels)


def _checked(intervals: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    out = sorted((int(f), int(t)) for f, t in intervals)
    if any(f > t for f, t in out) or any(a[1] >= b[0] for a, b in zip(out, out[1:])):
        raise RunError("CONFIG_INVALID_VALUE", "intervals overlap or end before they begin", str(out[:3]))
    return out


def fixed_intervals(intervals: Sequence[tuple[int, int]]) -> Intervals:
    """One level that is never coarsened."""
    level = _checked(intervals)
    return Intervals((tuple(level),), tuple((i,) for i in range(len(level))))


def interval_levels(intervals: Sequence[tuple[int, int]], parts: int = 2) -> Intervals:
    """Refine the coarse intervals ``floor(log(min width) / log(parts))`` times.

    Each step splits an interval into ``parts``; the last part takes the remainder
    and intervals narrower than ``parts`` stay.
    """
    n = max(2, int(parts))
    coarse = _checked(intervals)
    narrow = min((t - f + 1 for f, t in coarse), default=1)
    # the logarithms are those of doubles on purpose: 1000 in parts of 10 gives 2 steps
    steps = 0 if narrow < n else math.floor(math.log(narrow) / math.log(n))
    levels = [coarse]
    for _ in range(steps):
        finer = []
        for f, t in levels[-1]:
            width = t - f + 1
            if width < n:
                finer.append((f, t))
                continue
            part = width // n
            edges = [f + i * part for i in range(n)]
            finer += [(a, b - 1) for a, b in zip(edges, edges[1:])] + [(edges[-1], t)]
        levels.append(finer)
    levels.reverse()
    begins = [[f for f, _ in lv] for lv in levels]
    up = tuple(tuple(max(0, bisect_right(b, f) - 1) for b in begins) for f, _ in levels[0])
    return Intervals(tuple(map(tuple, levels)), up)


def ladder_label(ladder: Mapping[str, Sequence[str]] | None, value: str, level: int) -> str:
    """What a value is published as at a level of its ladder (level 1 is the value)."""
    if level <= 1:
        return value
    rungs = (ladder or {}).get(value, (ladder or {}).get("*"))
    return rungs[level - 2] if rungs is not None and level - 2 < len(rungs) else "*"


def ladder_of(ladders: Ladders, column: str) -> Mapping[str, Sequence[str]] | None:
    """A column's ladder; the names of ladders are matched without case."""
    return next((v for k, v in ladders.items() if k.lower() == column.lower()), None)


@dataclass(frozen=True)
class QI:
    """One quasi-identifier; ``bound`` fills what depends on the data."""

    name: str
    kind: str  # uniform, interval or category
    factor: int = 2
    low: int = 0
    high: int = 0
    intervals: Intervals | None = None
    ladder: Mapping[str, Sequence[str]] | None = None
    domain: tuple[str, ...] = ()
    dtype: str = "string"
    groups: tuple[tuple[int, ...], ...] = field(default=())  # groups[level - 1][domain place]
    labels: tuple[tuple[str, ...], ...] = field(default=())

    @property
    def span(self) -> int:
        return max(1, self.high - self.low + 1)

    @property
    def top(self) -> int:
        """The coarsest level (for uniform bins the whole range as one width)."""
        return self.span if self.kind == "uniform" else self.intervals.depth if self.kind == "interval" else max(1, len(self.groups))

    def next_level(self, level: int) -> int | None:
        if self.kind == "uniform":
            if self.factor < 1:
                raise RunError("CONFIG_INVALID_VALUE", "size factors start at 1", self.name)
            coarser = min(level * self.factor, self.span)
            return coarser if coarser > level else None
        return level + 1 if level < self.top else None

    def chain(self, start: int = 1) -> list[int]:
        out = [start]
        while (n := self.next_level(out[-1])) is not None:
            out.append(n)
        return out

    def bins(self, level: int) -> int:
        """How many bins a level has at most."""
        if self.kind == "uniform":
            return -(-self.span // max(1, level))
        at = min(max(1, level), self.top)
        return len(self.intervals.levels[at - 1]) if self.kind == "interval" else max(self.groups[at - 1], default=0) + 1 if self.groups else 1

    def with_domain(self, domain: Sequence[str]) -> QI:
        """Fill the levels of a categorical one from its sorted distinct values.

        Redundant top levels are dropped; a ladder whose levels do not nest is refused.
        """
        values = tuple(sorted(domain))
        depth = max((len(r) for r in (self.ladder or {}).values()), default=0) + 2
        labels = [[ladder_label(self.ladder, v, lv) for v in values] for lv in range(1, depth + 1)]
        groups = []
        for row in labels:
            seen: dict[str, int] = {}
            groups.append(tuple(seen.setdefault(x, len(seen)) for x in row))
        while len(groups) > 1 and groups[-1] == groups[-2]:
            groups.pop()
            labels.pop()
        for lower, upper in zip(groups, groups[1:]):
            to: dict[int, int] = {}
            for a, b in zip(lower, upper):
                if to.setdefault(a, b) != b:
                    raise RunError("CONFIG_INVALID_VALUE", "the levels of a categorical hierarchy do not nest", self.name)
        return replace(self, domain=values, groups=tuple(groups), labels=tuple(map(tuple, labels)))

    # Column expressions

    def cell(self) -> Column:
        """The compared value of a row: a whole number or a category."""
        c = F.col(f"`{self.name}`")
        return category(c) if self.kind == "category" else number(c, self.dtype)

    def fine(self, v: Column) -> Column:
        """The base coordinate of a compared number (categories are placed by :func:`placed`)."""
        if self.kind == "uniform":
            return F.coalesce(v - F.lit(self.low).cast("bigint"), F.lit(-1).cast("bigint"))
        bins = F.array(*[F.struct(F.lit(f).cast("bigint").alias("f"), F.lit(t).cast("bigint").alias("t"), F.lit(i).cast("bigint").alias("i")) for i, (f, t) in enumerate(self.intervals.levels[0])])
        return F.coalesce(F.get(F.filter(bins, lambda b: (b["f"] <= v) & (v <= b["t"])), 0)["i"], F.lit(-1).cast("bigint"))

    def coarse(self, u: Column, level: Column) -> Column:
        """The bin of a base coordinate at a level given as a Column."""
        if self.kind == "uniform":
            return F.when(u < 0, F.lit(-1).cast("bigint")).otherwise(F.floor(u / level).cast("bigint") if self.span > EXACT else ((u - u % level) / level).cast("bigint"))
        table = self.intervals.up if self.kind == "interval" else tuple(zip(*self.groups)) if self.groups else ()
        if not table:
            return F.lit(-1).cast("bigint")
        flat = F.array(*[F.lit(x).cast("bigint") for row in table for x in row])
        return F.when(u < 0, F.lit(-1).cast("bigint")).otherwise(F.get(flat, (u * len(table[0]) + level - 1).cast("int")))

    def label(self, level: int) -> Column:
        """What a row is published as at a level."""
        v = self.cell()
        if self.kind == "category":
            if level <= 1:
                return v
            rows = {k: ladder_label(self.ladder, k, level) for k in (self.ladder or {})}
            miss = F.lit(ladder_label(self.ladder, "*", level))
            known = [(k, x) for k, x in rows.items() if k != "*"]
            if not known:
                return miss
            return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in known for x in kv]), v), miss)
        if self.kind == "uniform":
            w = max(1, level)
            start = v - F.pmod(v - F.lit(self.low), F.lit(w))
            return F.when(v.isNull(), F.lit("*")).otherwise(F.concat(F.lit("["), start.cast("string"), F.lit("-"), (start + (w - 1)).cast("string"), F.lit("]")))
        level_bins = self.intervals.levels[min(max(1, level), self.top) - 1]
        text = [f"[{f}]" if f == t else f"[{f}-{t}]" for f, t in level_bins]
        bins = F.array(*[F.struct(F.lit(f).cast("bigint").alias("f"), F.lit(t).cast("bigint").alias("t"), F.lit(x).alias("x")) for (f, t), x in zip(level_bins, text)])
        return F.coalesce(F.get(F.filter(bins, lambda b: (b["f"] <= v) & (v <= b["t"])), 0)["x"], F.lit("*"))


def uniform(name: str, factor: int = 2) -> QI:
    return QI(name, "uniform", factor=factor)


def interval(name: str, intervals: Sequence[tuple[int, int]], parts: int = 2) -> QI:
    return QI(name, "interval", intervals=interval_levels(intervals, parts))


def fixed(name: str, intervals: Sequence[tuple[int, int]]) -> QI:
    return QI(name, "interval", intervals=fixed_intervals(intervals))


def categorical(name: str, ladders: Ladders | None = None) -> QI:
    return QI(name, "category", ladder=ladder_of(ladders or {}, name))


def typed(df: DataFrame, qis: Sequence[QI]) -> list[QI]:
    """The quasi-identifiers with the types of their columns."""
    if not qis:
        raise RunError("ANON_NO_QIS", "no quasi-identifiers are named")
    missing = [q.name for q in qis if q.name not in df.columns]
    if missing:
        raise RunError("DATA_COLUMN_MISSING", "a quasi-identifier is not in the header", missing[0])
    return [replace(q, dtype=df.schema[q.name].dataType.simpleString()) for q in qis]


def value_counts(df: DataFrame, qis: Sequence[QI]) -> DataFrame:
    """``(v0 … vn, n)``: rows per combination of compared values; the one pass over the rows."""
    return df.select(*[q.cell().alias(f"v{i}") for i, q in enumerate(qis)]).groupBy(*[f"v{i}" for i in range(len(qis))]).agg(F.count("*").alias("n"))


def domains(counts: DataFrame, qis: Sequence[QI]) -> DataFrame:
    """``(column_name, value)``: the distinct values of the categorical ones, from the counts."""
    cells = F.array(*[F.struct(F.lit(q.name).alias("column_name"), F.col(f"v{i}").alias("value")) for i, q in enumerate(qis) if q.kind == "category"])
    return counts.select(F.explode(cells).alias("c")).select("c.*").distinct()


#: A categorical quasi-identifier with more distinct values than this is refused.
MAX_DOMAIN = 100_000


def bind(df: DataFrame, qis: Sequence[QI]) -> tuple[list[QI], int]:
    """The quasi-identifiers with ranges and domains of the data, and the number of rows.

    One pass with sums on the map side: rows, least and largest numbers per combination of
    the categorical values, so numbers that are nearly all different shuffle nothing.
    """
    qis = typed(df, qis)
    numeric = [i for i, q in enumerate(qis) if q.kind != "category"]
    cells = df.select(*[q.cell().alias(f"v{i}") for i, q in enumerate(qis)])
    per = cells.groupBy(*[f"v{i}" for i in range(len(qis)) if i not in numeric]).agg(F.count("*").alias("n"), *[f(f"v{i}").alias(f"{p}{i}") for i in numeric for p, f in (("lo", F.min), ("hi", F.max))]).persist()
    found = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), *[f(f"{p}{i}").alias(f"{p}{i}") for i in numeric for p, f in (("lo", F.min), ("hi", F.max))]).first()
    bound = [replace(q, low=found[f"lo{i}"] or 0, high=found[f"hi{i}"] or 0) if q.kind == "uniform" else q for i, q in enumerate(qis)]
    try:
        if any(q.kind == "category" for q in bound):
            values: dict[str, list[str]] = {q.name: [] for q in bound if q.kind == "category"}
            for c, v in domains(per, bound).limit(MAX_DOMAIN * len(values) + 1).collect():
                values[c].append(v)
            if any(len(v) > MAX_DOMAIN for v in values.values()):
                raise RunError("LATTICE_TOO_LARGE", "a categorical quasi-identifier has too many distinct values", max(values, key=lambda c: len(values[c])))
            bound = [q.with_domain(values[q.name]) if q.kind == "category" else q for q in bound]
    finally:
        per.unpersist()
    return bound, found["n"]
