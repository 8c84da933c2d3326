"""Masking of characters, of regular-expression matches, and by character class."""
from __future__ import annotations

import os
import re
from collections.abc import Mapping
from dataclasses import dataclass
from functools import lru_cache

import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from veilspark.plans.errors import RunError

STEPS = ("characters", "regex", "class")


@dataclass(frozen=True)
class Pattern:
    """One regular expression of a mask, given or derived from delimiters."""

    expression: str
    derived: bool
    char: str
    kind: str = ""
    delimiter: str = ""
    length: int | None = None
    groups: tuple[tuple[int, str], ...] = ()


@dataclass(frozen=True)
class Mask:
    column: str
    char: str = "*"
    positions: tuple[int, ...] = ()
    patterns: tuple[Pattern, ...] = ()
    order: tuple[str, ...] = STEPS
    class_mode: str | None = None
    letter: str = "X"
    digit: str = "0"

    @property
    def built_in(self) -> bool:
        """Whether Spark's own functions can do it all."""
        return not self.patterns and self.class_mode != "random_class" and not (self.class_mode == "fixed_class" and class_of(self.letter) == "digit")


def derive(kind: str, delimiter: str = "", start: str = "", end: str = "") -> str:
    """The expression whose first group is before or after a delimiter, or between two."""
    q = re.escape
    if kind == "before" and delimiter:
        return f"^(.+?){q(delimiter)}"
    if kind == "after" and delimiter:
        return f"{q(delimiter)}(.+)$"
    if kind == "in_between" and start and end:
        return f"{q(start)}(.+)$" if end == "$" else f"{q(start)}(.+?){q(end)}"
    return ""


def compiled(expression: str) -> re.Pattern:
    """Compile without look-around and back-references; ``$`` is the very end of the text."""
    if re.search(r"(?<!\\)\(\?(?:[=!]|<[=!]|P=|\()|(?<!\\)(?:\\\\)*\\[1-9]", expression):
        raise re.error("look-around and back-references are not supported")
    whole, in_class, escaped = "", False, False
    for c in expression:
        whole += r"\Z" if c == "$" and not in_class and not escaped else c
        in_class = in_class if escaped else c == "[" or (in_class and c != "]")
        escaped = c == "\\" and not escaped
    return re.compile(whole)


def parse(entry: Mapping) -> Mask:
    """A mask of the configuration; one that would mask nothing is refused."""

    def bad(message: str, details: str = "") -> RunError:
        return RunError("PREPROCESS_CONFIG_INVALID", message, details or str(entry.get("column", "")))

    column = entry.get("column")
    if not isinstance(column, str) or not column:
        raise bad("a mask needs a column")
    char = entry.get("masking_char", "*")
    if not isinstance(char, str) or not char:
        raise bad("masking_char must not be empty", column)
    positions = entry.get("characters_to_mask") or []
    if any(not isinstance(p, int) or isinstance(p, bool) for p in positions):
        raise bad("characters_to_mask must be whole numbers", column)
    order = tuple(entry.get("apply_order") or STEPS)
    patterns = []
    for p in entry.get("regex_patterns") or []:
        if not isinstance(p, Mapping):
            raise bad("a regex pattern must be an object", column)
        kind, delimiter = str(p.get("type") or "").lower(), p.get("delimiter") or ""
        derived = derive(kind, delimiter, p.get("start") or "", p.get("end") or "")
        given = p.get("regex")
        for expression, is_derived in ((given, False), (derived, True)):
            try:
                if expression:
                    compiled(expression)
                    break
            except re.error:
                continue
        else:
            raise bad("a regex pattern cannot be used", column)
        groups = tuple(sorted((int(k), v) for k, v in (p.get("mask_groups") or {}).items() if str(k).isdigit() and isinstance(v, str)))
        length = p.get("length")
        patterns.append(Pattern(expression, is_derived, (p.get("masking_char") or char)[0], kind, delimiter, None if length is None else max(0, int(length)), groups))
    mode = entry.get("class_masking_mode")
    on = {"characters": any(p > 0 for p in positions), "regex": bool(patterns), "class": mode is not None}
    if unknown := [s for s in order if s not in STEPS]:
        raise bad("unknown masking step", f"{column}: {unknown[0]}")
    if not any(on.values()):
        raise bad("a mask names no step", column)
    if left_out := [s for s, o in on.items() if o and s not in order]:
        raise bad("a configured step is missing from apply_order", f"{column}: {left_out[0]}")
    if mode not in (None, "random_class", "fixed_class"):
        raise bad("unknown class_masking_mode", f"{column}: {mode}")
    return Mask(column, char[0], tuple(p for p in positions if p > 0), tuple(patterns), order, mode, (entry.get("class_mask_letter") or "X")[0], (entry.get("class_mask_digit") or "0")[0])


def masked_column(c: Column, m: Mask) -> Column:
    """The mask as built-in expressions (only where ``m.built_in``)."""
    for step in m.order:
        if step == "characters":
            for p in sorted(set(m.positions)):
                c = F.when(F.length(c) >= p, F.overlay(c, F.lit(m.char), F.lit(p), F.lit(1))).otherwise(c)
        elif step == "class" and m.class_mode == "fixed_class":
            c = F.regexp_replace(F.regexp_replace(c, r"[\p{IsAlphabetic}&&[^\p{N}]]", m.letter.replace("\\", r"\\").replace("$", r"\$")), r"\p{N}", m.digit.replace("\\", r"\\").replace("$", r"\$"))
    return c


def _by_delimiter(value: str, p: Pattern) -> str:
    """``length`` characters before or after every delimiter."""
    chars, at = list(value), value.find(p.delimiter)
    while at >= 0:
        lo, hi = (at + len(p.delimiter), at + len(p.delimiter) + p.length) if p.kind == "after" else (max(0, at - p.length), at)
        for i in range(lo, min(hi, len(chars))):
            chars[i] = p.char
        at = value.find(p.delimiter, at + len(p.delimiter))
    return "".join(chars)


def by_pattern(value: str, p: Pattern) -> str:
    """One pattern; groups are masked at their own place in the text."""
    if p.length and p.delimiter and p.kind in ("before", "after") and p.delimiter in value:
        changed = _by_delimiter(value, p)
        if changed != value:
            return changed
    groups = p.groups or (((1, "full"),) if p.derived else ((0, "full"),))

    def one(m: re.Match) -> str:
        chars = list(m.group())
        for g, mode in groups:
            if g > m.re.groups or m.start(g) < 0:
                continue
            lo, hi = m.start(g) - m.start(), m.end(g) - m.start()
            lo += mode == "partial"
            if mode in ("full", "partial"):
                chars[lo:hi] = p.char * max(0, hi - lo)
        return "".join(chars)

    return compiled(p.expression).sub(one, value)


@lru_cache(maxsize=1 << 16)
def class_of(c: str) -> str:
    """``digit``, ``upper``, ``letter`` or nothing: the Unicode properties Number, Uppercase and Alphabetic.

    Alphabetic holds vowel signs and other marks, so nothing of a word in any script is
    left; the built-in expression of :func:`masked_column` uses the same properties.
    """
    return next((name for name, p in _CLASSES if p.match(c)), "")


_CLASSES = [("digit", regex.compile(r"\p{N}")), ("upper", regex.compile(r"[\p{Alphabetic}&&\p{Uppercase}]", regex.V1)), ("letter", regex.compile(r"\p{Alphabetic}"))]


def cloak(value: str) -> str:
    """Each letter or digit as a random ASCII one of its class, from the system's generator."""
    out = []
    for c in value:
        # rejection keeps the draw even
        size, base = {"digit": (10, 48), "upper": (26, 65), "letter": (26, 97)}.get(class_of(c), (0, 0))
        if not size:
            out.append(c)
            continue
        while (b := os.urandom(1)[0]) >= 256 - 256 % size:
            pass
        out.append(chr(base + b % size))
    return "".join(out)


def masked(value: str, m: Mask) -> str:
    """The whole mask of one value, in the configured order."""
    for step in m.order:
        if step == "characters":
            chars = list(value)
            for p in m.positions:
                if p <= len(chars):
                    chars[p - 1] = m.char
            value = "".join(chars)
        elif step == "regex":
            for p in m.patterns:
                value = by_pattern(value, p)
        elif step == "class" and m.class_mode == "random_class":
            value = cloak(value)
        elif step == "class" and m.class_mode == "fixed_class":
            put = {"digit": m.digit, "upper": m.letter, "letter": m.letter}
            value = "".join(put.get(class_of(c), c) for c in value)
    return value
