"""Text expressions that stay on the JVM."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space, as a Java character class body.
WS = r"\t\n\x0B\f\r\x1C-\x1F \x85\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
#: Characters that render as nothing (default ignorable code points), as a class body.
INVISIBLE = (
    r"\x{AD}\x{34F}\x{61C}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180F}\x{200B}-\x{200F}"
    r"\x{202A}-\x{202E}\x{2060}-\x{206F}\x{3164}\x{FE00}-\x{FE0F}\x{FEFF}\x{FFA0}\x{FFF0}-\x{FFF8}"
    r"\x{1BCA0}-\x{1BCA3}\x{1D173}-\x{1D17A}\x{E0000}-\x{E0FFF}"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it many times inside ``body``.

    A projection that is merged into a lambda would be evaluated per element; a
    one-element ``transform`` binds it instead.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def trim_unicode(c: Column) -> Column:
    """Strip Unicode white space at both ends."""
    return F.regexp_replace(c, f"^[{WS}]+|[{WS}]+$", "")


def is_blank(c: Column) -> Column:
    """True for null, empty and white-space-only text."""
    return c.isNull() | F.regexp_like(c, F.lit(f"^[{WS}]*$"))


def _compose(c: Column, compat: bool) -> Column:
    return F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(compat))


def nfc(c: Column) -> Column:
    """Unicode NFC by the ICU library that Spark ships; no Python worker.

    Text below U+0300 is always in NFC and is passed through.
    """
    return F.when(F.regexp_like(c, F.lit(r"[^\x{0}-\x{2FF}]")), _compose(c, False)).otherwise(c)


def nfkc(c: Column) -> Column:
    """Unicode NFKC (compatibility forms folded); ASCII is passed through."""
    return F.when(F.regexp_like(c, F.lit(r"[^\x{0}-\x{7F}]")), _compose(c, True)).otherwise(c)


def nfkd(c: Column) -> Column:
    """Unicode NFKD (compatibility forms folded, accents apart); ASCII is passed through."""
    apart = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("decompose"), c, F.lit(True))
    return F.when(F.regexp_like(c, F.lit(r"[^\x{0}-\x{7F}]")), apart).otherwise(c)
