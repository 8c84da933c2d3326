"""Repetition and other quality ratios of single documents, in one projection.

A threshold table (metric, comparison, limit) is compiled into one Spark projection
of length, symbol, stop-word, line and repetition ratios. No user function: all ratios
of a document are computed in its own row, without a shuffle (but for an input of fewer
splits than cores, which is spread first). The repeated share
sorts the hashes of the document's 8-word runs, so it takes n log n of its words.

Defined results: null and empty texts have 0 words, share 0 and ratios 0; fewer than
eight words give share 0; texts of any length are taken whole; repeated rows give
repeated results; an empty table gives an empty result; other columns are carried.
Runs are compared by 64-bit hashes within one document.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilspark.functions.text import WS, let
from veilspark.session import spread

# Frequent function words of the five languages of the collection.
STOP_WORDS = (
    "the a an and or of to in on for with is was were be by at as it that this from not "
    "und der die das ist mit ein eine zu den von im nicht "
    "le la les et de des un une est dans pour que à du "
    "el los las y en del una es por con se al "
    "है का की के में और को से पर यह ने था थी"
).split()


@dataclass(frozen=True)
class Threshold:
    """One row of the threshold table: the text is marked ``name`` when the comparison holds."""

    name: str
    metric: str
    compare: str
    limit: float


THRESHOLDS = (
    Threshold("repeated", "repeated_share", ">=", 0.4),
    Threshold("short", "n_words", "<", 5),
    Threshold("symbols", "symbol_ratio", ">", 0.1),
    Threshold("few_stop_words", "stop_word_ratio", "<", 0.02),
    Threshold("repeated_lines", "repeated_line_ratio", ">", 0.3),
)


def words_of(text: Column) -> Column:
    """Words parted by white space, lower case, punctuation dropped."""
    bare = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"\p{P}+", "")
    return F.filter(F.split(bare, f"[{WS}]+"), lambda w: w != "")


def repeated_share(words: Column, run: int = 8) -> Column:
    """Share of words lying in a run of ``run`` words that also starts earlier in the text."""

    def body(w: Column) -> Column:
        n = F.size(w)
        # the hashed runs, in the order of hash and place: a run equal to its predecessor occurs earlier
        runs = F.array_sort(F.transform(F.sequence(F.lit(0), n - run), lambda i: F.struct(F.xxhash64(F.slice(w, i + 1, run)).alias("h"), i.alias("p"))))
        again = let(runs, lambda s: F.array_sort(F.filter(F.transform(s, lambda x, i: F.when(i > 0, F.when(s[i - 1]["h"] == x["h"], x["p"]))), lambda p: p.isNotNull())))
        covered = let(again, lambda q: F.aggregate(F.transform(q, lambda p, i: F.when(i == F.size(q) - 1, run).otherwise(F.least(F.lit(run), F.get(q, i + 1) - p))), F.lit(0), lambda acc, x: acc + x))
        return F.when(n < run, F.lit(0.0)).otherwise(covered / n)

    return let(words, body)


def metrics(text: Column, words: Column) -> dict[str, Column]:
    """The ratios a threshold may name, each a built-in expression over the text and its words."""
    t = F.coalesce(text, F.lit(""))
    chars = F.length(t)
    lines = F.filter(F.transform(F.split(t, r"\r\n|\r|\n"), lambda x: F.trim(x)), lambda x: x != "")
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    return {
        "n_chars": chars,
        "n_words": F.size(words),
        "symbol_ratio": ratio(chars - F.length(F.regexp_replace(t, r"[\p{S}#…•]", "")), chars),
        "stop_word_ratio": let(words, lambda w: ratio(F.size(F.filter(w, lambda x: x.isin(STOP_WORDS))), F.size(w))),
        "repeated_line_ratio": let(lines, lambda x: ratio(F.size(x) - F.size(F.array_distinct(x)), F.size(x))),
        "repeated_share": repeated_share(words),
    }


def profile(df: DataFrame, text_col: str = "text", thresholds: Sequence[Threshold] = THRESHOLDS) -> DataFrame:
    """``df`` without its text, with every metric the table names (``m_<metric>``) and ``marks``."""
    named = list(dict.fromkeys(t.metric for t in thresholds))
    compare = {">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b}

    def ratios(words: Column) -> Column:
        have = metrics(F.col(text_col), words)
        return F.struct(*[have[m].alias(f"m_{m}") for m in named])

    def marked(m: Column) -> Column:
        marks = F.array_compact(F.array(*[F.when(compare[t.compare](m[f"m_{t.metric}"], F.lit(t.limit)), F.lit(t.name)) for t in thresholds]))
        return F.struct(*[m[f"m_{x}"].alias(f"m_{x}") for x in named], marks.alias("marks"))

    # one expression, in which the words and each ratio are bound once, also where a filter on the marks is pushed into it
    whole = let(let(words_of(F.col(text_col)), ratios), marked).alias("__profile")
    others = [F.col(f"`{c}`") for c in df.columns if c != text_col and not c.startswith("m_") and c != "marks"]
    return spread(df).select(*others, whole).select(*others, "__profile.*")
