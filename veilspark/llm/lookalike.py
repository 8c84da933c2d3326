"""Bring text that looks the same to one form.

Every distinct value is mapped: compatibility forms folded (NFKC), invisible
characters dropped, look-alike letters and hyphens of other scripts replaced while
accents stand apart from their letters and put together again, white space of any kind
and number made one space and trimmed. The mapped values are grouped in SQL under the accent- and case-sensitive ``UNICODE`` collation, which also
holds composed and decomposed accents equal; each class gets one canonical member
(fewest code points above ASCII, then smallest), joined back.

Defined results: null and values that show nothing have no class and stay null in the
``_same`` column; repeated rows and ties get one deterministic member; an empty table
gives an empty table; other columns, also with clashing names, are carried through.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilspark.functions.text import INVISIBLE, WS, nfc, nfkd

# Letters of other scripts that have the shape of a Latin letter, and hyphens.
LOOKALIKES = {
    # Greek capitals and small letters
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o", "Ϲ": "C", "ϲ": "c", "Ϳ": "J", "ϳ": "j",
    "α": "a", "ι": "i", "κ": "k", "ν": "v", "ρ": "p", "υ": "u",
    # Cyrillic capitals
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "У": "Y", "Ү": "Y", "Ԛ": "Q", "Ԝ": "W", "Ԍ": "G", "Ӏ": "I",
    # Cyrillic small letters
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ѵ": "v", "ү": "y",
    # Latin and Armenian letters of the same shape
    "ɡ": "g", "ɑ": "a", "օ": "o", "Օ": "O", "ս": "u", "ց": "g", "հ": "h", "Տ": "S", "Լ": "L",
    "ı": "i", "ɩ": "i", "ʋ": "u",
    # Cherokee capitals
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭰ": "D", "Ꭼ": "E", "Ꮐ": "G", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M", "Ꮲ": "P", "Ꮢ": "R", "Ꮪ": "S", "Ꭲ": "T", "Ꮩ": "V", "Ꮤ": "W", "Ꮓ": "Z",
    # Lisu
    "ꓐ": "B", "ꓑ": "P", "ꓓ": "D", "ꓔ": "T", "ꓖ": "G", "ꓗ": "K", "ꓙ": "J", "ꓚ": "C", "ꓜ": "Z", "ꓝ": "F", "ꓟ": "M", "ꓠ": "N", "ꓡ": "L", "ꓢ": "S", "ꓣ": "R", "ꓦ": "V", "ꓧ": "H", "ꓪ": "W", "ꓫ": "X", "ꓬ": "Y", "ꓮ": "A", "ꓰ": "E", "ꓲ": "I", "ꓳ": "O", "ꓴ": "U",
    # hyphens
    "‐": "-", "‑": "-", "‒": "-", "⁃": "-", "−": "-", "˗": "-",
}


def mapped(c: Column) -> Column:
    """The look-alike-mapped form of a text; ASCII text is only cleaned of its spaces."""
    shown = F.regexp_replace(nfkd(c), f"[{INVISIBLE}]+", "")
    # a composed letter may hide a look-alike base: swap with the accents apart, compose again
    swapped = F.translate(shown, "".join(LOOKALIKES), "".join(LOOKALIKES.values()))
    spaced = F.trim(F.regexp_replace(swapped, f"[{WS}]+", " "))
    plain = F.trim(F.regexp_replace(c, "[\t-\r ]+", " "))
    return F.when(F.regexp_like(c, F.lit(r"[^\x{20}-\x{7E}]")), nfc(spaced)).otherwise(plain)


def classes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, value, same, members)``: each distinct value with its class's canonical member."""
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in columns])).alias("c")).select("c.*")
    values = cells.filter(F.col("value").isNotNull() & (F.col("value") != "")).select("column_name", "value").distinct()
    keyed = values.select("*", mapped(F.col("value")).alias("look")).filter(F.col("look") != "")
    return keyed.sparkSession.sql(
        """
        WITH canon AS (
          SELECT column_name, collate(look, 'UNICODE') AS k, count(*) AS members,
                 min_by(value, struct(length(regexp_replace(value, '[ -~]', '')), value)) AS same
          FROM {keyed} GROUP BY column_name, collate(look, 'UNICODE'))
        SELECT v.column_name, v.value, c.same, c.members
        FROM {keyed} v JOIN canon c ON v.column_name = c.column_name AND collate(v.look, 'UNICODE') = c.k
        """,
        keyed=keyed,
    )


def consistent(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with ``<column>_same``: the canonical member of each value's class."""
    from veilspark.session import cut

    table = cut(classes(df, columns))
    out = df
    for i, c in enumerate(columns):
        t = table.filter(F.col("column_name") == c).select(F.col("value").alias(f"__v{i}"), F.col("same").alias(f"__s{i}"))
        out = out.join(t, out[c] == F.col(f"__v{i}"), "left").drop(f"__v{i}")
    taken = set(df.columns)
    return out.withColumnsRenamed({f"__s{i}": f"{c}_same" + "_2" * (f"{c}_same" in taken) for i, c in enumerate(columns)})


def look_classes(df: DataFrame, id_col: str, columns: Sequence[str]) -> DataFrame:
    """``(id, form, same)`` of the rows whose ``columns`` look like those of a row stored differently.

    The columns together are one value: its mapped forms are grouped under the collation
    in SQL, the class keeps its smallest and largest stored form and its canonical member,
    and only classes with two forms are joined back. Rows are shuffled once to be grouped
    and once to be joined with those few classes.
    """
    c = list(columns)
    looks = [mapped(F.col(f"`{x}`")).alias(f"k{i}") for i, x in enumerate(c)]
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.struct(*[F.col(f"`{x}`").alias(f"v{i}") for i, x in enumerate(c)]).alias("form"), *looks)
    rows = rows.filter(" AND ".join(f"k{i} <> ''" for i in range(len(c))))
    keys = [f"collate(k{i}, 'UNICODE')" for i in range(len(c))]
    strange = " + ".join(f"length(regexp_replace(form.v{i}, '[ -~]', ''))" for i in range(len(c)))
    return df.sparkSession.sql(
        f"""
        WITH canon AS (
          SELECT {", ".join(f"{k} AS g{i}" for i, k in enumerate(keys))}, min_by(form, struct({strange}, form)) AS same
          FROM {{rows}} GROUP BY {", ".join(keys)} HAVING min(form) <> max(form))
        SELECT r.id, r.form, c.same FROM {{rows}} r JOIN canon c ON {" AND ".join(f"{k.replace('(k', '(r.k')} = c.g{i}" for i, k in enumerate(keys))}
        """,
        rows=rows,
    )


def same_looking_pairs(df: DataFrame, id_col: str, columns: Sequence[str]) -> DataFrame:
    """Pairs of rows whose ``columns`` all look the same while at least one is stored differently.

    Pairs are made between the stored forms of a class, found by its canonical member,
    before the rows of each form are joined on; equal copies are never compared.
    """
    from veilspark.session import cut

    kept = cut(look_classes(df, id_col, columns))
    forms = kept.select("same", "form").distinct()
    pairs = forms.select("same", F.col("form").alias("fa")).join(forms.select("same", F.col("form").alias("fb")), "same").filter(F.col("fa") != F.col("fb"))
    left = kept.select(F.col("id").alias("ida"), "same", F.col("form").alias("fa"))
    right = kept.select(F.col("id").alias("idb"), "same", F.col("form").alias("fb"))
    both = left.join(pairs, ["same", "fa"]).join(right, ["same", "fb"]).filter("ida < idb")
    return both.select(F.col("ida").alias("row_id_a"), F.col("idb").alias("row_id_b"))
