"""Failed rows against a character-by-character reading of the same rules."""
import csv
import io
import random
import re
import unicodedata

import pytest

from veilspark.operators import failed_rows as fr


def brute(raw):
    if raw is None or not raw.strip():
        return None
    text = re.sub(r"[\r\n]+\Z", "", raw)
    field = r'(?:"(?:[^"]|"")*"|[^",\r\n]*)'
    if not re.fullmatch(f"{field}(?:,{field})*", text):
        return "quoting"
    cells = next(csv.reader(io.StringIO(text, newline=""), strict=True)) if text else [""]
    if len(cells) != 7:
        return "column_count"
    note = cells[6]
    bad = "�" in note or any(unicodedata.category(c) == "Cc" and c not in "\t\n\r" for c in note)
    return "bad_value" if bad or not re.fullmatch("P[0-9]{6,12}", cells[0].strip()) else ""


csv.field_size_limit(1 << 24)
CASES = [
    None, "", "  \t\r\n", "P123456,a,1,F,5,d,n", "P123456,a,1,F,5,d,n\r\r\n", '"P123456",a,1,F,5,"d, e","n ""q"" x"', 'P123456,a,1,F,5,d,"open', 'P123456",a,1,F,5,d,n', 'P123456,a,1,F,5,d,"x" y', 'P123456,a,1,F,5,d,""""',
    "P123456,a,1,F,5,d", "P123456,a,1,F,5,d,n,m", ",,,,,,", "P12345,a,1,F,5,d,n", "p123456,a,1,F,5,d,n", " P123456 ,a,1,F,5,d,n", "P1234567890123,a,1,F,5,d,n", "Ｐ123456,a,1,F,5,d,n", "P123456,a,1,F,5,d,�", "P123456,a,1,F,5,d,a\u0007",
    'P123456,a,1,F,5,d,"two\r\nlines\tx"', "P123456,a\nb,1,F,5,d,n", "P123456,a,1,F,5,d,\u0001\u0002ab", "P123456,\u0001,\u0002a,F,5,\u0002b,n", "P123456,a,1,F,5,d," + "long " * 40000, '"' * 7, '""', ",", "P123456,a,1,F,5,d,\x85",
]


def test_reasons_match_brute_force(spark):
    rng = random.Random(4)
    rows = CASES + ["".join(rng.choice('",aP1\n\r 2') for _ in range(rng.randrange(1, 18))) for _ in range(300)] + ["P123456,a,1,F,5,d," + "".join(rng.choice('",a') for _ in range(6)) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(rows)), "line_no long, raw_record string")
    out = fr.load(df, "line_no", "raw_record")
    got = {r.line_no: r.reason for r in out.failed.collect()}
    want = {i: b for i, x in enumerate(rows) if (b := brute(x))}
    assert got == want
    assert {r.line_no for r in out.valid.select("line_no").collect()} == {i for i, x in enumerate(rows) if brute(x) == ""}


def test_values_survive_parsing(spark):
    df = spark.createDataFrame([(1, 'P123456,"a, ""b""",\u0001,\u0002a,5,d,"x\ny"')], "line_no long, raw_record string")
    row = fr.load(df, "line_no", "raw_record").valid.first()
    assert list(row)[1:] == ["P123456", 'a, "b"', "\u0001", "\u0002a", "5", "d", "x\ny"]


def test_repeats_nulls_empty_and_clashing_columns(spark):
    rows = [(1, "P123456,a,1,F,5,d,n", "k"), (1, "P123456,a,1,F,5,d,n", None), (None, "x", "k"), (None, "x", "k"), (1, "bad", "k")]
    df = spark.createDataFrame(rows, "line_no long, raw_record string, Name string")
    out = fr.load(df, "line_no", "raw_record", keep=["Name"])
    assert out.valid.columns[:3] == ["line_no", "Name_src", "PatientId"]
    assert sorted((r[1] or "") for r in out.valid.collect()) == ["", "k"]
    assert sorted((r.line_no or 0, r.reason) for r in out.failed.collect()) == [(0, "column_count"), (1, "column_count")]
    empty = fr.load(df.limit(0), "line_no", "raw_record")
    assert empty.valid.count() == empty.failed.count() == empty.errors.count() == 0


@pytest.mark.parametrize("text", ["a,b\r\n", "a"])
def test_other_rules_and_columns(spark, text):
    rules = [r for r in fr.intake_rules() if r.column == fr.RECORD]
    out = fr.load(spark.createDataFrame([(7, text)], "i long, t string"), "i", "t", ["x", "y"], rules)
    assert out.valid.count() == (1 if "," in text else 0)
