"""Sheet joins with their order, suffixes and restoring."""
import pytest

from veilspark.operators import sheets as sh
from veilspark.plans.errors import RunError


def sheet(spark, name, columns, rows):
    return sh.Sheet(name, spark.createDataFrame([(*r, [i]) for i, r in enumerate(rows)], ", ".join(f"`{c}` string" for c in columns) + ", __row array<bigint>"))


def rows(s):
    df = s.df if isinstance(s, sh.Sheet) else s
    return [tuple(r)[:-1] for r in df.select(*[c for c in df.columns if c != sh.ROW], sh.ROW).orderBy(sh.ROW).collect()]


@pytest.fixture
def two(spark):
    return sheet(spark, "L", ["id", "v", "w"], [("1", "a", "x"), ("2", "b", "y"), ("", "c", "z"), ("9", "d", "q")]), sheet(spark, "R", ["id", "v", "r"], [("2", "B", "r2"), ("1", "A", "r1"), ("1", "A2", "r1b"), ("", "E", "re"), ("7", "S", "r7")])


@pytest.mark.parametrize(
    "how,want",
    [
        ("inner", [("1", "a", "x", "A", "r1"), ("1", "a", "x", "A2", "r1b"), ("2", "b", "y", "B", "r2"), ("", "c", "z", "E", "re")]),
        ("left", [("1", "a", "x", "A", "r1"), ("1", "a", "x", "A2", "r1b"), ("2", "b", "y", "B", "r2"), ("", "c", "z", "E", "re"), ("9", "d", "q", "", "")]),
        ("right", [("1", "a", "x", "A", "r1"), ("1", "a", "x", "A2", "r1b"), ("2", "b", "y", "B", "r2"), ("", "c", "z", "E", "re"), ("7", "", "", "S", "r7")]),
        ("outer", [("1", "a", "x", "A", "r1"), ("1", "a", "x", "A2", "r1b"), ("2", "b", "y", "B", "r2"), ("", "c", "z", "E", "re"), ("9", "d", "q", "", ""), ("7", "", "", "S", "r7")]),
    ],
)
def test_joins(two, how, want):
    out = sh.join(*two, ["id"], how)
    assert out.columns == ["id", "v_x", "w", "v_y", "r"]
    assert rows(out) == want


def test_cross_join_suffixes_keys_too(two):
    out = sh.join(*two, ["id"], "cross")
    assert out.columns == ["id_x", "v_x", "w", "id_y", "v_y", "r"] and out.df.count() == 20
    with pytest.raises(RunError, match="DATA_COLUMN_MISSING"):
        sh.join(*two, ["nope"], "cross")


def test_star_and_restore(spark):
    a = sheet(spark, "schools", ["id", "kind"], [("s1", "gov"), ("s2", "private")])
    b = sheet(spark, "rooms", ["id", "n"], [("s1", "3"), ("s1", "4"), ("s2", "5")])
    c = sheet(spark, "pupils", ["id", "n"], [("s2", "90"), ("s1", "80")])
    merged, plan = sh.combine([a, b, c], sh.parse_joins([{"left": "schools", "right": "rooms", "on": "id"}, {"left": "schools", "right": "pupils", "on": ["id"]}]))
    assert merged.columns == ["id", "kind", "n_x", "n_y"]
    assert rows(merged) == [("s1", "gov", "3", "80"), ("s1", "gov", "4", "80"), ("s2", "private", "5", "90")]
    back = sh.restore(merged.df, plan)
    assert list(back) == ["schools", "rooms", "pupils"]
    assert rows(back["schools"]) == [("s1", "gov"), ("s2", "private")]
    assert rows(back["rooms"]) == [("s1", "3"), ("s1", "4"), ("s2", "5")]
    assert rows(back["pupils"]) == [("s1", "80"), ("s2", "90")]


def test_union_auto_join_and_side_by_side(spark):
    a, b = sheet(spark, "A", ["x", "y"], [("1", "2")]), sheet(spark, "B", ["y", "x"], [("4", "3")])
    assert rows(sh.combine([a, b])[0]) == [("1", "2"), ("3", "4")]
    c = sheet(spark, "C", ["x", "z"], [("1", "Z")])
    assert rows(sh.combine([a, c])[0]) == [("1", "2", "Z")]
    d = sheet(spark, "D", ["q"], [("a",), ("b",), ("c",)])
    assert rows(sh.combine([a, d])[0]) == [("1", "2", "a"), ("", "", "b"), ("", "", "c")]
    assert sh.combine([a]) == (a, None)


@pytest.mark.parametrize("bad", [[{"left": "A"}], [{"left": "A", "right": "B", "on": []}], [{"left": "A", "right": "B", "on": [1]}], [{"left": "A", "right": "B", "on": "x", "how": "semi"}]])
def test_bad_joins(bad):
    with pytest.raises(RunError, match="CONFIG_INVALID_VALUE"):
        sh.parse_joins(bad)


def test_unknown_sheet(spark, two):
    with pytest.raises(RunError, match="DATA_XLSX_INVALID"):
        sh.chain(list(two), [sh.Join("L", "Z", ("id",))])
