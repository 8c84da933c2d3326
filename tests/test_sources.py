"""Readers and writers: round trips, strictness, sniffing, the database's statements."""
import csv
import json

import pytest

from veilspark.operators.sheets import ROW
from veilspark.plans.errors import RunError
from veilspark.sources import postgres as pg
from veilspark.sources import sinks, tables, xlsx


def texts(df):
    return [tuple(r)[:-1] for r in df.orderBy(ROW).collect()]


def test_csv_round_trip(spark, tmp_path):
    rows = [("a", 'say "hi", x', ""), ("two\nlines", " pad ", "राम"), ("", "", "z"), ("\\", "'", "a\rb")]
    src = tmp_path / "t.csv"
    with open(src, "w", newline="", encoding="utf-8") as f:
        csv.writer(f, lineterminator="\r\n").writerows([("A", "B b", "C"), *rows])
    df = tables.read_csv(spark, src)
    assert df.columns == ["A", "B b", "C", ROW] and texts(df) == rows
    sinks.write_csv(df, tmp_path / "out.csv")
    with open(tmp_path / "out.csv", newline="", encoding="utf-8") as f:
        assert list(csv.reader(f)) == [["A", "B b", "C"], *map(list, rows)]
    assert not list(tmp_path.glob(".writing*"))


@pytest.mark.parametrize("body", [b"1\n", b"1,2,3\n", b'"1,2\n', b'1,"a"b\n', b"1,\xff\n"])
def test_broken_csv_fails(spark, tmp_path, body):
    (tmp_path / "t.csv").write_bytes(b"a,b\n1,2\n" + body)
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
        tables.read_csv(spark, tmp_path / "t.csv").collect()


def test_blank_records_are_skipped(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n\n1,2\n   \n3,4\n")
    assert texts(tables.read_csv(spark, tmp_path / "t.csv")) == [("1", "2"), ("3", "4")]


def test_json_table(spark, tmp_path):
    (tmp_path / "t.json").write_text('[{"b":1,"a":"x"},{"b":1.50,"c":true,"a":null},{"d":[1,{"k":2}]}]')
    df = tables.read_json(spark, tmp_path / "t.json")
    assert df.columns == ["b", "a", "c", "d", ROW]
    assert texts(df) == [("1", "x", "", ""), ("1.50", "", "True", ""), ("", "", "", '[1,{"k":2}]')]
    sinks.write_json(df, tmp_path / "o.json")
    assert json.loads((tmp_path / "o.json").read_text())[0] == {"b": "1", "a": "x", "c": "", "d": ""}
    (tmp_path / "bad.json").write_text('{"a": 1}')
    with pytest.raises(Exception, match="DATA_JSON_INVALID"):
        tables.read_json(spark, tmp_path / "bad.json").collect()


def test_xlsx_round_trip(spark, tmp_path):
    p = tmp_path / "b.xlsx"
    xlsx.write(str(p), [("One & 1", ["a", "b"], [["1", "x<y"], ["", "राम\nz"]]), ("Two", ["q"], [["7"]])])
    assert xlsx.read(str(p)) == [("One & 1", ["a", "b"], [["1", "x<y"], ["", "राम\nz"]]), ("Two", ["q"], [["7"]])]
    one, two = tables.read_excel(spark, p)
    assert texts(one.df) == [("1", "x<y"), ("", "राम\nz")] and two.name == "Two"
    sinks.write_xlsx(one.df, tmp_path / "o.xlsx")
    assert xlsx.read(str(tmp_path / "o.xlsx"))[0][1:] == (["a", "b"], [["1", "x<y"], ["", "राम\nz"]])
    (tmp_path / "bad.xlsx").write_bytes(b"PK\x03\x04nonsense")
    with pytest.raises(RunError, match="DATA_XLSX_INVALID"):
        xlsx.read(str(tmp_path / "bad.xlsx"))


def test_sniffing_and_discovery(tmp_path):
    for name, data, kind in (("a.csv", b"  [1]", "json"), ("b.json", b"x,y", "csv"), ("c.csv", b"PK\x03\x04", "excel"), ("d.csv", b"", None)):
        (tmp_path / name).write_bytes(data)
        assert tables.sniff(tmp_path / name) == kind
    with pytest.raises(RunError, match="DATA_AMBIGUOUS_INPUT"):
        tables.discover(tmp_path)
    with pytest.raises(RunError, match="DATA_DIR_MISSING"):
        tables.discover(tmp_path / "none")
    (tmp_path / "e").mkdir()
    with pytest.raises(RunError, match="DATA_NO_CSV"):
        tables.discover(tmp_path / "e")


def source(**kw):
    return {"input": {"type": "postgres", "host": "h", "database": "d", "user": "u", "password": "s3cret", "table": "public.t", **kw}}


def test_postgres_source(monkeypatch):
    r = pg.parse_source(source(columns=["a b", 'q"x'], limit=5))
    assert r.query == 'SELECT "a b", "q""x" FROM "public"."t" LIMIT 5'
    assert r.connection.options()["sslmode"] == "verify-full" and "s3cret" not in repr(r) + r.connection.scrub("pw s3cret")
    assert pg.parse_source(source(table=None, query=" SELECT 1 ;; ")).query == "SELECT 1"
    assert pg.parse_source({}) is None and pg.parse_source({"input": {"type": "file"}}) is None
    monkeypatch.setenv("PG_HOST", "db1")
    assert pg.parse_source(source(host="${PG_HOST}", port="${PG_PORT:-6000}")).connection.url == "jdbc:postgresql://db1:6000/d"
    c = pg.parse_source(source(host=None, database=None, user=None, password=None, dsn="postgresql://me:pw12@srv:99/base?sslmode=require")).connection
    assert (c.host, c.port, c.database, c.user, c.ssl) == ("srv", 99, "base", "me", "require") and c.warning


@pytest.mark.parametrize("kw,code", [({"query": "x"}, "DB_CONFIG"), ({"table": None}, "DB_CONFIG"), ({"table": "a.b.c"}, "DB_CONFIG"), ({"table": "${T}"}, "DB_CONFIG"), ({"sslmode": "maybe"}, "DB_CONFIG"), ({"sslmode": "verify-ca"}, "DB_CONFIG"), ({"host": "${NOT_THERE}"}, "ENV_VAR"), ({"host": "${X"}, "DB_CONFIG"), ({"limit": 0}, "DB_CONFIG"), ({"type": "oracle"}, "DB_CONFIG"), ({"password_env": "NOT_THERE"}, "ENV_VAR"), ({"sslmode": "disable", "sslrootcert": "c"}, "DB_CONFIG")])
def test_postgres_refusals(kw, code):
    with pytest.raises(RunError, match=code):
        pg.parse_source(source(**kw))


def test_postgres_sink():
    inherited = pg.parse_source(source()).connection
    w = pg.parse_sink({"output_sink": {"type": "postgres", "table": "out.t", "mode": "replace"}}, inherited)
    assert w.connection is inherited
    assert pg.ddl(w, ["a", "b"]) == ['CREATE SCHEMA IF NOT EXISTS "out"', 'DROP TABLE IF EXISTS "out"."t"', 'CREATE TABLE "out"."t" ("a" text, "b" text)']
    stage = pg.staging(w)
    moves = pg.swap(w, stage, ["a"])
    assert moves[0] == "BEGIN" and moves[-1] == "COMMIT" and f'INSERT INTO "out"."t" ("a") SELECT "a" FROM {stage.sql}' in moves
    assert pg.ddl(pg.Write(inherited, pg.Table(("t",)), "truncate"), ["a"])[-1] == 'TRUNCATE TABLE "t"'
    assert pg.ddl(pg.Write(inherited, pg.Table(("t",)), "append"), ["a"]) == []
    with pytest.raises(RunError, match="DB_CONFIG"):
        pg.parse_sink({"output_sink": {"type": "postgres", "table": "t", "mode": "upsert"}}, inherited)


def test_rows_as_text(spark):
    df = pg.as_text(spark.createDataFrame([(1, "a\r\nb", None)], "i int, t string, n double"))
    assert tuple(df.first())[:3] == ("1", "a  b", "")
