"""Files of another scheme, parts that go missing, and what a cluster refuses."""
import csv
import json

import pytest

from veilspark.operators import techniques as tq
from veilspark.plans.errors import RunError
from veilspark.sources import files, sinks, tables


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("view")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.shared.link./data", d.as_uri())
    return "viewfs://shared/data", d


@pytest.fixture
def on_a_cluster(monkeypatch):
    for m in (files, tq):
        monkeypatch.setattr(m, "on_one_machine", lambda spark: False)


def test_outputs_of_another_scheme(spark, root):
    uri, d = root
    df = spark.range(1000).selectExpr("string(id) AS a", "CASE WHEN id = 3 THEN 'x,\"y\"\n' ELSE 'z' END AS b").repartition(5)
    sinks.write_csv(df, f"{uri}/o.csv")
    rows = list(csv.reader(open(d / "o.csv", newline="")))
    assert rows[0] == ["a", "b"] and len(rows) == 1001 and ["3", 'x,"y"\n'] in rows
    sinks.write_json(df, f"{uri}/o.json")
    assert sorted(int(r["a"]) for r in json.load(open(d / "o.json"))) == list(range(1000))
    sinks.write_json(df.limit(0), f"{uri}/none.json")
    assert json.load(open(d / "none.json")) == []
    sinks.write_parquet(df, f"{uri}/o.parquet")
    assert spark.read.parquet(f"{uri}/o.parquet").count() == 1000
    assert not [p for p in d.iterdir() if p.name.startswith(".draft")]


def test_an_output_is_replaced_at_once_and_checked(spark, tmp_path, monkeypatch):
    sinks.write_csv(spark.range(10).selectExpr("string(id) AS a"), tmp_path / "o.csv")
    before = (tmp_path / "o.csv").read_text()
    monkeypatch.setattr(files, "shared_dir", lambda s: str(tmp_path))
    kept = files.place

    class Blind:
        def __init__(self, fs):
            self.fs = fs

        def listStatus(self, folder):
            return []

        def __getattr__(self, n):
            return getattr(self.fs, n)

    monkeypatch.setattr(files, "place", lambda s, p: (Blind(kept(s, p)[0]), kept(s, p)[1]) if "parts-" in str(p) else kept(s, p))
    with pytest.raises(RunError):
        sinks.write_csv(spark.range(5).selectExpr("string(id) AS a"), tmp_path / "o.csv")
    assert (tmp_path / "o.csv").read_text() == before


def test_on_a_cluster_tasks_use_the_shared_folder(spark, tmp_path, on_a_cluster, monkeypatch):
    shared = tmp_path / "shared"
    monkeypatch.setattr(files, "shared_dir", lambda s: str(shared))
    monkeypatch.setattr(tq, "shared_dir", lambda s: str(shared))
    (tmp_path / "in.csv").write_text("a,b\n1,x\n2,y\n")
    df = tables.read_csv(spark, tmp_path / "in.csv")
    assert len(df.collect()) == 2 and all(str(shared) in f for f in df.inputFiles())
    with pytest.raises(RunError):
        sinks.write_parquet(df, tmp_path / "o.parquet")
    vault = tq.Vault(spark, tmp_path / "vault")
    out = tq.tokenise(df.drop("#row"), tq.Tokens("b"), vault)
    assert len(out.collect()) == 2 and list((shared / "vault").iterdir())
    again = tq.tokenise(df.drop("#row"), tq.Tokens("b"), tq.Vault(spark, tmp_path / "vault"))
    assert sorted(r.b for r in again.collect()) == sorted(r.b for r in out.collect())
