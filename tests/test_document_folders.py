"""Folders of many small documents: few tasks and jobs, every file counted."""
import json

import pyarrow as pa

from veilspark.functions.keys import KeyFolder
from veilspark.operators import bundles
from veilspark.operators import documents as dc
from veilspark.operators.policy import parse_policy
from veilspark.plans.run import Paths, run
from veilspark.sources import files


def folder(at, n):
    at.mkdir()
    for i in range(n):
        (at / f"d{i}.json").write_text(json.dumps({"id": i, "name": "x"}))
    return at


def test_tasks_do_not_grow_with_the_files(spark, tmp_path, monkeypatch):
    docs = dc.read_documents(spark, str(folder(tmp_path / "docs", 300)))
    assert docs.rdd.getNumPartitions() == 1 and docs.distinct().count() == 300
    monkeypatch.setattr(files, "PACK", 1000)
    more = dc.read_documents(spark, str(tmp_path / "docs"))
    assert len(more.inputFiles()) > 1 and sorted(more.collect()) == sorted(docs.collect())


def test_every_file_counts(spark, tmp_path):
    """Empty files are documents that fail, and names may hold what patterns of paths are made of."""
    docs = folder(tmp_path / "docs", 40)
    (docs / "empty.json").write_text("")
    (docs / "_a{b[é].JSON").write_text('{"id": "é"}')
    (docs / "note.txt").write_text("{}")
    (tmp_path / "config").mkdir()
    (tmp_path / "config" / "c.json").write_text(json.dumps({"data_type": "t", "t": {"nested_json": True, "input_path": str(docs), "keep": ["id"]}}))
    shared = files.shared_dir(spark)
    fs, p = files.place(spark, shared)
    before = {str(s.getPath()) for s in fs.listStatus(p)} if fs.exists(p) else set()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("folders", "")
    status = run(spark, Paths.under(tmp_path))
    jobs = len(tracker.getJobIdsForGroup("folders"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    out = status["outputs"]
    assert (status["status"], out["documents"], out["written"], out["failed"]) == ("ok", 42, 41, 1)
    assert json.loads((tmp_path / "output/nested_json/_a{b[é].json").read_text(encoding="utf-8")) == {"id": "é"}
    assert len(list((tmp_path / "output/nested_json").iterdir())) == 41 and jobs < 12
    assert {str(s.getPath()) for s in fs.listStatus(p)} <= before  # nothing is left in the shared folder


def test_batches_are_walked_in_pieces():
    b = pa.RecordBatch.from_pydict({"file_name": list("abcde"), "doc": ["xx", None, "xxxx", "", "é"]})
    assert [p.column(0).to_pylist() for p in dc.pieces(iter([b, b.slice(0, 0)]), 4)] == [["a", "b", "c"], ["d", "e"]]
    assert [p.num_rows for p in dc.pieces(iter([b]))] == [5]


def test_a_summed_census_is_the_same(spark, tmp_path):
    docs = [{"a": i, "b": [i, None, "x" * (i % 3)], "n": {"\ud83d": i} if i % 7 else "z"} for i in range(200)]
    rows = [(f"d{i * 37 % 200}.json", json.dumps(d)) for i, d in enumerate(docs)] + [("broken.json", "{"), ("none.json", None)]
    df = spark.createDataFrame(rows, "file_name string, doc string").repartition(5)
    policy, keys = parse_policy({"keep": ["a", "b"], "hashing_with_salt": ["n"]}), KeyFolder(tmp_path)
    plain, summed = dc.anonymise(df, policy, keys), dc.anonymise(df, policy, keys, summed=True)
    assert sorted(dc.census_table(plain).collect()) == sorted(dc.census_table(summed).collect())
    two = ["file_name", "document"]
    assert sorted(plain.select(two).fillna("").collect()) == sorted(summed.select(two).fillna("").collect()) and plain.count() == 202
    bundle = [(f"b{i}.json", json.dumps({"resourceType": "Bundle", "type": "x" * (i % 2), "entry": [{"resource": {"resourceType": "Patient", "id": str(i), "gender": "f"}}]})) for i in range(30)]
    many, rules = spark.createDataFrame(bundle, "file_name string, doc string").repartition(3), bundles.parse_bundle_policy({"keep": ["Bundle.type", "Patient.gender"]})
    plain, summed = (bundles.anonymise_bundles(many, rules, keys, x) for x in (False, True))
    assert sorted(dc.census_table(plain).collect()) == sorted(dc.census_table(summed).collect()) and dc.census_table(summed).count() > 2
