"""Whole runs: every flow from files to report."""
import csv
import json
import random
from collections import Counter

import pytest

from veilspark import cli
from veilspark.plans import config
from veilspark.plans.errors import RunError
from veilspark.plans.run import Paths, run
from veilspark.sources import xlsx

HEADER = ["PatientId", "Name", "Aadhaar", "Phone", "Age", "Gender", "Pincode", "Diagnosis", "Note"]


def people(n=220):
    rng = random.Random(3)
    rows = [[f"P{i}", f"Person {i}", f"{10**11 + i}", f"9{i:09d}", str(rng.randrange(20, 80)), rng.choice("MF"), str(560000 + 10 * rng.randrange(4)), rng.choice(["Flu", "Cold", "Cough"]), "a, b" if i % 7 else "two\nlines"] for i in range(n)]
    return [*rows, ["P999", "Out Lier", "1", "9999999999", "99", "F", "560000", "HIV", ""]]


SECTION = {
    "k_anonymize": {"k": 5}, "suppression_limit": 0.05, "suppress": ["Name"], "hashing_with_salt": ["Aadhaar"], "tokenization": [{"column": "PatientId", "digits": 6}], "encrypt": [{"column": "Phone", "format_preserving": True}],
    "quasi_identifiers": {"numerical": [{"column": "Age"}, {"column": "Pincode"}], "categorical": [{"column": "Gender"}]}, "size": {"Age": 3, "Pincode": 10},
    "categorical_hierarchies": {"gender": {"M": ["Any"], "F": ["Any"]}}, "l_diversity": {"l": 2, "sensitive_attributes": ["Diagnosis"]},
}


def setup(root, section, data=None):
    for d in ("config", "data", "output"):
        (root / d).mkdir(exist_ok=True)
    (root / "config" / "c.json").write_text(json.dumps({"data_type": "t", "t": section}))
    if data is not None:
        with open(root / "data" / "in.csv", "w", newline="", encoding="utf-8") as f:
            csv.writer(f).writerows([HEADER, *data])
    return Paths.under(root)


def read(path):
    with open(path, newline="", encoding="utf-8") as f:
        return list(csv.reader(f))


def test_csv_run_and_chosen_node(spark, tmp_path):
    paths = setup(tmp_path, SECTION, people())
    status = run(spark, paths)
    assert status["status"] == "success", status
    out = status["outputs"]
    header, *rows = read(tmp_path / "output" / "generalized.csv")
    assert header == [h for h in HEADER if h != "Name"]
    classes = {}
    for r in rows:
        classes.setdefault((r[3], r[4], r[5]), []).append(r[6])
    assert all(len(c) >= 5 and len(set(c)) >= 2 for c in classes.values())
    assert len(rows) + out["removed_records"] == 221 and len(out["parameter_grid"]) == 12
    assert all(r[0].startswith("TK-") and len(r[1]) == 64 and len(r[2]) == 10 for r in rows)
    assert "two\nlines" in {r[7] for r in rows}
    assert not {f.name for f in (tmp_path / "output").rglob("*")} & {"token_vault.json", "encryption_keys.json"}
    # the node found, given as the node chosen, releases the same table
    node = dict(zip(["Age", "Pincode", "Gender"], out["final_rf"]))
    before = [r[:1] + r[2:] for r in rows]
    status = run(spark, setup(tmp_path, {**SECTION, "pass": "pass2", "generalization_node": node}))
    assert status["outputs"]["flow"] == "CHOSEN_NODE"
    assert [r[:1] + r[2:] for r in read(tmp_path / "output" / "generalized.csv")[1:]] == before


def test_pass1_writes_no_table(spark, tmp_path):
    status = run(spark, setup(tmp_path, {**SECTION, "pass": "pass1"}, people()))
    assert status["phase"] == "awaiting_pass2" and status["outputs"]["k_optimal"] >= 1
    assert not (tmp_path / "output" / "generalized.csv").exists() and (tmp_path / "output" / "parameter_grid.txt").exists()


def test_failed_run_leaves_no_table(spark, tmp_path):
    paths = setup(tmp_path, {**SECTION, "suppression_limit": 0, "k_anonymize": {"k": 500}}, people())
    (tmp_path / "output" / "generalized.csv").write_text("old")
    status = run(spark, paths)
    assert status["error"]["code"] == "GENERALIZATION_FAILED" and status["error"]["http_status"] == 422
    assert not (tmp_path / "output" / "generalized.csv").exists()
    assert json.loads((tmp_path / "output" / "status.json").read_text())["status"] == "error"


def test_json_in_json_out_preprocess_only(spark, tmp_path):
    paths = setup(tmp_path, {"suppress": ["b"], "masking": [{"column": "a", "characters_to_mask": [1]}]})
    (tmp_path / "data" / "t.json").write_text('[{"a": "xy", "b": 1}, {"a": true}]')
    status = run(spark, paths)
    assert status["outputs"]["pass"] == "preprocess_only"
    assert json.loads((tmp_path / "output" / "generalized.json").read_text()) == [{"a": "*y"}, {"a": "*rue"}]


def test_workbook_join_and_restore(spark, tmp_path):
    section = {"k_anonymize": {"k": 2}, "quasi_identifiers": {"numerical": [{"column": "Age"}]}, "fixed_bins": {"Age": [{"from": 0, "to": 39}, {"from": 40, "to": 99}]}, "sheet_joins": [{"left": "P", "right": "V", "on": "id"}], "restore_sheets": True, "suppression_limit": 1}
    paths = setup(tmp_path, section)
    xlsx.write(str(tmp_path / "data" / "w.xlsx"), [("P", ["id", "Age"], [["1", "30"], ["2", "35"], ["3", "50"], ["4", "60"]]), ("V", ["id", "code"], [["1", "a"], ["1", "b"], ["2", "c"], ["3", "d"]])])
    status = run(spark, paths)
    assert status["status"] == "success", status
    assert Counter(r[1] for r in read(tmp_path / "output" / "generalized.csv")[1:]) == {"[0-39]": 3, "[40-99]": 2}
    sheets = {n: (h, r) for n, h, r in xlsx.read(str(tmp_path / "output" / "generalized_restored.xlsx"))}
    assert sheets["P"] == (["id", "Age"], [["1", "[0-39]"], ["2", "[0-39]"], ["3", "[40-99]"], ["4", "[40-99]"]])
    assert sheets["V"][1][:3] == [["1", "a"], ["1", "b"], ["2", "c"]]


def test_parquet_in_and_out_and_detokenising(spark, tmp_path):
    from veilspark import detokenise

    paths = setup(tmp_path, {"tokenization": [{"column": "id"}], "output_path": "out.parquet"})
    df = spark.createDataFrame([(i, f"v{i % 3}", i % 2) for i in range(9)], "n int, id string, g int")
    df.write.parquet(str(tmp_path / "in.parquet"))
    status = run(spark, Paths(paths.config, tmp_path / "in.parquet", paths.output, paths.keys, paths.root))
    assert status["status"] == "success", status
    out = spark.read.parquet(str(tmp_path / "output" / "out.parquet"))
    assert out.columns == ["n", "id", "g"] and out.select("id").distinct().count() == 3 and "run.log" in {f.name for f in (tmp_path / "output").iterdir()}
    with open(tmp_path / "tokens.csv", "w", newline="") as f:
        csv.writer(f).writerows([("n", "id"), *((r.n, r.id) for r in out.collect()), ("99", "TK-unknown")])
    assert detokenise.run(spark, str(tmp_path / "tokens.csv"), str(tmp_path / "values.csv"), str(tmp_path / "keys"), ["id"]) == {"id": 1}
    assert {r[1] for r in read(tmp_path / "values.csv")[1:]} == {"v0", "v1", "v2", "TK-unknown"}


def test_document_runs(spark, tmp_path):
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "a.json").write_text('{"id": "1", "name": "Ann"}')
    (docs / "b.JSON").write_text("{broken")
    status = run(spark, setup(tmp_path, {"nested_json": True, "input_path": str(docs), "keep": ["id"]}))
    assert status["status"] == "ok" and status["outputs"]["written"] == 1 and status["outputs"]["failed"] == 1
    assert json.loads((tmp_path / "output" / "nested_json" / "a.json").read_text()) == {"id": "1"}
    assert read(tmp_path / "output" / "nested_json_census.csv")[1] == ["id", "1", "1", "keep", "id", "1"]
    status = run(spark, setup(tmp_path, {"nested_json": True, "input_path": str(docs), "keep": ["id"], "dry_run": True, "output_path": "dry"}))
    assert status["outputs"]["written"] == 0 and not (tmp_path / "output" / "dry").exists()
    (docs / "b.JSON").write_text('{"resourceType": "Bundle", "entry": [{"resource": {"resourceType": "Patient", "id": "x", "gender": "f"}}]}')
    status = run(spark, setup(tmp_path, {"fhir_bundle": True, "input_path": str(docs), "keep": ["Patient.gender"]}))
    assert status["outputs"]["written"] == 1 and (tmp_path / "output" / "fhir_bundle" / "b_anonymised.fhir.json").exists()


@pytest.mark.parametrize(
    "change,code",
    [
        ({"typo": 1}, "CONFIG_UNKNOWN_KEY"), ({"k_anonymize": {"k": 5.5}}, "CONFIG_INVALID_VALUE"), ({"k_anonymize": {"k": "5"}}, "CONFIG_INVALID_VALUE"), ({"k_anonymize": {}}, "CONFIG_MISSING_FIELD"), ({"suppression_limit": 2}, "CONFIG_INVALID_VALUE"),
        ({"pass": "pass3"}, "CONFIG_INVALID_VALUE"), ({"fpe": ["x"]}, "CONFIG_INVALID_VALUE"), ({"size": {"Age": 0}}, "CONFIG_INVALID_VALUE"), ({"suppress": [1]}, "CONFIG_INVALID_VALUE"), ({"fixed_bins": {"Age": [{"from": 1}]}}, "CONFIG_INVALID_VALUE"),
        ({"l_diversity": {"l": 2, "sensitive_attributes": ["Age"]}}, "CONFIG_INVALID_VALUE"), ({"l_diversity": {"l": 2}}, "CONFIG_INVALID_VALUE"), ({"flow_mode": "odd"}, "CONFIG_INVALID_VALUE"), ({"nested_json": True, "fhir_bundle": True}, "CONFIG_INVALID_VALUE"),
        ({"quasi_identifiers": {"categorical": [7]}}, "CONFIG_INVALID_VALUE"), ({"masking": [{"column": "a"}]}, "PREPROCESS_CONFIG_INVALID"), ({"generalization_node": {"Age": 0}}, "CONFIG_INVALID_VALUE"),
    ],
)
def test_strict_configuration(change, code):
    with pytest.raises(RunError, match=code):
        config.parse({"data_type": "t", "t": {**SECTION, **change}})


def test_lenient_configuration():
    c = config.parse({"data_type": "t", "t": {**SECTION, "_note": 1, "k_anonymize": {"k": 5.0}, "output_directory": "x", "insensitive_columns": ["a"], "flow_mode": "DIRECT"}})
    assert c.k == 5 and c.flow == "direct" and any("output_directory" in w for w in c.warnings)
    for raw, code in ((1, "MISSING"), ({"data_type": "x"}, "MISSING"), ({"data_type": "x", "x": []}, "INVALID")):
        with pytest.raises(RunError, match=code):
            config.parse(raw)


def test_command_line(tmp_path):
    p = cli.parse(["-r", str(tmp_path), "-d", "in.csv"], {"VEILSPARK_DATA": "no", "VEILSPARK_KEYS": "k"})
    assert (p.data.name, str(p.keys), p.config) == ("in.csv", "k", tmp_path / "config")
    for bad in (["--odd"], ["-c", " "]):
        with pytest.raises(RunError, match="CLI_INVALID_ARGUMENT"):
            cli.parse(bad, {})
    with pytest.raises(RunError, match="KEY_MATERIAL_IN_OUTPUT"):
        Paths(tmp_path, tmp_path, tmp_path / "o", tmp_path / "o" / "k").key_folder(config.Config({}, "t"))
