"""Nested documents and bundles under path rules."""
import json

import pytest
from pyspark.sql import functions as F

from veilspark.functions.keys import KeyFolder
from veilspark.operators import bundles as bu
from veilspark.operators import documents as dc
from veilspark.operators.policy import parse_policy
from veilspark.operators.techniques import Vault, hash_value
from veilspark.plans.errors import RunError


def frame(spark, docs):
    return spark.createDataFrame([(f"d{i}.json", d if isinstance(d, str) or d is None else json.dumps(d)) for i, d in enumerate(docs)], "file_name string, doc string")


def run(spark, docs, policy, tmp_path, vault=None):
    done = dc.anonymise(frame(spark, docs), parse_policy(policy), KeyFolder(tmp_path), vault).persist()
    return {r.file_name: json.loads(r.document) if r.document else None for r in done.collect()}, done


def test_rules_and_census(spark, tmp_path):
    doc = {"case_id": "C1", "total": 3, "pages": [{"link": "https://h/x/My%20File.pdf?k=1", "data": {"name": "Ann", "age": "49Y", "flag": True, "lat": 1.50, "note": ""}}, {"data": {}}], "codes": ["a", "b"]}
    policy = {"keep": ["case_id", "total", "pages[].data.flag", "**.lat", "codes"], "masking": [{"column": "**.age", "characters_to_mask": [2]}], "hashing_with_salt": ["pages[].data.name"], "filename": ["pages.[].link"], "suppress": ["pages[].data.*"]}
    out, done = run(spark, [doc, "{broken", None], policy, tmp_path)
    got = out["d0.json"]
    salt = bytes.fromhex(KeyFolder(tmp_path).salt("nested_json", True))
    # the rule without a double star is more specific, so 'lat' is suppressed by the page rule and 'age' too
    assert got == {"case_id": "C1", "total": 3, "pages": [{"link": "My File.pdf", "data": {"name": hash_value(salt, "Ann"), "flag": True}}, {"data": {}}], "codes": ["a", "b"]}
    assert out["d1.json"] is None and out["d2.json"] is None
    census = {r.path: r for r in dc.census_table(done).collect()}
    assert census["codes[]"].documents_seen == 2 and census["codes[]"].matched_by == "codes" and census["codes[]"].example_value == "a"
    assert census["pages[].data.note"].non_empty == 0 and census["pages[].data.name"].action == "hashing_with_salt"


def test_numbers_keep_their_form(spark, tmp_path):
    out = dc.anonymise(frame(spark, ['{"a": 1.50, "b": [1e3, -0], "c": "\\u0041"}']), parse_policy({"default_action": "keep"}), KeyFolder(tmp_path)).first().document
    assert '"a": 1.50' in out and "1e3" in out and "-0" in out and '"c": "A"' in out


def test_tokens_encryption_and_missing_values(spark, tmp_path):
    docs = [[{"v": "KA01", "p": {"phone": "9000000001", "name": "Ann", "id": "x"}}, {"v": None, "p": {"phone": "", "name": " ", "id": "x"}}], [{"v": "KA01 ", "p": {"phone": "12", "name": "Bob", "id": None}}]]
    policy = {"tokenization": [{"column": "[].v"}], "encrypt": [{"column": "[].p.phone", "format_preserving": True}, {"column": "[].p.id"}], "charcloak": ["[].p.name"]}
    out, _ = run(spark, docs, policy, tmp_path, Vault(spark, tmp_path / "t"))
    a, b = out["d0.json"], out["d1.json"]
    assert a[0]["v"] == b[0]["v"] and a[0]["v"].startswith("TK-") and a[1]["v"] is None
    assert len(a[0]["p"]["phone"]) == 10 and a[0]["p"]["phone"] != "9000000001" and a[1]["p"]["phone"] == ""
    assert "phone" not in b[0]["p"]  # too short to keep its format: removed, never in clear
    assert a[0]["p"]["id"].startswith("ENC1$") and a[0]["p"]["id"] == a[1]["p"]["id"] and b[0]["p"]["id"] is None
    assert a[0]["p"]["name"] != "Ann" and a[1]["p"]["name"] == " "


@pytest.mark.parametrize("value,want", [("https://h.org/a/b.pdf", "b.pdf"), ("a/b/c%20d.txt#x", "c d.txt"), ("https://h.org", None), ("https://h.org/", None), (r"c:\x\y.doc", "y.doc"), ("plain", "plain"), ("/a/?q=1", None)])
def test_file_names(value, want):
    assert dc.file_name(value) == want


def test_more_specific_rules_win():
    p = parse_policy({"keep": ["a.**", "a.b.c"], "suppress": ["a.*.c", "**"], "hashing_with_salt": ["a.b*"]})
    assert p.decide(["a", "b", "c"])[1] == "a.b.c" and p.decide(["a", "x", "c"])[0].kind == "suppress"
    assert p.decide(["a", "q", "r"])[1] == "a.**" and p.decide(["z"])[1] == "**" and p.decide(["a", "bb"])[1] == "a.b*"
    q = parse_policy({"keep": ["x.y"], "suppress": ["X.Y"]})
    assert q.decide(["x", "y"])[0].kind == "suppress" and q.decide(["x", "y", "[]", "[]"])[0].kind == "suppress" and q.decide(["w"])[1] == "<default>"


@pytest.mark.parametrize("bad", [{}, {"keep": "a"}, {"keep": ["a"], "fpe": ["x"]}, {"keep": ["a"], "size": {"a": 2}}, {"keep": ["a"], "qi_constraints": {"a": {"precision": 1}}}, {"keep": ["a"], "default_action": "hide"}, {"masking": [{"column": "a"}]}])
def test_policies_that_are_refused(bad):
    with pytest.raises(RunError):
        parse_policy(bad)


def bundle():
    patient = {"resourceType": "Patient", "id": "p1", "name": [{"text": "Ramesh Kumar"}], "gender": "male", "identifier": [{"value": "ABHA-99887766"}]}
    hb = {"resourceType": "Observation", "id": "o1", "status": "final", "code": {"text": "Haemoglobin", "coding": [{"system": "S", "code": "718-7", "display": "Hb"}]}, "subject": {"reference": "Patient/p1"}, "valueQuantity": {"value": 12.50, "unit": "g"}, "performer": [{"extension": [{"url": bu.ABSENT, "valueCode": "unknown"}]}], "text": {"status": "generated", "div": "<div/>"}}
    gps = {"resourceType": "Observation", "id": "o2", "code": {"text": "GPS latitude"}, "valueString": "12.9"}
    report = {"resourceType": "DiagnosticReport", "id": "r1", "result": [{"reference": "Observation/o1"}, {"reference": "urn:uuid:o2"}, {"reference": "http://x/y"}]}
    ref = {"resourceType": "DocumentReference", "id": "f1", "description": 4, "_description": {"x": "1"}, "category": [{"text": "report of Ramesh"}, {"text": "scan"}], "url": "file_Ramesh+Kumar.pdf"}
    return {"resourceType": "Bundle", "type": "collection", "entry": [{"fullUrl": f"urn:uuid:{r['id']}", "resource": r} for r in (patient, hb, gps, report, ref)]}


POLICY = {
    "keep": ["Bundle.type", "Patient.gender", "Observation.**", "DiagnosticReport.**", "DocumentReference.**"], "suppress": ["Observation.text.div", "DocumentReference.description"], "hashing_with_salt": ["Patient.identifier[].value"],
    "code_rules": {"suppress": ["gps_*"], "keep": ["haemoglobin"]}, "propagation": {"from": ["Patient.name[].text", "Patient.identifier[].value"]}, "hash_strip_prefixes": ["abha-"],
}


def test_bundle(spark, tmp_path):
    keys = KeyFolder(tmp_path)
    done = bu.anonymise_bundles(frame(spark, [bundle(), {"resourceType": "Patient"}]), bu.parse_bundle_policy(POLICY), keys).persist()
    docs = {r.file_name: r.document for r in done.collect()}
    assert docs["d1.json"] is None
    out = json.loads(docs["d0.json"])
    kinds = [e["resource"]["resourceType"] for e in out["entry"]]
    assert kinds == ["Patient", "Observation", "DiagnosticReport", "DocumentReference"]
    patient, hb, report, ref = (e["resource"] for e in out["entry"])
    id_key, salt = bytes.fromhex(keys.salt(bu.ID_COLUMN, True)), bytes.fromhex(keys.salt("Patient.identifier[].value", True))
    assert patient == {"resourceType": "Patient", "id": bu.pseudo_id(id_key, "p1"), "gender": "male", "identifier": [{"value": hash_value(salt, "99887766")}]}
    assert hb["subject"]["reference"] == f"Patient/{patient['id']}" and hb["valueQuantity"] == {"value": 12.5, "unit": "g"} and "text" not in hb
    assert hb["performer"][0]["extension"][0]["valueCode"] == "unknown"
    assert report["result"] == [{"reference": f"Observation/{hb['id']}"}]
    assert ref["category"] == [{"text": "scan"}] and "url" not in ref and "_description" not in ref
    assert out["entry"][0]["fullUrl"] == f"urn:uuid:{patient['id']}"
    census = {r.path: r for r in dc.census_table(done).collect()}
    assert census["DocumentReference.url"].matched_by.startswith("propagated:") and census["Observation[code=gps_latitude]"].action == "drop_resource"
    assert "Ramesh" not in docs["d0.json"]


def test_suppressed_observation_without_id_is_dropped(spark, tmp_path):
    b = bundle()
    del b["entry"][2]["resource"]["id"]
    out = bu.anonymise_bundles(frame(spark, [b]), bu.parse_bundle_policy(POLICY), KeyFolder(tmp_path)).first().document
    assert "GPS" not in out and "12.9" not in out


@pytest.mark.parametrize("bad", [{"encrypt": [{"column": "a"}]}, {"code_rules": {"masking": ["x"]}}, {"propagation": {"min_length": 2}}, {"code_rules": ["x"]}])
def test_bundle_policies_that_are_refused(bad):
    with pytest.raises(RunError, match="CONFIG_INVALID_VALUE"):
        bu.parse_bundle_policy({"keep": ["a"], **bad})


def test_empty_input(spark, tmp_path):
    empty = frame(spark, [""]).limit(0)
    done = dc.anonymise(empty, parse_policy({"keep": ["a"]}), KeyFolder(tmp_path))
    assert done.count() == 0 and dc.census_table(done).count() == 0
    assert done.select(F.col("document")).count() == 0


def test_deep_documents_and_half_characters(spark, tmp_path):
    """What is nested too deeply counts as no JSON and fails nothing else; half a surrogate pair becomes U+FFFD."""
    deep = '{"a": ' * 5000 + "1" + "}" * 5000
    out, _ = run(spark, [deep, '{"a": "x\\ud83d"}', {"a": "y"}], {"keep": ["a"]}, tmp_path)
    assert out == {"d0.json": None, "d1.json": {"a": "x�"}, "d2.json": {"a": "y"}}
    both = spark.createDataFrame([("x", '{"resourceType": "Bundle", "entry": ' + "[" * 5000 + "]" * 5000 + "}"), ("y", '{"resourceType": "Bundle", "type": "b"}')], "file_name string, doc string")
    done = bu.anonymise_bundles(both, bu.parse_bundle_policy({"keep": ["Bundle.type"]}), KeyFolder())
    assert {r.file_name: r.document is None for r in done.collect()} == {"x": True, "y": False}
