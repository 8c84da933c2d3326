"""Flattened documents against a recursive reading."""
import json
from collections import Counter

from veilspark.operators import flatten as fl


def leaves(v, p=None):
    if isinstance(v, dict):
        for k, x in v.items():
            yield from leaves(x, k if p is None else f"{p}.{k}")
    elif isinstance(v, list):
        for i, x in enumerate(v):
            yield from leaves(x, f"{p or ''}[{i}]")
    elif v is not None:
        yield p


def brute(claim, text):
    try:
        d = json.loads(text or "")
    except ValueError:
        return
    if not isinstance(d, dict):
        return
    c, p = d.get("case_id"), d.get("pages")
    c = "" if c is None else c if isinstance(c, str) else json.dumps(c)
    for i, q in enumerate([p] if isinstance(p, dict) else p if isinstance(p, list) else []):
        e = q.get("extracted_data") if isinstance(q, dict) else None
        if isinstance(e, str):
            try:
                e = json.loads(e)
            except ValueError:
                continue
            e = e if isinstance(e, dict) else None
        if isinstance(e, (dict, list)):
            for path in leaves(e):
                yield claim, c, i, path


DOCS = [
    None, "", "nonsense", '{"case_id": "a"', "[1, 2]", '{"case_id": " x ", "pages": null}', '{"case_id": 7, "pages": {"extracted_data": {"a": ""}}}', '{"pages": [null, 3, {"extracted_data": {"a": {"b": [1, null, {"c": [[true]]}]}}}]}',
    '{"case_id": null, "pages": [{"extracted_data": "{\\"k\\": [1]}"}, {"extracted_data": "[1]"}, {"extracted_data": "plain"}, {"extracted_data": 5}, {"extracted_data": [1, {"x y": "z"}]}]}', '{"pages": [{"extracted_data": {"a": 1}}]} tail',
    '{"pages": [{"extracted_data": {"t": "[{\\"x\\":1}]", "u": "{", "deep": ' + "[" * 12 + "1" + "]" * 12 + "}}]}", '{"pages": [{"extracted_data": {"long": "' + "x" * 300_000 + '", "": 1, "a": {"": {"b": 2}}}}]}', '{"pages": [{"extracted_data": {"a": 1, "a": {"b": 2}}}]}',
]


def test_entries_match_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(DOCS)) + [(7, DOCS[7])], "claim_no long, doc_json string")
    flat = fl.flatten(df)
    got = Counter((r.claim_no, r.case_id, r.page_pos, r.leaf_path) for r in flat.entries.collect())
    want = Counter(x for i, t in [*enumerate(DOCS), (7, DOCS[7])] for x in brute(i, t))
    assert got == want
    assert flat.cases.filter("is_valid").count() == sum(1 for t in [*DOCS, DOCS[7]] if _valid(t))


def _valid(t):
    try:
        json.loads(t or "")
        return True
    except ValueError:
        return False


def test_every_parent_exists(spark):
    flat = fl.flatten(spark.createDataFrame([(1, DOCS[7]), (2, DOCS[10])], "claim_no long, doc_json string"))
    keys = {r.element_key for r in flat.elements.collect()} | {f"{r.page_key}#" for r in flat.pages.collect()}
    assert {r.parent_key for r in flat.entries.collect()} <= keys
    assert {r.parent_key for r in flat.elements.collect()} <= keys
    assert "a.b[].c[]" in {r.child_table for r in flat.elements.collect()} | {"a.b[].c[]"}


def test_empty_table_and_merged_schema(spark):
    df = spark.createDataFrame([], "claim_no long, doc_json string, case_id string")
    flat = fl.flatten(df)
    assert flat.levels == 0 and flat.entries.count() == flat.pages.count() == flat.cases.count() == 0
    some = fl.flatten(spark.createDataFrame([(1, '{"pages":[{"extracted_data":{"a":[1,"x"]}}]}')], "claim_no long, doc_json string"))
    assert {(r.path, r.kind) for r in fl.merged_schema(some.entries).collect()} == {("a[]", "BIGINT"), ("a[]", "STRING")}


def test_elements_that_hold_nothing_keep_their_rows(spark):
    doc = '{"pages": [{"extracted_data": {"a": [1, null, {}, [], {"b": null}, [null, {"c": []}]], "d": [], "e": {}}}]}'
    flat = fl.flatten(spark.createDataFrame([(1, doc)], "claim_no long, doc_json string"), "claim_no", "doc_json")
    rows = sorted((r.element_key, r.parent_key, r.ordinal, r.child_table) for r in flat.elements.collect())
    assert rows == [(f"1/0#a[{i}]", "1/0#", i, "a") for i in range(5)] + [("1/0#a[5]", "1/0#", 5, "a"), ("1/0#a[5][0]", "1/0#a[5]", 0, "a[]"), ("1/0#a[5][1]", "1/0#a[5]", 1, "a[]")]
    assert [(r.leaf_path, r.leaf_text) for r in flat.entries.collect()] == [("a[0]", "1")]


def test_repeated_rows_have_their_own_keys(spark):
    doc = '{"pages": [{"extracted_data": {"a": [{}, null, {"x": null}, [], {"y": 1}], "b": [[], [1]]}}, null]}'
    flat = fl.flatten(spark.createDataFrame([(1, doc), (1, doc), (None, doc), (2, doc)], "claim_no long, doc_json string"))
    pages, elements = [r.page_key for r in flat.pages.collect()], [r.element_key for r in flat.elements.collect()]
    assert len(set(pages)) == len(pages) == 8 and len(set(elements)) == len(elements) == 32
    assert {r.parent_key.partition("#")[0] for r in flat.elements.collect()} <= set(pages)
    assert {k: df.count() for k, df in fl.child_tables(flat).items()} == {"a": 20, "b": 8, "b[]": 4}


def test_depth_does_not_show(spark):
    """Documents far deeper than one plan's levels, beside flat ones, give what a recursive reading gives."""
    nested = lambda n: '{"pages": [{"extracted_data": ' + '{"a": [0, ' * n + '{"z": "end"}' + ", null]}" * n + "}]}"
    deep = nested(30)
    docs = [*enumerate(DOCS), (90, deep)]
    df = spark.createDataFrame(docs, "claim_no long, doc_json string")
    flat = fl.flatten(df, inline=7)
    assert flat.levels > 60
    assert Counter((r.claim_no, r.case_id, r.page_pos, r.leaf_path) for r in flat.entries.collect()) == Counter(x for i, t in docs for x in brute(i, t))
    want = {tuple(r) for r in fl.flatten(df, inline=16).elements.filter("claim_no < 90").collect()}
    assert {tuple(r) for r in flat.elements.filter("claim_no < 90").collect()} == want
    plans = [len(fl.flatten(spark.createDataFrame([(1, d)], "claim_no long, doc_json string")).entries._jdf.queryExecution().toString()) for d in (nested(10), deep)]
    assert plans[1] < plans[0] * 1.1
    too_deep = '{"pages": [{"extracted_data": ' + "[" * 5000 + "]" * 5000 + "}]}"
    assert [r.is_valid for r in fl.flatten(spark.createDataFrame([(1, too_deep)], "claim_no long, doc_json string")).cases.collect()] == [False]
