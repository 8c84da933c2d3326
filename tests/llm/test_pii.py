"""Personal information: known cases, held-out names, message passing, placeholders."""
import math
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from veilspark.llm import pii

GIVEN = "Ganur Jovitha Orana Kelesh Marina Tarvik Belina Haresh Devomi Solana Vesur Yasina Umana Farela Zoritha Navela Quenur Ishant".split()
FAMILY = "Moredi Thalsey Eskaru Wexedi Bramaru Jararu Kathedi Ostoja Nimulla Pellmoor Goloja Sutulla Vandmoor Lorsey Fenmoor Adhedi Zimkar Rindoja".split()
FILLER = ["The patient was stable on review.", "After lunch, the claimant walked 40 metres with mild pain.", "Lumefin 20 mg was given at noon.", "Bill 2025-38622 paid.", "The output stayed empty, although the pharmacist had promised to call.", "Referred to Lorsey District Hospital.", "From Lakshore to Rivermound the van carried 2 cases."]
CARRIERS = ["Next of kin: {}.", "Attender {} informed.", "Spoke to {} about diet.", "Seen by Dr {}.", "{} was anxious about the bill.", "Sent home with {}.", "Is {} allergic to dust?", "{} agrees."]


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(3)
    known = [(n, "given") for n in GIVEN[:12]] + [(n, "family") for n in FAMILY[:12]]
    texts = []
    for _ in range(1500):
        name = f"{rng.choice(GIVEN[:12])} {rng.choice(FAMILY[:12])}"
        texts.append(f"{rng.choice(FILLER)} {rng.choice(CARRIERS).format(name)} {rng.choice(FILLER)}")
    return pii.fit(known, texts)


def found(text, model):
    return [(text[s:e], pii.TYPES[k]) for _, s, e, k in pii.analyse([text], model)]


PATTERNS = [
    ("Write to ann.lee+w1@post.example.net for it.", ("ann.lee+w1@post.example.net", "EMAIL")), ("cc a_b at ward dot example dot org now", ("a_b at ward dot example dot org", "EMAIL")), ("<x1 (at) clinic.test> asked", ("x1 (at) clinic.test", "EMAIL")), ("via q @ inbox.invalid.", ("q @ inbox.invalid", "EMAIL")),
    ("Call +91 98786 09595 now", ("+91 98786 09595", "PHONE")), ("tel:(080) 4687 2726", ("(080) 4687 2726", "PHONE")), ("[09109966323]", ("09109966323", "PHONE")), ("SMS to 866.482.5773", ("866.482.5773", "PHONE")), ("on 0091 7470371263;", ("0091 7470371263", "PHONE")), ("on 080-26826062 for", ("080-26826062", "PHONE")),
    ("UID 3259 0806 8568", ("3259 0806 8568", "ID")), ("Aadhaar on file: 231048774284.", ("231048774284", "ID")), ("PAN srrsb6564o", ("srrsb6564o", "ID")), ("Van TN-42-OI-1663 released.", ("TN-42-OI-1663", "ID")), ("See P118975 for", ("P118975", "ID")),
    ("Lives at H.No 2-337, Kelmoor St, Northgate.", ("H.No 2-337, Kelmoor St, Northgate", "ADDRESS")), ("House is #314, Mango Lane, Millpet - 560749; no", ("#314, Mango Lane, Millpet - 560749", "ADDRESS")), ("R/o Door no 337, near Lotus Temple, Fernmarket 560525", ("Door no 337, near Lotus Temple, Fernmarket 560525", "ADDRESS")), ("from 408 Canal Lane, Northgate by bus", ("408 Canal Lane, Northgate", "ADDRESS")),
]


@pytest.mark.parametrize("text,want", PATTERNS)
def test_patterns(model, text, want):
    assert found(text, model) == [want]


@pytest.mark.parametrize("text", ["Txn 03609136091 settled.", "Lot 151248087 opened.", "Bill 2025-51303 paid.", "File 97072/73 shelved at row 3.", "Pump serial KX-71-30584.", "Vitals at 02.34, temp 99.8.", "Hb 6.6, platelets 1,119,000.", "Seen on 12/12/2025 at 12:16.", "Room 12/4, Lotus ward.", "Handover @ 6 pm.", "Batch AB49280C expired.", "Referred to Lorsey District Hospital.", "", "The patient was stable on review."])
def test_no_cases(model, text):
    assert found(text, model) == []


def test_held_out_names_are_found(model):
    """Names that the lexicon and the sample do not hold, in every carrier."""
    hits = total = 0
    for carrier, g, f in product(CARRIERS, GIVEN[12:], FAMILY[12:]):
        text = f"{FILLER[0]} {carrier.format(f'{g} {f}')} {FILLER[2]}"
        total += 1
        hits += any(t == f"{g} {f}" and k == "NAME" for t, k in found(text, model))
    assert hits / total >= 0.9
    quiet = sum(bool([x for x in found(f"{a} {b}", model) if x[1] == "NAME"]) for a in FILLER for b in FILLER)
    assert quiet == 0


@pytest.mark.parametrize("name", ["Ganur Moredi", "GANUR MOREDI", "ganur moredi", "Moredi, Ganur", "G. Moredi", "Ganur B. Moredi", "Moredi-Thalsey", 'Ganur "Gan" Moredi'])
def test_forms_of_one_name(model, name):
    got = [x for x in found(f"Seen by Dr {name}. The output stayed empty.", model) if x[1] == "NAME"]
    assert len(got) == 1 and got[0][0].startswith(name.split('"')[0].strip().split(",")[0])


NONE = np.array([], np.int64)
PAIRS = pii.couplings(pii.PRIOR)


def test_skip_edges_carry_evidence():
    """A doubtful mention is lifted by a sure one of the same spelling."""
    unary = np.full((2, 6), pii.NEVER)
    unary[:, 0], unary[:, pii.NAME] = 0, [4.0, -0.8]
    assert pii.propagate(unary, NONE, NONE, NONE, PAIRS).argmax(1).tolist() == [pii.NAME, pii.O]
    assert pii.propagate(unary, np.array([0]), np.array([1]), np.array([1]), PAIRS).argmax(1).tolist() == [pii.NAME] * 2


def test_messages_are_exact_on_trees():
    rng = np.random.default_rng(0)
    for _ in range(5):
        n, k = 5, 4
        unary, a = rng.normal(0, 2, (n, k)), np.array([rng.integers(0, i) for i in range(1, n)])
        unary[:, 0] = 0
        b, kind, pairs = np.arange(1, n), rng.integers(0, 2, n - 1), rng.normal(0, 1, (2, k, k))
        got = pii.propagate(unary, a, b, kind, pairs)
        mass = np.zeros((n, k))
        for y in product(range(k), repeat=n):
            y = np.array(y)
            mass[np.arange(n), y] += math.exp(float(unary[np.arange(n), y].sum() + pairs[kind, y[a], y[b]].sum()))
        assert np.allclose(got - got[:, :1], np.log(mass / mass[:, :1]), atol=1e-3)


def test_messages_settle_on_loops():
    """A ring and a long chain of doubtful nodes around one sure node."""
    n = 400
    unary = np.full((n, 6), pii.NEVER)
    unary[:, 0], unary[:, pii.NAME] = 0, -0.1
    unary[0, pii.NAME] = 6
    a = np.arange(n)
    y = pii.propagate(unary, a, (a + 1) % n, np.full(n, 3), PAIRS).argmax(1)
    assert (y[:5] == pii.NAME).all() and (y[-5:] == pii.NAME).all() and y[n // 2] == pii.O


def test_batches_do_not_mix_texts(model):
    texts = [t for t, _ in PATTERNS] + ["", "Next of kin: Ganur Moredi.", "x\x00y P123456"] * 2
    alone = [(i, s, e, k) for i, t in enumerate(texts) for _, s, e, k in pii.analyse([t], model)]
    assert pii.analyse(texts, model) == alone
    assert pii.analyse([], model) == []


def test_frames_placeholders_and_documents(spark, model):
    rows = [(1, "Call 9876543210 or ann@x.org. Ganur Moredi agrees.", "c"), (1, "Call 9876543210 or ann@x.org. Ganur Moredi agrees.", "c"), (2, None, "c"), (3, "", "c"), (4, "क " * 50_000 + "P123456", "c")]
    df = spark.createDataFrame(rows, "visit_id long, Note string, found string")
    out = pii.find(df, ["visit_id"], "Note", model)
    clean = sorted((r[0], r[1]) for r in out.select("visit_id", pii.replace(F.col("text"), F.col("found"))).collect())
    assert clean[:2] == [(1, "Call [PHONE] or [EMAIL]. [NAME] agrees.")] * 2 and clean[2][1].endswith(" [ID]") and len(clean) == 3
    whole = pii.find(spark.createDataFrame([(1, "nothing"), (2, "P123456")], "visit_id long, Note string"), ["visit_id"], "Note", model, every=True)
    assert sorted(tuple(r) for r in whole.select("visit_id", pii.replace(F.col("text"), F.col("found"))).collect()) == [(1, "nothing"), (2, "[ID]")]
    assert pii.find(df.limit(0), ["visit_id"], "Note", model).count() == 0
    doc = '{"pages": [null, {"extracted_data": {"remarks": "a", "x": {"discharge_advice": ["b", {"clinical_summary": "c", "other": "d"}]}}}, {"extracted_data": "{\\"remarks\\": \\"e\\"}"}]}'
    docs = spark.createDataFrame([(5, doc), (6, None), (7, "{"), (8, '{"pages": {"extracted_data": {"remarks": "f"}}}'), (9, "[1]")], "claim_no long, doc_json string")
    got = sorted(tuple(r) for r in docs.mapInArrow(pii.claim_texts, "record_id bigint, page_pos int, leaf_path string, text string").collect())
    assert got == [(5, 1, "remarks", "a"), (5, 1, "x.discharge_advice[0]", "b"), (5, 1, "x.discharge_advice[1].clinical_summary", "c"), (5, 2, "remarks", "e"), (8, 0, "remarks", "f")]


def test_nothing_to_learn_from(spark):
    m = pii.fit([], [])
    assert [k for *_, k in pii.analyse(["Call 9876543210"], m)] == [2]


REPEATED = [
    ("Mobile 98786 09595 noted.", " Query 9878609595 open.", "PHONE"), ("Call +91 98786 09595 now.", " Room 09878609595 asked.", "PHONE"), ("UID 3259 0806 8568 seen.", " Ref 325908068568 again.", "ID"),
    ("tel:(080) 4687 2726 in use.", " Rang 4687 2726 twice.", "PHONE"), ("Came from 408 Canal Lane, Northgate by bus.", " Parcel left for 408 Canal again.", "ADDRESS"),
]


@pytest.mark.parametrize("clear,doubtful,kind", REPEATED)
def test_a_clear_mention_decides_a_doubtful_one(model, clear, doubtful, kind):
    """Only messages over skip edges give the label: alone, or with another number before it, the second mention is off."""
    assert [k for _, k in found(clear, model)] == [kind] and found(doubtful, model) == []
    assert [k for _, k in found(clear + doubtful, model)] == [kind] * 2
    other = clear.translate(str.maketrans("56789", "67896"))
    assert [k for _, k in found(other + doubtful, model)] == [kind]


def test_a_transaction_number_stays_unmarked(model):
    assert found("9878609595 was rung. Txn 9878609595 settled.", model) == [("9878609595", "PHONE")]


def test_every_row_is_kept_when_replacing(spark, model):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "P123456"), (3, "P123456")], "visit_id long, Note string")
    whole = pii.find(df, ["visit_id"], "Note", model, every=True)
    got = sorted((r[0], r[1] or "", r[1] is None) for r in whole.select("visit_id", pii.replace(F.col("text"), F.col("found"))).collect())
    assert got == [(1, "", True), (2, "", False), (3, "[ID]", False), (3, "[ID]", False)]
    assert list(pii.leaves({"remarks": "", "x": {"remarks": None}})) == [("remarks", "")]


def test_nothing_is_cut_short(model):
    """Local parts, distances and names of streets of any length."""
    local = "a" * 300
    assert found(f"Mail {local}@x.example.org now", model) == [(f"{local}@x.example.org", "EMAIL")]
    street = "12 Kelmoor New Upper East Side Old Mill Road, Northgate"
    assert found(f"Came from {street} by bus.", model) == [(street, "ADDRESS")]
    assert found("Txn" + " " * 200 + "03609136091 settled.", model) == []
    deep = '{"pages": [{"extracted_data": ' + '{"a": [' * 20_000 + '{"remarks": "x"}' + "]}" * 20_000 + "}]}"
    assert [t for _, t in pii.leaves(pii.loads(deep)["pages"][0])] == ["x"]


@pytest.mark.parametrize("number", ["+1 415 555 2671", "+44 20 7946 0958", "+971-50-1234567"])
def test_numbers_of_other_countries(model, number):
    assert found(f"Call {number} now.", model) == [(number, "PHONE")]


def test_context_and_messages_choose_the_type(model):
    """Twelve digits may be a phone number or an identity number; what is said of one mention holds for all."""
    assert found("Call 919876543210 now.", model) == [("919876543210", "PHONE")]
    assert found("Aadhaar 919876543210 seen.", model) == [("919876543210", "ID")]
    assert found("It reads 919876543210 there.", model) == [("919876543210", "ID")]
    assert [k for _, k in found("Call +91 98765 43210. It reads 919876543210 there.", model)] == ["PHONE", "PHONE"]


def test_weights_are_fitted_and_stay_near_their_prior(model):
    moved = np.abs(model.weights - pii.PRIOR)
    assert moved.max() > 0.01 and moved.max() < 3 and np.isfinite(model.weights).all()
    assert model.weights[pii.PLACE["lexicon"]] == pii.PRIOR[pii.PLACE["lexicon"]]


def test_a_name_that_differs_by_one_letter_is_linked(model):
    f = pii.field_of(["Seen by Dr Zoritha Rindoja. zorita was anxious."], model)
    assert 2 in f.edge.tolist() or len(f.node) < 3
    g = pii.field_of(["Zoritha Rindoja agrees. Mail zoritha.rindoja@x.example.org now"], model)
    assert g.edge.tolist().count(4) == 2


def test_the_sample_is_bounded_and_drawn_by_hash(spark):
    df = spark.range(20_000).selectExpr("id", "concat('t', id) AS text")
    got = pii.drawn(df, "id", 500).collect()
    assert 400 <= len(got) <= 500 and max(r.id for r in got) > 15_000
    assert pii.drawn(df.limit(0), "id", 500).collect() == []
    assert pii.drawn(df.limit(30), "id", 500).count() == 30
    with pytest.raises(ValueError):
        pii.fit_from(spark.range(pii.MAX_LEXICON + 1).selectExpr("string(id) AS name_part", "'given' AS name_kind"), df, "id", "text")
