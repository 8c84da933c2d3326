"""Published vectors, round trips, and what masks must refuse."""
import os
import re
import stat

import pytest
from pyspark.sql import functions as F

from veilspark.functions import crypto, keys, mask
from veilspark.operators import techniques as tq
from veilspark.plans.errors import RunError

MASTER = "".join(f"{i:02x}" for i in range(32))


def test_siv_vector():
    key = bytes.fromhex("fffefdfcfbfaf9f8f7f6f5f4f3f2f1f0f0f1f2f3f4f5f6f7f8f9fafbfcfdfeff")
    ad, text = bytes.fromhex("101112131415161718191a1b1c1d1e1f2021222324252627"), bytes.fromhex("112233445566778899aabbccddee")
    out = crypto.siv_encrypt([text], key, ad)[0]
    assert out.hex() == "85632d07c6e8f37f950acd320a2ecc9340c02b9690c4dc04daef7f6afe5c"
    assert crypto.siv_decrypt([out, out[:-1] + b"\0", b"x"], key, ad) == [text, None, None]


def test_ff1_vectors():
    k128, k256 = bytes.fromhex("2B7E151628AED2A6ABF7158809CF4F3C"), bytes.fromhex("2B7E151628AED2A6ABF7158809CF4F3CEF4359D8D580AA4F7F036D6F04FC6A94")
    tweak = bytes.fromhex("39383736353433323130")
    assert crypto.ff1([123456789], 10, b"", k128) == [2433477484]
    assert crypto.ff1([123456789], 10, tweak, k128) == [6124200773]
    assert crypto.ff1([123456789], 10, b"", k256) == [6657667009]
    assert crypto.ff1([6657667009, 6657667009], 10, b"", k256, False) == [123456789] * 2


def test_round_trips_and_refusals():
    values = ["x" * n for n in range(40)] + ["राम", "a\u0000b"]
    assert crypto.decrypt_values(crypto.encrypt_values(values, MASTER, "c"), MASTER, "c") == values
    assert crypto.decrypt_values(crypto.encrypt_values(["v"], MASTER, "c"), MASTER, "d") == [None]
    shaped = ["9000000001", "TEST-1234-ab", "9999999999", "000000", "zzzzz"]
    out = crypto.format_values(shaped, MASTER, "c")
    assert crypto.format_values(out, MASTER, "c", False) == shaped
    assert [re.sub("[A-Z]", "U", re.sub("[a-z]", "l", re.sub(r"\d", "9", v))) for v in out] == [re.sub("[A-Z]", "U", re.sub("[a-z]", "l", re.sub(r"\d", "9", v))) for v in shaped]
    for v, code in (("5", "FPE_DOMAIN_TOO_SMALL"), ("12345", "FPE_DOMAIN_TOO_SMALL"), ("AB", "FPE_DOMAIN_TOO_SMALL"), ("राम प्रसाद", "FPE_VALUE_UNSUPPORTED")):
        with pytest.raises(RunError, match=code):
            crypto.format_values([v], MASTER, "c")


def test_hash_vector(spark):
    df = spark.createDataFrame([("BOCW/UP/1",), (" BOCW/UP/1 ",)], "a string")
    got = {r[0] for r in df.select(tq.keyed_hash(tq.identifier(F.col("a")), MASTER)).collect()}
    assert got == {"5b4bed85ff61c96ad4d36d61eb290807fe8414d4f3e97abec032405af7d20d25"}
    assert tq.hash_value(bytes(range(32)), "BOCW/UP/1") in got
    for bad in ("", "test-salt", "00ff", "g" * 64, "0" * 66):
        with pytest.raises(RunError, match="KEY_MATERIAL_INVALID"):
            keys.salt_key(bad, "c")


MASKS = [
    ({"characters_to_mask": [9, 10, 12, 13, 15, 16, 18, 19]}, "2025-04-21T10:30:00+05:30", "2025-04-**T**:**:**+05:30"),
    ({"characters_to_mask": [2]}, "49Y", "4*Y"),
    ({"characters_to_mask": [1, 2, 99, 0, -3]}, "21/04/2025", "**/04/2025"),
    ({"class_masking_mode": "fixed_class"}, "राम P-12", "XXX X-00"),
    ({"class_masking_mode": "fixed_class", "class_mask_letter": "7"}, "ab1", "770"),
    ({"regex_patterns": [{"type": "before", "delimiter": "@"}]}, "ann@x.org", "***@x.org"),
    ({"regex_patterns": [{"type": "after", "delimiter": "@"}]}, "ann@x.org", "ann@*****"),
    ({"regex_patterns": [{"type": "in_between", "start": "(", "end": ")"}]}, "a (b c) d", "a (***) d"),
    ({"regex_patterns": [{"type": "in_between", "start": "#", "end": "$"}]}, "a#bc", "a#**"),
    ({"regex_patterns": [{"type": "before", "delimiter": "-", "length": 2}]}, "abc-def-g", "a**-d**-g"),
    ({"regex_patterns": [{"type": "after", "delimiter": "-", "length": 0}]}, "ab-cd", "ab-**"),
    ({"regex_patterns": [{"regex": r"(\w)(\w+)", "mask_groups": {"2": "partial"}}]}, "anna b", "an** b"),
    ({"regex_patterns": [{"regex": r"\d+", "masking_char": "#"}]}, "a12 b3", "a## b#"),
    ({"regex_patterns": [{"type": "in_between", "start": "1", "end": "2"}]}, "1112", "1**2"),
]


@pytest.mark.parametrize("entry,value,want", MASKS)
def test_masks(spark, entry, value, want):
    m = mask.parse({"column": "a", **entry})
    assert mask.masked(value, m) == want
    df = spark.createDataFrame([(value,), (None,), ("",)], "a string")
    assert [r[0] for r in df.select(tq.mask_column(F.col("a"), m)).collect()][:2] == [want, None]


@pytest.mark.parametrize("entry", [{}, {"regex_patterns": [{"regex": "(?<=a)b"}]}, {"regex_patterns": [{"regex": r"(a)\1"}]}, {"characters_to_mask": [1], "apply_order": ["class"]}, {"class_masking_mode": "odd"}, {"characters_to_mask": [1], "apply_order": ["characters", "x"]}, {"regex_patterns": [{"type": "before"}]}, {"characters_to_mask": ["1"]}])
def test_masks_that_would_mask_nothing_are_refused(entry):
    with pytest.raises(RunError, match="PREPROCESS_CONFIG_INVALID"):
        mask.parse({"column": "a", **entry})


def test_all_techniques_and_tokens(spark, tmp_path):
    rows = [("a", "P1", "ann@x.org", "9000000001", "Ann", "s"), ("a", "P1", "nan", "", "", "s"), ("b", "P2 ", "bob@x.org", "9000000002", "Bob", "s"), ("c", None, None, None, None, "s")]
    df = spark.createDataFrame(rows, "id string, tok string, mail string, phone string, name string, drop string")
    t = tq.Techniques(["drop"], ["id"], [mask.parse({"column": "mail", "regex_patterns": [{"type": "before", "delimiter": "@"}]})], ["name"], [tq.Tokens("tok", "T-", 4)], [tq.Encryption("phone", True)])
    folder = keys.KeyFolder(tmp_path)
    vault = tq.Vault(spark, tmp_path / "tokens")
    out = tq.apply(df, t, folder, vault)
    got = [tuple(r) for r in out.orderBy("id").collect()]
    assert out.columns == ["id", "tok", "mail", "phone", "name"]
    assert len({g[0] for g in got}) == 3 and all(re.fullmatch("[0-9a-f]{64}", g[0]) for g in got)
    tokens = [g[1] for g in got if g[1]]
    assert len(tokens) == 3 and len(set(tokens)) == 2 and all(re.fullmatch(r"T-\d{4}", x) for x in tokens)
    assert sorted(g[2] or "" for g in got) == ["", "***@x.org", "***@x.org", "nan"]
    assert sorted(g[4] or "" for g in got)[2:] != ["Ann", "Bob"] and all(re.fullmatch("[A-Z][a-z]{2}", g[4]) for g in got if g[4])
    phones = [g[3] for g in got if g[3]]
    assert sorted(crypto.format_values(phones, folder.key("phone"), "phone", False)) == ["9000000001", "9000000002"]
    assert tq.counters(df, t) == {"suppress:drop": 4, "hashing_with_salt:id": 4, "masking:mail": 2, "charcloak:name": 2, "tokenization:tok": 3, "encrypt:phone": 2}
    again = tq.tokenise(df, t.tokens[0], tq.Vault(spark, tmp_path / "tokens"))  # another run gives the same tokens
    assert {r.tok for r in again.collect()} - {None} == set(tokens)
    back, unresolved = tq.detokenise(out, "tok", vault)
    assert sorted(r.tok or "" for r in back.collect()) == ["", "P1", "P1", "P2"] and unresolved.first()[0] == 0
    for f in tmp_path.glob("*.json"):
        assert stat.S_IMODE(os.stat(f).st_mode) == 0o600


def test_token_space_and_missing_columns(spark, tmp_path):
    df = spark.createDataFrame([(str(i),) for i in range(10)], "a string")
    with pytest.raises(RunError, match="TOKEN_SPACE_EXHAUSTED"):
        tq.tokenise(df, tq.Tokens("a", "", 1), tq.Vault(spark, tmp_path))
    with pytest.raises(RunError, match="PREPROCESS_COLUMN_MISSING"):
        tq.apply(df, tq.Techniques(hashing=["b"]), keys.KeyFolder())
    with pytest.raises(RunError, match="PREPROCESS_COLUMN_MISSING"):
        tq.apply(df, tq.Techniques(suppress=["a"], hashing=["a"]), keys.KeyFolder())
    with pytest.raises(RunError, match="KEY_MATERIAL_IN_OUTPUT"):
        keys.outside(tmp_path / "out" / "keys", tmp_path / "out")


SCRIPTS = ["कुमारी", "一二 ९", "Ｎame Ⅷ", "ญี่ปุ่น", "Ǆ ǅ ª ͅ", "مُحَمَّد", "ab-12_é", "½ ² ٣", "😀 .,"]


def test_no_letter_of_any_script_survives(spark):
    """Built-in and Python paths use the same classes; cloaked text keeps no letter, mark or digit of its own."""
    plain = mask.parse({"column": "v", "class_masking_mode": "fixed_class"})
    steps = mask.parse({"column": "v", "class_masking_mode": "fixed_class", "regex_patterns": [{"regex": "never there"}]})
    assert plain.built_in and not steps.built_in
    df = spark.createDataFrame([(i, v) for i, v in enumerate(SCRIPTS)], "i int, v string")
    got = df.select("i", tq.mask_column(F.col("v"), plain).alias("a"), tq.mask_column(F.col("v"), steps).alias("b"), tq.cloak_column(F.col("v"), "v").alias("c")).orderBy("i").collect()
    assert [r.a for r in got] == [r.b for r in got]
    assert [r.a for r in got][:2] == ["XXXXXX", "XX 0"]
    for v, r in zip(SCRIPTS, got):
        assert len(r.c) == len(v)
        for x, y in zip(v, r.c):
            assert (y.isascii() and y.isalnum()) if mask.class_of(x) else x == y
