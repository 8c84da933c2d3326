"""Look-alike text against a mapping by Python's own normalisation."""
import re
import unicodedata
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from veilspark.llm import lookalike as la

TABLE = str.maketrans(la.LOOKALIKES)
HIDDEN = re.compile("[\xad͏؜ᅟᅠ឴឵᠋-᠏​-‏‪-‮⁠-⁯ㅤ︀-️﻿ﾠ]")


def brute(x):
    return unicodedata.normalize("NFC", " ".join(HIDDEN.sub("", unicodedata.normalize("NFKD", x)).translate(TABLE).split()))


NAMES = ["Ann Lee", "Ann  Lee", "Ａnn Lee", "Аnn Lee", "Ann​ Lee ", "Ann\xa0Lee", "ann Lee", "Ánn Lee", "Ánn Lee", "Ann-Lee", "Ann‐Lee", "Ann–Lee", "AnnLee", "ﬆone", "stone", "ड़", "ड़", "", " ​", None, "Ann. Lee", "x" * 50_000, "х" * 50_000, "Ann͏́", "Ań", "ёж", "ëж", "її", "ïï", "άb", "áb", "ӓö", "äӧ"]


def test_classes_match_brute_force(spark):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(NAMES)], "i int, n string")
    same = {r.i: r.n_same for r in la.consistent(df, ["n"]).collect()}
    assert len(same) == len(NAMES)
    for (i, a), (j, b) in combinations([(i, n) for i, n in enumerate(NAMES) if n and brute(n)], 2):
        assert (same[i] == same[j]) == (brute(a) == brute(b)), (a[:20], b[:20])
    assert all(same[i] is None for i, n in enumerate(NAMES) if not n or not brute(n))


def rows():
    out = []
    for i, n in enumerate(NAMES):
        for m in ("a@x.org", "а@x.org", "b@x.org", None):
            out.append((len(out), n, "12 3", m))
    return out + out[:3]


def test_pairs_match_brute_force(spark):
    data = rows()
    df = spark.createDataFrame(data, "id int, Name string, Aadhaar string, Email string").withColumn("form", F.lit("clash")).withColumn("same", F.lit("clash"))
    got = [tuple(r) for r in la.same_looking_pairs(df, "id", ["Name", "Aadhaar", "Email"]).collect()]
    keyed = [(r, tuple(brute(x or "") for x in r[1:])) for r in data]
    want = [(min(a[0], b[0]), max(a[0], b[0])) for (a, ka), (b, kb) in combinations(keyed, 2) if ka == kb and all(ka) and a[1:] != b[1:] and a[0] != b[0]]
    assert sorted(got) == sorted(want)


def test_canonical_member_is_the_plainest(spark):
    df = spark.createDataFrame([("Ａb",), ("Ａb",), ("Ab",), ("c​",), ("c",), ("Ｄ",), ("Ｄ​",)], "n string")
    assert sorted(r.n_same for r in la.consistent(df, ["n"]).collect()) == ["Ab", "Ab", "Ab", "c", "c", "Ｄ", "Ｄ"]


@pytest.mark.parametrize("a,b", [("ёлка", "ëлка"), ("Ї", "Ï"), ("ά", "á"), ("ӧ", "ö"), ("ꓮΒꮯ".upper(), "ABC"), ("ıt", "it")])
def test_composed_look_alikes_meet(spark, a, b):
    df = spark.createDataFrame([(1, a), (2, b)], "id int, n string")
    assert [tuple(r) for r in la.same_looking_pairs(df, "id", ["n"]).collect()] == [(1, 2)]


def test_empty_table_and_clashing_names(spark):
    df = spark.createDataFrame([], "id int, n string, n_same string")
    assert la.same_looking_pairs(df, "id", ["n"]).count() == 0
    out = la.consistent(spark.createDataFrame([(1, "a", "kept")], "id int, n string, n_same string"), ["n"])
    assert out.first().asDict() == {"id": 1, "n": "a", "n_same": "kept", "n_same_2": "a"}


@pytest.mark.parametrize("a,b", [("O", "0"), ("l", "1"), ("rn", "m"), ("é", "e"), ("A", "a"), ("a,b", "ab")])
def test_what_one_sees_stays_apart(spark, a, b):
    df = spark.createDataFrame([(1, a), (2, b)], "id int, n string")
    assert la.same_looking_pairs(df, "id", ["n"]).count() == 0
