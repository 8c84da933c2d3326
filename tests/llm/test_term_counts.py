"""Term counts against counting by hand, whole and in updates."""
import unicodedata
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from veilspark.llm import term_counts as tc

ROWS = [(1, "a; b;a", "x"), (2, "b", "x"), (3, None, ""), (4, " ; ;", None), (5, "É; É;\xa0e　", "y"), (6, "b", "x"), (6, "b", "x"), (7, "w" * 100_000, ";;z"), (8, "k;q", " ")]


def brute(rows):
    occ, rec = defaultdict(Counter), defaultdict(Counter)
    for _, d, g in rows:
        for c, terms in (("d", (d or "").split(";")), ("g", [g or ""])):
            terms = [t for t in (unicodedata.normalize("NFC", x).strip() for x in terms) if t]
            occ[c].update(terms)
            rec[c].update(set(terms))
    return {(c, t): (n, rec[c][t]) for c in occ for t, n in occ[c].items()}


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, d string, g string")


def counted(df):
    return {(r.column_name, r.term_text): (r.occurrences, r.records) for r in df.collect()}


COLUMNS = {"d": ";", "g": None}


def test_counts_match_brute_force(spark):
    store = tc.TermStore(spark).apply(tc.terms_of(frame(spark, ROWS), COLUMNS))
    assert counted(store.counts()) == brute(ROWS)


def test_updates_equal_a_recount(spark):
    old = ROWS[:5]
    new = [r for r in ROWS if r[0] in (1, 2, 7)] + [(5, "changed; b", "x"), (9, "b;c", "z")]
    store = tc.TermStore(spark, buckets=4).apply(tc.terms_of(frame(spark, old), COLUMNS))
    delta = tc.changes(frame(spark, old), frame(spark, new), "id", ["d", "g"])
    assert {r.sign for r in delta.collect()} == {-1, 1} and delta.filter("d = 'b'").count() == 0  # unchanged rows are not read
    store.apply(tc.terms_of(delta, COLUMNS, F.col("sign")))
    assert counted(store.counts()) == brute(new)
    again = tc.TermStore(spark, store.path, buckets=4)  # the store is persistent
    assert counted(again.counts()) == brute(new)


def test_everything_deleted_and_empty_tables(spark):
    store = tc.TermStore(spark, buckets=2).apply(tc.terms_of(frame(spark, ROWS).limit(0), COLUMNS))
    assert store.counts().count() == 0
    store.apply(tc.terms_of(frame(spark, ROWS), COLUMNS)).apply(tc.terms_of(frame(spark, ROWS), COLUMNS, -1))
    assert store.counts().count() == 0


def test_verdicts_and_clashing_columns(spark):
    rows = [(i, "often" if i < 30 else f"t{i}", "g") for i in range(60)] + [(70, "twice", "g"), (71, "twice", "g")]
    df = frame(spark, rows).withColumn("term_text", F.lit("clash")).withColumn("column_name", F.lit("clash"))
    v = {(r.term_text, r.verdict) for r in tc.verdicts(tc.summed(tc.terms_of(df, {"d": None}))).collect()}
    assert ("often", "common") in v and ("often", "rare") not in v and ("twice", "rare") in v and len(v) == 32
    both = tc.verdicts(tc.summed(tc.terms_of(frame(spark, rows[:1]), {"d": None}))).collect()
    assert {r.verdict for r in both} == {"rare", "common"}


def test_debts_zeros_and_order_of_updates(spark):
    """Signed deltas commute; what comes to nothing is not kept, a lone deletion is not shown."""
    df = frame(spark, ROWS)
    store = tc.TermStore(spark, buckets=2).apply(tc.terms_of(df, COLUMNS, -1))
    assert store.counts().count() == 0
    store.apply(tc.terms_of(df, COLUMNS)).apply(tc.terms_of(df, COLUMNS))
    assert counted(store.counts()) == brute(ROWS)
    first = tc.TermStore(spark).apply(tc.terms_of(df, COLUMNS).unionByName(tc.terms_of(df, COLUMNS, -1)))
    assert first.counts().count() == 0 and first.manifest["at"] == {}


def test_buckets_belong_to_the_store_and_grow(spark):
    rows = [(i, f"t{i % 50}", "g") for i in range(200)]
    store = tc.TermStore(spark, buckets=2, bucket_rows=10).apply(tc.terms_of(frame(spark, rows), COLUMNS))
    again = tc.TermStore(spark, store.path, buckets=32, bucket_rows=10)
    assert again.buckets == 2 and sum(again.manifest["rows"].values()) == 51
    again.apply(tc.terms_of(frame(spark, rows[:1]), COLUMNS))
    assert again.buckets == 8 and counted(again.counts()) == {**brute(rows), ("d", "t0"): (5, 5), ("g", "g"): (201, 201)}
    assert counted(tc.TermStore(spark, store.path).counts()) == counted(again.counts())


def test_a_second_writer_of_an_update_fails_and_loses_nothing(spark):
    one = tc.TermStore(spark).apply(tc.terms_of(frame(spark, ROWS), COLUMNS))
    two = tc.TermStore(spark, one.path)
    one.apply(tc.terms_of(frame(spark, ROWS[:2]), COLUMNS))
    with pytest.raises(RuntimeError):
        two.apply(tc.terms_of(frame(spark, ROWS[:3]), COLUMNS))
    assert counted(tc.TermStore(spark, one.path).counts()) == brute([*ROWS, *ROWS[:2]])
