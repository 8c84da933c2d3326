"""Search, grid and release against worked examples, a naive search, and the promised invariants."""
import random
from collections import Counter
from itertools import product

import pytest

from veilspark.operators import anonymise as an
from veilspark.operators import qi
from veilspark.plans.errors import RunError

GRID_ROWS = {("0", "F"): 2, ("0", "M"): 1, ("1", "F"): 8, ("1", "M"): 7, ("2", "F"): 1, ("2", "M"): 1}


@pytest.fixture(scope="module")
def worked(spark):
    df = spark.createDataFrame([k for k, n in GRID_ROWS.items() for _ in range(n)], "Age string, Gender string")
    qis, n = qi.bind(df, [qi.interval("Age", [(0, 3), (4, 7)], 2), qi.categorical("Gender")])
    return df, qis, n


@pytest.mark.parametrize("local", [10**6, 0])
def test_worked_grid(worked, local):
    df, qis, n = worked
    scorer = an.Scorer(an.histogram(df, qis), qis, [2, 5, 10, 15], local_cells=local)
    cells = an.parameter_grid(scorer, [1, 1], n, [2, 5, 10, 15], [0, 0.05, 0.1])
    low, high = [((3, 1), 202), ((3, 1), 202), ((2, 1), 164)], [((3, 2), 400), ((3, 2), 400), ((2, 2), 324)]
    assert [(c.node, c.score.dm_star) for c in cells] == low + low + high + high
    assert len(an.Lattice.build(qis, [1, 1]).nodes) == 6


def rows_of(rng, n):
    return [(str(rng.randrange(100)), str(560000 + 17 * rng.randrange(6)), rng.choice(["M", "F", "X", " M", "m"]), f"D{rng.randrange(5)}") for _ in range(n)]


LADDER = {"gender": {"M": ["Any"], "F": ["Any"], "X": ["Any"], "*": ["Any"]}}


def naive(rows, qis, k, sigma, l=1):
    """Every node by hand."""
    best = None
    for node in product(*(q.chain() for q in qis)):
        classes = {}
        for r in rows:
            classes.setdefault(tuple(label(q, v, lv) for q, v, lv in zip(qis, r, node)), []).append(r[3])
        fail = sum(len(c) for c in classes.values() if len(c) < k or len(set(c)) < l)
        good = [len(c) for c in classes.values() if len(c) >= k and len(set(c)) >= l]
        if fail <= an.allowed(sigma, len(rows)):
            key = (sum(x * x for x in good), fail, -len(good), node)
            best = key if best is None else min(best, key)
    return best


def label(q, v, level):
    if q.kind == "category":
        return qi.ladder_label(q.ladder, v.strip(), level)
    return (int(v) - q.low) // level


@pytest.mark.parametrize("seed,k,sigma,l", [(1, 3, 0.0, 1), (2, 5, 0.05, 1), (3, 4, 0.1, 2), (4, 2, 0.25, 3)])
def test_search_finds_the_naive_best(spark, seed, k, sigma, l):
    rows = rows_of(random.Random(seed), 60)
    df = spark.createDataFrame(rows, "Age string, Zip string, Gender string, Diagnosis string")
    qis, n = qi.bind(df, [qi.uniform("Age", 3), qi.uniform("Zip", 10), qi.categorical("Gender", LADDER)])
    values = an.sensitive_values(df, qis, ["Diagnosis"], l) if l > 1 else None
    scorer = an.Scorer(an.histogram(df, qis), qis, [k], values, l, local_cells=10**6 if seed % 2 else 0)
    found = an.search(scorer, [1, 1, 1], k, sigma, n)
    want = naive(rows, qis, k, sigma, l)
    assert (found.score.dm_star, found.score.suppressed, -found.score.classes, found.node) == want
    assert found.top[0][0] == found.node and len(found.top) <= 5


@pytest.mark.parametrize("seed", range(4))
def test_release_keeps_its_promise(spark, seed):
    rng = random.Random(seed)
    rows, k, sigma, l = rows_of(rng, rng.randrange(1, 80)), rng.randrange(1, 9), rng.choice([0, 0.05, 0.25, 1]), rng.choice([1, 2])
    df = spark.createDataFrame(rows, "Age string, Zip string, Gender string, Diagnosis string")
    qis, n = qi.bind(df, [qi.uniform("Age", 2), qi.uniform("Zip", 10), qi.categorical("Gender", LADDER)])
    d = an.Diversity(l, ("Diagnosis",)) if l > 1 else None
    scorer = an.Scorer(an.histogram(df, qis), qis, [k], an.sensitive_values(df, qis, d.attributes, l) if d else None, l)
    try:
        found = an.search(scorer, [1, 1, 1], k, sigma, n)
    except RunError as e:
        assert e.code == "GENERALIZATION_FAILED"
        return
    r = an.release(df, qis, found.node, k, d)
    out = [tuple(x) for x in r.table.collect()]
    classes = {}
    for x in out:
        classes.setdefault(x[:3], []).append(x[3])
    assert len(out) + r.summary.removed == n
    assert all(len(c) >= k and len(set(c)) >= l for c in classes.values())
    assert r.summary.suppressed <= an.allowed(sigma, n)
    assert (r.summary.dm_star, r.summary.suppressed) == (found.score.dm_star, found.score.suppressed)


def people(spark, rows):
    return spark.createDataFrame(rows, "Age string, Name string")


def test_small_tables(spark):
    df = people(spark, [("20", "Alice"), ("20", "Bob"), ("21", "Carol")])
    q, _ = qi.bind(df, [qi.uniform("Age")])
    assert sorted(map(tuple, an.release(df, q, [1], 2).table.collect())) == [("[20-20]", "Alice"), ("[20-20]", "Bob")]
    df = people(spark, [("20", "Alice"), ("21", "Bob"), ("20", "Carol"), ("30", "Dan")])
    q, _ = qi.bind(df, [qi.uniform("Age")])
    assert sorted(map(tuple, an.release(df, q, [1], 2).table.collect())) == [("*", "Bob"), ("*", "Dan"), ("[20-20]", "Alice"), ("[20-20]", "Carol")]
    df = people(spark, [("30", "x")] * 3 + [("31", "y")] * 3)
    q, n = qi.bind(df, [qi.uniform("Age")])
    r = an.release(df, q, [2], 5)
    assert {x.Age for x in r.table.collect()} == {"[30-31]"} and r.summary.suppressed == 0
    assert an.release(df, q, [2], 50).table.count() == 0


def test_extreme_numbers_have_no_bin(spark):
    df = people(spark, [(a, "n") for a in ("-1e18", "inf", "NaN", "1e308", "1d", "0x10", None, "")] + [("40", "n")] * 6)
    q, n = qi.bind(df, [qi.uniform("Age")])
    assert (q[0].low, q[0].high, n) == (40, 40, 14)
    assert Counter(r.Age for r in an.release(df, q, [1], 6).table.collect()) == {"*": 8, "[40-40]": 6}


def test_number_and_category_forms(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(x,) for x in [" 7 ", "2.5", "-2.5", ".5", "5.", "+3", "1_0", "1e2"]], "a string")
    assert [r[0] for r in df.select(qi.number(F.col("a"))).collect()] == [7, 3, -3, 1, 5, 3, None, 100]
    assert spark.createDataFrame([(" É ",)], "a string").select(qi.category(F.col("a"))).first()[0] == "É"


def test_interval_levels():
    h = qi.interval_levels([(100, 149), (150, 199)], 2)
    assert h.depth == 6 and h.levels[-1] == ((100, 149), (150, 199)) and h.levels[0][0] == (100, 100)
    assert qi.interval_levels([(0, 999)], 10).depth == 3  # logarithms of doubles
    assert qi.interval_levels([(0, 1)], 5).depth == 1
    with pytest.raises(RunError):
        qi.fixed_intervals([(0, 5), (5, 9)])


def test_fixed_bins_and_ladders(spark):
    df = spark.createDataFrame([(str(a), g) for a in (20, 39, 40, 130) for g in ("M", "m", " M", "F")], "Age string, Gender string")
    q, _ = qi.bind(df, [qi.fixed("Age", [(40, 120), (0, 39)]), qi.categorical("Gender", {"GENDER": {"M": ["Person"], "F": ["Person"]}})])
    out = an.generalise(df, q, [1, 2])
    assert {r.Age for r in out.collect()} == {"[0-39]", "[40-120]", "*"}
    assert Counter(r.Gender for r in out.collect()) == {"Person": 12, "*": 4}


def test_refusals(spark):
    df = spark.createDataFrame([("A", *["1", "99999"][i % 2 :][:1] * 8) for i in range(50)], ", ".join(f"c{i} string" for i in range(9)))
    with pytest.raises(RunError, match="do not nest"):
        qi.categorical("c0", {"c0": {"A": ["X", "P"], "B": ["X", "Q"]}}).with_domain(["A", "B"])
    qis, _ = qi.bind(df, [qi.uniform(f"c{i}") for i in range(1, 9)])
    with pytest.raises(RunError, match="LATTICE_TOO_LARGE"):
        an.Lattice.build(qis, [1] * 8)
    with pytest.raises(RunError, match="DATA_COLUMN_MISSING"):
        qi.bind(df, [qi.uniform("c1 ")])
    with pytest.raises(RunError, match="ANON_NO_QIS"):
        qi.bind(df, [])


def test_packed_key_and_bounds(worked):
    df, qis, n = worked
    hist = an.histogram(df, qis)
    back = an.z_decode(an.z_histogram(hist, qis), qis)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, hist.collect()))
    assert an.equivalence_space(qis) == 16 and an.choose_flow("auto", 20, qis) == "original"
    assert an.k_optimal(hist, qis, 0.0, n) == 20
    assert an.first_node(qis, 10**6) == [1, 1] and an.first_node(qis, 4) == [2, 2] if len(qis[1].groups) > 1 else True
    assert an.allowed(0.29, 100) == 29
