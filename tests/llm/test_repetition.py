"""Repeated shares against marking words one by one."""
import random
import unicodedata

from veilspark.llm import repetition as rp


def brute(text):
    w = [z for z in ("".join(c for c in q if unicodedata.category(c)[0] != "P") for q in (text or "").lower().split()) if z]
    seen, covered = set(), set()
    for i in range(len(w) - 7):
        run = tuple(w[i : i + 8])
        if run in seen:
            covered.update(range(i, i + 8))
        seen.add(run)
    return len(covered) / len(w) if len(w) >= 8 else 0.0


def texts():
    rng = random.Random(8)
    line = "one two three four five six seven eight"
    out = [None, "", " ", "few words", line, f"{line} {line}", f"{line.upper()}! ... {line}", "a " * 50, f"{line} nine {line} ten {line}", "। ".join([line] * 3), "a b c d e f g h " * 4000, "x" * 200_000, "no　break\xa0spaces " * 9]
    for _ in range(60):
        words = [rng.choice("abc") for _ in range(rng.randrange(1, 60))]
        out.append(" ".join(words + words[: rng.randrange(len(words))]))
    return out


def test_share_matches_brute_force(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([*rows, rows[5]], "doc_id long, text string")
    got = [(r.doc_id, r.m_repeated_share) for r in rp.profile(df).collect()]
    assert len(got) == len(rows) + 1
    for i, share in got:
        assert abs(share - brute(rows[i][1])) < 1e-12, rows[i][1][:50]


def test_marks_and_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "§§ ## $$"), (2, "The cat is on the mat\nThe cat is on the mat\n"), (3, None)], "doc_id long, text string")
    p = rp.profile(df)
    marks = {r.doc_id: set(r.marks) for r in p.collect()}
    assert {"short", "symbols"} <= marks[1] and "repeated_lines" in marks[2] and "short" in marks[3]
    plan = p._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_empty_table_extra_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b", "x", 7.0)], "doc_id long, text string, lang string, m_n_words double")
    out = rp.profile(df)
    assert out.first().m_n_words == 2 and "lang" in out.columns and "text" not in out.columns
    assert rp.profile(df.limit(0)).count() == 0


def test_the_query_computes_the_whole_threshold_table(spark, tmp_path):
    from veilspark.llm import queries

    rows = [(1, "one two three four five six seven eight " * 3), (2, "nothing is said again in this text at all"), (3, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.p8_found(spark, str(tmp_path))
    assert [r.doc_id for r in found.collect()] == [1]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert all(t.name in plan for t in rp.THRESHOLDS)
