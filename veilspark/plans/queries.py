"""Queries of the anonymisation operators over the test tables, with their SQL."""
from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilspark.functions import mask
from veilspark.functions.keys import KeyFolder
from veilspark.operators import anonymise as an
from veilspark.operators import bundles, documents, qi, sheets
from veilspark.operators import techniques as tq
from veilspark.operators.policy import parse_policy
from veilspark.session import shared_dir, spread
from veilspark.streaming import release as streams

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
SALT = "".join(f"{i:02x}" for i in range(32))


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{d}/{name}.parquet")
    return df.select(*columns) if columns else df


# statistics

_NUM = "CASE WHEN regexp_full_match(t, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') AND abs(try_cast(t AS DOUBLE)) <= 9007199254740992 THEN CAST(round(try_cast(t AS DOUBLE)) AS BIGINT) END"
_WS = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _strip(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^{_WS}+', ''), '{_WS}+$', '')"


@query("SELECT min(CAST(round(c_acctbal) AS BIGINT)) AS lo, max(CAST(round(c_acctbal) AS BIGINT)) AS hi, count(*) AS n FROM customer")
def qi_minmax(spark, d):
    df = _t(spark, d, "customer", "c_acctbal")
    v = qi.typed(df, [qi.uniform("c_acctbal")])[0].cell()
    return df.agg(F.min(v).alias("lo"), F.max(v).alias("hi"), F.count("*").alias("n"))


@query("SELECT DISTINCT 'o_orderpriority' AS column_name, o_orderpriority AS value FROM orders UNION ALL SELECT DISTINCT 'o_orderstatus', o_orderstatus FROM orders")
def qi_domain(spark, d):
    qis = [qi.categorical("o_orderpriority"), qi.categorical("o_orderstatus")]
    return qi.domains(qi.value_counts(_t(spark, d, "orders"), qis), qis)


@query(f"WITH a AS (SELECT row_id, {_strip('Age')} AS t FROM patients) SELECT row_id, {_NUM} AS age FROM a")
def numeric_parse(spark, d):
    return _t(spark, d, "patients", "row_id", "Age").select("row_id", qi.number(F.col("Age")).alias("age"))


@query(f"SELECT row_id, coalesce(nfc_normalize({_strip('Name')}), '') AS name FROM patients")
def category_normalise(spark, d):
    return _t(spark, d, "patients", "row_id", "Name").select("row_id", qi.category(F.col("Name")).alias("name"))


# histogram and lattice over lineitem

LINE = ("l_quantity", "l_linenumber", "l_returnflag", "l_linestatus")
LINE_K = (50, 200, 1000, 5000)


def _line(spark, d):
    df = _t(spark, d, "lineitem", *LINE)
    qis, n, counts = an.prepare(df, [qi.uniform("l_quantity", 2), qi.uniform("l_linenumber", 2), qi.categorical("l_returnflag"), qi.categorical("l_linestatus")])
    return an.histogram_of(counts, qis), qis, n


_BASE = """b AS (SELECT CAST(min(l_quantity) AS BIGINT) AS q0, CAST(max(l_quantity) AS BIGINT) AS q1, min(l_linenumber)::BIGINT AS n0, max(l_linenumber)::BIGINT AS n1 FROM lineitem),
  flags AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS p FROM (SELECT DISTINCT l_returnflag AS v FROM lineitem)),
  states AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS p FROM (SELECT DISTINCT l_linestatus AS v FROM lineitem)),
  hist AS (SELECT CAST(l_quantity AS BIGINT) - q0 AS c0, l_linenumber::BIGINT - n0 AS c1, flags.p AS c2, states.p AS c3, count(*) AS n
           FROM lineitem, b, flags, states WHERE flags.v = l_returnflag AND states.v = l_linestatus GROUP BY ALL)"""
_NODES = f"""{_BASE},
  w0 AS (SELECT DISTINCT least(CAST(2 ** i AS BIGINT), q1 - q0 + 1) AS a FROM b, range(0, 40) t(i)), w1 AS (SELECT DISTINCT least(CAST(2 ** i AS BIGINT), n1 - n0 + 1) AS b FROM b, range(0, 40) t(i)),
  nodes AS (SELECT a, w1.b, f.f, s.s FROM w0, w1, range(1, 3) f(f), range(1, 3) s(s)),
  classes AS (SELECT a, nodes.b, f, s, c0 // a AS g0, c1 // nodes.b AS g1, CASE WHEN f = 1 THEN c2 ELSE 0 END AS g2, CASE WHEN s = 1 THEN c3 ELSE 0 END AS g3, sum(n)::BIGINT AS n FROM hist, nodes GROUP BY ALL),
  ks AS (SELECT unnest([50, 200, 1000, 5000]) AS k),
  scores AS (SELECT a, b, f, s, k, sum(CASE WHEN n < k THEN n ELSE 0 END)::BIGINT AS suppressed, sum(CASE WHEN n >= k THEN n * n ELSE 0 END)::BIGINT AS dm_star, count(*) FILTER (n >= k) AS classes FROM classes, ks GROUP BY ALL)"""


@query(f"WITH {_BASE} SELECT * FROM hist")
def base_histogram(spark, d):
    hist, qis, _ = _line(spark, d)
    return hist


@query(f"WITH {_BASE} SELECT ((c0 + 1) * (n1 - n0 + 2) + c1 + 1) * (SELECT count(*) FROM flags) * (SELECT count(*) FROM states) + c2 * (SELECT count(*) FROM states) + c3 AS z, n FROM hist, b")
def z_histogram(spark, d):
    hist, qis, _ = _line(spark, d)
    return an.z_histogram(hist, qis)


@query(f"WITH {_BASE} SELECT c0, c1, c2, c3, n FROM hist")
def z_decoded(spark, d):
    hist, qis, _ = _line(spark, d)
    return an.z_decode(an.z_histogram(hist, qis), qis)


@query(f"WITH {_BASE} SELECT c0 // 8 AS g0, c1 // 2 AS g1, c2 AS g2, 0::BIGINT AS g3, sum(n)::BIGINT AS n FROM hist GROUP BY ALL")
def merge_node(spark, d):
    hist, qis, _ = _line(spark, d)
    return an.merge(hist, qis, [8, 2, 1, 2])


@query(f"WITH {_BASE} SELECT count(*) AS buckets, min(n) AS smallest, max(n) AS largest, count(*) FILTER (n < 5) AS below_5, count(*) FILTER (n >= 5 AND n < 50) AS below_50, count(*) FILTER (n >= 50) AS from_50 FROM hist")
def histogram_diagnostic(spark, d):
    hist, qis, _ = _line(spark, d)
    n = F.col("n")
    return hist.agg(F.count("*").alias("buckets"), F.min(n).alias("smallest"), F.max(n).alias("largest"), F.count_if(n < 5).alias("below_5"), F.count_if((n >= 5) & (n < 50)).alias("below_50"), F.count_if(n >= 50).alias("from_50"))


@query(f"WITH {_NODES} SELECT a AS l0, b AS l1, f AS l2, s AS l3, k, suppressed, dm_star, classes FROM scores")
def node_scores(spark, d):
    hist, qis, _ = _line(spark, d)
    nodes = an.Lattice.build(qis, [1] * 4).nodes
    classes = an.Scorer(hist, qis, LINE_K, local_cells=0).classes(nodes)
    levels = F.element_at(F.from_json(F.lit(json.dumps(nodes)), "array<array<bigint>>"), F.col("node") + 1)
    ks = F.explode(F.array(*[F.lit(k) for k in LINE_K]))
    n, k = F.col("n"), F.col("k")
    per = classes.select("node", "n", ks.alias("k")).groupBy("node", "k").agg(F.sum(F.when(n < k, n).otherwise(0)).alias("suppressed"), F.sum(F.when(n >= k, n * n).otherwise(0)).alias("dm_star"), F.count_if(n >= k).alias("classes"))
    return per.select(*[levels[i].alias(f"l{i}") for i in range(4)], "k", "suppressed", "dm_star", "classes")


def _scorer(spark, d, ks=LINE_K):
    hist, qis, n = _line(spark, d)
    return an.Scorer(hist, qis, ks), n


@query(f"WITH {_NODES}, best AS (SELECT k, min({{'dm': dm_star, 's': suppressed, 'c': -classes, 'n': [a, b, f, s]}}) AS x FROM scores, (SELECT count(*) AS total FROM lineitem) WHERE suppressed <= floor(0.01 * total + 1e-9) GROUP BY k) SELECT k, x.dm AS dm_star, x.s AS suppressed, -x.c AS classes, array_to_string(x.n, ',') AS node FROM best")
def best_node(spark, d):
    scorer, n = _scorer(spark, d)
    rows = []
    for k in LINE_K:
        f = an.search(scorer, [1] * 4, k, 0.01, n)
        rows.append((k, f.score.dm_star, f.score.suppressed, f.score.classes, ",".join(map(str, f.node))))
    scorer.close()
    return spark.createDataFrame(rows, "k int, dm_star bigint, suppressed bigint, classes bigint, node string")


@query(f"WITH {_NODES}, sig AS (SELECT unnest([0.0, 0.01, 0.1])::DOUBLE AS sigma), best AS (SELECT k, sigma, min({{'dm': dm_star, 's': suppressed, 'c': -classes, 'n': [a, b, f, s]}}) AS x FROM scores, sig, (SELECT count(*) AS total FROM lineitem) WHERE suppressed <= floor(sigma * total + 1e-9) GROUP BY k, sigma) SELECT k, sigma, x.dm AS dm_star, x.s AS suppressed, -x.c AS classes, array_to_string(x.n, ',') AS node FROM best")
def param_grid(spark, d):
    scorer, n = _scorer(spark, d)
    cells = an.parameter_grid(scorer, [1] * 4, n, LINE_K, an.GRID_SIGMA)
    scorer.close()
    rows = [(c.k, float(c.sigma), c.score.dm_star, c.score.suppressed, c.score.classes, ",".join(map(str, c.node))) for c in cells if c.feasible]
    return spark.createDataFrame(rows, "k int, sigma double, dm_star bigint, suppressed bigint, classes bigint, node string")


@query()
def top_nodes(spark, d):
    scorer, n = _scorer(spark, d)
    f = an.search(scorer, [1] * 4, 1000, 0.1, n)
    scorer.close()
    return spark.createDataFrame([(i + 1, ",".join(map(str, node)), s.dm_star, s.suppressed, s.classes) for i, (node, s) in enumerate(f.top)], "place int, node string, dm_star bigint, suppressed bigint, classes bigint")


@query("""WITH s AS (SELECT n, count(*) AS c FROM (SELECT count(*) AS n FROM orders GROUP BY CASE WHEN o_totalprice IS NULL THEN 0 ELSE 1 END, o_orderpriority IS NULL) GROUP BY n),
  r AS (SELECT n, coalesce(sum(n * c) OVER (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM s)
  SELECT max(n) AS k_optimal FROM r WHERE before <= floor(0.05 * (SELECT count(*) FROM orders) + 1e-9)""")
def k_optimal(spark, d):
    df = _t(spark, d, "orders", "o_totalprice", "o_orderpriority")
    qis, n, counts = an.prepare(df, [qi.uniform("o_totalprice", 10), qi.categorical("o_orderpriority")])
    return spark.createDataFrame([(an.k_optimal(an.histogram_of(counts, qis), qis, 0.05, n),)], "k_optimal bigint")


@query(f"WITH {_NODES}, b4 AS (SELECT DISTINCT a, b, f, s FROM nodes), e AS (SELECT b4.*, ceil((q1 - q0 + 1) / a) * ceil((n1 - n0 + 1) / b4.b) * CASE WHEN f = 1 THEN (SELECT count(*) FROM flags) ELSE 1 END * CASE WHEN s = 1 THEN (SELECT count(*) FROM states) ELSE 1 END AS e FROM b4, b) SELECT array_to_string(min([a, b, f, s]), ',') AS node FROM e WHERE e <= 100")
def first_node(spark, d):
    _, qis, _ = _line(spark, d)
    return spark.createDataFrame([(",".join(map(str, an.first_node(qis, 100))),)], "node string")


@query("""WITH b AS (SELECT min(CAST(l_quantity AS BIGINT)) AS q0 FROM lineitem)
  SELECT DISTINCT CAST(l_quantity AS BIGINT) - q0 AS c0, 0 AS attribute, o AS value FROM (SELECT l_quantity, l_shipdate, l_returnflag AS o FROM lineitem), b""")
def sensitive_values(spark, d):
    df = _t(spark, d, "lineitem", "l_quantity", "l_returnflag")
    qis, _ = qi.bind(df, [qi.uniform("l_quantity")])
    return an.sensitive_values(df, qis, ["l_returnflag"], 3)


# generalisation


@query("SELECT p_partkey, '[' || s || '-' || (s + 6) || ']' AS p_size FROM (SELECT p_partkey, lo + ((p_size - lo) // 7) * 7 AS s FROM part, (SELECT min(p_size) AS lo FROM part))")
def generalize_uniform(spark, d):
    df = _t(spark, d, "part", "p_partkey", "p_size")
    qis, _ = qi.bind(df, [qi.uniform("p_size")])
    return an.generalise(df, qis, [7])


@query("SELECT p_partkey, CASE WHEN p_size BETWEEN 1 AND 5 THEN '[1-5]' WHEN p_size BETWEEN 6 AND 10 THEN '[6-10]' WHEN p_size BETWEEN 11 AND 25 THEN '[11-25]' WHEN p_size BETWEEN 26 AND 40 THEN '[26-40]' ELSE '*' END AS p_size FROM part")
def generalize_interval(spark, d):
    return an.generalise(_t(spark, d, "part", "p_partkey", "p_size"), [qi.interval("p_size", [(1, 10), (11, 40)], 2)], [3])


@query("SELECT p_partkey, CASE WHEN p_size <= 9 THEN '[0-9]' WHEN p_size = 10 THEN '[10]' WHEN p_size BETWEEN 20 AND 49 THEN '[20-49]' ELSE '*' END AS p_size FROM part")
def generalize_fixed(spark, d):
    return an.generalise(_t(spark, d, "part", "p_partkey", "p_size"), [qi.fixed("p_size", [(20, 49), (0, 9), (10, 10)])], [1])


@query("SELECT c_custkey, coalesce(r_name, 'elsewhere') AS c_nation FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def generalize_ladder(spark, d):
    names = _t(spark, d, "nation").join(_t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    ladder = {r[0]: [r[1]] for r in names.select("n_name", "r_name").collect()} | {"*": ["elsewhere"]}  # 25 nations
    df = _t(spark, d, "customer", "c_custkey", "c_nationkey").join(_t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", F.col("n_name").alias("c_nation"))
    return an.generalise(df, [qi.categorical("c_nation", {"C_NATION": ladder})], [2])


# release

_PEOPLE = ("Age", "Gender", "Pincode", "BloodGroup")


def _people(spark, d):
    df = _t(spark, d, "patients", "row_id", *_PEOPLE)
    qis = [qi.interval("Age", [(0, 49), (50, 99)], 5), qi.categorical("Gender", {"Gender": {"M": ["known"], "F": ["known"], "*": ["other"]}}), qi.fixed("Pincode", [(560000, 560399), (560400, 560999)]), qi.categorical("BloodGroup")]
    return df, qi.bind(df, qis)[0]


_LABELS = f"""num AS (SELECT row_id, (SELECT {_NUM} FROM (SELECT {_strip('p.Age')} AS t)) AS age, (SELECT {_NUM} FROM (SELECT {_strip('p.Pincode')} AS t)) AS pin,
    coalesce(nfc_normalize({_strip('Gender')}), '') AS g, coalesce(nfc_normalize({_strip('BloodGroup')}), '') AS bg FROM patients p),
  labels AS (SELECT row_id, CASE WHEN age BETWEEN 0 AND 99 THEN '[' || (age // 10 * 10) || '-' || (age // 10 * 10 + 9) || ']' ELSE '*' END AS "Age", CASE WHEN g IN ('M', 'F') THEN 'known' ELSE 'other' END AS "Gender",
    CASE WHEN pin BETWEEN 560000 AND 560399 THEN '[560000-560399]' WHEN pin BETWEEN 560400 AND 560999 THEN '[560400-560999]' ELSE '*' END AS "Pincode", bg AS "BloodGroup" FROM num)"""
_NODE = [2, 2, 1, 1]


@query(f'WITH {_LABELS} SELECT "Age", "Gender", "Pincode", "BloodGroup", count(*) AS size, count(*) >= 40 AS passes FROM labels GROUP BY ALL')
def class_sizes(spark, d):
    df, qis = _people(spark, d)
    return an.class_verdicts(an.generalise(df, qis, _NODE), qis, 40)


@query(f'WITH {_LABELS}, c AS (SELECT count(*) AS size FROM labels GROUP BY "Age", "Gender", "Pincode", "BloodGroup") SELECT size, count(*) AS classes FROM c WHERE size >= 40 GROUP BY size')
def class_size_hist(spark, d):
    df, qis = _people(spark, d)
    return an.class_verdicts(an.generalise(df, qis, _NODE), qis, 40).filter("passes").groupBy("size").agg(F.count("*").alias("classes"))


@query(f'WITH {_LABELS}, c AS (SELECT count(*) AS n FROM labels GROUP BY "Age", "Gender", "Pincode", "BloodGroup"), p AS (SELECT n FROM c WHERE n >= 40) SELECT (SELECT coalesce(sum(n), 0)::BIGINT FROM c WHERE n < 40) AS suppressed, (SELECT sum(n * n)::BIGINT FROM p) AS dm_star, count(*) AS classes, min(n) AS smallest, max(n) AS largest, quantile_disc(n, 0.5) AS median FROM p')
def class_stats(spark, d):
    df, qis = _people(spark, d)
    s = an.release(df, qis, _NODE, 40).summary
    x = s.size_stats()
    return spark.createDataFrame([(s.suppressed, s.dm_star, s.classes, x["min"], x["max"], x["median"])], "suppressed bigint, dm_star bigint, classes bigint, smallest bigint, largest bigint, median bigint")


@query(f"""WITH {_LABELS}, c AS (SELECT *, count(*) OVER (PARTITION BY "Age", "Gender", "Pincode", "BloodGroup") AS n FROM labels), x AS (SELECT *, n >= 40 AS ok FROM c), star AS (SELECT count(*) AS n FROM x WHERE NOT ok)
  SELECT row_id, CASE WHEN ok THEN "Age" ELSE '*' END AS "Age", CASE WHEN ok THEN "Gender" ELSE '*' END AS "Gender", CASE WHEN ok THEN "Pincode" ELSE '*' END AS "Pincode", CASE WHEN ok THEN "BloodGroup" ELSE '*' END AS "BloodGroup" FROM x, star WHERE ok OR star.n >= 40""")
def k_anonymous_output(spark, d):
    df, qis = _people(spark, d)
    return an.release(df, qis, _NODE, 40).table


@query("""WITH j AS (SELECT o_orderkey, '[' || s || '-' || (s + 99999) || ']' AS o_totalprice, o_orderstatus, o_orderpriority FROM (SELECT *, lo + ((CAST(round(o_totalprice) AS BIGINT) - lo) // 100000) * 100000 AS s FROM orders, (SELECT min(CAST(round(o_totalprice) AS BIGINT)) AS lo FROM orders))),
  c AS (SELECT o_totalprice, o_orderstatus, count(*) AS n, count(DISTINCT o_orderpriority) AS dv FROM j GROUP BY ALL), x AS (SELECT j.*, n >= 10 AND dv >= 5 AS ok FROM j JOIN c USING (o_totalprice, o_orderstatus)), star AS (SELECT count(*) AS n, count(DISTINCT o_orderpriority) AS dv FROM x WHERE NOT ok)
  SELECT o_orderkey, CASE WHEN ok THEN o_totalprice ELSE '*' END AS o_totalprice, CASE WHEN ok THEN o_orderstatus ELSE '*' END AS o_orderstatus, o_orderpriority FROM x, star WHERE ok OR (star.n >= 10 AND star.dv >= 5)""")
def l_diverse_output(spark, d):
    df = _t(spark, d, "orders", "o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    qis, _ = qi.bind(df, [qi.uniform("o_totalprice", 10), qi.categorical("o_orderstatus")])
    return an.release(df, qis, [100_000, 1], 10, an.Diversity(5, ("o_orderpriority",))).table


@query("""WITH j AS (SELECT p_partkey, p_type, CAST(CAST(round(p_retailprice) AS BIGINT) AS VARCHAR) AS v, round(p_retailprice) AS r FROM part), b AS (SELECT min(r)::BIGINT AS lo FROM j),
  l AS (SELECT p_partkey, '[' || (lo + ((r::BIGINT - lo) // 16) * 16) || '-' || (lo + ((r::BIGINT - lo) // 16) * 16 + 15) || ']' AS p_retailprice FROM j, b), c AS (SELECT *, count(*) OVER (PARTITION BY p_retailprice) AS n FROM l), star AS (SELECT count(*) AS n FROM c WHERE n < 12)
  SELECT p_partkey, CASE WHEN c.n >= 12 THEN p_retailprice ELSE '*' END AS p_retailprice FROM c, star WHERE c.n >= 12 OR star.n >= 12""")
def suppress_or_remove(spark, d):
    df = _t(spark, d, "part", "p_partkey", "p_retailprice")
    qis, _ = qi.bind(df, [qi.uniform("p_retailprice")])
    return an.release(df, qis, [16], 12).table


# techniques

def _pad(byte: int) -> str:
    return bytes(b ^ byte for b in bytes.fromhex(SALT).ljust(64, b"\0")).hex()


@query(f"SELECT c_custkey, sha256(unhex('{_pad(0x5C)}') || unhex(sha256(unhex('{_pad(0x36)}') || encode(c_name)))) AS c_name FROM customer")
def hash_fixed_salt(spark, d):
    return _t(spark, d, "customer", "c_custkey", "c_name").select("c_custkey", tq.keyed_hash(tq.identifier(F.col("c_name")), SALT).alias("c_name"))


def _masked(spark, d, table, key, column, entry):
    m = mask.parse({"column": column, **entry})
    return _t(spark, d, table, key, column).select(key, F.when(tq.missing(F.col(column)), F.col(column)).otherwise(tq.mask_column(F.col(column), m)).alias(column))


@query("SELECT c_custkey, regexp_replace(regexp_replace(c_name, '^(.)(.)', '\\1#'), '^(.{9}).', '\\1#') AS c_name FROM customer")
def mask_characters(spark, d):
    return _masked(spark, d, "customer", "c_custkey", "c_name", {"masking_char": "#", "characters_to_mask": [2, 10, 0, 400]})


_BLANK = f"(c IS NULL OR {_strip('c')} = '' OR lower({_strip('c')}) = 'nan')"


@query(f"SELECT row_id, CASE WHEN {_BLANK} OR NOT regexp_matches(c, '^[^\\n@]+@') THEN c ELSE repeat('*', strpos(c, '@') - 1) || c[strpos(c, '@'):] END AS \"Email\" FROM (SELECT row_id, Email AS c FROM patients)")
def mask_before(spark, d):
    return _masked(spark, d, "patients", "row_id", "Email", {"regex_patterns": [{"type": "before", "delimiter": "@"}]})


@query(f"SELECT row_id, CASE WHEN {_BLANK} OR strpos(c, '@') IN (0, length(c)) THEN c ELSE c[:strpos(c, '@')] || repeat('*', length(c) - strpos(c, '@')) END AS \"Email\" FROM (SELECT row_id, Email AS c FROM patients)")
def mask_after(spark, d):
    return _masked(spark, d, "patients", "row_id", "Email", {"regex_patterns": [{"type": "after", "delimiter": "@"}]})


@query("SELECT c_custkey, CASE WHEN regexp_matches(c, '#.') THEN regexp_extract(c, '^([^#]*#)', 1) || repeat('*', length(c) - strpos(c, '#')) ELSE c END AS c_name FROM (SELECT c_custkey, c_name AS c FROM customer)")
def mask_between(spark, d):
    return _masked(spark, d, "customer", "c_custkey", "c_name", {"regex_patterns": [{"type": "in_between", "start": "#", "end": "$"}]})


@query("SELECT c_custkey, regexp_replace(regexp_replace(c_name, '[A-Za-z]', 'X', 'g'), '[0-9]', '0', 'g') AS c_name FROM customer")
def mask_class(spark, d):
    return _masked(spark, d, "customer", "c_custkey", "c_name", {"class_masking_mode": "fixed_class"})


@query("SELECT c_custkey, regexp_replace(regexp_replace(regexp_replace(c_name, '[A-Z]', 'A', 'g'), '[a-z]', 'a', 'g'), '[0-9]', '0', 'g') AS shape FROM customer")
def cloak_shape(spark, d):
    df = _t(spark, d, "customer", "c_custkey", "c_name").select("c_custkey", tq.cloak_column(F.col("c_name"), "c_name").alias("c"))
    return df.select("c_custkey", F.regexp_replace(F.regexp_replace(F.regexp_replace("c", "[A-Z]", "A"), "[a-z]", "a"), "[0-9]", "0").alias("shape"))


@query("SELECT c_custkey, c_name FROM customer")
def encrypt_roundtrip(spark, d):
    e = tq.Encryption("c_name")
    return spread(_t(spark, d, "customer", "c_custkey", "c_name"), "c_custkey").select("c_custkey", tq.decrypt_column(tq.encrypt_column(F.col("c_name"), e, SALT), e, SALT).alias("c_name"))


@query("SELECT c_custkey, c_name FROM customer")
def fpe_roundtrip(spark, d):
    e = tq.Encryption("c_name", True)
    return spread(_t(spark, d, "customer", "c_custkey", "c_name"), "c_custkey").select("c_custkey", tq.decrypt_column(tq.encrypt_column(F.col("c_name"), e, SALT), e, SALT).alias("c_name"))


def _scratch(spark: SparkSession, name: str) -> str:
    """A place for a query's files: on a cluster a folder of the driver, whose contents tasks get by way of the shared folder."""
    return f"{tempfile.mkdtemp(prefix='veilspark-')}/{name}-{uuid.uuid4().hex}"


@query("SELECT c_custkey, c_mktsegment FROM customer")
def tokenise_roundtrip(spark, d):
    vault = tq.Vault(spark, _scratch(spark, "vault"))
    df = tq.tokenise(_t(spark, d, "customer", "c_custkey", "c_mktsegment"), tq.Tokens("c_mktsegment"), vault)
    return tq.detokenise(df, "c_mktsegment", vault)[0]


@query(f"""SELECT 'hashing_with_salt:Aadhaar' AS counter, count(*) FILTER (NOT {_BLANK}) AS cells FROM (SELECT Aadhaar AS c FROM patients)
  UNION ALL SELECT 'encrypt:Phone', count(*) FILTER (NOT {_BLANK}) FROM (SELECT Phone AS c FROM patients) UNION ALL SELECT 'suppress:Name', count(*) FROM patients""")
def technique_counters(spark, d):
    t = tq.Techniques(suppress=["Name"], hashing=["Aadhaar"], encrypt=[tq.Encryption("Phone")])
    return spark.createDataFrame(sorted(tq.counters(_t(spark, d, "patients"), t).items()), "counter string, cells bigint")


@query()
def techniques_applied(spark, d):
    t = tq.Techniques(suppress=["Name"], hashing=["Aadhaar"], masks=[mask.parse({"column": "Email", "regex_patterns": [{"type": "before", "delimiter": "@"}]})], encrypt=[tq.Encryption("PAN")])
    return tq.apply(_t(spark, d, "patients", "row_id", "Name", "Aadhaar", "Email", "PAN"), t, KeyFolder())


# sheets


def _sheet(spark, d, table, columns) -> sheets.Sheet:
    df = _t(spark, d, table)
    return sheets.Sheet(table, df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in columns.items()], F.array(F.monotonically_increasing_id()).alias(sheets.ROW)))


_CUST, _ORD = {"c_custkey": "key", "c_mktsegment": "kind"}, {"o_orderkey": "order", "o_custkey": "key", "o_orderstatus": "kind"}
_HOSP, _VISIT = {"hospital_id": "key", "ownership": "kind"}, {"visit_id": "order", "hospital_id": "key", "Diagnosis": "kind"}
_SIDES = {
    "customer": ("(SELECT c_custkey::VARCHAR AS key, c_mktsegment AS kind FROM customer)", '(SELECT o_orderkey::VARCHAR AS "order", o_custkey::VARCHAR AS key, o_orderstatus AS kind FROM orders)'),
    "hospitals": ("(SELECT hospital_id AS key, coalesce(ownership, '') AS kind FROM hospitals)", "(SELECT visit_id::VARCHAR AS \"order\", coalesce(hospital_id, '') AS key, coalesce(\"Diagnosis\", '') AS kind FROM visits)"),
}


def _joined(how: str, sides: str) -> str:
    left, right = _SIDES[sides]
    return f'SELECT coalesce(l.key, r.key) AS key, coalesce(l.kind, \'\') AS kind_x, coalesce(r."order", \'\') AS "order", coalesce(r.kind, \'\') AS kind_y FROM {left} l {how} JOIN {right} r ON l.key = r.key'


def _customers(spark, d, how):
    return sheets.join(_sheet(spark, d, "customer", _CUST), _sheet(spark, d, "orders", _ORD), ["key"], how).df.drop(sheets.ROW)


def _hospitals(spark, d, how):
    return sheets.join(_sheet(spark, d, "hospitals", _HOSP), _sheet(spark, d, "visits", _VISIT), ["key"], how).df.drop(sheets.ROW)


@query(_joined("INNER", "customer"))
def join_inner(spark, d):
    return _customers(spark, d, "inner")


@query(_joined("LEFT", "customer"))
def join_left(spark, d):
    return _customers(spark, d, "left")


@query(_joined("RIGHT", "hospitals"))
def join_right(spark, d):
    return _hospitals(spark, d, "right")


@query(_joined("FULL", "hospitals"))
def join_outer(spark, d):
    return _hospitals(spark, d, "outer")


@query("SELECT n_nationkey::VARCHAR AS key_x, n_name AS name_x, r_regionkey::VARCHAR AS key_y, r_name AS name_y FROM nation, region")
def join_cross(spark, d):
    a, b = _sheet(spark, d, "nation", {"n_nationkey": "key", "n_name": "name"}), _sheet(spark, d, "region", {"r_regionkey": "key", "r_name": "name"})
    return sheets.join(a, b, ["key"], "cross").df.drop(sheets.ROW)


def _star(spark, d):
    all_sheets = [_sheet(spark, d, "customer", {"c_custkey": "ck", "c_nationkey": "nk"}), _sheet(spark, d, "nation", {"n_nationkey": "nk", "n_name": "name", "n_regionkey": "rk"}), _sheet(spark, d, "region", {"r_regionkey": "rk", "r_name": "name"})]
    return sheets.combine(all_sheets, sheets.parse_joins([{"left": "customer", "right": "nation", "on": "nk"}, {"left": "customer", "right": "region", "on": "rk"}]))


_STAR = "SELECT c_custkey::VARCHAR AS ck, c_nationkey::VARCHAR AS nk, coalesce(n_name, '') AS name_x, coalesce(n_regionkey::VARCHAR, '') AS rk, coalesce(r_name, '') AS name_y FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"


@query(_STAR)
def star_join(spark, d):
    return _star(spark, d)[0].df.drop(sheets.ROW)


@query(f"SELECT DISTINCT nk, name_x AS name, rk FROM ({_STAR})")
def restore_sheet(spark, d):
    merged, plan = _star(spark, d)
    return sheets.restore(merged.df, plan)["nation"].drop(sheets.ROW).select("nk", "name", "rk")


@query("SELECT c_custkey::VARCHAR AS ck, c_nationkey::VARCHAR AS nk, coalesce(n_name, '') AS name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def auto_join(spark, d):
    return sheets.auto_join([_sheet(spark, d, "customer", {"c_custkey": "ck", "c_nationkey": "nk"}), _sheet(spark, d, "nation", {"n_nationkey": "nk", "n_name": "name"})]).df.drop(sheets.ROW)


@query("SELECT c_name AS a, coalesce(s_name, '') AS b FROM (SELECT c_name, row_number() OVER (ORDER BY c_custkey) AS i FROM customer) LEFT JOIN (SELECT s_name, row_number() OVER (ORDER BY s_suppkey) AS i FROM supplier) USING (i)")
def hconcat(spark, d):
    a, b = _t(spark, d, "customer"), _t(spark, d, "supplier")
    left = sheets.Sheet("a", a.select(F.col("c_name").alias("a"), F.array("c_custkey").alias(sheets.ROW)))
    return sheets.beside(left, sheets.Sheet("b", b.select(F.col("s_name").alias("b"), F.array("s_suppkey").alias(sheets.ROW)))).df.drop(sheets.ROW)


@query("SELECT c_name AS name, c_nationkey::VARCHAR AS nk FROM customer UNION ALL SELECT s_name, s_nationkey::VARCHAR FROM supplier")
def vconcat(spark, d):
    return sheets.below([_sheet(spark, d, "customer", {"c_name": "name", "c_nationkey": "nk"}), _sheet(spark, d, "supplier", {"s_nationkey": "nk", "s_name": "name"})]).df.drop(sheets.ROW)


# documents

_POLICY = {"keep": ["case_id", "total_*", "pages[].page_number"], "filename": ["pages[].link"], "hashing_with_salt": ["pages[].document"], "suppress": ["pages[].extracted_data.**"]}


def _documents(spark, d) -> DataFrame:
    docs = _t(spark, d, "claim_docs", "claim_no", "doc_json").select(F.concat(F.col("claim_no").cast("string"), F.lit(".json")).alias("file_name"), F.col("doc_json").alias("doc"))
    return documents.anonymise(docs, parse_policy(_POLICY), KeyFolder())


_LINKS = """d AS (SELECT CASE WHEN json_valid(doc_json) THEN doc_json::JSON END AS doc, claim_no FROM claim_docs),
  p AS (SELECT claim_no, unnest(CASE json_type(doc, '$.pages') WHEN 'ARRAY' THEN CAST(doc->'$.pages' AS JSON[]) ELSE [] END) AS page FROM d)"""


@query(f"WITH {_LINKS} SELECT claim_no, regexp_extract(page->>'$.link', '[^/]*$') AS name FROM p WHERE json_type(page, '$.link') = 'VARCHAR' AND trim(page->>'$.link') <> ''")
def filename(spark, d):
    done = _documents(spark, d).select("file_name", "document").filter("document IS NOT NULL")
    listed = done.select("file_name", F.try_variant_get(F.try_parse_json("document"), "$.pages", "array<variant>").alias("pages")).select("file_name", F.explode("pages").alias("p"))
    link = F.try_variant_get("p", "$.link", "string")
    return listed.select(F.regexp_extract("file_name", r"^(\d+)", 1).cast("bigint").alias("claim_no"), link.alias("name")).filter("name IS NOT NULL AND trim(name) <> ''")


@query()
def nested_documents(spark, d):
    return _documents(spark, d).select("file_name", "document")


#: Observations of one bundle; a customer with more orders has several bundles.
_PER_BUNDLE = 5


def _bundles(spark, d) -> DataFrame:
    """Numbered bundles of each customer: the patient, and an observation for each of the next orders. Every order is in one."""
    place = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1
    orders = _t(spark, d, "orders", "o_custkey", "o_orderkey", "o_totalprice").withColumn("number", F.floor(place / _PER_BUNDLE) + 1)
    orders = orders.groupBy("o_custkey", "number").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_totalprice"))).alias("os"))
    c = _t(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    c = c.repartition(spark.sparkContext.defaultParallelism, "c_custkey", "number")  # small rows that become costly documents
    patient = F.struct(F.struct(F.lit("Patient").alias("resourceType"), F.concat(F.lit("p"), F.col("c_custkey").cast("string")).alias("id"), F.array(F.struct(F.col("c_name").alias("text"))).alias("name"), F.col("c_mktsegment").alias("gender")).alias("resource"))
    seen = lambda o: F.struct(F.struct(F.lit("Observation").alias("resourceType"), F.concat(F.lit("o"), o["o_orderkey"].cast("string")).alias("id"), F.struct(F.lit("Total price").alias("text")).alias("code"), o["o_totalprice"].cast("string").alias("valueString"), F.struct(F.concat(F.lit("Patient/p"), F.col("c_custkey").cast("string")).alias("reference")).alias("subject")).alias("resource"))
    # both kinds of entry as text, since their fields differ
    entries = F.concat(F.array(F.to_json(patient)), F.coalesce(F.transform("os", lambda o: F.to_json(seen(o))), F.array().cast("array<string>")))
    text = F.concat(F.lit('{"resourceType":"Bundle","type":"collection","entry":['), F.array_join(entries, ","), F.lit("]}"))
    later = F.when(F.col("number") > 1, F.concat(F.lit("-"), F.col("number").cast("string"))).otherwise("")
    return c.select(F.concat(F.col("c_custkey").cast("string"), later, F.lit(".json")).alias("file_name"), text.alias("doc"))


_FHIR = {"keep": ["Bundle.type", "Patient.gender", "Observation.code.text", "Observation.valueString"], "propagation": {"from": ["Patient.name[].text"]}}


_NUMBERED = """WITH o AS (SELECT o_custkey, o_orderkey, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 5 AS n FROM orders), b AS (SELECT c_custkey, n, count(o_orderkey) AS held FROM customer LEFT JOIN o ON c_custkey = o_custkey GROUP BY c_custkey, n)"""


@query(f"{_NUMBERED} SELECT c_custkey || CASE WHEN n > 0 THEN '-' || (n + 1) ELSE '' END || '.json' AS file_name, 1 + held AS entries FROM b")
def fhir_entries(spark, d):
    """How many resources each released bundle holds."""
    done = bundles.anonymise_bundles(_bundles(spark, d), bundles.parse_bundle_policy(_FHIR), KeyFolder())
    entries = F.try_variant_get(F.try_parse_json("document"), "$.entry", "array<variant>")
    return done.select("file_name", F.size(entries).cast("bigint").alias("entries"))


@query(
    f"""{_NUMBERED}, c AS (SELECT count(*) AS bundles, sum(held)::BIGINT AS held FROM b) SELECT path, CASE WHEN of_bundle THEN bundles ELSE held END AS documents_seen, documents_seen AS non_empty, action FROM c, (VALUES ('Bundle.type', true, 'keep'), ('Patient.id', true, 'pseudonymise_id'),
      ('Patient.name[].text', true, 'suppress'), ('Patient.gender', true, 'keep'), ('Observation.id', false, 'pseudonymise_id'), ('Observation.code.text', false, 'keep'), ('Observation.valueString', false, 'keep'), ('Observation.subject.reference', false, 'pseudonymise_reference')) t(path, of_bundle, action)"""
)
def fhir_census(spark, d):
    return documents.census_table(bundles.anonymise_bundles(_bundles(spark, d), bundles.parse_bundle_policy(_FHIR), KeyFolder())).select("path", "documents_seen", "non_empty", "action")


@query("SELECT n_nationkey::VARCHAR AS n_nationkey, n_name, n_regionkey::VARCHAR AS n_regionkey FROM nation ORDER BY nation.n_nationkey LIMIT 10")
def sample_rows(spark, d):
    """The first ten rows that a run's report shows."""
    from veilspark.sources import sinks

    rows = sinks.sample(_files(spark, d, "nation"))
    return spark.createDataFrame([tuple(r.values()) for r in rows], "n_nationkey string, n_name string, n_regionkey string")


# sources and sinks, there and back


def _files(spark, d, table):
    from veilspark.sources import tables

    return tables.read_parquet(spark, f"{d}/{table}.parquet")


@query("SELECT p_partkey::VARCHAR AS p_partkey, p_name, p_brand, p_type, p_size::VARCHAR AS p_size FROM part")
def csv_roundtrip(spark, d):
    from veilspark.sources import sinks, tables

    p = _scratch(spark, "part") + ".csv"
    sinks.write_csv(_files(spark, d, "part").drop("p_retailprice"), p)
    return tables.read_csv(spark, p).drop(sheets.ROW)


@query("SELECT n_nationkey::VARCHAR AS n_nationkey, n_name, n_regionkey::VARCHAR AS n_regionkey FROM nation")
def json_roundtrip(spark, d):
    from veilspark.sources import sinks, tables

    p = _scratch(spark, "nation") + ".json"
    sinks.write_json(_files(spark, d, "nation"), p)
    return tables.read_json(spark, p).drop(sheets.ROW)


@query("SELECT s_suppkey::VARCHAR AS s_suppkey, s_name, s_nationkey::VARCHAR AS s_nationkey FROM supplier")
def xlsx_roundtrip(spark, d):
    from veilspark.sources import sinks, tables

    p = _scratch(spark, "supplier") + ".xlsx"
    sinks.write_xlsx(_files(spark, d, "supplier").drop("s_acctbal"), p)
    return tables.read_excel(spark, p)[0].df.drop(sheets.ROW)


# streams


@query("SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS size FROM events GROUP BY ALL")
def stream_classes(spark, d):
    stream = spark.readStream.schema(_t(spark, d, "events").schema).parquet(f"{d}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))
    counts = streams.window_classes(stream, [qi.categorical("event_type")], [1], "ts", "1 day", "30 days")
    at = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    streams.publish_classes(counts, f"{at}/out", f"{at}/checkpoint").awaitTermination()
    return streams.latest_classes(spark, f"{at}/out", ["event_type"]).select(F.col("span.start").cast("date").alias("day"), "event_type", "size")


@query("WITH j AS (SELECT event_id, event_type, '[' || (user_id - user_id % 10) || '-' || (user_id - user_id % 10 + 9) || ']' AS user_id FROM events), c AS (SELECT *, count(*) OVER (PARTITION BY user_id, event_type) AS n FROM j) SELECT event_id, user_id, event_type FROM c WHERE n >= 135")
def stream_release(spark, d):
    stream = spark.readStream.schema(_t(spark, d, "events").schema).parquet(f"{d}/events.parquet*").select("event_id", "user_id", "event_type")
    at = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    streams.publish(stream, [qi.uniform("user_id"), qi.categorical("event_type")], [10, 1], 135, f"{at}/out", f"{at}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{at}/out/released").drop("batch")
