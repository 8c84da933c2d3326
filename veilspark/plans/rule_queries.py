"""Queries of rules, refusals, documents, bundles and whole runs over the test tables, with their SQL."""
from __future__ import annotations

import json
import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilspark.functions import crypto, mask
from veilspark.functions.keys import KeyFolder, salt_key
from veilspark.operators import anonymise as an
from veilspark.operators import bundles, documents, qi, sheets
from veilspark.operators import techniques as tq
from veilspark.operators.policy import DEFAULT, parse_policy
from veilspark.plans import config, run
from veilspark.plans.errors import RunError
from veilspark.plans.queries import _BASE, _BLANK, _POLICY, SALT, _documents, _masked, _pad, _strip, _t
from veilspark.sources import files, postgres, sinks, tables

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return add


def _folder() -> Path:
    """A folder of the driver for a query's files."""
    return Path(tempfile.mkdtemp(prefix="veilspark-"))


def _keys(salts: dict[str, str], cipher_keys: dict[str, str] | None = None) -> KeyFolder:
    """A key folder whose salts are known."""
    at = _folder()
    (at / "hash_salts.json").write_text(json.dumps(salts))
    (at / "encryption_keys.json").write_text(json.dumps(cipher_keys or {}))
    return KeyFolder(at)


def _hmac(message: str) -> str:
    """SQL of the keyed hash of a blob under SALT."""
    return f"sha256(unhex('{_pad(0x5C)}') || unhex(sha256(unhex('{_pad(0x36)}') || {message})))"


def _values(rows: list[tuple], names: str) -> str:
    """SQL of a table of expected outcomes."""
    return "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in r) + ")" for r in rows) + f") t({names})"


# masks

# what Unicode calls alphabetic, of the scripts of the tables
_ALPHA = r"[\p{L}\p{Nl}\x{900}-\x{903}\x{93A}\x{93B}\x{93E}-\x{94C}\x{94E}\x{94F}\x{955}-\x{957}\x{962}\x{963}]"


@query(rf"SELECT row_id, CASE WHEN {_BLANK} THEN c ELSE regexp_replace(regexp_replace(c, '{_ALPHA}', 'X', 'g'), '\p{{N}}', '0', 'g') END AS built_in, built_in AS by_worker FROM (SELECT row_id, Name AS c FROM patients)")
def mask_scripts(spark, d):
    """Letters and digits of names in every script, by the built-in expression and by the worker."""
    plain, worker = {"class_masking_mode": "fixed_class"}, {"class_masking_mode": "fixed_class", "regex_patterns": [{"regex": "\x01"}]}
    a, b = (_masked(spark, d, "patients", "row_id", "Name", x) for x in (plain, worker))
    return a.select("row_id", F.col("Name").alias("built_in")).join(b.select("row_id", F.col("Name").alias("by_worker")), "row_id")


@query(rf"SELECT row_id, regexp_replace(regexp_replace(regexp_replace(Name, '\p{{N}}', chr(1), 'g'), '\p{{Lu}}', chr(2), 'g'), '{_ALPHA}', chr(3), 'g') AS shape FROM patients")
def cloak_scripts(spark, d):
    """Cloaked names: every letter, mark and digit of any script became one of its class in ASCII, all else is as it was."""
    df = _t(spark, d, "patients", "row_id", "Name").select("row_id", tq.cloak_column(F.col("Name"), "Name").alias("c"))
    return df.select("row_id", F.regexp_replace(F.regexp_replace(F.regexp_replace("c", "[0-9]", "\x01"), "[A-Z]", "\x02"), "[a-z]", "\x03").alias("shape"))


@query("SELECT c_custkey, regexp_replace(regexp_replace(c_name, '[0-9]{3}$', '###'), '^Cust', 'XXXX') AS c_name FROM customer")
def mask_regex(spark, d):
    return _masked(spark, d, "customer", "c_custkey", "c_name", {"masking_char": "#", "regex_patterns": [{"regex": "[0-9]{3}$"}, {"regex": "^Cust", "masking_char": "X"}]})


@query("SELECT c_custkey, c_name[:strpos(c_name, '#') - 4] || '***' || '#' || c_name[strpos(c_name, '#') + 1:] AS c_name FROM customer")
def mask_length(spark, d):
    return _masked(spark, d, "customer", "c_custkey", "c_name", {"regex_patterns": [{"type": "before", "delimiter": "#", "length": 3}]})


@query(r"SELECT c_custkey, CASE WHEN regexp_matches(c, '#0+[1-9][0-9]*$') THEN regexp_extract(c, '^(.*#)0+[1-9]', 1) || repeat('*', length(regexp_extract(c, '#(0+)', 1))) || regexp_extract(c, '#0+([1-9])', 1) || repeat('*', length(regexp_extract(c, '#0+[1-9]([0-9]*)$', 1))) ELSE c END AS c_name FROM (SELECT c_custkey, c_name AS c FROM customer)")
def mask_groups(spark, d):
    return _masked(spark, d, "customer", "c_custkey", "c_name", {"regex_patterns": [{"regex": "#(0+)([1-9][0-9]*)$", "mask_groups": {"1": "full", "2": "partial"}}]})


# techniques


@query(f"""WITH p AS (SELECT row_id, Aadhaar AS a, Email AS c, PAN FROM patients) SELECT row_id, CASE WHEN {_BLANK.replace('(c ', '(a ').replace("('c'", "('a'").replace('(c,', '(a,')} THEN a ELSE {_hmac(f"encode(nfc_normalize({_strip('a')}))")} END AS "Aadhaar",
  CASE WHEN {_BLANK} OR NOT regexp_matches(c, '^[^\\n@]+@') THEN c ELSE repeat('*', strpos(c, '@') - 1) || c[strpos(c, '@'):] END AS "Email", "PAN" FROM p""")
def techniques_shared(spark, d):
    """Suppression, a hash under a kept salt, a mask, and encryption that is undone again, in one run."""
    keys = _keys({"Aadhaar": SALT})
    t = tq.Techniques(suppress=["Name"], hashing=["Aadhaar"], masks=[mask.parse({"column": "Email", "regex_patterns": [{"type": "before", "delimiter": "@"}]})], encrypt=[tq.Encryption("BloodGroup")], shared_salts=True)
    done = tq.apply(_t(spark, d, "patients", "row_id", "Name", "Aadhaar", "Email", "PAN", "BloodGroup"), t, keys)
    assert "Name" not in done.columns
    return done.select("row_id", "Aadhaar", "Email", "PAN")


@query("SELECT count(DISTINCT c_mktsegment) AS known, count(DISTINCT c_mktsegment) AS tokens, count(DISTINCT c_mktsegment) AS same_again, count(DISTINCT c_mktsegment) AS well_formed FROM customer")
def vault_again(spark, d):
    """A vault that is opened again gives the same tokens; each value has one of its own."""
    at, t = _folder() / "vault", tq.Tokens("c_mktsegment", "SEG-", 8)
    df = _t(spark, d, "customer", "c_custkey", "c_mktsegment")
    first = tq.tokenise(df.filter("c_custkey % 2 = 0").unionByName(df.filter("c_custkey % 2 <> 0")), t, tq.Vault(spark, at))
    again = tq.tokenise(df, t, tq.Vault(spark, at))
    both = df.withColumnRenamed("c_mktsegment", "v").join(first.withColumnRenamed("c_mktsegment", "a"), "c_custkey").join(again.withColumnRenamed("c_mktsegment", "b"), "c_custkey")
    return both.agg(F.count_distinct("v").alias("known"), F.count_distinct("v", "a").alias("tokens"), F.count_distinct("v", F.when(F.col("a") == F.col("b"), F.col("b"))).alias("same_again"), F.count_distinct(F.when(F.regexp_like("a", F.lit(r"\ASEG-[0-9]{8}\z")), F.col("a"))).alias("well_formed"))


# Published answers of HMAC-SHA-256, AES-SIV (RFC 5297, A.1) and FF1 (NIST samples 1 and 2).
_VECTORS = [
    ("hash", "5b4bed85ff61c96ad4d36d61eb290807fe8414d4f3e97abec032405af7d20d25"), ("siv", "85632d07c6e8f37f950acd320a2ecc9340c02b9690c4dc04daef7f6afe5c"),
    ("siv back", "112233445566778899aabbccddee"), ("ff1", "2433477484"), ("ff1 with a tweak", "6124200773"), ("ff1 back", "0123456789"),
]


@query(_values(_VECTORS, "case_name, result"))
def known_answers(spark, d):
    """Published answers of the hash and both ciphers."""
    siv = bytes.fromhex("fffefdfcfbfaf9f8f7f6f5f4f3f2f1f0f0f1f2f3f4f5f6f7f8f9fafbfcfdfeff"), bytes.fromhex("101112131415161718191a1b1c1d1e1f2021222324252627")
    sealed = crypto.siv_encrypt([bytes.fromhex("112233445566778899aabbccddee")], *siv)[0]
    k = bytes.fromhex("2b7e151628aed2a6abf7158809cf4f3c")
    rows = [("siv", sealed.hex()), ("siv back", crypto.siv_decrypt([sealed], *siv)[0].hex()), ("ff1", str(crypto.ff1([123456789], 10, b"", k)[0])), ("ff1 with a tweak", str(crypto.ff1([123456789], 10, b"9876543210", k)[0])), ("ff1 back", f"{crypto.ff1([2433477484], 10, b'', k, False)[0]:010d}")]
    return spark.range(1).select(F.lit("hash").alias("case_name"), tq.keyed_hash(F.lit("BOCW/UP/1"), SALT).alias("result")).unionByName(spark.createDataFrame(rows, "case_name string, result string"))


@query(f"""SELECT row_id, CASE WHEN blank THEN NULL ELSE v END AS opened, CASE WHEN blank THEN NULL ELSE true END AS hidden, CASE WHEN blank THEN NULL ELSE regexp_replace(v, '[0-9]', '0', 'g') END AS shape
  FROM (SELECT row_id, nfc_normalize({_strip('c')}) AS v, {_BLANK} AS blank FROM (SELECT row_id, CASE WHEN regexp_matches(Phone, '^[0-9+() -]+$') AND length(regexp_replace(Phone, '[^0-9]', '', 'g')) >= 6 THEN Phone END AS c FROM patients))""")
def format_kept(spark, d):
    """Format-preserving encryption of phone numbers: another number of the same shape, opened again to the same."""
    e = tq.Encryption("Phone", True)
    rows = _t(spark, d, "patients", "row_id", "Phone").withColumn("c", F.when(F.regexp_like("Phone", F.lit("^[0-9+() -]+$")) & (F.length(F.regexp_replace("Phone", "[^0-9]", "")) >= 6), F.col("Phone")))
    value = F.when(~tq.missing(F.col("c")), tq.identifier(F.col("c")))
    hidden = rows.select("row_id", value.alias("v"), tq.encrypt_column(value, e, SALT).alias("x"))
    return hidden.select("row_id", tq.decrypt_column(F.col("x"), e, SALT).alias("opened"), (F.col("x") != F.col("v")).alias("hidden"), F.regexp_replace("x", "[0-9]", "0").alias("shape"))


# refusals: what a configuration, a file or a connection must not be

_SECTION = {"k_anonymize": {"k": 5}, "suppression_limit": 0.05, "quasi_identifiers": {"numerical": [{"column": "Age"}], "categorical": [{"column": "Gender"}]}, "l_diversity": {"l": 2, "sensitive_attributes": ["Diagnosis"]}}
_SOURCE = {"type": "postgres", "host": "h", "database": "d", "user": "u", "password": "s3cret", "table": "public.t"}


def _code(f) -> str:
    try:
        f()
        return "accepted"
    except RunError as e:
        return e.code
    except Exception as e:
        return next((c for c in ("DATA_MALFORMED_ROW", "DATA_JSON_INVALID") if c in str(e)), "DATA_MALFORMED_ROW" if "MALFORMED" in str(e) or "FAILED_READ_FILE" in str(e) else type(e).__name__)


def _configured(**change):
    return lambda: config.parse({"data_type": "t", "t": {**_SECTION, **change}})


def _connected(**change):
    return lambda: postgres.parse_source({"input": {**_SOURCE, **change}})


def _outcomes(spark: SparkSession, cases: dict) -> DataFrame:
    return spark.createDataFrame([(n, _code(f)) for n, (f, _) in cases.items()], "case_name string, outcome string")


_RULES = {
    "as it should be": (_configured(), "accepted"),
    "unknown key": (_configured(typo=1), "CONFIG_UNKNOWN_KEY"),
    "k is text": (_configured(k_anonymize={"k": "5"}), "CONFIG_INVALID_VALUE"),
    "no k": (_configured(k_anonymize={}), "CONFIG_MISSING_FIELD"),
    "limit above 1": (_configured(suppression_limit=2), "CONFIG_INVALID_VALUE"),
    "sensitive attribute generalised": (_configured(l_diversity={"l": 2, "sensitive_attributes": ["Age"]}), "CONFIG_INVALID_VALUE"),
    "two kinds of documents": (_configured(nested_json=True, fhir_bundle=True), "CONFIG_INVALID_VALUE"),
    "mask of nothing": (_configured(masking=[{"column": "a"}]), "PREPROCESS_CONFIG_INVALID"),
    "mask looks around": (lambda: mask.parse({"column": "a", "regex_patterns": [{"regex": "(?<=x)a"}]}), "PREPROCESS_CONFIG_INVALID"),
    "mask step left out": (lambda: mask.parse({"column": "a", "characters_to_mask": [1], "apply_order": ["regex"]}), "PREPROCESS_CONFIG_INVALID"),
    "unknown mask step": (lambda: mask.parse({"column": "a", "characters_to_mask": [1], "apply_order": ["odd"]}), "PREPROCESS_CONFIG_INVALID"),
    "unknown class mode": (lambda: mask.parse({"column": "a", "class_masking_mode": "odd"}), "PREPROCESS_CONFIG_INVALID"),
    "empty masking character": (lambda: mask.parse({"column": "a", "characters_to_mask": [1], "masking_char": ""}), "PREPROCESS_CONFIG_INVALID"),
    "ladder does not nest": (lambda: qi.categorical("g", {"g": {"A": ["X", "P"], "B": ["X", "Q"]}}).with_domain(["A", "B"]), "CONFIG_INVALID_VALUE"),
    "ladder nests": (lambda: qi.categorical("g", {"g": {"A": ["X", "P"], "B": ["X", "P"]}}).with_domain(["A", "B"]), "accepted"),
    "intervals overlap": (lambda: qi.fixed("a", [(0, 10), (5, 20)]), "CONFIG_INVALID_VALUE"),
    "interval ends before it begins": (lambda: qi.interval("a", [(9, 1)]), "CONFIG_INVALID_VALUE"),
    "lattice too large": (lambda: an.Lattice([qi.QI(f"q{i}", "uniform", 2, 0, 1023) for i in range(8)], [1] * 8), "LATTICE_TOO_LARGE"),
    "no node within the bound": (lambda: an.first_node([qi.QI("q", "uniform", 2, 0, 9)], 0), "GENERALIZATION_FAILED"),
    "salt too short": (lambda: salt_key("00ff", "a"), "KEY_MATERIAL_INVALID"),
    "salt not hexadecimal": (lambda: salt_key("g" * 64, "a"), "KEY_MATERIAL_INVALID"),
    "salt fits": (lambda: salt_key("0" * 64, "a"), "accepted"),
    "format too short": (lambda: crypto.format_values(["5"], SALT, "a", True, crypto.FORMAT_CONTEXT), "FPE_DOMAIN_TOO_SMALL"),
    "format of another script": (lambda: crypto.format_values(["राम प्रसाद"], SALT, "a", True, crypto.FORMAT_CONTEXT), "FPE_VALUE_UNSUPPORTED"),
    "policy that keeps nothing": (lambda: parse_policy({}), "CONFIG_INVALID_VALUE"),
    "policy with sizes": (lambda: parse_policy({"keep": ["a"], "size": {"a": 1}}), "CONFIG_INVALID_VALUE"),
    "bundle with tokens": (lambda: bundles.parse_bundle_policy({"keep": ["a"], "tokenization": [{"column": "b"}]}), "CONFIG_INVALID_VALUE"),
    "bundle with an odd code rule": (lambda: bundles.parse_bundle_policy({"keep": ["a"], "code_rules": {"odd": ["b"]}}), "CONFIG_INVALID_VALUE"),
    "connection": (_connected(), "accepted"),
    "table and query": (_connected(query="SELECT 1"), "DB_CONFIG_INVALID"),
    "neither table nor query": (_connected(table=None), "DB_CONFIG_INVALID"),
    "table of three parts": (_connected(table="a.b.c"), "DB_CONFIG_INVALID"),
    "odd sslmode": (_connected(sslmode="maybe"), "DB_CONFIG_INVALID"),
    "limit of 0": (_connected(limit=0), "DB_CONFIG_INVALID"),
    "other database": (_connected(type="oracle"), "DB_CONFIG_INVALID"),
    "variable not set": (_connected(host="${VEILSPARK_NOT_THERE}"), "ENV_VAR_MISSING"),
    "variable with a default": (_connected(host="${VEILSPARK_NOT_THERE:-h2}"), "accepted"),
    "variable not closed": (_connected(host="${X"), "DB_CONFIG_INVALID"),
    "odd sink mode": (lambda: postgres.parse_sink({"output_sink": {"type": "postgres", "table": "t", "mode": "upsert"}}, postgres.Connection()), "DB_CONFIG_INVALID"),
    "sink that replaces": (lambda: postgres.parse_sink({"output_sink": {"type": "postgres", "table": "t", "mode": "replace"}}, postgres.Connection()), "accepted"),
}


@query(_values([(n, o) for n, (_, o) in _RULES.items()], "case_name, outcome"))
def rule_outcomes(spark, d):
    """What is refused, with its error code, and what is not."""
    return _outcomes(spark, _RULES)


_STATEMENTS = [
    ("query", 'SELECT "a b", "q""x" FROM "public"."t" LIMIT 5'), ("url", "jdbc:postgresql://srv:99/base"), ("ssl", "require"), ("user", "me"), ("hidden", "True"), ("replace 1", 'DROP TABLE IF EXISTS "out"."t"'), ("replace 2", 'CREATE TABLE "out"."t" ("a" text, "b" text)'),
    ("truncate", 'TRUNCATE TABLE "t"'), ("append", "0"), ("swap first", "BEGIN"), ("swap last", "COMMIT"),
]


@query(_values(_STATEMENTS, "case_name, result"))
def database_statements(spark, d):
    """The options and statements of the PostgreSQL source and sink."""
    r = postgres.parse_source({"input": {**_SOURCE, "columns": ["a b", 'q"x'], "limit": 5}})
    c = postgres.parse_source({"input": {"type": "postgres", "table": "t", "dsn": "postgresql://me:pw12@srv:99/base?sslmode=require"}}).connection
    w = postgres.parse_sink({"output_sink": {"type": "postgres", "table": "out.t", "mode": "replace"}}, c)
    ddl, swap = postgres.ddl(w, ["a", "b"]), postgres.swap(w, postgres.staging(w), ["a"])
    rows = [("query", r.query), ("url", c.url), ("ssl", c.ssl), ("user", c.user), ("hidden", str("pw12" not in repr(c) and "pw12" not in c.scrub("is pw12"))), ("replace 1", ddl[-2]), ("replace 2", ddl[-1])]
    rows += [("truncate", postgres.ddl(postgres.Write(c, postgres.Table(("t",)), "truncate"), ["a"])[-1]), ("append", str(len(postgres.ddl(postgres.Write(c, postgres.Table(("t",)), "append"), ["a"])))), ("swap first", swap[0]), ("swap last", swap[-1])]
    return spark.createDataFrame(rows, "case_name string, result string")


_FILES = [
    # name, bytes, kind, outcome of reading it as CSV
    ("plain.csv", b"a,b\n1,2\n", "csv", "1 rows"), ("quoted.csv", b'a,b\n"x,1","y\nz"\n', "csv", "1 rows"), ("narrow.csv", b"a,b\n1\n", "csv", "DATA_MALFORMED_ROW"), ("wide.csv", b"a,b\n1,2,3\n", "csv", "DATA_MALFORMED_ROW"),
    ("stray.csv", b'a,b\n1,"x"y\n', "csv", "DATA_MALFORMED_ROW"), ("open.csv", b'a,b\n1,"x\n', "csv", "DATA_MALFORMED_ROW"), ("bytes.csv", b"a,b\n1,\xff\xfe\n", "csv", "DATA_MALFORMED_ROW"), ("twice.csv", b"a,a\n1,2\n", "csv", "DATA_MALFORMED_ROW"), ("blank.csv", b"a,b\n\n1,2\n\n", "csv", "1 rows"),
    ("empty.csv", b"", "None", "DATA_EMPTY"), ("table.json", b'  [{"a": 1}]', "json", "-"), ("misnamed.csv", b'[{"a": 1}]', "json", "-"), ("book.csv", b"PK\x03\x04....", "excel", "-"), ("old.xls", b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1", "excel", "-"),
]


@query(_values([(n, k, o) for n, _, k, o in _FILES], "file_name, kind, as_csv"))
def file_kinds(spark, d):
    """What the first bytes make of a file, and strict reading: widths, quotes, bytes, headers, blank records."""
    at, rows = _folder(), []
    for name, data, kind, outcome in _FILES:
        (at / name).write_bytes(data)
        if outcome == "-":
            rows.append((name, str(tables.sniff(at / name)), "-"))
            continue
        got = _code(lambda: rows.append((name, str(tables.sniff(at / name)), f"{len(tables.read_csv(spark, at / name).collect())} rows")))
        if got != "accepted":
            rows.append((name, str(tables.sniff(at / name)), got))
    return spark.createDataFrame(rows, "file_name string, kind string, as_csv string")


@query(_values([("none", "DATA_DIR_MISSING"), ("nothing", "DATA_NO_CSV"), ("two", "DATA_AMBIGUOUS_INPUT"), ("one", "in.csv"), ("staged first", "staged.csv"), ("named file", "in.csv")], "case_name, outcome"))
def input_order(spark, d):
    """Which file a run reads: the staged one, the named one, the only one of the folder."""
    root = _folder()
    for f in ("nothing", "two", "one"):
        (root / f).mkdir()
    for f in ("two/a.csv", "two/b.json", "one/in.csv", "one/.hidden.csv", "staged.csv"):
        (root / f).write_text("file_name\n" + Path(f).name + "\n")
    rows = [(n, _code(lambda n=n: tables.discover(root / n))) for n in ("none", "nothing", "two")]
    c = config.parse({"data_type": "t", "t": {"suppress": ["x"]}})
    paths = lambda data: run.Paths(root, root / data, root / "output", None, root)
    name = lambda c, p: run.read_input(spark, c, p).df.select("file_name").collect()[0][0]
    rows += [("one", name(c, paths("one"))), ("named file", name(c, paths("one/in.csv")))]
    staged = config.Config(**{**c.__dict__, "staged_input": "staged.csv"})
    return spark.createDataFrame([*rows, ("staged first", name(staged, paths("one")))], "case_name string, outcome string")


# statistics and search


@query(f"WITH {_BASE} SELECT ((q1 - q0 + 1) * (n1 - n0 + 1) * (SELECT count(*) FROM flags) * (SELECT count(*) FROM states))::DOUBLE AS space, CASE WHEN (SELECT count(*) * log2(count(*)) FROM lineitem) <= (q1 - q0 + 1) * (n1 - n0 + 1) * (SELECT count(*) FROM flags) * (SELECT count(*) FROM states) THEN 'direct' ELSE 'original' END AS flow FROM b")
def space_and_flow(spark, d):
    from veilspark.plans.queries import _line

    _, qis, n = _line(spark, d)
    return spark.createDataFrame([(an.equivalence_space(qis), an.choose_flow("auto", n, qis))], "space double, flow string")


@query("SELECT c0, attribute, value FROM (SELECT *, row_number() OVER (PARTITION BY c0 ORDER BY value) AS r FROM (SELECT DISTINCT CAST(l_quantity AS BIGINT) - (SELECT min(CAST(l_quantity AS BIGINT)) FROM lineitem) AS c0, 0 AS attribute, l_returnflag || l_linenumber AS value FROM lineitem)) WHERE r <= 4")
def sensitive_capped(spark, d):
    """At most l distinct sensitive values of a cell, where it has more."""
    df = _t(spark, d, "lineitem", "l_quantity", "l_returnflag", "l_linenumber").select("l_quantity", F.concat("l_returnflag", F.col("l_linenumber").cast("string")).alias("s"))
    return an.sensitive_values(df, qi.bind(df, [qi.uniform("l_quantity")])[0], ["s"], 4)


@query("""WITH c AS (SELECT count(*) AS n FROM part GROUP BY CASE WHEN p_size <= 2 THEN 0 WHEN p_size <= 5 THEN 1 WHEN p_size <= 11 THEN 2 WHEN p_size <= 30 THEN 3 WHEN p_size <= 45 THEN 4 END, p_brand), s AS (SELECT n, count(*) AS c FROM c GROUP BY n),
  r AS (SELECT n, coalesce(sum(n * c) OVER (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM s) SELECT max(n)::BIGINT AS k_optimal FROM r WHERE before <= floor(0.2 * (SELECT count(*) FROM part) + 1e-9)""")
def k_optimal_classes(spark, d):
    """The largest k that many classes allow: fixed bins and brands that no level joins."""
    df = _t(spark, d, "part", "p_size", "p_brand")
    brands = sorted(r[0] for r in df.select("p_brand").distinct().collect())  # 25 brands
    place = F.array_position(F.array(*[F.lit(b) for b in brands]), F.col("p_brand")).cast("int")
    df = df.select("p_size", place.alias("brand"))
    qis, n = qi.bind(df, [qi.fixed("p_size", [(1, 2), (3, 5), (6, 11), (12, 30), (31, 45)]), qi.fixed("brand", [(i + 1, i + 1) for i in range(len(brands))])])
    return spark.createDataFrame([(an.k_optimal(an.histogram(df, qis), qis, 0.2, n),)], "k_optimal bigint")


_DIVERSE = f"""{_BASE}, w0 AS (SELECT DISTINCT least(CAST(2 ** i AS BIGINT), q1 - q0 + 1) AS a FROM b, range(0, 40) t(i)), w1 AS (SELECT DISTINCT least(CAST(2 ** i AS BIGINT), n1 - n0 + 1) AS b FROM b, range(0, 40) t(i)),
  nodes AS (SELECT a, w1.b, s.s FROM w0, w1, range(1, 3) s(s)), classes AS (SELECT a, nodes.b, s, sum(n)::BIGINT AS n, count(DISTINCT c2) AS l FROM hist, nodes GROUP BY a, nodes.b, s, c0 // a, c1 // nodes.b, CASE WHEN s = 1 THEN c3 ELSE 0 END),
  scores AS (SELECT a, b, s, sum(CASE WHEN n < 200 OR l < 3 THEN n ELSE 0 END)::BIGINT AS suppressed, sum(CASE WHEN n >= 200 AND l >= 3 THEN n * n ELSE 0 END)::BIGINT AS dm_star, count(*) FILTER (n >= 200 AND l >= 3) AS classes FROM classes GROUP BY ALL)"""


@query(f"WITH {_DIVERSE}, best AS (SELECT min({{'dm': dm_star, 's': suppressed, 'c': -classes, 'n': [a, b, s]}}) AS x FROM scores WHERE suppressed <= floor(0.05 * (SELECT count(*) FROM lineitem) + 1e-9)) SELECT x.dm AS dm_star, x.s AS suppressed, -x.c AS classes, array_to_string(x.n, ',') AS node FROM best")
def diverse_node(spark, d):
    """The least distorting node whose classes hold at least 200 rows and three values of the sensitive column."""
    df = _t(spark, d, "lineitem", "l_quantity", "l_linenumber", "l_linestatus", "l_returnflag")
    qis, n, values = an.prepare(df, [qi.uniform("l_quantity", 2), qi.uniform("l_linenumber", 2), qi.categorical("l_linestatus")])
    scorer = an.Scorer(an.histogram_of(values, qis), qis, [200], an.sensitive_values(df, qis, ["l_returnflag"], 3), 3)
    f = an.search(scorer, [1] * 3, 200, 0.05, n)
    scorer.close()
    return spark.createDataFrame([(f.score.dm_star, f.score.suppressed, f.score.classes, ",".join(map(str, f.node)))], "dm_star bigint, suppressed bigint, classes bigint, node string")


# nested documents

_DOC = "d AS (SELECT claim_no, CASE WHEN json_valid(doc_json) THEN doc_json::JSON END AS doc FROM claim_docs)"
_LEAVES = rf"""RECURSIVE {_DOC}, nodes AS (SELECT claim_no, '' AS path, doc AS v FROM d WHERE doc IS NOT NULL
    UNION ALL SELECT claim_no, CASE WHEN k.obj THEN CASE WHEN path = '' THEN k.key ELSE path || '.' || k.key END ELSE path || '[]' END, k.v
    FROM (SELECT claim_no, path, unnest(CASE json_type(v) WHEN 'OBJECT' THEN list_transform(map_entries(CAST(v AS MAP(VARCHAR, JSON))), lambda e: {{'obj': true, 'key': lower(e.key), 'v': e.value}})
            ELSE list_transform(CAST(v AS JSON[]), lambda x: {{'obj': false, 'key': '', 'v': x}}) END) AS k FROM nodes WHERE json_type(v) IN ('OBJECT', 'ARRAY'))),
  leaves AS (SELECT claim_no, path, CASE WHEN json_type(v) = 'NULL' OR v IS NULL THEN '' ELSE v->>'$' END AS t FROM nodes WHERE v IS NULL OR json_type(v) NOT IN ('OBJECT', 'ARRAY'))"""
_ACTION = "CASE WHEN path IN ('case_id', 'pages[].page_number') OR regexp_full_match(path, 'total_[^.\\[]*') THEN 'keep' WHEN path = 'pages[].link' THEN 'filename' WHEN path = 'pages[].document' THEN 'hashing_with_salt' ELSE 'suppress' END"
_BY = f"CASE WHEN path IN ('case_id', 'pages[].page_number', 'pages[].link', 'pages[].document') THEN path WHEN regexp_full_match(path, 'total_[^.\\[]*') THEN 'total_*' WHEN starts_with(path, 'pages[].extracted_data') THEN 'pages[].extracted_data.**' ELSE '{DEFAULT}' END"


@query(rf"WITH {_LEAVES} SELECT path, count(*) AS documents_seen, count(*) FILTER ({_strip('t')} <> '') AS non_empty, {_ACTION} AS action, {_BY} AS matched_by FROM leaves GROUP BY path")
def nested_census(spark, d):
    """The census of every path of all documents: how often seen and filled, the action and the rule."""
    return documents.census_table(_documents(spark, d)).select("path", "documents_seen", "non_empty", "action", "matched_by")


@query(rf"""WITH {_DOC}, p AS (SELECT claim_no, unnest(CAST(doc->'$.pages' AS JSON[])) AS page FROM d WHERE json_type(doc, '$.pages') = 'ARRAY'),
  x AS (SELECT claim_no, page->>'$.page_number' AS page_number, json_type(page, '$.document') AS kind, page->>'$.document' AS t FROM p WHERE json_type(page) = 'OBJECT')
  SELECT claim_no, page_number, CASE WHEN kind IS NULL OR kind = 'NULL' OR {_strip('t')} = '' THEN CASE WHEN kind = 'NULL' THEN NULL ELSE t END ELSE {_hmac(f"encode({_strip('t')})")} END AS document FROM x
  WHERE (page_number IS NOT NULL OR t IS NOT NULL OR kind = 'NULL') AND coalesce(kind, '') NOT IN ('OBJECT', 'ARRAY')""")
def nested_rules(spark, d):
    """The pages of the documents that are released: numbers kept, document names hashed under a kept salt."""
    docs = _t(spark, d, "claim_docs", "claim_no", "doc_json").select(F.col("claim_no").cast("string").alias("file_name"), F.col("doc_json").alias("doc"))
    done = documents.anonymise(docs, parse_policy(_POLICY), _keys({"nested_json": SALT})).select("file_name", "document").filter("document IS NOT NULL")
    get = lambda c, p: F.try_variant_get(c, p, "string")
    pages = done.select("file_name", F.explode(F.try_variant_get(F.try_parse_json("document"), "$.pages", "array<variant>")).alias("p"))
    rows = pages.select(F.col("file_name").cast("bigint").alias("claim_no"), get("p", "$.page_number").alias("page_number"), get("p", "$.document").alias("document"), F.try_variant_get("p", "$.document", "variant").isNotNull().alias("named"))
    return rows.filter("page_number IS NOT NULL OR named").drop("named")


@query(f"WITH {_DOC} SELECT count(*) AS documents, count(doc) AS written, count(*) - count(doc) AS failed, count(doc) FILTER (json_type(doc, '$.case_id') NOT IN ('OBJECT', 'ARRAY')) AS case_ids_seen, count(doc) AS files FROM d")
def documents_run(spark, d):
    """A whole run over a folder of documents: files read, files written, what failed, the census file."""
    root = _folder()
    (root / "docs").mkdir(), (root / "config").mkdir()
    for n, text in files.streamed(_t(spark, d, "claim_docs", "claim_no", "doc_json")):
        with open(f"{root}/docs/{n}.json", "wb") as f:
            f.write((text or "").encode())
    (root / "config" / "c.json").write_text(json.dumps({"data_type": "t", "t": {"nested_json": True, "input_path": str(root / "docs"), **_POLICY}}))
    out = run.run(spark, run.Paths.under(root))["outputs"]
    census = {line.split(",")[0]: line.split(",") for line in (root / "output" / "nested_json_census.csv").read_text().splitlines()}
    return spark.createDataFrame([(out["documents"], out["written"], out["failed"], int(census["case_id"][1]), len(os.listdir(root / "output" / "nested_json")))], "documents bigint, written bigint, failed bigint, case_ids_seen bigint, files bigint")


# bundles: a patient, an observation for each order and a report on all of them

_FHIR = {
    "keep": ["Bundle.type", "Patient.gender", "Observation.code.text", "Observation.valueString", "DiagnosticReport.status"],
    "code_rules": {"suppress": ["gps*"], "hashing_with_salt": ["total_price"]},
    "propagation": {"from": ["Patient.name[].text"]},
}


def _bundle_rows(spark, d) -> DataFrame:
    """Bundles of up to 20 orders of a customer, numbered; together they hold every order."""
    place = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1
    orders = _t(spark, d, "orders", "o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus").withColumn("number", F.floor(place / 20))
    named = orders.join(_t(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    resource = lambda kind, key, **more: F.struct(F.struct(F.lit(kind).alias("resourceType"), key.alias("id"), *[v.alias(k) for k, v in more.items()]).alias("resource"))
    oid = F.concat(F.lit("o"), F.col("o_orderkey").cast("string"))
    code = F.when(F.col("o_orderstatus") == "F", "GPS latitude").when(F.col("o_orderstatus") == "O", "Total price").otherwise("Remark")
    value = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("seen "), F.col("c_name"))).otherwise(F.col("o_totalprice").cast("decimal(12,2)").cast("string"))
    seen = resource("Observation", oid, code=F.struct(code.alias("text")), valueString=value, _valueString=F.struct(F.lit("x").alias("id")))
    grouped = named.groupBy("c_custkey", "number", "c_name", "c_mktsegment").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", F.to_json(seen).alias("json"), F.concat(F.lit("Observation/"), oid).alias("reference")))).alias("os"))
    patient = resource("Patient", F.concat(F.lit("p"), F.col("c_custkey").cast("string")), name=F.array(F.struct(F.col("c_name").alias("text"))), gender=F.col("c_mktsegment"))
    report = resource("DiagnosticReport", F.lit("r"), status=F.lit("final"), result=F.transform("os", lambda o: F.struct(o["reference"].alias("reference"))))
    entries = F.concat(F.array(F.to_json(patient)), F.transform("os", lambda o: o["json"]), F.array(F.to_json(report)))
    return grouped.select(F.concat_ws("-", F.col("c_custkey").cast("string"), F.col("number").cast("string")).alias("file_name"), F.concat(F.lit('{"resourceType":"Bundle","type":"collection","entry":['), F.array_join(entries, ","), F.lit("]}")).alias("doc"))


def _released(spark, d) -> DataFrame:
    """Every resource of the released bundles."""
    keys = _keys({bundles.ID_COLUMN: SALT, "code:total_price": SALT})
    done = bundles.anonymise_bundles(_bundle_rows(spark, d), bundles.parse_bundle_policy(_FHIR), keys)
    entry = F.explode(F.try_variant_get(F.try_parse_json("document"), "$.entry", "array<variant>")).alias("e")
    get = lambda p, t="string": F.try_variant_get("e", p, t)
    return done.select("file_name", entry).select(
        "file_name", get("$.resource.resourceType").alias("kind"), get("$.resource.id").alias("id"), get("$.resource.code.text").alias("code"), get("$.resource.valueString").alias("value"), get("$.resource.gender").alias("gender"),
        get("$.resource.name", "variant").isNotNull().alias("has_name"), get("$.resource._valueString", "variant").isNotNull().alias("has_extra"), get("$.resource.result", "array<variant>").alias("result"),
    )


def _uuid(identity: str) -> str:
    """SQL of the pseudonym of an id."""
    h = _hmac(f"encode('fhir-id') || '\\x00'::BLOB || encode({identity})")
    return f"(SELECT h[:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || ['8','9','a','b'][(instr('0123456789abcdef', h[17]) - 1) % 4 + 1] || h[18:20] || '-' || h[21:32] FROM (SELECT {h} AS h))"


_ORDERS = "o AS (SELECT *, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 20 AS n FROM orders)"


@query(f"WITH {_ORDERS} SELECT o_custkey || '-' || n AS file_name, {_uuid("'o' || o_orderkey")} AS id, CASE o_orderstatus WHEN 'O' THEN 'Total price' ELSE 'Remark' END AS code, CASE o_orderstatus WHEN 'O' THEN {_hmac("encode(replace(CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS VARCHAR), '.', ''))")} END AS value FROM o WHERE o_orderstatus <> 'F'")
def fhir_observations(spark, d):
    """Code rules drop and hash observations, what names the patient is taken out of others, ids are pseudonyms."""
    return _released(spark, d).filter("kind = 'Observation'").select("file_name", "id", "code", "value")


@query(f"WITH {_ORDERS}, r AS (SELECT o_custkey, n, o_orderkey, {_uuid("'o' || o_orderkey")} AS id FROM o WHERE o_orderstatus <> 'F') SELECT o_custkey || '-' || n AS file_name, {_uuid("'r'")} AS id, coalesce((SELECT string_agg('Observation/' || r.id, ',' ORDER BY r.o_orderkey) FROM r WHERE r.o_custkey = g.o_custkey AND r.n = g.n), '') AS result FROM (SELECT DISTINCT o_custkey, n FROM o) g")
def fhir_references(spark, d):
    """Reports refer to pseudonyms, and to no observation that was dropped."""
    listed = F.transform("result", lambda x: F.try_variant_get(x, "$.reference", "string"))
    return _released(spark, d).filter("kind = 'DiagnosticReport'").select("file_name", "id", F.coalesce(F.array_join(listed, ","), F.lit("")).alias("result"))


@query(f"WITH {_ORDERS} SELECT DISTINCT o_custkey || '-' || n AS file_name, {_uuid("'p' || o_custkey")} AS id, c_mktsegment AS gender, false AS has_name FROM o JOIN customer ON o_custkey = c_custkey")
def fhir_patients(spark, d):
    """Patients keep what the policy names and nothing else."""
    return _released(spark, d).filter("kind = 'Patient'").select("file_name", "id", "gender", "has_name")


@query(f"WITH {_ORDERS} SELECT o_orderstatus AS status, count(*) AS observations, 0::BIGINT AS left_over FROM o WHERE o_orderstatus <> 'F' GROUP BY ALL")
def fhir_tidy(spark, d):
    """What belongs to a value that went goes with it."""
    rows = _released(spark, d).filter("kind = 'Observation'")
    status = F.when(F.col("code") == "Total price", "O").otherwise("P")
    return rows.groupBy(status.alias("status")).agg(F.count("*").alias("observations"), F.count_if(F.col("has_extra") & F.col("value").isNull()).alias("left_over"))


_SEEN = "SELECT path, count(*) AS seen, action FROM c GROUP BY ALL"


@query(f"""WITH {_ORDERS}, b AS (SELECT DISTINCT o_custkey, n FROM o), c AS (
    SELECT 'Observation[code=gps_latitude]' AS path, 'drop_resource' AS action FROM o WHERE o_orderstatus = 'F' UNION ALL SELECT 'DiagnosticReport.result[]', 'drop_reference' FROM o WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'DiagnosticReport.result[].reference', 'pseudonymise_reference' FROM o WHERE o_orderstatus <> 'F' UNION ALL SELECT 'Observation.id', 'pseudonymise_id' FROM o WHERE o_orderstatus <> 'F'
    UNION ALL SELECT 'Patient.id', 'pseudonymise_id' FROM b UNION ALL SELECT 'DiagnosticReport.id', 'pseudonymise_id' FROM b UNION ALL SELECT 'Patient.name[].text', 'suppress' FROM b UNION ALL SELECT 'Patient.gender', 'keep' FROM b UNION ALL SELECT 'DiagnosticReport.status', 'keep' FROM b
    UNION ALL SELECT 'Bundle.type', 'keep' FROM b UNION ALL SELECT 'Observation.code.text', 'keep' FROM o WHERE o_orderstatus <> 'F' UNION ALL SELECT 'Observation._valueString.id', 'suppress' FROM o WHERE o_orderstatus <> 'F'
    UNION ALL SELECT 'Observation.valueString', CASE o_orderstatus WHEN 'O' THEN 'hashing_with_salt' ELSE 'suppress' END FROM o WHERE o_orderstatus <> 'F') {_SEEN}""")
def fhir_actions(spark, d):
    """How often each action was taken at each path of the bundles."""
    keys = _keys({bundles.ID_COLUMN: SALT, "code:total_price": SALT})
    done = bundles.anonymise_bundles(_bundle_rows(spark, d), bundles.parse_bundle_policy(_FHIR), keys)
    return done.select(F.explode("census").alias("c")).groupBy(F.col("c.path").alias("path"), F.col("c.action").alias("action")).agg(F.count("*").alias("seen"))


# whole runs


def _run(spark, section: dict, name: str, write) -> tuple[dict, Path]:
    root = _folder()
    for f in ("config", "data"):
        (root / f).mkdir()
    (root / "config" / "c.json").write_text(json.dumps({"data_type": "t", "t": section}))
    write(str(root / "data" / name))
    status = run.run(spark, run.Paths.under(root))
    if status["status"] == "error":
        raise RuntimeError(status["error"])
    return status, root


_CHOSEN = """c AS (SELECT '[' || (p_size - (p_size - 1) % 10) || '-' || (p_size - (p_size - 1) % 10 + 9) || ']' AS p_size, p_brand, count(*) AS n FROM part GROUP BY ALL)"""


@query(f"WITH {_CHOSEN} SELECT 'CHOSEN_NODE' AS flow, (SELECT count(*) FROM part) AS total_records, count(*) FILTER (n >= 5) AS classes, sum(CASE WHEN n >= 5 THEN n * n ELSE 0 END)::BIGINT AS dm_star, coalesce(sum(n) FILTER (n < 5), 0)::BIGINT AS suppressed, min(n) FILTER (n >= 5) AS smallest, max(n) FILTER (n >= 5) AS largest FROM c")
def chosen_node_run(spark, d):
    """A run with a chosen node from CSV to the report: its flow, classes, distortion and suppression."""
    part = tables.read_parquet(spark, f"{d}/part.parquet").select("p_partkey", "p_size", "p_brand", sheets.ROW)
    section = {"k_anonymize": {"k": 5}, "suppression_limit": 1, "pass": "pass2", "generalization_node": {"p_size": 10, "p_brand": 1}, "quasi_identifiers": {"numerical": [{"column": "p_size"}], "categorical": [{"column": "p_brand"}]}}
    status, _ = _run(spark, section, "part.csv", lambda p: sinks.write_csv(part, p))
    o, s = status["outputs"], status["outputs"]["anonymisation_summary"]
    row = (o["flow"], o["total_records"], o["num_equivalence_classes"], o["lowest_dm_star"], o["suppressed_records"], s["class_size_min"], s["class_size_max"])
    return spark.createDataFrame([row], "flow string, total_records bigint, classes bigint, dm_star bigint, suppressed bigint, smallest bigint, largest bigint")


@query("SELECT n_nationkey::VARCHAR AS n_nationkey, '*' || n_name[2:] AS n_name FROM nation")
def json_run(spark, d):
    """A run that only applies techniques, from JSON: the result again as JSON."""
    nation = tables.read_parquet(spark, f"{d}/nation.parquet")
    status, root = _run(spark, {"suppress": ["n_regionkey"], "masking": [{"column": "n_name", "characters_to_mask": [1]}]}, "nation.json", lambda p: sinks.write_json(nation, p))
    assert status["outputs"]["pass"] == "preprocess_only" and status["outputs"]["chunk_count"] >= 1
    return tables.read_json(spark, status["outputs"]["format_matched_output_path"]).drop(sheets.ROW)


@query("SELECT s_suppkey::VARCHAR AS s_suppkey, coalesce(n_name, '') AS n_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey")
def workbook_run(spark, d):
    """A run over a workbook whose sheets are joined, the result again as a workbook."""
    s = tables.read_parquet(spark, f"{d}/supplier.parquet").select("s_suppkey", F.col("s_nationkey").alias("key"), sheets.ROW)
    n = tables.read_parquet(spark, f"{d}/nation.parquet").select(F.col("n_nationkey").alias("key"), "n_name", sheets.ROW)
    section = {"suppress": ["key"], "sheet_joins": [{"left": "s", "right": "n", "on": "key"}]}
    status, _ = _run(spark, section, "book.xlsx", lambda p: sinks.write_workbook({"s": s, "n": n}, p))
    return tables.read_excel(spark, status["outputs"]["format_matched_output_path"])[0].df.drop(sheets.ROW)
