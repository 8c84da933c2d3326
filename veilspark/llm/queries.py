"""Queries of the text problems 3 to 8, with their SQL where SQL can express them."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.functions.text import INVISIBLE
from veilspark.llm import corpus_tokens, lookalike, packing, pii, repetition, term_counts

_COLUMNS = {"patients": {"Age": None, "Pincode": None, "Gender": None}, "visits": {"Diagnosis": ";"}}


def _read(spark: SparkSession, d: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{table}.parquet")


def _terms(spark: SparkSession, d: str, when=None) -> DataFrame:
    out = None
    for table, columns in _COLUMNS.items():
        rows = _read(spark, d, table)
        part = term_counts.terms_of(rows if when is None else rows.filter(when), columns)
        out = part if out is None else out.unionByName(part)
    return out


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """All rows as one delta of additions to an empty store."""
    store = term_counts.TermStore(spark).apply(_terms(spark, d))
    return term_counts.verdicts(store.counts()).select("column_name", "term_text", "verdict")


def p3_counts(spark: SparkSession, d: str) -> DataFrame:
    """The counts after two updates: rows loaded before a date, then the rows loaded since."""
    early = F.col("loaded_at") < F.lit("2025-07-01").cast("timestamp")
    store = term_counts.TermStore(spark).apply(_terms(spark, d, early)).apply(_terms(spark, d, ~early | F.col("loaded_at").isNull()))
    return store.counts().select("column_name", "term_text", "occurrences", "records")


def p3_updated(spark: SparkSession, d: str) -> DataFrame:
    """The counts of the present tables, reached from an earlier state by the records added, changed and deleted since.

    Earlier, the rows loaded before a date had other values, and every patient was there
    twice: the second rows are deleted.
    """
    early = F.col("loaded_at") < F.lit("2025-07-01").cast("timestamp")
    patients, visits = _read(spark, d, "patients"), _read(spark, d, "visits")
    p = patients.select("row_id", *_COLUMNS["patients"])
    before = patients.filter(early).withColumn("Gender", F.concat(F.lit("was "), "Gender")).select(p.columns)
    before = before.unionByName(p.withColumn("row_id", -F.col("row_id") - 1))
    v = visits.select("visit_id", "Diagnosis")
    old = visits.filter(early).select("visit_id", F.concat_ws(";", "Diagnosis", "hospital_id").alias("Diagnosis"))
    store = term_counts.TermStore(spark).apply(term_counts.terms_of(before, _COLUMNS["patients"]).unionByName(term_counts.terms_of(old, _COLUMNS["visits"])))
    changed = [term_counts.terms_of(term_counts.changes(a, b, k, list(c)), c, F.col("sign")) for a, b, k, c in ((before, p, "row_id", _COLUMNS["patients"]), (old, v, "visit_id", _COLUMNS["visits"]))]
    return store.apply(changed[0].unionByName(changed[1])).counts().select("column_name", "term_text", "occurrences", "records")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.same_looking_pairs(_read(spark, d, "patients"), "row_id", ["Name", "Aadhaar", "Email"])


def p4_consistent(spark: SparkSession, d: str) -> DataFrame:
    """Every patient row with the canonical member of each of its three texts."""
    same = lookalike.consistent(_read(spark, d, "patients").select("row_id", "Name", "Aadhaar", "Email"), ["Name", "Aadhaar", "Email"])
    return same.select("row_id", "Name_same", "Aadhaar_same", "Email_same")


def _pii(spark: SparkSession, d: str, every: bool = False) -> DataFrame:
    """Texts with findings (or every text) of visits and of the claim documents' free-text entries."""
    visits = _read(spark, d, "visits")
    model = pii.fit_from(_read(spark, d, "name_lexicon"), visits, "visit_id", "Note", _read(spark, d, "claim_docs").select("claim_no", "doc_json"))
    notes = visits.select(F.lit("visits").alias("source_table"), F.col("visit_id").alias("record_id"), F.lit(-1).alias("page_pos"), F.lit("Note").alias("leaf_path"), F.col("Note").alias("text"))
    entries = _read(spark, d, "claim_docs").select("claim_no", "doc_json").mapInArrow(pii.claim_texts, "record_id bigint, page_pos int, leaf_path string, text string")
    claims = entries.select(F.lit("claim_docs").alias("source_table"), "record_id", "page_pos", "leaf_path", "text")
    return pii.find(notes.unionByName(claims), ["source_table", "record_id", "page_pos", "leaf_path"], "text", model, every)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    found = _pii(spark, d)
    return found.select("source_table", "record_id", "page_pos", "leaf_path", F.explode("found").alias("f")).select("source_table", "record_id", "page_pos", "leaf_path", "f.start_pos", "f.pii_type")


def p5_replaced(spark: SparkSession, d: str) -> DataFrame:
    """Every text, with typed placeholders in the place of personal information and all else unchanged."""
    found = _pii(spark, d, True)
    return found.select("source_table", "record_id", "page_pos", "leaf_path", pii.replace(F.col("text"), F.col("found")).alias("clean_text"))


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return corpus_tokens.encode(_read(spark, d, "documents").select("doc_id", "text"))


def p6_decoded(spark: SparkSession, d: str) -> DataFrame:
    """Every document's text out of its ids: equal to the stored text, null as empty."""
    return corpus_tokens.decode(p6_ids(spark, d))


def _capacities(spark: SparkSession, d: str) -> list[tuple[str, int]]:
    return [(r[0], r[1]) for r in _read(spark, d, "pack_sizes").select("size_name", "capacity_tokens").collect()]


def p7_packed(spark: SparkSession, d: str) -> DataFrame:
    """Where every document (or piece of one) lies, for each container size."""
    return packing.pack(packing.sizes(p6_ids(spark, d)), _capacities(spark, d))


def p7_invariants(spark: SparkSession, d: str) -> DataFrame:
    """What must not be: containers over the brim, documents lost or split without need, tokens lost; and the documents packed."""
    sized = packing.sizes(p6_ids(spark, d))
    caps = _capacities(spark, d)
    room = F.create_map(*[F.lit(x) for pair in caps for x in pair])[F.col("size_name")]
    rows = packing.pack(sized, caps)
    over = rows.groupBy("size_name", "container_id").agg(F.sum("n_tokens").alias("t")).groupBy("size_name").agg(F.count_if(F.col("t") > room).alias("over_full"))
    per = rows.groupBy("size_name", "doc_id").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("pieces")).join(sized.select(F.col("id").alias("doc_id"), F.col("size")), "doc_id", "full")
    docs = per.groupBy("size_name").agg(F.count_if(F.col("t").isNull() | (F.col("t") != F.col("size"))).alias("lost"), F.count_if((F.col("pieces") > 1) & (F.col("size") <= room)).alias("split_in_vain"), F.count("*").alias("documents"))
    return docs.join(over, "size_name").select("size_name", "documents", "over_full", "lost", "split_in_vain")


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    """Containers and tokens of each size, and the share of the room that is used."""
    caps = F.create_map(*[F.lit(x) for pair in _capacities(spark, d) for x in pair])
    per = p7_packed(spark, d).groupBy("size_name").agg(F.count_distinct("container_id").alias("containers"), F.sum("n_tokens").alias("tokens"))
    return per.select("size_name", "containers", "tokens", (F.col("tokens") / (F.col("containers") * caps[F.col("size_name")])).alias("used_share"))


def p8_method(spark: SparkSession, d: str) -> DataFrame:
    """The threshold table over the whole collection: every document with all its ratios and the marks they give."""
    p = repetition.profile(_read(spark, d, "documents").select("doc_id", "text"))
    return p.select("doc_id", *[F.round(c, 9).alias(c) if c != "m_n_words" else F.col(c) for c in p.columns if c.startswith("m_")], F.array_join("marks", ",").alias("marks"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    marked = repetition.profile(_read(spark, d, "documents").select("doc_id", "text"))
    return marked.filter(F.array_contains("marks", "repeated")).select("doc_id")


def p8_profile(spark: SparkSession, d: str) -> DataFrame:
    """The same under its older name."""
    return p8_method(spark, d)


QUERIES = {f.__name__: f for f in (p3_found, p3_counts, p3_updated, p4_found, p4_consistent, p5_found, p5_replaced, p6_ids, p6_decoded, p7_packed, p7_fill, p7_invariants, p8_method, p8_found, p8_profile)}

_WS = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_TRIM = rf"regexp_replace(regexp_replace(nfc_normalize(t), '^{_WS}+', ''), '{_WS}+$', '')"
_COUNTS = f"""WITH cells AS (
    SELECT 'Age' AS column_name, row_id AS id, Age AS t FROM patients UNION ALL SELECT 'Pincode', row_id, Pincode FROM patients
    UNION ALL SELECT 'Gender', row_id, Gender FROM patients UNION ALL SELECT 'Diagnosis', visit_id, unnest(string_split(Diagnosis, ';')) FROM visits),
  terms AS (SELECT column_name, id, {_TRIM} AS term_text FROM cells WHERE t IS NOT NULL),
  counts AS (SELECT column_name, term_text, count(*) AS occurrences, count(DISTINCT id) AS records FROM terms WHERE term_text <> '' GROUP BY ALL)"""
_RUNS = r"""WITH split AS (
    SELECT doc_id, list_filter(regexp_split_to_array(regexp_replace(lower(coalesce(text, '')), '\p{P}+', '', 'g'), '""" + _WS + r"""+'), lambda w: w <> '') AS w FROM documents),
  runs AS (SELECT doc_id, i, array_to_string(w[i:i+7], ' ') AS run FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM split WHERE len(w) >= 8)),
  firsts AS (SELECT doc_id, i, min(i) OVER (PARTITION BY doc_id, run) AS f FROM runs),
  covered AS (SELECT DISTINCT doc_id, i + unnest(range(0, 8)) AS p FROM firsts WHERE f < i),
  share AS (SELECT s.doc_id, len(s.w) AS n, count(c.p) / greatest(len(s.w), 1) AS share FROM split s LEFT JOIN covered c USING (doc_id) GROUP BY s.doc_id, len(s.w))"""
_STOPS = ", ".join(f"'{w}'" for w in repetition.STOP_WORDS)
# the fifth ratio is the share of repeated words, from _RUNS
_PROFILE = rf"""{_RUNS},
  lines AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(coalesce(text, ''), '\r\n|\r|\n'), lambda x: trim(x)), lambda x: x <> '') AS l, length(coalesce(text, '')) AS chars,
            length(regexp_replace(coalesce(text, ''), '[\p{{S}}#…•]', '', 'g')) AS left_chars FROM documents),
  ratios AS (SELECT doc_id, n::INTEGER AS m_n_words, round(share, 9) AS m_repeated_share, CASE WHEN chars > 0 THEN round((chars - left_chars) / chars, 9) ELSE 0.0 END AS m_symbol_ratio,
            CASE WHEN n > 0 THEN round(len(list_filter(w, lambda x: x IN ({_STOPS}))) / n, 9) ELSE 0.0 END AS m_stop_word_ratio,
            CASE WHEN len(l) > 0 THEN round((len(l) - len(list_distinct(l))) / len(l), 9) ELSE 0.0 END AS m_repeated_line_ratio
            FROM share JOIN split USING (doc_id) JOIN lines USING (doc_id))
  SELECT *, concat_ws(',', CASE WHEN m_repeated_share >= 0.4 THEN 'repeated' END, CASE WHEN m_n_words < 5 THEN 'short' END, CASE WHEN m_symbol_ratio > 0.1 THEN 'symbols' END,
            CASE WHEN m_stop_word_ratio < 0.02 THEN 'few_stop_words' END, CASE WHEN m_repeated_line_ratio > 0.3 THEN 'repeated_lines' END) AS marks FROM ratios"""
# compatibility forms of the collection: full-width characters by rule, a ligature, a small at sign
_WIDE, _PLAIN = "".join(chr(0xFEE0 + i) for i in range(33, 127)), "".join(map(chr, range(33, 127)))


def _look(c: str) -> str:
    table = {**dict(zip(_WIDE, _PLAIN)), **lookalike.LOOKALIKES, "﹫": "@"}
    quoted = lambda x: x.replace("'", "''")
    bare = f"translate(replace(regexp_replace(nfc_normalize({c}), '[{INVISIBLE}]+', '', 'g'), 'ﬆ', 'st'), '{quoted(''.join(table))}', '{quoted(''.join(table.values()))}')"
    return f"nfc_normalize(trim(regexp_replace({bare}, '{_WS}+', ' ', 'g')))"


_FORMS = f"""forms AS (SELECT row_id, "Name" AS n, "Aadhaar" AS a, "Email" AS e, {_look('"Name"')} AS fn, {_look('"Aadhaar"')} AS fa, {_look('"Email"')} AS fe FROM patients)"""
_CANON = ", ".join(f"canon_{x} AS (SELECT f{x}, arg_min({x}, {{'s': length(regexp_replace({x}, '[ -~]', '', 'g')), 'v': {x}}}) AS same FROM forms WHERE f{x} <> '' GROUP BY f{x})" for x in "nae")
ORACLE = {
    "p3_found": f"""{_COUNTS}, totals AS (SELECT column_name, sum(occurrences) AS total FROM counts GROUP BY ALL)
      SELECT column_name, term_text, 'rare' AS verdict FROM counts WHERE records <= 3
      UNION ALL SELECT column_name, term_text, 'common' FROM counts JOIN totals USING (column_name) WHERE occurrences * 10 > total""",
    "p3_counts": f"{_COUNTS} SELECT column_name, term_text, occurrences, records FROM counts",
    "p3_updated": f"{_COUNTS} SELECT column_name, term_text, occurrences, records FROM counts",
    "p4_found": f"""WITH {_FORMS} SELECT x.row_id AS row_id_a, y.row_id AS row_id_b FROM forms x JOIN forms y ON x.fn = y.fn AND x.fa = y.fa AND x.fe = y.fe AND x.row_id < y.row_id
      WHERE x.fn <> '' AND x.fa <> '' AND x.fe <> '' AND (x.n <> y.n OR x.a <> y.a OR x.e <> y.e)""",
    "p4_consistent": f"""WITH {_FORMS}, {_CANON} SELECT row_id, canon_n.same AS "Name_same", canon_a.same AS "Aadhaar_same", canon_e.same AS "Email_same"
      FROM forms LEFT JOIN canon_n USING (fn) LEFT JOIN canon_a USING (fa) LEFT JOIN canon_e USING (fe)""",
    "p7_invariants": "SELECT size_name, count(*) AS documents, 0::BIGINT AS over_full, 0::BIGINT AS lost, 0::BIGINT AS split_in_vain FROM documents, pack_sizes GROUP BY size_name",
    "p8_method": _PROFILE,
    "p8_profile": _PROFILE,
    "p6_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
    "p8_found": f"{_RUNS} SELECT doc_id FROM share WHERE share >= 0.4",
}
