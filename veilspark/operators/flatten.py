"""Turn nested JSON documents into flat tables that keep parent-child links.

``cases`` (one row per document), ``pages`` (one per entry of ``pages``), ``elements``
(one per array element at any depth, whatever it holds; :func:`child_tables` has one
table per array of the merged schema) and ``entries`` (one per non-null scalar) carry
the parent's surrogate key and the ordinal in the parent array.

A first pass merges the shape of all documents: how deep it goes. Then every level is
one ``explode`` of the level above in the same stage, without a shuffle or another
read; an array level gives a row for each of its elements as it is exploded. At most
``INLINE`` levels stand in one plan. What lies deeper, if anything, goes on in rounds
of as many levels over the few nodes that are left, so no plan grows with the deepest
document. :func:`merged_schema` is the merged schema as a table.

A page's key is its document's id and its ordinal. Where ids repeat, the documents are
numbered in a written copy and the number is part of the key, so keys stay unique.

Defined results: null, empty, cut-off or otherwise invalid JSON (also text after the
document, and documents above Spark's VARIANT limits: 128 MiB, 1,000 levels) gives a
case row with ``is_valid`` false and no pages; ``pages`` that is one object is a list of
one; null and non-object entries of ``pages`` keep their place but have no entries; of
keys given twice in one object the last counts (for this the session setting
``spark.sql.variant.allowDuplicateKeys`` is switched on); other columns of the input are
ignored; repeated rows give repeated results, each with its own keys.
"""
from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilspark.functions.text import let
from veilspark.plans.errors import RunError
from veilspark.session import cut, shared_dir, spread

#: Levels that one plan explodes.
INLINE = 16
#: More arrays than this in a merged schema have no table of their own each.
MAX_TABLES = 10_000


@dataclass(frozen=True)
class Flat:
    cases: DataFrame
    pages: DataFrame
    elements: DataFrame
    entries: DataFrame
    levels: int


def parse_json(text: Column) -> Column:
    """VARIANT of a whole JSON text, null when it is not exactly one JSON value."""
    wrapped = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>")
    return let(wrapped, lambda a: F.when(F.size(a) == 1, F.element_at(a, 1)))


def as_map(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def as_array(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def _depth(v: Column) -> Column:
    """Levels of nesting of a VARIANT, from its text without strings."""
    bare = F.regexp_replace(F.regexp_replace(F.to_json(v), r"\\.", ""), '"[^"]*"', "")
    step = lambda c: F.when(c.isin("[", "{"), 1).when(c.isin("]", "}"), -1).otherwise(0)
    run = F.aggregate(
        F.split(F.regexp_replace(bare, r"[^\[\]{}]", ""), ""),
        F.struct(F.lit(0).alias("now"), F.lit(0).alias("top")),
        lambda acc, c: F.struct((acc["now"] + step(c)).alias("now"), F.greatest(acc["top"], acc["now"] + step(c)).alias("top")),
        lambda acc: acc["top"],
    )
    return F.coalesce(run, F.lit(0))


NODE, ELEMENT = 0, 1


def _children(e: Column) -> Column:
    """The children of one node, with a row for each element of an array; a scalar is itself, nothing comes of what is empty."""
    node = lambda role, path, up, ordinal, v: F.struct(F.lit(role).alias("role"), path.alias("path"), up.alias("up"), ordinal.alias("ordinal"), v.alias("v"))

    def of_array(a: Column) -> Column:
        place = lambda i: F.concat(F.coalesce(e["path"], F.lit("")), F.lit("["), i.cast("string"), F.lit("]"))
        held = F.transform(a, lambda x, i: node(NODE, place(i), place(i), i, x))
        rows = F.transform(a, lambda x, i: node(ELEMENT, place(i), e["up"], i, F.lit(None).cast("variant")))
        return F.concat(rows, held)

    def of_map(m: Column) -> Column:
        def one(kv: Column) -> Column:
            p = F.when(e["path"].isNull(), kv["key"]).otherwise(F.concat(e["path"], F.lit("."), kv["key"]))
            return node(NODE, p, e["up"], e["ordinal"], kv["value"])

        return F.transform(F.map_entries(m), one)

    return let(
        F.struct(as_array(e["v"]).alias("a"), as_map(e["v"]).alias("m")),
        lambda k: F.when(k["a"].isNotNull(), of_array(k["a"])).when(k["m"].isNotNull(), of_map(k["m"])).otherwise(F.array(e)),
    )


def keyed(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """``(claim_no, doc_key, text)``: documents with keys that are unique also where ids repeat."""
    rows = df.select(F.col(id_col).alias("claim_no"), F.col(json_col).alias("text"))
    often = rows.groupBy("claim_no").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("claim_no").alias("__often"))
    plain = F.coalesce(F.col("claim_no").cast("string"), F.lit(""))
    if often.isEmpty():
        return rows.select("claim_no", plain.alias("doc_key"), "text")
    numbered = cut(rows.withColumn("__row", F.monotonically_increasing_id()))
    return numbered.join(often, F.col("claim_no").eqNullSafe(F.col("__often")) , "left").select(
        "claim_no", F.when(F.col("__often").isNull() & F.col("claim_no").isNotNull(), plain).otherwise(F.concat(plain, F.lit("~"), F.col("__row").cast("string"))).alias("doc_key"), "text"
    )


def documents(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """``(id, doc_key, doc, case_id)`` with ``doc`` VARIANT or null."""
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    rows = spread(keyed(df, id_col, json_col), "claim_no")
    doc = rows.select("claim_no", "doc_key", parse_json(F.col("text")).alias("doc"))
    text = lambda p: F.try_variant_get("doc", p, "string")
    return doc.select("claim_no", "doc_key", "doc", F.coalesce(text("$.case_id"), F.lit("")).alias("case_id"))


def page_rows(docs: DataFrame) -> DataFrame:
    """``(id, case_id, page_pos, page, data)``: one row per entry of ``pages``."""
    pages = F.try_variant_get("doc", "$.pages", "variant")
    listed = let(pages, lambda p: F.when(as_map(p).isNotNull(), F.array(p)).otherwise(as_array(p)))
    rows = docs.select("claim_no", "doc_key", "case_id", F.posexplode(listed).alias("page_pos", "page"))

    def payload(v: Column) -> Column:
        inner = lambda t: let(parse_json(t), lambda x: F.when(as_map(x).isNotNull(), x))
        return F.when(as_map(v).isNotNull() | as_array(v).isNotNull(), v).when(F.schema_of_variant(v) == "STRING", inner(F.try_variant_get(v, "$", "string")))

    data = let(F.try_variant_get("page", "$.extracted_data", "variant"), payload)
    return rows.select("claim_no", F.concat_ws("/", "doc_key", F.col("page_pos").cast("string")).alias("page_key"), "case_id", "page_pos", "page", data.alias("data"))


def levels_of(pages: DataFrame) -> int:
    """How many levels the merged shape of all payloads has (one aggregate, one number)."""
    return pages.select(_depth(F.col("data")).alias("d")).agg(F.coalesce(F.max("d"), F.lit(0))).first()[0]


_PAGE = ("claim_no", "case_id", "page_pos", "page_key")


def _read_off(df: DataFrame) -> DataFrame:
    """Exploded nodes as rows: elements, and scalars with their kind and text."""
    e = F.col("e")
    kind = F.when(e["role"] == NODE, F.schema_of_variant(e["v"]))
    rows = df.filter((e["role"] == ELEMENT) | ~F.is_variant_null(e["v"])).select(*_PAGE, e["role"].alias("role"), e["path"].alias("path"), e["up"].alias("up"), e["ordinal"].alias("ordinal"), kind.alias("kind"), F.try_variant_get(e["v"], "$", "string").alias("leaf_text"))
    return rows


def walk(pages: DataFrame, levels: int, inline: int = INLINE) -> DataFrame:
    """Every array element and every non-null scalar of the payloads, exploded level by level.

    ``up`` is the path of the array element around a row, ``ordinal`` an element's own place or that of the element around a scalar.
    """
    start = F.struct(F.lit(NODE).alias("role"), F.lit(None).cast("string").alias("path"), F.lit("").alias("up"), F.lit(None).cast("int").alias("ordinal"), F.col("data").alias("v"))
    df = pages.filter(F.col("data").isNotNull()).select(*_PAGE, start.alias("e"))

    def down(df: DataFrame, n: int) -> DataFrame:
        for _ in range(n):
            df = df.select(*_PAGE, F.explode(_children(F.col("e"))).alias("e"))
        return df

    if levels <= inline:
        return _read_off(down(df, levels))
    v = F.col("e.v")
    deep = as_array(v).isNotNull() | as_map(v).isNotNull()
    spark, folder = pages.sparkSession, f"{shared_dir(pages.sparkSession)}/nodes-{uuid.uuid4().hex}"
    left, done = df, 0
    while done < levels:
        left = cut(down(left, min(inline, levels - done)))
        done += inline
        _read_off(left.filter(~F.coalesce(deep, F.lit(False)))).write.mode("append").parquet(folder)
        left = left.filter(deep)
    return spark.read.parquet(folder)


def flatten(df: DataFrame, id_col: str = "claim_no", json_col: str = "doc_json", inline: int = INLINE) -> Flat:
    """The related tables of all documents."""
    docs = documents(df, id_col, json_col)
    pages = page_rows(docs)
    levels = levels_of(pages)
    num = lambda c, p: F.try_variant_get(c, p, "string")
    cases = docs.select(
        "claim_no", "case_id", F.col("doc").isNotNull().alias("is_valid"), num("doc", "$.total_documents").alias("total_documents"), num("doc", "$.total_pages").alias("total_pages"), "doc_key"
    )
    page_table = pages.select(
        "claim_no", "case_id", "page_pos", "page_key", num("page", "$.document").alias("document"), num("page", "$.link").alias("link"),
        num("page", "$.page_number").alias("page_number"), num("page", "$.total_pages").alias("total_pages"), F.col("data").isNotNull().alias("has_data"),
    )
    nodes = walk(pages, levels, inline)
    parent = F.concat_ws("#", "page_key", "up")
    entries = nodes.filter(F.col("role") == NODE).select("claim_no", "case_id", "page_pos", "page_key", F.col("path").alias("leaf_path"), parent.alias("parent_key"), "ordinal", "kind", "leaf_text")
    array = F.expr("substring(path, 1, length(path) - length(string(ordinal)) - 2)")
    elements = nodes.filter(F.col("role") == ELEMENT).select(
        "claim_no", "page_key", F.concat_ws("#", "page_key", "path").alias("element_key"), parent.alias("parent_key"), "ordinal", F.regexp_replace(array, r"\[\d+\]", "[]").alias("child_table"),
    )
    return Flat(cases, page_table, elements, entries, levels)


def merged_schema(entries: DataFrame) -> DataFrame:
    """The merged schema as a table: every path (ordinals dropped) with its kinds and counts."""
    kind = F.regexp_replace("kind", r"\(.*", "").alias("kind")
    return entries.groupBy(F.regexp_replace("leaf_path", r"\[\d+\]", "[]").alias("path"), kind).agg(F.count("*").alias("entries"), F.count_distinct("claim_no").alias("documents"))


def child_tables(flat: Flat) -> dict[str, DataFrame]:
    """The elements of each array of the merged schema as a table of its own, by the array's path."""
    names = [r[0] for r in flat.elements.select("child_table").distinct().limit(MAX_TABLES + 1).collect()]
    if len(names) > MAX_TABLES:
        raise RunError("CONFIG_INVALID_VALUE", "the merged schema has too many arrays for a table each", f"more than {MAX_TABLES}")
    return {n: flat.elements.filter(F.col("child_table") == n).drop("child_table") for n in sorted(names)}
