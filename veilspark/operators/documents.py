"""De-identification of nested JSON documents under default-deny path rules, with a census of paths.

Each document is walked once in an Arrow batch. Tokens need all documents first: one
pass collects the distinct values per rule, the vault mints tokens, and each document
gets just its own tokens joined to it, so no task holds the whole vault.
"""
from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import accumulate, chain
from pathlib import Path
from urllib.parse import unquote_to_bytes

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.functions import crypto, mask
from veilspark.functions.deep_json import well_formed
from veilspark.functions.keys import KeyFolder, salt_key
from veilspark.operators.policy import Action, Policy
from veilspark.operators.techniques import Tokens, Vault, hash_value
from veilspark.plans.errors import RunError
from veilspark.session import shared_dir, spread

CENSUS = "array<struct<path:string,non_empty:boolean,action:string,matched_by:string,example:string>>"
CENSUS_TYPE = pa.list_(pa.struct([("path", pa.string()), ("non_empty", pa.bool_()), ("action", pa.string()), ("matched_by", pa.string()), ("example", pa.string())]))

#: Census rows of some documents added up, a row for each path: its last place, and that of its first example.
SUMS = "array<struct<path:string,seen:bigint,non_empty:bigint,action:string,matched_by:string,last:struct<file_name:string,i:int>,example:string,first:struct<file_name:string,i:int>>>"
_PLACE = pa.struct([("file_name", pa.string()), ("i", pa.int32())])
SUMS_TYPE = pa.list_(pa.struct([("path", pa.string()), ("seen", pa.int64()), ("non_empty", pa.int64()), ("action", pa.string()), ("matched_by", pa.string()), ("last", _PLACE), ("example", pa.string()), ("first", _PLACE)]))


class Number(str):
    """A number kept as it is written."""


def load_json(text: str):
    return json.loads(text, parse_float=Number, parse_int=Number)


def dump_json(value, indent: int | None = 2, separators: tuple[str, str] | None = None) -> str:
    """JSON with numbers as they were read."""
    marks: list[str] = []

    def plain(v):
        if isinstance(v, Number):
            marks.append(str(v))
            return f"\x00{len(marks) - 1}\x00"
        if isinstance(v, dict):
            return {k: plain(x) for k, x in v.items()}
        if isinstance(v, list):
            return [plain(x) for x in v]
        return v

    out = json.dumps(plain(value), ensure_ascii=False, indent=indent, separators=separators)
    return re.sub(r'"\\u0000(\d+)\\u0000"', lambda m: marks[int(m.group(1))], out) if marks else out


def leaf_text(v) -> str:
    """The text of a scalar."""
    return "" if v is None else ("true" if v else "false") if isinstance(v, bool) else str(v)


def file_name(value: str) -> str | None:
    """The last segment of a URL or path, without query, percent-decoded."""
    path = re.split(r"[?#]", value.strip())[0]
    if "://" in path:
        path = path.split("://", 1)[1]
        if "/" not in path:
            return None
        path = path.split("/", 1)[1]
    last = re.split(r"[/\\]", path)[-1]
    return unquote_to_bytes(last).decode("utf-8", "replace").strip() or None


GONE = object()


@dataclass
class Keys:
    """What actions need: the hash key, encryption keys by pattern, tokens of one document."""

    hash_key: bytes = b"\0" * 32
    encryption: dict[str, str] = field(default_factory=dict)
    tokens: dict[str, str] = field(default_factory=dict)
    contexts: dict[str, str] = field(default_factory=dict)


def normal(text: str) -> str:
    import unicodedata

    return unicodedata.normalize("NFC", text.strip())


def act(a: Action, value, pattern: str, keys: Keys):
    """A leaf under its action; GONE when it is not released, also when the action cannot handle it."""
    if a.kind in ("keep", "free_text"):
        return value
    if a.kind == "suppress":
        return GONE
    text = leaf_text(value)
    if not text.strip():
        return value
    if a.kind == "masking":
        return mask.masked(text, a.mask)
    if a.kind == "hashing_with_salt":
        return hash_value(keys.hash_key, text.strip())
    if a.kind == "charcloak":
        return mask.cloak(text)
    if a.kind == "filename":
        return file_name(text) or GONE
    if a.kind == "tokenization":
        return keys.tokens.get(f"{pattern}\x1f{normal(text)}", GONE)
    master = keys.encryption.get(pattern)
    if master is None:
        return GONE
    try:
        if a.format_preserving:
            return crypto.format_values([normal(text)], master, pattern, True, keys.contexts.get("format", crypto.FORMAT_CONTEXT))[0]
        return crypto.encrypt_values([normal(text)], master, pattern, keys.contexts.get("encrypt", crypto.ENCRYPT_CONTEXT))[0]
    except RunError:
        return GONE


@lru_cache(maxsize=50_000)
def _shown(path: tuple[str, ...]) -> str:
    return re.sub(r"\.\[\]", "[]", ".".join(path))


def show(path: list[str]) -> str:
    return _shown(tuple(path))


def census_row(path: list[str] | str, value, action: str, by: str, sample: bool) -> dict:
    text = value if isinstance(value, str) else "" if value is None else dump_json(value, None, (",", ":"))
    full = bool(text.strip())
    return {"path": path if isinstance(path, str) else show(path), "non_empty": full, "action": action, "matched_by": by, "example": text[:40] if full and sample else None}


def text_array(values: list[str | None]) -> pa.Array:
    """An array of texts, as UTF-8 can hold them."""
    try:
        return pa.array(values, pa.string())
    except UnicodeEncodeError:
        return pa.array([v if v is None else well_formed(v) for v in values], pa.string())


def census_array(rows: list[list[dict]]) -> pa.Array:
    """The census rows of some documents, made column by column."""
    flat, names = list(chain.from_iterable(rows)), CENSUS_TYPE.value_type.names
    columns = [pa.array([r[n] for r in flat], pa.bool_()) if n == "non_empty" else text_array([r[n] for r in flat]) for n in names]
    ends = pa.array([0, *accumulate(map(len, rows))], pa.int32())
    return pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(columns, fields=list(CENSUS_TYPE.value_type)), type=CENSUS_TYPE)


def sums_array(names: list[str], rows: list[list[dict]]) -> pa.Array:
    """The census rows of some documents added up by path, all in the place of the last document."""
    sums: dict[str, dict] = {}
    for name, census in sorted(zip(names, rows), key=lambda x: x[0]):
        for i, r in enumerate(census):
            s = sums.get(r["path"])
            if s is None:
                s = sums[r["path"]] = {"seen": 0, "non_empty": 0, "example": None, "first": None}
            s["seen"] += 1
            s["non_empty"] += r["non_empty"]
            s["row"], s["last"] = r, (name, i)
            if s["first"] is None and r["example"] is not None:
                s["example"], s["first"] = r["example"], (name, i)
    place = lambda at: at and {"file_name": at[0], "i": at[1]}
    text = lambda t: None if t is None else well_formed(t)
    out = [
        {"path": text(path), "seen": s["seen"], "non_empty": s["non_empty"], "action": s["row"]["action"], "matched_by": text(s["row"]["matched_by"]), "last": place(s["last"]), "example": text(s["example"]), "first": place(s["first"])}
        for path, s in sums.items()
    ]
    return pa.array([*[None] * (len(rows) - 1), out], SUMS_TYPE)


def label(a: Action) -> str:
    return a.kind


def walk(value, policy: Policy, keys: Keys, census: list[dict], wanted: list | None = None):
    """A document without what is not released. ``wanted`` collects (pattern, action, value) of tokens instead."""
    path: list[str] = []

    def go(v):
        if isinstance(v, dict):
            out = {}
            for k, x in v.items():
                path.append(k.lower())
                kept = go(x)
                path.pop()
                if kept is not GONE:
                    out[k] = kept
            return out
        if isinstance(v, list):
            path.append("[]")
            kept = [x for x in map(go, v) if x is not GONE]
            path.pop()
            return kept
        action, by = policy.decide(path)
        if wanted is not None:
            if action.kind == "tokenization" and leaf_text(v).strip():
                wanted.append((by, normal(leaf_text(v))))
            return v
        census.append(census_row(path, v, label(action), by, action.kind == "keep"))
        return act(action, v, by, keys)

    return go(value)


def pieces(batches: Iterator[pa.RecordBatch], most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of about ``most`` bytes of text: the census of documents takes many times their size."""
    for b in batches:
        start = size = 0
        for i, n in enumerate(pc.binary_length(b.column(1)).fill_null(0).to_pylist()):
            size += n
            if size >= most:
                yield b.slice(start, i + 1 - start)
                start, size = i + 1, 0
        if start < b.num_rows:
            yield b.slice(start)


def _token_values(policy: Policy):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, patterns, values = [], [], []
            for name, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                wanted: list = []
                try:
                    walk(load_json(text or ""), policy, Keys(), [], wanted)
                except (ValueError, RecursionError):
                    continue
                for p, v in dict.fromkeys(wanted):
                    names.append(name), patterns.append(p), values.append(well_formed(v))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(patterns, pa.string()), pa.array(values, pa.string())], names=["file_name", "pattern", "value"])

    return run


def _anonymiser(policy: Policy, keys: Keys, with_tokens: bool, summed: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            outs, rows = [], []
            tokens = b.column(2).to_pylist() if with_tokens else [None] * b.num_rows
            for text, own in zip(b.column(1).to_pylist(), tokens):
                census: list[dict] = []
                try:
                    doc = load_json(text or "")
                    mine = Keys(keys.hash_key, keys.encryption, dict(own or []), keys.contexts)
                    kept = walk(doc, policy, mine, census)
                    out = dump_json(None if kept is GONE else kept)
                except (ValueError, RecursionError):  # no JSON, or nested deeper than documents may be (some hundred levels)
                    outs.append(None), rows.append([])
                    continue
                outs.append(out), rows.append(census)
            yield pa.RecordBatch.from_arrays([b.column(0), text_array(outs), sums_array(b.column(0).to_pylist(), rows) if summed else census_array(rows)], names=["file_name", "document", "census"])

    return run


def anonymise(docs: DataFrame, policy: Policy, keys: KeyFolder, vault: Vault | None = None, shared_salt: bool = True, contexts: dict | None = None, summed: bool = False) -> DataFrame:
    """``(file_name, document, census)`` of ``docs`` (file_name, doc); document is null where JSON is broken.

    ``summed``: the census is added up over the documents of a batch, for :func:`census_table`.
    """
    held = Keys(salt_key(keys.salt("nested_json", shared_salt), "nested_json"), {r.pattern: keys.key(r.pattern) for r in policy.rules if r.action.kind == "encrypt"}, {}, contexts or {})
    docs = spread(docs.select(F.col("file_name"), F.col("doc")), "file_name")
    tokenised = {r.pattern: Tokens(r.pattern, r.action.prefix, r.action.digits) for r in policy.rules if r.action.kind == "tokenization"}
    out = f"file_name string, document string, census {SUMS if summed else CENSUS}"
    if not tokenised:
        return docs.mapInArrow(_anonymiser(policy, held, False, summed), out)
    if vault is None:
        raise RunError("PREPROCESS_CONFIG_INVALID", "tokens need a key folder", next(iter(tokenised)))
    wanted = docs.mapInArrow(_token_values(policy), "file_name string, pattern string, value string")
    minted = None
    for pattern, t in tokenised.items():
        own = wanted.filter(F.col("pattern") == pattern)
        table = vault.mint(own.select("value"), t)
        part = own.join(table, "value").select("file_name", F.struct(F.concat_ws("\x1f", "pattern", "value").alias("key"), "token").alias("t"))
        minted = part if minted is None else minted.unionByName(part)
    per = minted.groupBy("file_name").agg(F.map_from_entries(F.array_distinct(F.collect_list("t"))).alias("tokens"))  # one document's own tokens
    return docs.join(per, "file_name", "left").select("file_name", "doc", "tokens").mapInArrow(_anonymiser(policy, held, True, summed), out)


def census_table(done: DataFrame) -> DataFrame:
    """Per path: how often seen and filled, the last action and rule, the first kept example."""
    if "seen" in done.schema["census"].dataType.elementType.names:
        return done.select(F.explode("census").alias("c")).select("c.*").groupBy("path").agg(
            F.sum("seen").alias("documents_seen"), F.sum("non_empty").alias("non_empty"), F.max_by("action", "last").alias("action"), F.max_by("matched_by", "last").alias("matched_by"),
            F.coalesce(F.min_by("example", "first"), F.lit("")).alias("example_value"),
        )
    rows = done.select("file_name", F.posexplode("census").alias("i", "c")).select("file_name", "i", "c.*")
    at = F.struct("file_name", "i")
    return rows.groupBy("path").agg(
        F.count("*").alias("documents_seen"), F.count_if("non_empty").alias("non_empty"), F.max_by("action", at).alias("action"), F.max_by("matched_by", at).alias("matched_by"),
        F.coalesce(F.min_by("example", F.when(F.col("example").isNotNull(), at)), F.lit("")).alias("example_value"),
    )


def read_documents(spark: SparkSession, path: str, folder: str | None = None) -> DataFrame:
    """``(file_name, doc)`` of the JSON files of a folder (not below it), or of one file; packed into ``folder``, or one of the shared folder."""
    p = Path(path)
    from veilspark.sources.files import packed

    found = [str(p)] if p.is_file() else sorted(f.path for f in os.scandir(p) if os.path.splitext(f.name)[1].lower() == ".json" and f.is_file()) if p.is_dir() else []
    if not found:
        raise RunError("DATA_MISSING", "there are no JSON documents", str(path))
    rows = packed(spark, found, folder or f"{shared_dir(spark)}/input-{uuid.uuid4().hex}")
    return rows.select("file_name", F.col("content").cast("string").alias("doc"))
