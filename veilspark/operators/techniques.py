"""Per-column techniques: suppress, hash, mask, cloak, tokenise, encrypt, in this order.

Hashing and character masks are built-in expressions. Pattern masks, cloaking and
encryption run in Arrow batches over the distinct values of a batch. Cloaked columns
are written once, so that a second action or a retry sees the same characters.
Missing cells (blank, or ``nan``) pass through every technique but suppression.
"""
from __future__ import annotations

import hashlib
import hmac
import json
import secrets
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from veilspark.functions import crypto, mask
from veilspark.functions.keys import KeyFolder, private_dir, salt_key, write_secret
from veilspark.functions.text import nfc, trim_unicode
from veilspark.plans.errors import RunError
from veilspark.session import cut, on_one_machine, shared_dir, spread
from veilspark.sources.files import by_tasks


def missing(c: Column) -> Column:
    """Null, blank or ``nan`` in any case."""
    t = trim_unicode(c)
    return c.isNull() | (t == "") | (F.lower(t) == "nan")


def identifier(c: Column) -> Column:
    """The compared form of an identifier: trimmed, NFC."""
    return nfc(trim_unicode(c))


def keyed_hash(c: Column, salt: str, owner: str = "") -> Column:
    """HMAC-SHA256 in hexadecimal, out of Spark's own SHA-2."""
    key = salt_key(salt, owner).ljust(64, b"\0")
    inner, outer = (F.lit(bytes(b ^ x for b in key)) for x in (0x36, 0x5C))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, F.encode(c, "UTF-8")), 256))), 256)


def hash_value(key: bytes, value: str) -> str:
    """The same for one value in Python, for documents."""
    return hmac.new(key, value.encode(), hashlib.sha256).hexdigest()


def per_value(f: Callable[[list[str]], list[str | None]], name: str):
    """A text function over the distinct values of an Arrow batch; errors name the column only."""

    @arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for a in batches:
            d = a.dictionary_encode()
            values = d.dictionary.to_pylist()
            try:
                out = f(values)
            except RunError:
                raise
            except Exception as e:
                raise RunError("PREPROCESSING_FAILED", f"a technique failed: {type(e).__name__}", f"column {name}") from None
            yield pa.array(out, pa.string()).take(d.indices)

    return run


def cloak_column(c: Column, name: str) -> Column:
    @arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for a in batches:
            yield pa.array([None if v is None else mask.cloak(v) for v in a.to_pylist()], pa.string())

    return run.asNondeterministic()(c)


@dataclass(frozen=True)
class Tokens:
    """Settings of one tokenised column."""

    column: str
    prefix: str = "TK-"
    digits: int = 6

    @property
    def space(self) -> int:
        return 10 ** min(self.digits, 18)


class Vault:
    """Tokens by column, kept in the key folder: the mapping as Parquet, the counters as JSON.

    Tokens are a keyed permutation (FF1) of running numbers: random to look at, unique
    without the driver seeing a value, and the same again for values already known.
    """

    SCHEMA = "value string, token string"

    def __init__(self, spark, path: str | Path, shared: str | None = None):
        """``path`` is a folder of the driver; tasks write the mapping there, or on a cluster into ``shared``, by default the shared folder."""
        self.spark, self.path = spark, private_dir(path)
        self.shared = shared or (None if on_one_machine(spark) else f"{shared_dir(spark)}/vault")
        self.file = self.path / "token_vault.json"
        self.state: dict[str, dict] = json.loads(self.file.read_text()) if self.file.exists() else {}

    def _part(self, name: str) -> str:
        return name if "/" in name else by_tasks(self.spark, self.path / name)

    def known(self, column: str) -> DataFrame:
        parts = self.state.get(column, {}).get("parts", [])
        return self.spark.read.schema(self.SCHEMA).parquet(*[self._part(p) for p in parts]) if parts else self.spark.createDataFrame([], self.SCHEMA)

    def _save(self) -> None:
        write_secret(self.file, json.dumps(self.state, indent=1, sort_keys=True).encode())

    def mint(self, values: DataFrame, t: Tokens) -> DataFrame:
        """Tokens of all of ``values`` (one column ``value``), new ones added to the vault."""
        state = self.state.setdefault(t.column, {"issued": 0, "key": secrets.token_hex(32), "parts": []})
        new = cut(values.select("value").distinct().join(self.known(t.column), "value", "left_anti").withColumn("id", F.monotonically_increasing_id()))
        counts = {r[0]: r[1] for r in new.groupBy(F.shiftright("id", 33).alias("p")).count().collect()}  # one row per partition
        total = sum(counts.values())
        if total:
            if state["issued"] + total > t.space // 10 * 9:
                raise RunError("TOKEN_SPACE_EXHAUSTED", "the tokens of a column are nearly used up", t.column)
            offset, run = {}, state["issued"]
            for p in sorted(counts):
                offset[p], run = run, run + counts[p]
            starts = F.create_map(*[F.lit(x) for kv in offset.items() for x in kv])
            number = F.element_at(starts, F.shiftright("id", 33)) + F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
            numbered = new.select("value", number.cast("string").alias("n"))
            width, space, key = max(6, min(t.digits, 18)), t.space, bytes.fromhex(state["key"])

            def permuted(ns: list[str]) -> list[str]:
                todo = dict.fromkeys(ns)
                at = {n: int(n) for n in todo}
                while at:
                    for n, x in zip(list(at), crypto.ff1(list(at.values()), width, t.column.encode(), key)):
                        if x < space:
                            todo[n] = f"{t.prefix}{x:0{t.digits}d}"
                            del at[n]
                        else:
                            at[n] = x
                return [todo[n] for n in ns]

            part = f"vault-{uuid.uuid4().hex}"
            if self.shared:
                part = f"{self.shared}/{part}"
            numbered.select("value", per_value(permuted, t.column)("n").alias("token")).write.parquet(self._part(part))
            state["issued"] = run
            state["parts"].append(part)
        self._save()
        return self.known(t.column)


def tokenise(df: DataFrame, t: Tokens, vault: Vault) -> DataFrame:
    """The column's values as tokens; a hot value is one row of the vault, split by adaptive joins."""
    value = F.when(~missing(F.col(t.column)), identifier(F.col(t.column)))
    keyed = df.withColumn("__value", value)
    table = vault.mint(keyed.select(F.col("__value").alias("value")).filter("value IS NOT NULL"), t)
    joined = keyed.join(table.select(F.col("value").alias("__value"), F.col("token").alias("__token")), "__value", "left")
    return joined.withColumn(t.column, F.coalesce("__token", t.column)).select(*df.columns)


def detokenise(df: DataFrame, column: str, vault: Vault) -> tuple[DataFrame, DataFrame]:
    """Tokens back to values, and a one-row count of what could not be resolved."""
    table = vault.known(column).select(F.col("token").alias("__token"), F.col("value").alias("__value"))
    joined = df.join(table, F.trim(F.col(column)) == F.col("__token"), "left")
    unresolved = joined.agg(F.count_if(F.col("__value").isNull() & (F.trim(F.coalesce(F.col(column), F.lit(""))) != "")).alias("unresolved"))
    return joined.withColumn(column, F.coalesce("__value", column)).select(*df.columns), unresolved


@dataclass(frozen=True)
class Encryption:
    column: str
    format_preserving: bool = False


def encrypt_column(c: Column, e: Encryption, master: str, context: str | None = None) -> Column:
    if e.format_preserving:
        f = lambda vs: crypto.format_values(vs, master, e.column, True, context or crypto.FORMAT_CONTEXT)
    else:
        f = lambda vs: crypto.encrypt_values(vs, master, e.column, context or crypto.ENCRYPT_CONTEXT)
    return per_value(_skipping(f), e.column)(c)


def decrypt_column(c: Column, e: Encryption, master: str, context: str | None = None) -> Column:
    if e.format_preserving:
        f = lambda vs: crypto.format_values(vs, master, e.column, False, context or crypto.FORMAT_CONTEXT)
    else:
        f = lambda vs: crypto.decrypt_values(vs, master, e.column, context or crypto.ENCRYPT_CONTEXT)
    return per_value(_skipping(f), e.column)(c)


def _skipping(f):
    """Nulls stay null and are not handed to ``f``."""

    def run(values: list[str | None]) -> list[str | None]:
        there = [v for v in values if v is not None]
        got = iter(f(there))
        return [None if v is None else next(got) for v in values]

    return run


def mask_column(c: Column, m: mask.Mask) -> Column:
    if m.built_in:
        return mask.masked_column(c, m)
    if m.class_mode == "random_class":
        @arrow_udf("string")
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for a in batches:
                yield pa.array([None if v is None else mask.masked(v, m) for v in a.to_pylist()], pa.string())

        return run.asNondeterministic()(c)
    return per_value(_skipping(lambda vs: [mask.masked(v, m) for v in vs]), m.column)(c)


@dataclass
class Techniques:
    """The techniques of one run, by kind."""

    suppress: Sequence[str] = ()
    hashing: Sequence[str] = ()
    masks: Sequence[mask.Mask] = ()
    cloak: Sequence[str] = ()
    tokens: Sequence[Tokens] = ()
    encrypt: Sequence[Encryption] = ()
    shared_salts: bool = False
    contexts: Mapping[str, str] = field(default_factory=dict)

    def named(self) -> list[tuple[str, str]]:
        return [
            *(("hashing_with_salt", c) for c in self.hashing), *(("masking", m.column) for m in self.masks), *(("charcloak", c) for c in self.cloak),
            *(("tokenization", t.column) for t in self.tokens), *(("encrypt", e.column) for e in self.encrypt),
        ]


def counters(df: DataFrame, t: Techniques) -> dict[str, int]:
    """``technique:column`` → cells it transforms (rows, for suppression); one aggregation."""
    named = t.named()
    row = df.agg(F.count("*").alias("n"), *[F.count_if(~missing(F.col(c))).alias(f"x{i}") for i, (_, c) in enumerate(named)]).first()
    return {f"suppress:{c}": row["n"] for c in t.suppress} | {f"{k}:{c}": row[f"x{i}"] for i, (k, c) in enumerate(named)}


def apply(df: DataFrame, t: Techniques, keys: KeyFolder, vault: Vault | None = None) -> DataFrame:
    """``df`` with all techniques, suppressed columns gone, the order of columns kept."""
    for kind, c in [*(("suppress", c) for c in t.suppress), *t.named()]:
        if c not in df.columns or (kind != "suppress" and c in t.suppress):
            raise RunError("PREPROCESS_COLUMN_MISSING", "a technique names a column that is not there", f"{kind}: {c}")
    out = df.drop(*t.suppress)
    if t.cloak or t.encrypt or any(not m.built_in for m in t.masks):
        out = spread(out)  # what Python workers do is worth all cores
    held = lambda c, new: F.when(missing(F.col(c)), F.col(c)).otherwise(new)
    for c in t.hashing:
        out = out.withColumn(c, held(c, keyed_hash(identifier(F.col(c)), keys.salt(c, t.shared_salts), c)))
    for m in t.masks:
        out = out.withColumn(m.column, held(m.column, mask_column(F.col(m.column), m)))
    for c in t.cloak:
        out = out.withColumn(c, held(c, cloak_column(F.col(c), c)))
    if t.cloak or any(m.class_mode == "random_class" for m in t.masks):
        out = cut(out)
    for x in t.tokens:
        if vault is None:
            raise RunError("PREPROCESS_CONFIG_INVALID", "tokens need a key folder", x.column)
        out = tokenise(out, x, vault)
    for e in t.encrypt:
        # only cells with a value reach the worker
        value = F.when(~missing(F.col(e.column)), identifier(F.col(e.column)))
        out = out.withColumn(e.column, F.coalesce(encrypt_column(value, e, keys.key(e.column), t.contexts.get("format" if e.format_preserving else "encrypt")), F.col(e.column)))
    return out
