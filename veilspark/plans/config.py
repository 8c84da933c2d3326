"""The configuration of a run: strict, so a misspelt key never publishes a column in clear."""
from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path

from veilspark.functions import mask
from veilspark.operators import qi
from veilspark.operators.anonymise import Diversity
from veilspark.operators.policy import objects, texts
from veilspark.operators.sheets import Join, parse_joins
from veilspark.operators.techniques import Encryption, Techniques, Tokens
from veilspark.plans.errors import RunError
from veilspark.sources import postgres

# The keys of a section.
KEYS = frozenset(
    "output_path output_directory key_directory pass clean_output compute_parameter_grid flow_mode generalization_node "
    "k_anonymize suppression_limit quasi_identifiers categorical_hierarchies size qi_constraints fixed_bins l_diversity "
    "suppress hashing_with_salt hashing_without_salt shared_hash_salts masking encrypt charcloak tokenization key_contexts "
    "sheet_joins restore_sheets free_text_anonymization input output_sink "
    "nested_json fhir_bundle input_path dry_run default_action keep free_text filename code_rules propagation hash_strip_prefixes "
    "insensitive_columns max_classes fpe".split()
)


def invalid(message: str, details: str = "") -> RunError:
    return RunError("CONFIG_INVALID_VALUE", message, details)


@dataclass
class Config:
    """A parsed section."""

    section: Mapping
    data_type: str
    run_pass: str = "no_bounds"
    k: int = 0
    sigma: float = 0.0
    qis: list[qi.QI] = field(default_factory=list)
    diversity: Diversity | None = None
    techniques: Techniques = field(default_factory=Techniques)
    flow: str = "auto"
    grid: bool = True
    node: dict[str, int] | None = None
    joins: list[Join] = field(default_factory=list)
    restore: bool = False
    staged_input: str | None = None
    source: postgres.Read | None = None
    sink: postgres.Write | None = None
    documents: str | None = None  # nested_json or fhir_bundle
    output_path: str = "generalized.csv"
    key_directory: str | None = None
    clean: bool = False
    max_classes: int = 10_000_000
    warnings: list[str] = field(default_factory=list)


def find(path: str | Path) -> Path:
    """A file, or the first ``*.json`` of a folder."""
    p = Path(path)
    if p.is_dir():
        found = sorted(p.glob("*.json"))
        if found:
            return found[0]
    if not p.is_file():
        raise RunError("CONFIG_NOT_FOUND", "there is no configuration", str(p))
    return p


def load(path: str | Path) -> Config:
    p = find(path)
    try:
        raw = json.loads(p.read_text(encoding="utf-8"))
    except (ValueError, UnicodeDecodeError) as e:
        raise RunError("CONFIG_PARSE_ERROR", "the configuration is not JSON", str(e)) from None
    return parse(raw)


def _int(v, least: int, name: str) -> int:
    if isinstance(v, bool) or not isinstance(v, (int, float)) or v != int(v) or v < least:
        raise invalid(f"{name} must be a whole number of at least {least}", repr(v))
    return int(v)


def _object(section: Mapping, key: str) -> Mapping:
    v = section.get(key) or {}
    if not isinstance(v, Mapping):
        raise invalid(f"{key} must be an object")
    return v


def _intervals(entries, name: str) -> list[tuple[int, int]]:
    out = []
    for e in entries if isinstance(entries, list) else [entries]:
        if not isinstance(e, Mapping) or any(isinstance(e.get(x), bool) or not isinstance(e.get(x), int) for x in ("from", "to")):
            raise invalid("an interval needs whole numbers 'from' and 'to'", name)
        out.append((e["from"], e["to"]))
    if not out:
        raise invalid("intervals are empty", name)
    return out


def _ladders(section: Mapping) -> dict[str, dict[str, list[str]]]:
    import unicodedata

    out: dict[str, dict[str, list[str]]] = {}
    for column, rows in _object(section, "categorical_hierarchies").items():
        if column.lower() in {c.lower() for c in out}:
            raise invalid("a hierarchy is given twice", column)
        if not isinstance(rows, Mapping):
            raise invalid("a hierarchy is an object of values and labels", column)
        ladder: dict[str, list[str]] = {}
        for leaf, labels in rows.items():
            key = unicodedata.normalize("NFC", leaf.strip())
            if key in ladder or not isinstance(labels, list) or any(not isinstance(x, str) for x in labels):
                raise invalid("a value is given twice or its labels are no texts", f"{column}: {leaf}")
            ladder[key] = labels
        out[column] = ladder
    return out


def _qis(section: Mapping, warnings: list[str]) -> list[qi.QI]:
    block = _object(section, "quasi_identifiers")
    sizes = {c: _int(v, 1, f"size.{c}") for c, v in _object(section, "size").items()}
    limits, bins, ladders = _object(section, "qi_constraints"), _object(section, "fixed_bins"), _ladders(section)
    out = []
    for e in objects(block, "numerical"):
        c = e.get("column")
        if not isinstance(c, str) or not c:
            raise invalid("a numerical quasi-identifier needs a column")
        if old := [k for k in ("scale", "s", "encode", "type") if k in e]:
            warnings.append(f"{c}: {', '.join(old)} no longer have a meaning")
        if c in bins:
            out.append(qi.fixed(c, _intervals(bins[c], c)))
        elif isinstance(limits.get(c), Mapping) and limits[c].get("intervals"):
            out.append(qi.interval(c, _intervals(limits[c]["intervals"], c), sizes.get(c, 2)))
        else:
            out.append(qi.uniform(c, sizes.get(c, 2)))
    for e in block.get("categorical") or []:
        c = e if isinstance(e, str) else e.get("column") if isinstance(e, Mapping) else None
        if not isinstance(c, str) or not c:
            raise invalid("a categorical quasi-identifier needs a column")
        out.append(qi.categorical(c, ladders))
    names = [q.name for q in out]
    if twice := [n for n in names if names.count(n) > 1]:
        raise invalid("a quasi-identifier is named twice", twice[0])
    return out


def _techniques(section: Mapping) -> Techniques:
    def column(e: Mapping, key: str) -> str:
        if not isinstance(e.get("column"), str) or not e["column"]:
            raise RunError("PREPROCESS_CONFIG_INVALID", f"an entry of {key} needs a column")
        return e["column"]

    for key in ("hashing_without_salt", "fpe"):
        if section.get(key):
            raise invalid(f"{key} is not supported; use hashing_with_salt or encrypt")
    tokens = []
    for e in objects(section, "tokenization"):
        tokens.append(Tokens(column(e, "tokenization"), str(e.get("prefix", "TK-")), _int(e.get("digits", 6), 1, "digits")))
    encrypt = []
    for e in section.get("encrypt") or []:
        entry = {"column": e} if isinstance(e, str) else e
        if not isinstance(entry, Mapping):
            raise invalid("encrypt takes columns or objects")
        encrypt.append(Encryption(column(entry, "encrypt"), bool(entry.get("format_preserving", False))))
    return Techniques(
        suppress=texts(section, "suppress"), hashing=texts(section, "hashing_with_salt"), masks=[mask.parse(e) for e in objects(section, "masking")], cloak=texts(section, "charcloak"),
        tokens=tokens, encrypt=encrypt, shared_salts=bool(section.get("shared_hash_salts", False)), contexts=dict(_object(section, "key_contexts")),
    )


def parse(raw) -> Config:
    """``{"data_type": name, name: section}`` as a :class:`Config`."""
    if not isinstance(raw, Mapping) or not isinstance(raw.get("data_type"), str):
        raise RunError("CONFIG_MISSING_FIELD", "data_type is missing")
    name = raw["data_type"]
    section = raw.get(name)
    if section is None:
        raise RunError("CONFIG_MISSING_FIELD", "the section that data_type names is missing", name)
    if not isinstance(section, Mapping):
        raise RunError("CONFIG_INVALID", "the section must be an object", name)
    if unknown := [k for k in section if not k.startswith("_") and k not in KEYS]:
        raise RunError("CONFIG_UNKNOWN_KEY", "unknown configuration key", unknown[0])
    c = Config(section, name)
    c.output_path = section.get("output_path", c.output_path)
    c.key_directory = section.get("key_directory")
    c.clean = bool(section.get("clean_output", False))
    if "output_directory" in section:
        c.warnings.append("output_directory has no effect; the output folder is an argument of the run")
    c.source = postgres.parse_source(section)
    c.sink = postgres.parse_sink(section, c.source.connection if c.source else None)
    flows = [k for k in ("nested_json", "fhir_bundle") if section.get(k)]
    if len(flows) > 1:
        raise invalid("nested_json and fhir_bundle exclude each other")
    if flows:
        c.documents = flows[0]
        if not isinstance(section.get("input_path"), str) or not section["input_path"].strip():
            raise invalid(f"{flows[0]} needs input_path")
        return c
    c.run_pass = section.get("pass", "no_bounds")
    if c.run_pass not in ("pass1", "pass2", "no_bounds"):
        raise invalid("pass is pass1, pass2 or no_bounds", str(c.run_pass))
    sigma = section.get("suppression_limit", 0.0)
    if isinstance(sigma, bool) or not isinstance(sigma, (int, float)) or not 0 <= sigma <= 1:
        raise invalid("suppression_limit must lie in [0, 1]", repr(sigma))
    c.sigma = float(sigma)
    block = _object(section, "k_anonymize")
    if "k" in block:
        c.k = _int(block["k"], 1, "k")
    c.qis = _qis(section, c.warnings)
    if c.qis and c.run_pass != "pass1" and not c.k:
        raise RunError("CONFIG_MISSING_FIELD", "k_anonymize.k is missing")
    c.techniques = _techniques(section)
    if "l_diversity" in section:
        d = _object(section, "l_diversity")
        attributes = texts(d, "sensitive_attributes")
        l = _int(d.get("l", 1), 1, "l")
        if l > 1:
            if not attributes:
                raise invalid("l_diversity needs sensitive_attributes")
            if clash := [a for a in attributes if a in {q.name for q in c.qis} or a in c.techniques.suppress]:
                raise invalid("a sensitive attribute is a quasi-identifier or suppressed", clash[0])
            changed = {x for kind, x in c.techniques.named()}
            c.warnings += [f"{a}: a technique changes this sensitive attribute, and with it the diversity" for a in attributes if a in changed]
            c.diversity = Diversity(l, tuple(attributes))
    c.flow = str(section.get("flow_mode", "auto")).lower()
    if c.flow not in ("auto", "original", "direct"):
        raise invalid("flow_mode is auto, original or direct", c.flow)
    c.grid = bool(section.get("compute_parameter_grid", True))
    if section.get("generalization_node") is not None:
        c.node = {q: _int(v, 1, f"generalization_node.{q}") for q, v in _object(section, "generalization_node").items()}
    c.joins = parse_joins(section.get("sheet_joins") or [])
    c.restore = bool(section.get("restore_sheets", False))
    text = _object(section, "free_text_anonymization")
    if text.get("enabled"):
        if not isinstance(text.get("staged_input_path"), str):
            raise invalid("free_text_anonymization needs staged_input_path")
        c.staged_input = text["staged_input_path"]
    c.max_classes = _int(section.get("max_classes", c.max_classes), 1, "max_classes")
    return c
