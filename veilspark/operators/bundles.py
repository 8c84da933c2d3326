"""De-identification of FHIR bundles: path rules by resource, code rules, pseudonymous ids, propagation.

One bundle is one patient and one row; it is walked in an Arrow batch with the policy.
Salts are made on the driver, one per hashing rule, so every task hashes alike.
"""
from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from urllib.parse import unquote_to_bytes

import pyarrow as pa
from pyspark.sql import DataFrame

from veilspark.functions.keys import KeyFolder, salt_key
from veilspark.operators.documents import CENSUS, GONE, SUMS, Keys, act, census_array, census_row, dump_json, load_json, pieces, show, sums_array, text_array
from veilspark.operators.policy import DEFAULT, RANK, Action, Policy, Rule, ascii_lower, parse_policy, texts
from veilspark.operators.techniques import hash_value
from veilspark.plans.errors import RunError

ID_COLUMN = "fhir:id"
ABSENT = "http://hl7.org/fhir/StructureDefinition/data-absent-reason"
# Words too common to identify a person.
COMMON_WORDS = frozenset(
    "shri smt kumari baby master late name unknown illegible patient hospital hospitals medical college centre center research private limited government india general institute institution "
    "multispeciality multispecialty speciality specialty super heart care clinic health nursing home trust memorial district state city road nagar main near opposite post village ward block "
    "sciences science national authority scheme diagnostic diagnostics laboratory pathology eye kidney cancer children mother child womens women with from and the".split()
)


@dataclass
class BundlePolicy:
    paths: Policy
    codes: Policy = field(default_factory=lambda: Policy([], "keep"))
    codings: dict[str, Action] = field(default_factory=dict)
    sources: list[Policy] = field(default_factory=list)
    propagate: bool = True
    min_length: int = 6
    strip_prefixes: tuple[str, ...] = ()


def code_form(s: str) -> str:
    """Lower-case letters and digits, anything else as one underscore; ``*`` stays."""
    return re.sub(r"_+", "_", "".join(c if c.isalnum() or c == "*" else "_" for c in s.strip().lower())).strip("_")


def compact(s: str) -> str:
    return "".join(c for c in s if c.isalnum()).lower()


def parse_bundle_policy(section: Mapping) -> BundlePolicy:
    paths = parse_policy(section)
    if bad := [r.pattern for r in paths.rules if r.action.kind in ("tokenization", "encrypt")]:
        raise RunError("CONFIG_INVALID_VALUE", "bundles take neither tokens nor encryption", bad[0])
    out = BundlePolicy(paths)
    block = section.get("code_rules") or {}
    if not isinstance(block, Mapping):
        raise RunError("CONFIG_INVALID_VALUE", "code_rules must be an object of lists")
    rules = []
    for kind in block:
        if kind not in ("keep", "suppress", "hashing_with_salt", "free_text"):
            raise RunError("CONFIG_INVALID_VALUE", "unknown code_rules technique", str(kind))
        for entry in texts(block, kind):
            if "|" in entry:
                out.codings.setdefault(ascii_lower(entry.strip()), Action(kind))
            else:
                rules.append(Rule(code_form(entry), Action(kind)))
    out.codes = Policy(rules, "keep")
    spread = section.get("propagation") or {}
    out.propagate = bool(spread.get("enabled", True))
    least = spread.get("min_length", 6)
    if not isinstance(least, int) or least < 3:
        raise RunError("CONFIG_INVALID_VALUE", "propagation.min_length is a whole number of at least 3")
    out.min_length = least
    out.sources = [Policy([Rule(p, Action("suppress"))], "keep") for p in texts(spread, "from")]
    out.strip_prefixes = tuple(ascii_lower(p) for p in texts(section, "hash_strip_prefixes"))
    return out


def pseudo_id(key: bytes, identity: str) -> str:
    """A UUID-shaped pseudonym of a resource id."""
    x = hash_value(key, "fhir-id\0" + identity)
    return f"{x[:8]}-{x[8:12]}-5{x[13:16]}-{'89ab'[int(x[16], 16) % 4]}{x[17:20]}-{x[20:32]}"


def target(reference: str) -> str | None:
    """The id a relative or UUID reference points to."""
    if reference.startswith("urn:uuid:"):
        return reference[9:]
    if ":" in reference or reference.startswith("#"):
        return None
    parts = reference.split("/")
    return parts[1] if len(parts) > 1 and parts[0][:1].isascii() and parts[0][:1].isupper() else None


def moved(key: bytes, reference: str) -> str | None:
    if reference.startswith("#"):
        return reference
    if reference.startswith("urn:uuid:"):
        return "urn:uuid:" + pseudo_id(key, reference[9:])
    t = target(reference)
    return None if t is None else f"{reference.split('/')[0]}/{pseudo_id(key, t)}"


def _words(s: str) -> list[str]:
    return [w.lower() for w in re.findall(r"[^\W\d_]+", s)]


class Needles:
    """What identifies the patient: a released text that holds one is suppressed."""

    def __init__(self, least: int):
        self.least, self.whole, self.digits, self.words = least, [], [], {}

    def add(self, value: str, source: str) -> None:
        c = compact(value)
        if len(c) >= self.least:
            self.whole.append((c, source))
        self.digits += [(r, source) for r in re.findall(r"[0-9]{6,}", value)]
        if not any(ch in "0123456789" for ch in value):
            for w in _words(value):
                if len(w) >= 4 and w not in COMMON_WORDS:
                    self.words.setdefault(w, source)

    def hit(self, text: str) -> str | None:
        decoded = unquote_to_bytes(text.replace("+", " ")).decode("utf-8", "replace")
        c = compact(decoded)
        for n, source in self.whole:
            if n in c:
                return source
        runs = re.findall(r"[0-9]+", decoded)
        for n, source in self.digits:
            if any(n in r for r in runs):
                return source
        found = set(_words(decoded))
        return next((s for w, s in self.words.items() if w in found), None)


def resources(v) -> Iterator[dict]:
    if isinstance(v, dict):
        if isinstance(v.get("resourceType"), str):
            yield v
        for x in v.values():
            yield from resources(x)
    elif isinstance(v, list):
        for x in v:
            yield from resources(x)


def _leaves(v, path: list[str], shown: list[str]) -> Iterator[tuple[list[str], list[str], object]]:
    """Leaves of one resource, not of resources inside it."""
    if isinstance(v, dict):
        kind = v.get("resourceType")
        if isinstance(kind, str):
            if path:
                return
            path, shown = [kind.lower()], [kind]
        for k, x in v.items():
            if k != "resourceType":
                yield from _leaves(x, [*path, k.lower()], [*shown, k])
    elif isinstance(v, list):
        for x in v:
            yield from _leaves(x, [*path, "[]"], [*shown, "[]"])
    else:
        yield path, shown, v


def _codes(res: dict) -> tuple[list[str], list[str]]:
    code = res.get("code") if isinstance(res.get("code"), dict) else {}
    codings = [c for c in (code.get("coding") or []) if isinstance(c, dict)] if isinstance(code.get("coding"), list) else []
    names = [code.get("text"), *(c.get("display") for c in codings)]
    keys = [ascii_lower(f"{c['system']}|{c['code']}") for c in codings if isinstance(c.get("system"), str) and isinstance(c.get("code"), str)]
    return [f for n in names if isinstance(n, str) and (f := code_form(n))], keys


def code_action(policy: BundlePolicy, res: dict) -> tuple[Action, str] | None:
    """The most protective action that the names and codes of an Observation ask for."""
    names, keys = _codes(res)
    asked = [(a, f"code:{by}") for n in names for a, by in [policy.codes.decide((n,))] if by != DEFAULT]
    asked += [(policy.codings[k], f"coding:{k}") for k in keys if k in policy.codings]
    return max(asked, key=lambda x: RANK[x[0].kind], default=None)


class Walk:
    """One bundle."""

    def __init__(self, policy: BundlePolicy, salts: dict[str, bytes]):
        self.policy, self.salts, self.census = policy, salts, []
        self.dropped: set[str] = set()
        self.dropped_places: set[int] = set()
        self.needles = Needles(policy.min_length)
        self.override: tuple[Action, str] | None = None

    def note(self, path, value, action: str, by: str, sample: bool = False) -> None:
        self.census.append(census_row(path, value, action, by, sample))

    def run(self, bundle):
        for res in resources(bundle):
            if res["resourceType"] == "Observation" and (found := code_action(self.policy, res)) and found[0].kind == "suppress":
                names, _ = _codes(res)
                self.note(f"Observation[code={names[0] if names else ''}]", None, "drop_resource", found[1])
                self.dropped_places.add(id(res))  # also without an id
                if isinstance(res.get("id"), str):
                    self.dropped.add(res["id"])
        if self.policy.propagate and self.policy.sources:
            for res in resources(bundle):
                for path, shown, leaf in _leaves(res, [], []):
                    if isinstance(leaf, str) and any(s.decide(path)[1] != DEFAULT for s in self.policy.sources):
                        self.needles.add(str(leaf), show(shown))
        kept = self.value(bundle, [], [])
        return None if kept is GONE else kept

    def value(self, v, path: list[str], shown: list[str]):
        if isinstance(v, dict):
            return self.object(v, path, shown)
        if isinstance(v, list):
            kept = [k for x in v if (k := self.value(x, [*path, "[]"], [*shown, "[]"])) is not GONE]
            return kept or GONE
        return self.leaf(v, path, shown)

    def object(self, v: dict, path: list[str], shown: list[str]):
        if isinstance(v.get("resourceType"), str):
            return self.resource(v)
        if v.get("url") == ABSENT:
            return v
        reference = v.get("reference")
        if isinstance(reference, str) and target(reference) in self.dropped and target(reference) is not None:
            self.note(shown, None, "drop_reference", "<dropped resource>")
            return GONE
        out = {}
        for k, x in v.items():
            if k in ("reference", "fullUrl") and isinstance(x, str):
                new = moved(self.salts[ID_COLUMN], x)
                if new is None:
                    self.note([*shown, k], x, "suppress", "<unresolvable reference>")
                else:
                    self.note([*shown, k], x, "pseudonymise_reference", "<structural>")
                    out[k] = new
                continue
            kept = self.value(x, [*path, k.lower()], [*shown, k])
            if kept is not GONE:
                out[k] = kept
            elif isinstance(x, dict) and isinstance(x.get("resourceType"), str):
                return GONE  # an entry goes with its resource
        return self.tidy(v, out, path)

    def resource(self, v: dict):
        kind = v["resourceType"]
        if id(v) in self.dropped_places or (isinstance(v.get("id"), str) and v["id"] in self.dropped):
            return GONE
        before, self.override = self.override, code_action(self.policy, v) if kind == "Observation" else None
        out = {"resourceType": kind}
        for k, x in v.items():
            if k == "id" and isinstance(x, str):
                self.note(f"{kind}.id", x, "pseudonymise_id", "<structural>")
                out["id"] = pseudo_id(self.salts[ID_COLUMN], x)
            elif k != "resourceType" and (kept := self.value(x, [kind.lower(), k.lower()], [kind, k])) is not GONE:
                out[k] = kept
        self.override = before
        return self.tidy(v, out, [kind.lower()])

    @staticmethod
    def tidy(original: dict, out: dict, path: list[str]):
        """``_x`` goes with ``x``, a narrative without its text goes, nothing empty stays."""
        for k in original:
            if not k.startswith("_") and k not in out:
                out.pop(f"_{k}", None)
        if path and path[-1] == "text" and "status" in out and "div" not in out:
            return GONE
        return out or GONE

    def leaf(self, v, path: list[str], shown: list[str]):
        if self.override and self.override[0].kind == "hashing_with_salt" and len(path) > 1 and path[1].startswith("value"):
            action, by = self.override
        else:
            action, by = self.policy.paths.decide(path)
        if action.kind == "hashing_with_salt":
            text = str(v) if isinstance(v, str) else ""
            out = hash_value(self.salts[by], self.canonical(text)) if text.strip() else v
        else:
            out = act(action, v, by, Keys())
        if action.kind in ("keep", "free_text") and self.policy.propagate and type(v) is str and (source := self.needles.hit(v)):
            self.note(shown, v, "suppress", f"propagated:{source}")
            return GONE
        self.note(shown, v, action.kind, by, action.kind == "keep")
        return out

    def canonical(self, text: str) -> str:
        t = text.strip()
        for p in self.policy.strip_prefixes:
            if ascii_lower(t).startswith(p):
                t = t[len(p) :]
                break
        return compact(t)


def hash_columns(policy: BundlePolicy) -> list[str]:
    """Every name a salt is needed for."""
    out = [ID_COLUMN, *(r.pattern for r in policy.paths.rules if r.action.kind == "hashing_with_salt")]
    out += [f"code:{r.pattern}" for r in policy.codes.rules if r.action.kind == "hashing_with_salt"]
    return out + [f"coding:{k}" for k, a in policy.codings.items() if a.kind == "hashing_with_salt"]


def anonymise_bundles(docs: DataFrame, policy: BundlePolicy, keys: KeyFolder, summed: bool = False) -> DataFrame:
    """``(file_name, document, census)`` of bundles (file_name, doc); document is null where it is no bundle. ``summed``: as in ``documents.anonymise``."""
    salts = {c: salt_key(keys.salt(c, True), c) for c in hash_columns(policy)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            outs, rows = [], []
            for text in b.column(1).to_pylist():
                out, census = None, []
                try:
                    bundle = load_json(text or "")
                    if isinstance(bundle, dict) and bundle.get("resourceType") == "Bundle":
                        w = Walk(policy, salts)
                        out, census = dump_json(w.run(bundle)), w.census
                except (ValueError, RecursionError):  # no JSON, or nested deeper than documents may be (some hundred levels)
                    pass
                outs.append(out), rows.append(census)
            yield pa.RecordBatch.from_arrays([b.column(0), text_array(outs), sums_array(b.column(0).to_pylist(), rows) if summed else census_array(rows)], names=["file_name", "document", "census"])

    return docs.select("file_name", "doc").mapInArrow(run, f"file_name string, document string, census {SUMS if summed else CENSUS}")
