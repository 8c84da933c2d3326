"""Path rules for nested documents: glob patterns with actions, the most specific one wins."""
from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

from veilspark.functions import mask
from veilspark.plans.errors import RunError

# How protective an action is; the higher wins between equally specific rules.
RANK = {"suppress": 8, "masking": 7, "filename": 7, "charcloak": 6, "hashing_with_salt": 5, "tokenization": 4, "encrypt": 3, "keep": 1, "free_text": 1}
DEFAULT = "<default>"


@dataclass(frozen=True)
class Action:
    kind: str
    mask: mask.Mask | None = None
    prefix: str = "TK-"
    digits: int = 6
    format_preserving: bool = False


def segments(pattern: str) -> tuple[str, ...]:
    """``a.b[].**`` in parts; ``name[]`` and ``name.[]`` are the same."""
    return tuple(s if s == "**" else ascii_lower(s) for s in re.sub(r"\.?\[\]", ".[]", pattern).lstrip(".").split("."))


def ascii_lower(s: str) -> str:
    return s.lower() if s.isascii() else "".join(c.lower() if c.isascii() else c for c in s)


@dataclass(frozen=True)
class Rule:
    pattern: str
    action: Action
    parts: tuple[str, ...] = field(init=False)
    expression: re.Pattern = field(init=False, compare=False)
    weight: tuple = field(init=False)

    def __post_init__(self):
        parts = segments(self.pattern)
        object.__setattr__(self, "parts", parts)
        # a path is its segments, each closed by a line feed-free separator
        one = lambda s: "(?:[^\x1f]*\x1f)*" if s == "**" else re.escape(s).replace(r"\*", "[^\x1f]*") + "\x1f"
        object.__setattr__(self, "expression", re.compile("".join(map(one, parts)) + r"\Z", re.S))
        plain = [p for p in parts if p != "**"]
        stars = sum(p.count("*") for p in plain)
        object.__setattr__(self, "weight", (-(len(parts) - len(plain)), -stars, sum(map(len, plain)) - stars, len(parts), RANK[self.action.kind]))

    def matches(self, path: Sequence[str]) -> bool:
        return self.expression.match("".join(s.replace("\x1f", " ") + "\x1f" for s in path)) is not None


class Policy:
    """Rules and the action of paths that none names."""

    def __init__(self, rules: Sequence[Rule], default: str = "suppress"):
        self.rules, self.default = list(rules), Action(default)
        self._decide = lru_cache(maxsize=50_000)(self._decided)

    def __getstate__(self):
        return {"rules": self.rules, "default": self.default}

    def __setstate__(self, state):
        self.rules, self.default = state["rules"], state["default"]
        self._decide = lru_cache(maxsize=50_000)(self._decided)

    def _best(self, path: tuple[str, ...]) -> Rule | None:
        return max((r for r in self.rules if r.matches(path)), key=lambda r: r.weight, default=None)

    def _decided(self, path: tuple[str, ...]) -> tuple[Action, str]:
        bare = path
        while bare and bare[-1] == "[]":
            bare = bare[:-1]
        for p in dict.fromkeys((path, bare)):
            if (best := self._best(p)) is not None:
                return best.action, best.pattern
        return self.default, DEFAULT

    def decide(self, path: Sequence[str]) -> tuple[Action, str]:
        """Action and pattern for a path of lower-case segments; trailing ``[]`` may be left out of a rule."""
        return self._decide(tuple(path))


def texts(section: Mapping, key: str) -> list[str]:
    value = section.get(key)
    if value is None:
        return []
    if not isinstance(value, list) or any(not isinstance(v, str) or not v.strip() for v in value):
        raise RunError("CONFIG_INVALID_VALUE", f"{key} must be an array of non-empty strings")
    return value


def objects(section: Mapping, key: str) -> list[Mapping]:
    value = section.get(key)
    if value is None:
        return []
    if not isinstance(value, list) or any(not isinstance(v, Mapping) for v in value):
        raise RunError("CONFIG_INVALID_VALUE", f"{key} must be an array of objects")
    return value


def parse_policy(section: Mapping) -> Policy:
    """The rules of a document section; what documents cannot do is refused."""
    for key in ("hashing_without_salt", "fpe"):
        if section.get(key):
            raise RunError("CONFIG_INVALID_VALUE", f"{key} is not applied to nested documents")
    if section.get("size"):
        raise RunError("CONFIG_INVALID_VALUE", "size is not applied to nested documents")
    if any(isinstance(c, Mapping) and "precision" in c for c in (section.get("qi_constraints") or {}).values()):
        raise RunError("CONFIG_INVALID_VALUE", "precision is not applied to nested documents")
    rules = [Rule(p, Action(k)) for k in ("keep", "suppress", "hashing_with_salt", "free_text", "charcloak", "filename") for p in texts(section, k)]
    for e in objects(section, "masking"):
        m = mask.parse(e)
        rules.append(Rule(m.column, Action("masking", mask=m)))
    for e in objects(section, "tokenization"):
        rules.append(Rule(_column(e), Action("tokenization", prefix=str(e.get("prefix", "TK-")), digits=int(e.get("digits", 6)))))
    for e in objects(section, "encrypt"):
        rules.append(Rule(_column(e), Action("encrypt", format_preserving=bool(e.get("format_preserving", False)))))
    default = section.get("default_action", "suppress")
    if default not in ("suppress", "keep"):
        raise RunError("CONFIG_INVALID_VALUE", "default_action is suppress or keep", str(default))
    if not rules and default == "suppress":
        raise RunError("CONFIG_INVALID_VALUE", "this policy would suppress every field")
    return Policy(rules, default)


def _column(entry: Mapping) -> str:
    c = entry.get("column")
    if not isinstance(c, str) or not c.strip():
        raise RunError("PREPROCESS_CONFIG_INVALID", "an entry needs a column")
    return c
