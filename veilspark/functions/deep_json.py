"""Parsing JSON of any depth: the standard parser, and a stack where its recursion ends."""
from __future__ import annotations

import json
import re
from collections.abc import Callable
from json.decoder import scanstring

_SPACE = re.compile(r"[ \t\n\r]*")
_SCALAR = re.compile(r"true|false|null|(-?(?:0|[1-9]\d*))(\.\d+)?([eE][+-]?\d+)?")
_WORDS = {"true": True, "false": False, "null": None}
_SURROGATE = re.compile("[\ud800-\udfff]")


def well_formed(text: str) -> str:
    """The text with U+FFFD for halves of surrogate pairs, which no UTF-8 text can hold."""
    return _SURROGATE.sub("�", text)


def _refuse(name: str):
    raise ValueError(f"{name} is no JSON")


def loads(text: str, number: Callable[[str], object] | None = None):
    """One JSON value; ``number`` makes a number of its text. Anything else is a ``ValueError``."""
    try:
        return json.loads(text, parse_float=number, parse_int=number, parse_constant=_refuse)
    except RecursionError:
        return _by_stack(text, number)


def _by_stack(text: str, number: Callable[[str], object] | None):
    def skip(i: int) -> int:
        return _SPACE.match(text, i).end()

    def bad(i: int) -> ValueError:
        return json.JSONDecodeError("malformed", text, i)

    root: list = []
    open_: list[tuple[object, str | None]] = [(root, None)]  # containers, and the key that waits for its value
    i, value_next = skip(0), True
    while True:
        holder, key = open_[-1]
        c = text[i : i + 1]
        if value_next:
            if c in ("{", "["):
                made: object = {} if c == "{" else []
                holder.append(made) if isinstance(holder, list) else holder.__setitem__(key, made)
                i = skip(i + 1)
                if text[i : i + 1] == ("}" if c == "{" else "]"):
                    i, value_next = skip(i + 1), False
                    continue
                open_.append((made, None))
                if c == "{":
                    i = _key(text, i, skip, open_, bad)
                continue
            if c == '"':
                v, i = scanstring(text, i + 1, True)
            elif m := _SCALAR.match(text, i):
                i = m.end()
                if m.group(1) is None:
                    v = _WORDS[m.group()]
                else:
                    v = number(m.group()) if number else float(m.group()) if m.group(2) or m.group(3) else int(m.group())
            else:
                raise bad(i)
            holder.append(v) if isinstance(holder, list) else holder.__setitem__(key, v)
            i, value_next = skip(i), False
        elif holder is root:
            if i != len(text):
                raise bad(i)
            return root[0]
        elif c == ",":
            i = skip(i + 1)
            if isinstance(holder, dict):
                i = _key(text, i, skip, open_, bad)
            value_next = True
        elif c == ("}" if isinstance(holder, dict) else "]"):
            open_.pop()
            i = skip(i + 1)
        else:
            raise bad(i)


def _key(text: str, i: int, skip, open_: list, bad) -> int:
    """Read the key of an object and its colon."""
    if text[i : i + 1] != '"':
        raise bad(i)
    k, i = scanstring(text, i + 1, True)
    i = skip(i)
    if text[i : i + 1] != ":":
        raise bad(i)
    open_[-1] = (open_[-1][0], k)
    return skip(i + 1)
