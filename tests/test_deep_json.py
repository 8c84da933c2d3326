"""The parser with a stack against the standard one."""
import json
import random

import pytest

from veilspark.functions import deep_json as dj


def make(rng, depth):
    if depth == 0 or rng.random() < 0.3:
        return rng.choice([None, True, False, 0, -7, 2.5, 1e30, "", 'a"b\\c\n', "é "])
    if rng.random() < 0.5:
        return [make(rng, depth - 1) for _ in range(rng.randrange(4))]
    return {rng.choice("abcd") * rng.randrange(3): make(rng, depth - 1) for _ in range(rng.randrange(4))}


def test_same_as_the_standard_parser():
    rng = random.Random(3)
    for _ in range(300):
        text = json.dumps(make(rng, 5), indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5)
        assert dj._by_stack(text, None) == json.loads(text)
        cut = text[: rng.randrange(len(text) + 1)] + rng.choice(["", ",", "}", "]", ":", " x"])
        try:
            want = json.loads(cut)
        except ValueError:
            with pytest.raises(ValueError):
                dj._by_stack(cut, None)
        else:
            assert dj._by_stack(cut, None) == want


def test_depth_numbers_and_surrogates():
    v, n = dj.loads("[" * 50_000 + "1" + "]" * 50_000, str), 0
    while isinstance(v, list):
        v, n = v[0], n + 1
    assert (v, n) == ("1", 50_000)
    for bad in ("NaN", "[" * 50_000, "", "1 2", '{"a" 1}'):
        with pytest.raises(ValueError):
            dj.loads(bad)
    assert dj.loads('{"a": 1.50}', str) == {"a": "1.50"}
    assert dj.well_formed("a\ud83db") == "a�b"
