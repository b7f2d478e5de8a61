"""The tolerant reader on objects made by a grammar and then damaged."""

import json
import random

import pytest

from groundwork.functions import tolerant_json
from groundwork.operators import parse

LETTERS = "ab c1é\n\"'\\{}[]:,"


def value(rng, depth):
    kind = rng.randrange(8 if depth else 5)
    if kind < 3:
        return "".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 6)))
    if kind < 5:
        return rng.choice([None, True, False, 0, -3, 2.5, 1e10])
    return {f"k{i}": value(rng, depth - 1) for i in range(rng.randint(0, 3))} if kind < 7 else [value(rng, depth - 1) for _ in range(rng.randint(0, 3))]


def some(seed):
    rng = random.Random(seed)
    return {f"k{i}": value(rng, 3) for i in range(rng.randint(1, 4))}


def single(v):
    """v with single quotes, bare keys and words as Python writes them."""
    if isinstance(v, dict):
        return "{" + ", ".join(f"{k}: {single(x)}" for k, x in v.items()) + ",}"
    if isinstance(v, list):
        return "[" + " , ".join(map(single, v)) + ",]"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(v)


def ends(v):
    """Characters of JSON text that only close what is open at its end."""
    text = json.dumps(v)
    return len(text) - len(text.rstrip("}]"))


@pytest.mark.parametrize("seed", range(300))
def test_damaged_objects_are_read(seed):
    v = some(seed)
    assert tolerant_json.read(json.dumps(v)) == v
    assert tolerant_json.read("So: " + json.dumps(v, ensure_ascii=False, indent=1) + " that is all") == v
    assert tolerant_json.read(single(v)) == v
    for cut in range(ends(v) + 1):
        assert tolerant_json.read(json.dumps(v)[: len(json.dumps(v)) - cut]) == v


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("", None), ("no object", None), ("{}", None), ("{", None), ('{"a": oops }', {"a": "oops"}), ('{"a": "unclosed', {"a": "unclosed"}), ('{"a" "b"}', {"a": "b"}), ('{"a": 1 "b": 2}', {"a": 1, "b": 2}), ('{"a":', {"a": None}),
        ('{"a": [1, 2}', {"a": [1, 2]}), ('{"a": 1]}', {"a": 1}), ("{a: TRUE, b: None}", {"a": True, "b": None}), ('{"a": "\\u00e9\\u12"}', {"a": "éu12"}), ("{{}}", None), ("{" * 5000 + "a", {"a": None}), ('{"a": ' * 3000, {"a": {}}),
    ],
)
def test_texts(text, want):
    got = tolerant_json.read(text)
    if len(text) > 10_000:
        assert isinstance(got, dict)
    else:
        assert got == want


def test_only_rejects_are_repaired(spark):
    contents = ['{"question": "fine"}', '{"question": \'single\', confidence: high', "none at all", '{"other": 1', None, '{"question": "a" "answer": "b"']
    parsed = parse.parse_responses(spark.createDataFrame([(i, c) for i, c in enumerate(contents)], "cand_id long, content string"))
    got = {r.cand_id: (r.repaired, r.error is None, r.parsed.question if r.parsed else None, r.parsed.confidence if r.parsed else None) for r in parse.repair_responses(parsed).collect()}
    assert got == {0: (False, True, "fine", None), 1: (True, True, "single", "high"), 2: (False, False, None, None), 3: (False, False, None, None), 4: (False, False, None, None), 5: (True, True, "a", None)}
    assert parse.repair_responses(parsed.where("cand_id > 9")).count() == 0


def test_an_object_too_deep_is_a_reject():
    assert tolerant_json.repaired('{"a": ' * 200_000) is None
    assert tolerant_json.repaired('{"a": "\\ud800"') == '{"a": "?"}'
