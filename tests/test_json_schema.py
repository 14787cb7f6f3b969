"""Compiled schemas against a plain validator written for the tests."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from jobtide.functions import json_schema
from jobtide.plans import extraction


def kind(v):
    if v is None:
        return "null"
    if isinstance(v, bool):
        return "boolean"
    if isinstance(v, (int, float)):
        return "integer" if float(v).is_integer() else "number"
    return {str: "string", list: "array", dict: "object"}[type(v)]


def same(a, b):
    return kind(a) == kind(b) and a == b


def plain(v, s, doc, path=()):
    if s is True or s == {}:
        return []
    if s is False:
        return [(path, "false")]
    if "$ref" in s:
        at = doc
        for p in s["$ref"][2:].split("/"):
            at = at[p]
        return plain(v, at, doc, path)
    out, k = [], kind(v)
    err = lambda bad, rule: out.append((path, rule)) if bad else None
    if "type" in s:
        names = [s["type"]] if isinstance(s["type"], str) else s["type"]
        err(not (k in names or k == "integer" and "number" in names), "type")
    if "enum" in s:
        err(not any(same(v, x) for x in s["enum"]), "enum")
    if "const" in s:
        err(not same(v, s["const"]), "const")
    if k == "string":
        err(len(v) < s.get("minLength", 0), "minLength")
        err(len(v) > s.get("maxLength", 10**9), "maxLength")
        err("pattern" in s and not re.search(s.get("pattern", ""), v), "pattern")
    if k in ("integer", "number"):
        err(v < s.get("minimum", v), "minimum")
        err(v > s.get("maximum", v), "maximum")
        err("exclusiveMinimum" in s and v <= s["exclusiveMinimum"], "exclusiveMinimum")
        err("exclusiveMaximum" in s and v >= s["exclusiveMaximum"], "exclusiveMaximum")
    if k == "object":
        for name in s.get("required", []):
            err(name not in v, "required")
        for name, sub in s.get("properties", {}).items():
            out += plain(v[name], sub, doc, (*path, name)) if name in v else []
        extra = sorted(set(v) - set(s.get("properties", {})))
        more = s.get("additionalProperties", True)
        if more is False:
            err(extra, "additionalProperties")
        else:
            for name in extra:
                out += plain(v[name], more, doc, (*path, name))
        err(len(v) < s.get("minProperties", 0), "minProperties")
        err(len(v) > s.get("maxProperties", 10**9), "maxProperties")
    if k == "array":
        for i, x in enumerate(v):
            out += plain(x, s.get("items", True), doc, (*path, i))
        err(len(v) < s.get("minItems", 0), "minItems")
        err(len(v) > s.get("maxItems", 10**9), "maxItems")
        err(s.get("uniqueItems") and any(same(a, b) for i, a in enumerate(v) for b in v[:i]), "uniqueItems")
    ok = lambda sub: not plain(v, sub, doc, path)
    for sub in s.get("allOf", []):
        out += plain(v, sub, doc, path)
    err("anyOf" in s and not any(map(ok, s.get("anyOf", []))), "anyOf")
    err("oneOf" in s and sum(map(ok, s.get("oneOf", []))) != 1, "oneOf")
    err("not" in s and ok(s.get("not")), "not")
    if "if" in s:
        out += plain(v, s.get("then", True) if ok(s["if"]) else s.get("else", True), doc, path)
    return out


LEAF = [{"type": "string", "minLength": 2}, {"type": ["integer", "null"], "minimum": 2}, {"type": "number", "exclusiveMaximum": 5, "exclusiveMinimum": 0}, {"enum": ["a", 1, None, True]}, {"const": 2}, {"pattern": "^[ab]+$", "maxLength": 3}, {"not": {"type": "string"}}, True, False, {"$ref": "#/definitions/leaf"}]
SCHEMAS = [
    {"definitions": {"leaf": {"type": "string"}}, "type": "object", "properties": {f"p{i}": s for i, s in enumerate(LEAF)}, "required": ["p0", "x"], "additionalProperties": False},
    {"definitions": {"leaf": {"type": "integer"}}, "type": "array", "items": {"anyOf": LEAF[:2] + [{"$ref": "#/definitions/leaf"}]}, "minItems": 1, "maxItems": 4, "uniqueItems": True},
    {"properties": {"p0": {"type": "object", "additionalProperties": {"type": "array", "items": LEAF[0]}, "maxProperties": 2, "minProperties": 1}}, "oneOf": [{"required": ["p0"]}, {"required": ["p1"]}], "if": {"required": ["p2"]}, "then": {"required": ["p3"]}, "else": {"allOf": [{"maxProperties": 3}]}},
    True, False, {},
]


def value(rng, depth=0):
    leaf = [None, True, 0, 1, 2, 1.5, 2.0, -3, "a", "ab", "abc", "", "é", 7]
    r = rng.random()
    if depth > 2 or r < 0.4:
        return rng.choice(leaf)
    if r < 0.6:
        return [value(rng, depth + 1) for _ in range(rng.randrange(5))]
    return {rng.choice([f"p{i}" for i in range(10)] + ["x"]): value(rng, depth + 1) for _ in range(rng.randrange(6))}


@pytest.mark.parametrize("schema", SCHEMAS)
def test_equals_the_plain_validator(spark, schema):
    rng = random.Random(12)
    values = [value(rng) for _ in range(250)]
    df = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)] + [(-1, "{not json"), (-2, None)], "i int, t string")
    got = {r.i: [(e.path, e.rule) for e in r.e] for r in df.select("i", json_schema.validate_json(F.col("t"), schema).alias("e")).collect()}
    assert got.pop(-1) == got.pop(-2) == [("", "json")]
    for i, v in enumerate(values):
        want = [(" → ".join(map(str, p)), rule) for p, rule in plain(v, schema, schema)]
        assert sorted(got[i]) == sorted(want), v


def test_what_is_not_supported_is_refused():
    for schema in ({"dependencies": {}}, {"$ref": "other.json"}, {"definitions": {"a": {"items": {"$ref": "#/definitions/a"}}}, "$ref": "#/definitions/a"}, {"items": [True]}):
        with pytest.raises(ValueError):
            json_schema.compile_schema(schema)


def test_answers(spark):
    good = {"technical_skills": [{"name": "SQL", "source": "SQL"}], "soft_skills": [], "nice_to_have_skills": [], "benefits": [], "tasks": [], "job_family": "Data"}
    bad = good | {"technical_skills": [{"name": "", "source": "x"}, {"name": "a"}, "b"], "soft_skills": ["x", "x", ""], "extra": 1, "job_summary": ""}
    del bad["tasks"]
    texts = [json.dumps(good), "```json\n" + json.dumps(bad)[:-1] + ",}\n```", "no answer that could be read at all", json.dumps(good).replace("technical_skills", "technical_skils"), None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = df.select("i", extraction.schema_errors(F.col("t")).alias("errors"))
    got = {r.i: sorted((e.path, e.rule) for e in r.errors) for r in found.collect()}
    assert got[0] == got[3] == [] and got[2] == got[4] == [("", "json")]
    assert got[1] == sorted([("", "additionalProperties"), ("", "required"), ("job_summary", "oneOf"), ("soft_skills", "uniqueItems"), ("soft_skills → 2", "minLength"), ("technical_skills → 0 → name", "minLength"), ("technical_skills → 1", "required"), ("technical_skills → 2", "type")])
    report = {(r.path, r.rule): (r.n, r.rows) for r in extraction.schema_report(found).collect()}
    assert report["technical_skills → *", "required"] == (1, 1) and report["", "json"] == (2, 2)
