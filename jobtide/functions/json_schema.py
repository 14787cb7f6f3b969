"""JSON Schema (draft 7) compiled to Columns over VARIANT: every error of a value, with the path to it.

`compile_schema(schema)` gives a function from a VARIANT Column to ARRAY<STRUCT<path, rule, message>>, empty where the value is valid. The schema
is read once, on the driver; what remains are built-in expressions, so validation runs inside the JVM and reads a value's keys and items
once per level. Errors come in the order of the rules below, those of properties by the order of the schema, those of items by place. A path is
the keys and places joined by an arrow.

Supported: type, enum, const, minLength, maxLength, pattern, minimum, maximum, exclusiveMinimum, exclusiveMaximum, required, properties,
additionalProperties, minProperties, maxProperties, items (one schema), minItems, maxItems, uniqueItems, allOf, anyOf, oneOf, not, if, then, else, $ref into the
document, true and false. A keyword that is neither of these nor an annotation is refused when the schema is compiled, and so is a reference to
itself. Patterns are Java's. A NULL VARIANT (text that is no JSON) has one error of the rule `json`.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

ERRORS = "array<struct<path:string,rule:string,message:string>>"
ARROW = " → "
# Keywords that say nothing about validity.
ANNOTATIONS = {"$schema", "$id", "$comment", "title", "description", "default", "examples", "definitions", "format", "readOnly", "writeOnly", "contentEncoding", "contentMediaType"}
_RULES = {"type", "enum", "const", "minLength", "maxLength", "pattern", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "required", "properties", "additionalProperties", "minProperties", "maxProperties", "items", "minItems", "maxItems", "uniqueItems", "allOf", "anyOf", "oneOf", "not", "if", "then", "else", "$ref"}


def kind_of(v: Column) -> Column:
    """object, array, string, boolean, null, integer or number; 1.0 is an integer."""
    name = F.schema_of_variant(v)
    whole = lambda: F.try_variant_get(v, "$", "double")
    return let(
        name,
        lambda n: F.when(n.startswith("OBJECT"), "object").when(n.startswith("ARRAY"), "array").when(n == "STRING", "string").when(n == "BOOLEAN", "boolean").when(n == "VOID", "null")
        .when(n.rlike(r"^(TINYINT|SMALLINT|INT|BIGINT|DECIMAL\(\d+,0\))$"), "integer").when(whole() == F.floor(whole()), "integer").otherwise("number"),
    )


def _plain(v: Column, kind: Column) -> Column:
    """A text that is equal for equal values; numbers by their value, deeper numbers by their writing."""
    return F.when(kind.isin("integer", "number"), F.try_variant_get(v, "$", "double").cast("string")).otherwise(F.to_json(v))


def _literal(value: Any) -> str:
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    return str(float(value)) if number else json.dumps(value, ensure_ascii=False, separators=(",", ":"), sort_keys=True)


def _java_double(value: float) -> Column:
    return F.lit(float(value)).cast("string")


class _Compiler:
    def __init__(self, document: Mapping):
        self.document = document

    def resolve(self, reference: str, seen: tuple[str, ...]) -> tuple[Any, tuple[str, ...]]:
        if not reference.startswith("#"):
            raise ValueError(f"reference out of the document: {reference}")
        if reference in seen:
            raise ValueError(f"schema that refers to itself: {reference}")
        at: Any = self.document
        for part in [p for p in reference[1:].split("/") if p]:
            at = at[part.replace("~1", "/").replace("~0", "~")]
        return at, (*seen, reference)

    def errors(self, v: Column, path: Column, schema: Any, seen: tuple[str, ...] = ()) -> Column:
        if schema is True or schema == {}:
            return F.array().cast(ERRORS)
        if schema is False:
            return self._error(F.lit(True), path, "false", F.lit("nothing is valid here"))
        if "$ref" in schema:  # draft 7 ignores what stands beside it
            target, seen = self.resolve(schema["$ref"], seen)
            return self.errors(v, path, target, seen)
        if unknown := set(schema) - _RULES - ANNOTATIONS:
            raise ValueError(f"keywords not supported: {', '.join(sorted(unknown))}")
        return let(kind_of(v), lambda kind: self._checked(v, kind, path, schema, seen))

    @staticmethod
    def _error(when: Column, path: Column, rule: str, message: Column) -> Column:
        one = F.array(F.struct(path.alias("path"), F.lit(rule).alias("rule"), message.alias("message")))
        return F.when(F.coalesce(when, F.lit(False)), one).otherwise(F.array().cast(ERRORS))

    def _checked(self, v: Column, kind: Column, path: Column, s: Mapping, seen: tuple[str, ...]) -> Column:
        parts: list[Column] = []
        shown = F.to_json(v)
        add = lambda when, rule, message: parts.append(self._error(when, path, rule, message))
        told = lambda *xs: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in xs])

        if "type" in s:
            names = [s["type"]] if isinstance(s["type"], str) else list(s["type"])
            allowed = [*names, *(["integer"] if "number" in names else [])]
            add(~kind.isin(*allowed), "type", told(shown, f" is not of type {', '.join(names)}"))
        for rule, values in (("enum", s.get("enum")), ("const", [s["const"]] if "const" in s else None)):
            if values is not None:
                same = [_plain(v, kind) == (_java_double(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else F.lit(_literal(x))) for x in values]
                add(~F.coalesce(*same, F.lit(False)) if len(same) == 1 else ~F.greatest(*[F.coalesce(x, F.lit(False)) for x in same]), rule, told(shown, f" is not one of {json.dumps(values, ensure_ascii=False)}" if rule == "enum" else f" is not {json.dumps(values[0], ensure_ascii=False)}"))

        text, number = F.try_variant_get(v, "$", "string"), F.try_variant_get(v, "$", "double")
        is_text, is_number = kind == "string", kind.isin("integer", "number")
        if "minLength" in s:
            add(is_text & (F.length(text) < s["minLength"]), "minLength", told(shown, " is too short"))
        if "maxLength" in s:
            add(is_text & (F.length(text) > s["maxLength"]), "maxLength", told(shown, " is too long"))
        if "pattern" in s:
            add(is_text & ~text.rlike(s["pattern"]), "pattern", told(shown, f" does not match {s['pattern']}"))
        for rule, broken in (("minimum", lambda n, x: n < x), ("maximum", lambda n, x: n > x), ("exclusiveMinimum", lambda n, x: n <= x), ("exclusiveMaximum", lambda n, x: n >= x)):
            if rule in s:
                add(is_number & broken(number, F.lit(float(s[rule]))), rule, told(shown, f" breaks the {rule} of {s[rule]}"))

        if any(k in s for k in ("required", "properties", "additionalProperties", "minProperties", "maxProperties")):
            fields = F.when(kind == "object", F.try_variant_get(v, "$", "map<string,variant>"))
            parts.append(let(fields, lambda m: self._of_object(m, path, s, seen)))
        if any(k in s for k in ("items", "minItems", "maxItems", "uniqueItems")):
            items = F.when(kind == "array", F.try_variant_get(v, "$", "array<variant>"))
            parts.append(let(items, lambda xs: self._of_array(xs, path, s, seen)))

        for i, sub in enumerate(s.get("allOf", [])):
            parts.append(self.errors(v, path, sub, seen))
        valid = lambda sub: F.size(self.errors(v, path, sub, seen)) == 0
        if "anyOf" in s:
            add(F.size(F.filter(F.array(*map(valid, s["anyOf"])), lambda x: x)) == 0, "anyOf", told(shown, " is not valid under any of the given schemas"))
        if "oneOf" in s:
            held = F.size(F.filter(F.array(*map(valid, s["oneOf"])), lambda x: x))
            add(held == 0, "oneOf", told(shown, " is not valid under any of the given schemas"))
            add(held > 1, "oneOf", told(shown, " is valid under more than one of the given schemas"))
        if "not" in s:
            add(valid(s["not"]), "not", told(shown, " is valid under a schema that it must not be valid under"))
        if "if" in s and ("then" in s or "else" in s):
            parts.append(F.when(valid(s["if"]), self.errors(v, path, s.get("then", True), seen)).otherwise(self.errors(v, path, s.get("else", True), seen)))
        return F.concat(*parts) if parts else F.array().cast(ERRORS)

    def _of_object(self, m: Column, path: Column, s: Mapping, seen: tuple[str, ...]) -> Column:
        parts: list[Column] = []
        none = F.array().cast(ERRORS)
        at = lambda key: F.concat(F.when(path == "", "").otherwise(F.concat(path, F.lit(ARROW))), key)
        for name in s.get("required", []):
            parts.append(self._error(~F.map_contains_key(m, name), path, "required", F.lit(f"'{name}' is a required property")))
        known = s.get("properties", {})
        for name, sub in known.items():
            parts.append(F.when(F.map_contains_key(m, name), self._of_property(m, name, at(F.lit(name)), sub, seen)).otherwise(none))
        more = s.get("additionalProperties", True)
        if more is not True and more != {}:
            extra = F.filter(F.map_entries(m), lambda e: ~e["key"].isin(*known)) if known else F.map_entries(m)
            if more is False:
                names = F.array_join(F.array_sort(F.transform(extra, lambda e: F.concat(F.lit("'"), e["key"], F.lit("'")))), ", ")
                parts.append(self._error(F.size(extra) > 0, path, "additionalProperties", F.concat(F.lit("Additional properties are not allowed: "), names)))
            else:
                parts.append(F.flatten(F.transform(extra, lambda e: self.errors(e["value"], at(e["key"]), more, seen))))
        if "minProperties" in s:
            parts.append(self._error(F.size(m) < s["minProperties"], path, "minProperties", F.lit("too few properties")))
        if "maxProperties" in s:
            parts.append(self._error(F.size(m) > s["maxProperties"], path, "maxProperties", F.lit("too many properties")))
        return F.when(m.isNotNull(), F.concat(*parts) if parts else none).otherwise(none)

    def _of_property(self, m: Column, name: str, path: Column, sub: Any, seen: tuple[str, ...]) -> Column:
        return let(F.try_element_at(m, F.lit(name)), lambda x: self.errors(x, path, sub, seen))

    def _of_array(self, xs: Column, path: Column, s: Mapping, seen: tuple[str, ...]) -> Column:
        parts: list[Column] = []
        none = F.array().cast(ERRORS)
        if isinstance(s.get("items"), list):
            raise ValueError("items as a list of schemas is not supported")
        if "items" in s:
            at = lambda i: F.concat(F.when(path == "", "").otherwise(F.concat(path, F.lit(ARROW))), i.cast("string"))
            parts.append(F.flatten(F.transform(xs, lambda x, i: self.errors(x, at(i), s["items"], seen))))
        if "minItems" in s:
            parts.append(self._error(F.size(xs) < s["minItems"], path, "minItems", F.lit("too few items")))
        if "maxItems" in s:
            parts.append(self._error(F.size(xs) > s["maxItems"], path, "maxItems", F.lit("too many items")))
        if s.get("uniqueItems"):
            texts = F.transform(xs, lambda x: let(kind_of(x), lambda k: _plain(x, k)))
            parts.append(self._error(F.size(F.array_distinct(texts)) < F.size(xs), path, "uniqueItems", F.lit("items are not unique")))
        return F.when(xs.isNotNull(), F.concat(*parts) if parts else none).otherwise(none)


def compile_schema(schema: Mapping | bool) -> Callable[[Column], Column]:
    """A function of a VARIANT Column; see the module. Raises ValueError on what is not supported."""
    compiler = _Compiler(schema if isinstance(schema, Mapping) else {})
    compiler.errors(F.try_parse_json(F.lit("null")), F.lit(""), schema)  # refuses what it cannot say, before any data

    def errors(v: Column) -> Column:
        broken = F.array(F.struct(F.lit("").alias("path"), F.lit("json").alias("rule"), F.lit("no JSON value").alias("message")))
        return F.when(v.isNull(), broken).otherwise(let(v, lambda x: compiler.errors(x, F.lit(""), schema)))

    return errors


def validate_json(text: Column, schema: Mapping | bool) -> Column:
    """Errors of a JSON text."""
    return compile_schema(schema)(F.try_parse_json(text))
