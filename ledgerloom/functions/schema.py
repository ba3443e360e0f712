"""JSON Schema documents compiled to one column expression that names what a JSON text breaks, and where.

compiled(schema)(text) is an array of "path: keyword" in the order in which the schema states its keywords, the properties
of an object in the schema's order and the items of an array in theirs. It is built from the engine's variant functions,
so a check is part of a plan like any other expression, and a keyword costs nothing on values of another type.

Keywords: type (a name or several), enum, const, pattern, minLength, maxLength, minimum, maximum, exclusiveMinimum,
exclusiveMaximum, multipleOf, required, properties, patternProperties, additionalProperties, minProperties, maxProperties,
propertyNames, items (one schema, or one a place with additionalItems), minItems, maxItems, uniqueItems, contains, allOf,
anyOf, oneOf, not, if / then / else, dependencies, $ref within the document, and true and false as schemas. Others, such as
title, say nothing about values. A reference is followed `levels` deep; a value below that is reported as "path: depth".

Defined cases: a null text is "$: missing", text that is no JSON is "$: json"; numbers are compared as doubles, so 1 and 1.0
are equal, and both are integers; true is not 1; patterns are those of the engine, searched for, not matched in full; of an
object that repeats a name, none is taken: it is no JSON to the parser.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

LEVELS = 4
_KINDS = {"object": "OBJECT<", "array": "ARRAY<", "string": "STRING", "boolean": "BOOLEAN", "null": "VOID"}
_NUMBERS = ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT", "INT", "SMALLINT", "TINYINT")
_BETWEEN = ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf")


def _bound(x: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f reads it."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def _none() -> Column:
    return F.array().cast("array<string>")


def _all(parts: list[Column]) -> Column:
    return F.concat(*parts) if len(parts) > 1 else parts[0] if parts else _none()


class _Value:
    """A variant, the name of its type, and what it is as another type; null where it is none of that."""

    def __init__(self, v: Column, kind: Column):
        self.v, self.kind = v, kind
        self.number = F.try_variant_get(v, "$", "double")
        self.string = F.try_variant_get(v, "$", "string")
        self.items = F.try_variant_get(v, "$", "array<variant>")
        self.fields = F.try_variant_get(v, "$", "map<string,variant>")

    def is_a(self, name: str) -> Column:
        if name in ("number", "integer"):
            number = F.lit(False)
            for n in _NUMBERS:
                number = number | F.startswith(self.kind, F.lit(n))
            return number if name == "number" else number & (self.number % 1.0 == 0)
        if name not in _KINDS:
            raise ValueError(f"no such type: {name}")
        return F.startswith(self.kind, F.lit(_KINDS[name]))


def _value(x: Column, f: Callable[[_Value], Column]) -> Column:
    return _bound(x, lambda v: _bound(F.schema_of_variant(v), lambda kind: f(_Value(v, kind))))


def _at(name: str) -> str:
    """The path of a member, as the engine writes paths."""
    quote = '"' if "'" in name else "'"
    return f"$[{quote}{name}{quote}]"


def _equals(x: _Value, constant: Any) -> Column:
    """JSON equality with a constant, by its structure."""
    if constant is None:
        return x.is_a("null")
    if isinstance(constant, bool):
        return x.is_a("boolean") & (F.try_variant_get(x.v, "$", "boolean") == F.lit(constant))
    if isinstance(constant, int | float):
        return x.is_a("number") & (x.number == F.lit(float(constant)))
    if isinstance(constant, str):
        return x.is_a("string") & (x.string == F.lit(constant))
    if isinstance(constant, list):
        ok = x.is_a("array") & (F.size(x.items) == len(constant))
        for i, c in enumerate(constant):
            ok = ok & F.coalesce(_value(F.get(x.items, F.lit(i)), lambda y, c=c: _equals(y, c)), F.lit(False))
        return ok
    ok = x.is_a("object") & (F.size(x.fields) == len(constant))
    for name, c in constant.items():
        ok = ok & F.coalesce(_value(F.try_variant_get(x.v, _at(name), "variant"), lambda y, c=c: _equals(y, c)), F.lit(False))
    return ok


def _text(x: Column) -> Column:
    """A string as a variant."""
    return F.try_variant_get(F.to_variant_object(F.array(x)), "$[0]", "variant")


def _same_text(x: Column) -> Column:
    """A text that equal items share; numbers by their value."""
    return _value(x, lambda y: F.when(y.is_a("number"), F.concat(F.lit("n"), y.number.cast("string"))).otherwise(F.to_json(y.v)))


class _Compiler:
    def __init__(self, root: Any, levels: int):
        self.root, self.levels = root, levels

    def resolved(self, pointer: str) -> Any:
        if not pointer.startswith("#"):
            raise ValueError(f"a reference out of the document: {pointer}")
        found = self.root
        for part in filter(None, pointer[1:].split("/")):
            part = part.replace("~1", "/").replace("~0", "~")
            found = found[int(part)] if isinstance(found, list) else found[part]
        return found

    def errors(self, x: Column, schema: Any, path: Column, level: int = 0) -> Column:
        """What the variant x breaks; nothing where it is null, as a value that is not there breaks no rule."""
        if schema is True or schema == {}:
            return _none()
        if schema is False:
            return F.when(x.isNotNull(), F.array(F.concat(path, F.lit(": false")))).otherwise(_none())
        if "$ref" in schema:
            if level >= self.levels:
                return F.when(x.isNotNull(), F.array(F.concat(path, F.lit(": depth")))).otherwise(_none())
            return self.errors(x, self.resolved(schema["$ref"]), path, level + 1)
        made = lambda v: _all([p for k in schema if (p := self.keyword(k, schema, v, path, level)) is not None])
        return F.when(x.isNotNull(), _value(x, made)).otherwise(_none())

    def holds(self, x: Column, schema: Any, level: int) -> Column:
        return F.size(self.errors(x, schema, F.lit(""), level)) == 0

    def keyword(self, name: str, schema: dict, x: _Value, path: Column, level: int) -> Column | None:
        told, said = schema[name], lambda what: F.concat(path, F.lit(f": {what}"))
        unless = lambda ok, what=name: F.when(~F.coalesce(ok, F.lit(False)), F.array(said(what))).otherwise(_none())
        only = lambda kind, errors: F.when(x.is_a(kind), errors).otherwise(_none())
        below = lambda v, s, p: self.errors(v, s, p, level)
        member = lambda n: F.concat(path, F.lit(f".{n}"))
        inside = lambda key: F.concat(path, F.lit("."), key)
        place = lambda i: F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))
        either = lambda tests: tests[0] if len(tests) == 1 else tests[0] | either(tests[1:])
        if name == "type":
            return unless(either([x.is_a(t) for t in ([told] if isinstance(told, str) else told)]))
        if name == "enum":
            return unless(either([_equals(x, c) for c in told]) if told else F.lit(False))
        if name == "const":
            return unless(_equals(x, told))
        if name == "pattern":
            return only("string", unless(F.regexp_like(x.string, F.lit(told))))
        if name in ("minLength", "maxLength"):
            return only("string", unless(F.length(x.string) >= told if name == "minLength" else F.length(x.string) <= told))
        if name in _BETWEEN:
            n, t = x.number, float(told)
            tests = {"minimum": n >= t, "maximum": n <= t, "exclusiveMinimum": n > t, "exclusiveMaximum": n < t, "multipleOf": n / t % 1.0 == 0}
            return only("number", unless(tests[name]))
        if name == "required":
            return only("object", _all([unless(F.map_contains_key(x.fields, F.lit(n)), f"required {n}") for n in told]))
        if name in ("minProperties", "maxProperties"):
            return only("object", unless(F.size(x.fields) >= told if name == "minProperties" else F.size(x.fields) <= told))
        if name == "properties":
            return only("object", _all([below(F.try_variant_get(x.v, _at(n), "variant"), s, member(n)) for n, s in told.items()]))
        if name in ("patternProperties", "additionalProperties", "propertyNames"):
            entries = F.map_entries(x.fields)
            if name == "propertyNames":
                return only("object", F.flatten(F.transform(entries, lambda e: below(_text(e["key"]), told, inside(e["key"])))))
            if name == "patternProperties":
                each = lambda p, s: F.flatten(F.transform(F.filter(entries, lambda e: F.regexp_like(e["key"], F.lit(p))), lambda e: below(e["value"], s, inside(e["key"]))))
                return only("object", _all([each(p, s) for p, s in told.items()]))
            known, shapes = list(schema.get("properties", {})), list(schema.get("patternProperties", {}))

            def extra(e: Column) -> Column:
                is_known = e["key"].isin(*known) if known else F.lit(False)
                for p in shapes:
                    is_known = is_known | F.regexp_like(e["key"], F.lit(p))
                return ~is_known

            if told is False:
                return only("object", unless(~F.exists(entries, extra)))
            return only("object", F.flatten(F.transform(F.filter(entries, extra), lambda e: below(e["value"], told, inside(e["key"])))))
        if name == "items":
            if not isinstance(told, list):
                return only("array", F.flatten(F.transform(x.items, lambda v, i: below(v, told, place(i)))))
            parts = [below(F.get(x.items, F.lit(i)), s, place(F.lit(i))) for i, s in enumerate(told)]
            rest = schema.get("additionalItems", True)
            parts.append(F.flatten(F.transform(x.items, lambda v, i: F.when(i >= len(told), below(v, rest, place(i))).otherwise(_none()))))
            return only("array", _all(parts))
        if name in ("minItems", "maxItems"):
            return only("array", unless(F.size(x.items) >= told if name == "minItems" else F.size(x.items) <= told))
        if name == "uniqueItems":
            return only("array", unless(F.size(F.array_distinct(F.transform(x.items, _same_text))) == F.size(x.items))) if told else None
        if name == "contains":
            return only("array", unless(F.exists(x.items, lambda v: self.holds(v, told, level))))
        if name == "allOf":
            return _all([below(x.v, s, path) for s in told])
        if name == "anyOf":
            return unless(either([self.holds(x.v, s, level) for s in told]))
        if name == "oneOf":
            return unless(sum((self.holds(x.v, s, level).cast("int") for s in told[1:]), self.holds(x.v, told[0], level).cast("int")) == 1)
        if name == "not":
            return unless(~self.holds(x.v, told, level))
        if name == "if":
            then, other = schema.get("then", True), schema.get("else", True)
            return F.when(self.holds(x.v, told, level), below(x.v, then, path)).otherwise(below(x.v, other, path))
        if name == "dependencies":
            parts = []
            for n, needs in told.items():
                what = _all([unless(F.map_contains_key(x.fields, F.lit(k)), f"required {k}") for k in needs]) if isinstance(needs, list) else below(x.v, needs, path)
                parts.append(F.when(F.map_contains_key(x.fields, F.lit(n)), what).otherwise(_none()))
            return only("object", _all(parts))
        return None


def compiled(schema: dict | bool | str, levels: int = LEVELS) -> Callable[[Column], Column]:
    """A function of a column of JSON texts to the array of what each breaks. schema: as a value, or as JSON text."""
    root = json.loads(schema) if isinstance(schema, str) else schema
    compiler = _Compiler(root, levels)

    def errors(text: Column) -> Column:
        found = _bound(F.try_parse_json(text), lambda v: F.when(v.isNull(), F.array(F.lit("$: json"))).otherwise(compiler.errors(v, root, F.lit("$"))))
        return F.when(text.isNull(), F.array(F.lit("$: missing"))).otherwise(found)

    return errors


def first_errors(text: Column, schema: dict | bool | str, most: int = 3, levels: int = LEVELS) -> Column:
    """The first few of what a JSON text breaks, in order; an empty array where it is valid."""
    return F.slice(compiled(schema, levels)(text), 1, most)


def valid(text: Column, schema: dict | bool | str, levels: int = LEVELS) -> Column:
    return F.size(compiled(schema, levels)(text)) == 0
