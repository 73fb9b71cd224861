"""JSON Schema as Spark expressions: a schema is compiled once, each document is checked in one pass of built-in functions.

Documents are VARIANT values. Objects are followed property by property and arrays
item by item, so errors name their place; nothing is sent to Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Keywords that say nothing about validity.
NOTES = {"$schema", "$id", "title", "description", "default", "examples", "format", "$comment"}
CHECKED = {"type", "enum", "pattern", "required", "properties", "additionalProperties", "items", "minimum", "maximum", "minLength", "minItems"}


def _none() -> Column:
    return F.array().cast("array<string>")


def _error(path: Column, what: Column | str) -> Column:
    return F.concat(path, F.lit(": "), F.lit(what) if isinstance(what, str) else what)


def _is(v: Column, kind: str) -> Column:
    """Whether a variant is of a schema type; 1.0 is an integer."""
    of = F.schema_of_variant(v)
    starts = lambda *xs: F.coalesce(of.rlike(f"^(?:{'|'.join(xs)})"), F.lit(False))
    number = starts("BIGINT", "DECIMAL", "DOUBLE", "FLOAT", "INT", "SMALLINT", "TINYINT")
    whole = F.try_variant_get(v, "$", "double")
    return {
        "object": starts("OBJECT"), "array": starts("ARRAY"), "string": of == "STRING", "boolean": of == "BOOLEAN", "null": of == "VOID", "number": number, "integer": number & (whole == F.floor(whole)),
    }[kind]


def _deeper(path: Column, step: Column) -> Column:
    return F.when(path == "<root>", step).otherwise(F.concat(path, F.lit("/"), step))


def errors(v: Column, schema: dict, path: Column | None = None) -> Column:
    """Errors ``place: fault`` of a variant, in order of place; the root is ``<root>``.

    Of the keywords, those in ``CHECKED`` count; others than these and ``NOTES`` are refused when compiling.
    """
    if strange := set(schema) - CHECKED - NOTES:
        raise ValueError(f"keywords that are not checked: {sorted(strange)}")
    return F.array_sort(_errors(v, schema, F.lit("<root>") if path is None else path))


def _errors(v: Column, schema: dict, path: Column) -> Column:
    if strange := set(schema) - CHECKED - NOTES:
        raise ValueError(f"keywords that are not checked: {sorted(strange)}")
    faults, nested = [], []
    text, number = F.try_variant_get(v, "$", "string"), F.try_variant_get(v, "$", "double")
    if "type" in schema:
        kinds = [schema["type"]] if isinstance(schema["type"], str) else schema["type"]
        fits = F.lit(False)
        for k in kinds:
            fits = fits | F.coalesce(_is(v, k), F.lit(False))
        faults.append(F.when(~fits, _error(path, f"is not {' or '.join(kinds)}")))
    if "enum" in schema:
        strings = [x for x in schema["enum"] if isinstance(x, str)]
        if len(strings) < len(schema["enum"]):
            raise ValueError("only strings are compared in an enum")
        faults.append(F.when(~F.coalesce(_is(v, "string") & text.isin(*strings), F.lit(False)), _error(path, "is none of the values")))
    if "pattern" in schema:
        faults.append(F.when(_is(v, "string") & ~text.rlike(schema["pattern"]), _error(path, "does not match")))
    if "minLength" in schema:
        faults.append(F.when(_is(v, "string") & (F.length(text) < schema["minLength"]), _error(path, "is too short")))
    for word, wrong in (("minimum", lambda x: number < x), ("maximum", lambda x: number > x)):
        if word in schema:
            faults.append(F.when(_is(v, "number") & wrong(schema[word]), _error(path, f"is beyond its {word}")))
    for name in schema.get("required", []):
        faults.append(F.when(_is(v, "object") & _property(v, name).isNull(), _error(path, f"lacks {name}")))
    known = schema.get("properties", {})
    for name, inner in known.items():
        held = _property(v, name)
        nested.append(F.when(_is(v, "object") & held.isNotNull(), _errors(held, inner, _deeper(path, F.lit(name)))).otherwise(_none()))
    if schema.get("additionalProperties") is False:
        keys = F.map_keys(F.try_variant_get(v, "$", "map<string,variant>"))
        more = F.filter(keys, lambda k: ~k.isin(*known)) if known else keys
        nested.append(F.when(_is(v, "object"), F.transform(more, lambda k: _error(path, F.concat(F.lit("has also "), k)))).otherwise(_none()))
    elif isinstance(schema.get("additionalProperties"), dict):
        raise ValueError("schemas of additional properties are not checked")
    items = F.try_variant_get(v, "$", "array<variant>")
    if "minItems" in schema:
        faults.append(F.when(_is(v, "array") & (F.size(items) < schema["minItems"]), _error(path, "has too few items")))
    if "items" in schema:
        each = F.flatten(F.transform(items, lambda x, i: _errors(x, schema["items"], _deeper(path, i.cast("string")))))
        nested.append(F.when(_is(v, "array"), each).otherwise(_none()))
    own = F.array_compact(F.array(*faults)) if faults else _none()
    return F.concat(own, *[F.coalesce(n, _none()) for n in nested])


def _property(v: Column, name: str) -> Column:
    quoted = name.replace("\\", "\\\\").replace("'", "\\'")
    return F.try_variant_get(v, f"$['{quoted}']", "variant")


def validate(text: Column, schema: dict) -> Column:
    """Errors of a JSON text; one that cannot be parsed is ``<root>: is no JSON``, a null likewise."""
    v = F.try_parse_json(text)
    return F.when(v.isNull(), F.array(F.lit("<root>: is no JSON"))).otherwise(errors(v, schema))
