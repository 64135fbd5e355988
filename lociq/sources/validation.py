"""JSON schemas compiled into column expressions: every rule of a sheet or of documents is checked in one pass, a row for each violation.

Understood are type, enum, const, pattern, minLength, maxLength, minimum, maximum, exclusiveMinimum, exclusiveMaximum, properties, required,
additionalProperties (false), items, minItems, maxItems, uniqueItems and default; annotations are ignored, and any other keyword is an error instead of being passed over.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NOTES = {"$schema", "$id", "$comment", "title", "description", "examples", "default", "deprecated", "readOnly", "writeOnly"}
RULES = {"type", "enum", "const", "pattern", "minLength", "maxLength", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "properties", "required", "additionalProperties", "items", "minItems", "maxItems", "uniqueItems"}
# how a variant's type begins
KINDS = {"string": "STRING|DATE|TIMESTAMP|BINARY", "integer": "BIGINT", "number": "BIGINT|DOUBLE|FLOAT|DECIMAL", "boolean": "BOOLEAN", "object": "OBJECT", "array": "ARRAY", "null": "VOID"}


def load(path: str) -> dict:
    """A schema from a JSON or YAML file of the driver."""
    with open(path, encoding="utf-8") as f:
        if path.endswith(".json"):
            return json.load(f)
        import yaml

        return yaml.safe_load(f)


def _known(schema: dict, at: str) -> None:
    if unknown := sorted(set(schema) - NOTES - RULES):
        raise ValueError(f"rules that aren't understood at {at or 'the top'}: {', '.join(unknown)}")


def _is(kind: Column, names: str | Sequence[str], number: Column) -> Column:
    """Whether a value has one of the types; a number without a fraction is an integer."""
    names = [names] if isinstance(names, str) else names
    if unknown := [n for n in names if n not in KINDS]:
        raise ValueError(f"no type {', '.join(unknown)}")
    out = kind.rlike("^(" + "|".join(KINDS[n] for n in names) + ")")
    return out | (kind.rlike("^(DOUBLE|FLOAT|DECIMAL)") & (number == F.floor(number))) if "integer" in names else out


def compiled(schema: dict, value: Column, path: Column, null_is_missing: bool, at: str = "") -> Column:
    """An array of violations (field, rule, value) of a variant by a schema."""
    _known(schema, at)
    there = value.isNotNull()
    kind = F.schema_of_variant(value)
    text, number = F.try_variant_get(value, "$", "string"), F.try_variant_get(value, "$", "double")
    is_text, is_number = there & kind.startswith("STRING"), there & kind.rlike("^(" + KINDS["number"] + ")")
    is_object, is_array = there & kind.startswith("OBJECT"), there & kind.startswith("ARRAY")
    whole = F.when(kind.rlike("^(OBJECT|ARRAY)"), F.to_json(value)).otherwise(text)
    same = lambda x: _is(kind, {str: "string", bool: "boolean", int: "number", float: "number", type(None): "null"}[type(x)], number) & (F.lit(True) if x is None else number == x if isinstance(x, (int, float)) and not isinstance(x, bool) else text == (str(x).lower() if isinstance(x, bool) else x))
    listed = lambda xs: F.lit(False) if not xs else F.exists(F.array(*(F.coalesce(same(x), F.lit(False)) for x in xs)), lambda b: b)
    broken: list[tuple[str, Column]] = []
    for rule, x in schema.items():
        if rule == "type":
            broken.append((rule, there & ~_is(kind, x, number)))
        elif rule == "enum":
            broken.append((rule, there & ~listed(x)))
        elif rule == "const":
            broken.append((rule, there & ~listed([x])))
        elif rule == "pattern":
            broken.append((rule, is_text & ~text.rlike(x)))
        elif rule in ("minLength", "maxLength"):
            broken.append((rule, is_text & (F.length(text) < x if rule == "minLength" else F.length(text) > x)))
        elif rule in ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum"):
            broken.append((rule, is_number & {"minimum": number < x, "maximum": number > x, "exclusiveMinimum": number <= x, "exclusiveMaximum": number >= x}[rule]))
        elif rule in ("minItems", "maxItems", "uniqueItems"):
            items = F.try_variant_get(value, "$", "array<string>")
            wrong = {"minItems": F.size(items) < x, "maxItems": F.size(items) > x, "uniqueItems": F.size(items) > F.size(F.array_distinct(items)) if x else F.lit(False)}[rule]
            broken.append((rule, is_array & wrong))
    one = lambda field, rule, shown: F.struct(field.alias("field"), F.lit(rule).alias("rule"), shown.cast("string").alias("value"))
    parts = [F.array(*(F.when(F.coalesce(wrong, F.lit(False)), one(path, rule, whole)) for rule, wrong in broken))] if broken else []
    child = lambda name: _child(value, name, null_is_missing)
    join = lambda name: F.concat(path, F.when(path != "", ".").otherwise(""), F.lit(name))
    lacking = [F.when(is_object & child(n).isNull(), one(join(n), "required", F.lit(None))) for n in schema.get("required", [])]
    if lacking:
        parts.append(F.array(*lacking))
    for name, inner in schema.get("properties", {}).items():
        parts.append(F.when(is_object, compiled(inner, child(name), join(name), null_is_missing, f"{at}.{name}")))
    if schema.get("additionalProperties") is False:
        keys = F.map_keys(F.try_variant_get(value, "$", "map<string,variant>"))
        extra = F.filter(keys, lambda k: ~k.isin(*schema.get("properties", {})))
        parts.append(F.when(is_object, F.transform(extra, lambda k: one(F.concat(path, F.when(path != "", ".").otherwise(""), k), "additionalProperties", F.lit(None)))))
    if isinstance(schema.get("items"), dict):
        items = F.try_variant_get(value, "$", "array<variant>")
        parts.append(F.when(is_array, F.flatten(F.transform(items, lambda x, i: compiled(schema["items"], x, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), False, f"{at}[]")))))
    none = F.array().cast("array<struct<field:string,rule:string,value:string>>")
    found = F.flatten(F.array(none, *(F.coalesce(p, none) for p in parts)))
    return F.filter(found, lambda x: x.isNotNull())


def _child(value: Column, name: str, null_is_missing: bool) -> Column:
    quoted = name.replace("'", "\\'")
    out = F.try_variant_get(value, f"$['{quoted}']", "variant")
    return F.when(~F.is_variant_null(out), out) if null_is_missing else out


def violations(sheet: DataFrame, schema: dict, place: Sequence[str] = ()) -> DataFrame:
    """What the rows of a sheet break of a schema: the columns of ``place``, field, rule and value; a null cell is a missing one."""
    row = F.to_variant_object(F.struct(*(F.col(f"`{c}`") for c in sheet.columns)))
    found = compiled({"type": "object"} | schema, F.col("_row"), F.lit(""), True)
    return sheet.withColumn("_row", row).select(*(F.col(f"`{c}`") for c in place), F.explode(found).alias("_x")).select(*(F.col(f"`{c}`") for c in place), "_x.*")


def document_violations(documents: DataFrame, column: str, schema: dict, place: Sequence[str] = ()) -> DataFrame:
    """The same for JSON documents in a text column, nested as deep as the schema goes; what isn't JSON breaks the rule 'json'."""
    value = F.try_parse_json(F.col(f"`{column}`"))
    bad = F.array(F.struct(F.lit("").alias("field"), F.lit("json").alias("rule"), F.col(f"`{column}`").cast("string").alias("value")))
    found = F.when(F.col("_row").isNull(), bad).otherwise(compiled(schema, F.col("_row"), F.lit(""), False))
    return documents.withColumn("_row", value).select(*(F.col(f"`{c}`") for c in place), F.explode(found).alias("_x")).select(*(F.col(f"`{c}`") for c in place), "_x.*")


def with_defaults(sheet: DataFrame, schema: dict) -> DataFrame:
    """A sheet with the defaults of its schema in place of nulls, also of columns that it lacks."""
    given = {c: p["default"] for c, p in schema.get("properties", {}).items() if "default" in p}
    return sheet.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(x)) if c in sheet.columns else F.lit(x) for c, x in given.items()})


def validated(sheet: DataFrame, schema: dict, place: Sequence[str] = ()) -> DataFrame:
    """The sheet with defaults, if no row breaks the schema; else an error that shows some violations."""
    out = with_defaults(sheet, schema)
    if some := violations(out, schema, place).limit(5).collect():
        raise ValueError("; ".join(str(r.asDict()) for r in some))
    return out
