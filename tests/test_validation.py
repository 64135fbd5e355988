"""Schemas against sheets and documents."""

import json

import pytest

from lociq.sources import validation as va

SAMPLES = {"$schema": "x", "description": "a sample", "properties": {c: {"type": "string", "description": "x"} for c in ("sample_id", "tissue_id", "donor_id", "dna_type", "R1", "R2")}, "required": ["sample_id", "tissue_id", "donor_id"]}
CONFIG = {
    "type": "object",
    "properties": {"outdir": {"type": "string"}, "genome": {"type": "object", "properties": {"fasta": {"type": "string"}, "name": {"type": "string", "pattern": "^hs"}}, "required": ["fasta", "name"]}, "adapters": {"type": "object"}, "windows": {"type": "array", "items": {"type": "integer", "minimum": 1}, "maxItems": 3, "uniqueItems": True}},
    "required": ["outdir", "genome", "adapters"],
}


def found(df):
    return sorted(tuple(r) for r in df.collect())


def test_sheet(spark):
    rows = [("s1", "t1", "d1", "bulk", None, None), ("s2", None, "d1", None, "a", "b"), (None, None, None, None, None, None)]
    sheet = spark.createDataFrame(rows, "sample_id string, tissue_id string, donor_id string, dna_type string, R1 string, R2 string")
    got = [tuple(r) for r in va.violations(sheet, SAMPLES, ["R1"]).collect()]
    assert sorted(map(str, got)) == sorted(map(str, [("a", "tissue_id", "required", None), *((None, c, "required", None) for c in ("sample_id", "tissue_id", "donor_id"))]))
    assert va.violations(sheet.where("tissue_id is not null"), SAMPLES).count() == 0
    assert [r["field"] for r in va.violations(sheet.drop("donor_id").limit(1), SAMPLES).collect()] == ["donor_id"]
    assert va.validated(sheet.limit(1), SAMPLES).count() == 1
    with pytest.raises(ValueError, match="tissue_id"):
        va.validated(sheet, SAMPLES)


def test_rules_of_cells(spark):
    schema = {"properties": {"n": {"type": "integer", "minimum": 2, "exclusiveMaximum": 9}, "x": {"type": ["number", "null"], "maximum": 1.5}, "s": {"pattern": "^a.c", "minLength": 3, "maxLength": 4}, "e": {"enum": ["u", 3, None]}, "b": {"const": True}}, "additionalProperties": False}
    sheet = spark.createDataFrame([(2, 1.5, "abcd", "u", True), (1, 1.6, "ab", "v", False), (9, float("nan"), "abcde", "3", None)], "n int, x double, s string, e string, b boolean")
    want = [("b", "const", "false"), ("e", "enum", "3"), ("e", "enum", "v"), ("n", "exclusiveMaximum", "9"), ("n", "minimum", "1"), ("s", "maxLength", "abcde"), ("s", "minLength", "ab"), ("s", "pattern", "ab"), ("x", "maximum", "1.6"), ("x", "maximum", "NaN")]
    assert found(va.violations(sheet, schema)) == want  # Spark takes NaN as larger than any number
    text = spark.createDataFrame([("1", 2.0), ("x", 2.5)], "n string, m double")
    assert found(va.violations(text, {"properties": {"n": {"type": "integer"}, "m": {"type": "integer"}}})) == [("m", "type", "2.5"), ("n", "type", "1"), ("n", "type", "x")]
    assert found(va.violations(text.limit(1), {"properties": {"n": {}}, "additionalProperties": False})) == [("m", "additionalProperties", None)]
    with pytest.raises(ValueError, match="at .n: multipleOf"):
        va.violations(text, {"properties": {"n": {"multipleOf": 2}}})
    with pytest.raises(ValueError, match="no type text"):
        va.violations(text, {"properties": {"n": {"type": "text"}}})


def test_documents(spark):
    good = {"outdir": "o", "genome": {"fasta": "f", "name": "hs38"}, "adapters": {}, "windows": [750, 250]}
    bad = {"outdir": 3, "genome": {"name": "mm"}, "windows": [1, "x", 0, 1, 2.5]}
    docs = spark.createDataFrame([(1, json.dumps(good)), (2, json.dumps(bad)), (3, "{"), (4, json.dumps(good | {"adapters": None, "genome": []})), (5, "[]")], "k int, config string")
    want = [(2, "adapters", "required", None), (2, "genome.fasta", "required", None), (2, "genome.name", "pattern", "mm"), (2, "outdir", "type", "3"), (2, "windows", "maxItems", '[1,"x",0,1,2.5]'), (2, "windows", "uniqueItems", '[1,"x",0,1,2.5]'), (2, "windows[1]", "type", "x"), (2, "windows[2]", "minimum", "0"), (2, "windows[4]", "type", "2.5"), (3, "", "json", "{"), (4, "adapters", "type", None), (4, "genome", "type", "[]"), (5, "", "type", "[]")]
    assert sorted(map(str, found(va.document_violations(docs, "config", CONFIG, ["k"])))) == sorted(map(str, want))


def test_defaults_and_files(spark, tmp_path):
    schema = {"properties": {"a": {"type": "string", "default": "x"}, "b": {"default": 3}}, "required": ["a"]}
    assert [tuple(r) for r in va.validated(spark.createDataFrame([(None,), ("y",)], "a string"), schema).collect()] == [("x", 3), ("y", 3)]
    (tmp_path / "s.json").write_text(json.dumps(schema))
    (tmp_path / "s.yaml").write_text("properties:\n  a:\n    type: string\n    default: x\n  b:\n    default: 3\nrequired:\n  - a\n")
    assert va.load(str(tmp_path / "s.json")) == va.load(str(tmp_path / "s.yaml")) == schema
