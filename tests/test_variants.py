"""Variant files of several samples."""

import gzip

import pytest
from pyspark.sql import functions as F

from lociq.sources import variants as vr

HEAD = """##fileformat=VCFv4.2
##INFO=<ID=AC,Number=A,Type=Integer,Description="alleles">
##INFO=<ID=DP,Number=1,Type=Integer,Description="depth, all">
##INFO=<ID=DB,Number=0,Type=Flag,Description="known">
##INFO=<ID=AF,Number=A,Type=Float,Description="x">
##INFO=<ID=END,Number=1,Type=Integer,Description="x">
##INFO=<ID=a.b,Number=1,Type=String,Description="x">
##FORMAT=<ID=GT,Number=1,Type=String,Description="x">
##contig=<ID=chr1,length=1000>
"""
ROWS = [
    ["chr1", "10", "v1", "A", "AT", "50", "PASS", "AC=9;DP=7;DB;AF=0.25", "GT:DP", "0/0:3", "0/1:4"],
    ["chr1", "20", ".", "ACG", "A,ACGTT", ".", "q10;q20", "AF=0.5,.;axb=no;a.b=yes;END=40", "GT:DP:GQ", "1|2:3:9", "2/2"],
    ["chr1", "30", "v3", "T", "G", "1.5", ".", ".", "DP:GT", "5:./.", "6:1"],
    ["chr2", "40", "v4", "T", "G", "0", "PASS", "DP=x;DBX", "GT", ".", "0"],
]


@pytest.fixture(scope="module")
def path(tmp_path_factory):
    at = tmp_path_factory.mktemp("variants") / "a.vcf.gz"
    lines = "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", "A", "B"]) + "\n" + "\n".join("\t".join(r) for r in ROWS) + "\n"
    at.write_bytes(gzip.compress((HEAD + lines).encode()))
    return str(at)


def test_header(spark, path, tmp_path):
    h = vr.header(spark, path)
    assert h.samples == ["A", "B"] and h.info["AC"] == ("A", "Integer") and h.info["DB"] == ("0", "Flag") and h.format == {"GT": ("1", "String")}
    (tmp_path / "x.vcf").write_text("chr1\t1\n")
    with pytest.raises(ValueError, match="column names"):
        vr.header(spark, str(tmp_path / "x.vcf"))


def test_samples_are_chosen_by_name(spark, path):
    counts = lambda s: [(r["id"], r["ac"], r["an"]) for r in vr.read(spark, path, s).collect()]
    assert counts(["B"]) == [("v1", [1], 2), (None, [0, 2], 2), ("v3", [1], 1), ("v4", [0], 1)]
    assert counts(["A"]) == [("v1", [0], 2), (None, [1, 1], 2), ("v3", [0], 0), ("v4", [0], 0)]
    assert counts(["B", "A"]) == counts(None) == [("v1", [1], 4), (None, [1, 3], 4), ("v3", [1], 1), ("v4", [0], 1)]
    assert counts([]) == [(i, None, None) for i in ("v1", None, "v3", "v4")]
    with pytest.raises(ValueError, match="no sample C, only A, B"):
        vr.read(spark, path, ["A", "C"])
    got = vr.read(spark, path, ["B"]).select("calls").collect()
    assert [(c["sample"], c["genotype"], c["fields"]) for r in got for c in r["calls"]] == [("B", "0/1", {"GT": "0/1", "DP": "4"}), ("B", "2/2", {"GT": "2/2"}), ("B", "1", {"DP": "6", "GT": "1"}), ("B", "0", {"GT": "0"})]
    assert [r["id"] for r in vr.called(vr.read(spark, path, ["A"])).collect()] == [None]


def test_tags_are_typed(spark, path):
    rows = vr.read(spark, path)
    assert dict(rows.select("info.*").dtypes) == {"AC": "array<bigint>", "DP": "bigint", "DB": "boolean", "AF": "array<double>", "END": "bigint", "a.b": "string"}
    got = [tuple(r) for r in rows.select("qual", "filter", "info.AC", "info.DP", "info.DB", "info.AF", "info.`a.b`", "end_pos").collect()]
    assert got == [(50.0, "PASS", [9], 7, True, [0.25], None, 10), (None, "q10;q20", None, None, False, [0.5, None], "yes", 40), (1.5, None, None, None, False, None, None, 30), (0.0, "PASS", None, None, False, None, None, 40)]
    assert [r["id"] for r in vr.longer(rows).collect()] == ["v1", None]
    assert [tuple(r) for r in vr.intervals(rows.where("pos = 20"), depth=F.col("info.DP")).collect()] == [("chr1", 19, 40, None)]


def test_a_file_without_tags_or_samples(spark, tmp_path):
    (tmp_path / "n.vcf").write_text("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\nchr1\t5\t.\tAC\tG\t.\t.\t.\n")
    assert [(r["pos"], r["end_pos"], r["ac"], r["calls"]) for r in vr.read(spark, str(tmp_path / "n.vcf")).collect()] == [(5, 6, None, [])]
