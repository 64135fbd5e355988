"""Block-compressed alignment files: made byte by byte, written and read back in splits, and by region."""

import random
import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, LessThan

from lociq.sources import alignment_files as af
from lociq.sources import blocks as bl
from lociq.sources import readers as rd

SAM = "@HD\tVN:1.6\n@SQ\tSN:chr1\tLN:1000\n@SQ\tSN:chr2\tLN:500\nr1\t99\tchr1\t11\t60\t5M2S\t=\t51\t47\tACGTNAC\tIIIIHHH\tCB:Z:a:b\tAS:i:-3\tNM:i:200\tCB:Z:again\nr2\t4\t*\t0\t0\t*\t*\t0\t0\t*\t*\n"
CONTIGS = {"chr1": 5_000_000, "chr2": 900_000, "chrX": 10}
COLUMNS = [c for c in af.ARROW.names if c != "end_pos"]


def alignment(name, flag, ref, pos, mapq, ops, next_ref, next_pos, length, seq, qual, tags):
    bases = [af.BASES.index(c) for c in seq] + [0] * (len(seq) % 2)
    body = struct.pack("<iiBBHHHiiii", ref, pos, len(name) + 1, mapq, 0, len(ops), flag, len(seq), next_ref, next_pos, length)
    body += name.encode() + b"\0" + b"".join(struct.pack("<I", n << 4 | af.OPERATIONS.index(o)) for n, o in ops)
    body += bytes(a << 4 | b for a, b in zip(bases[::2], bases[1::2], strict=True)) + bytes(ord(c) - 33 for c in qual) + tags
    return struct.pack("<i", len(body)) + body


def test_both_forms(spark, tmp_path):
    (tmp_path / "a.sam").write_text(SAM)
    head = b"BAM\1" + struct.pack("<i", 4) + b"@HD\n" + struct.pack("<i", 2)
    head += b"".join(struct.pack("<i", len(n) + 1) + n + b"\0" + struct.pack("<i", 1000) for n in (b"chr1", b"chr2"))
    one = alignment("r1", 99, 0, 10, 60, [(5, "M"), (2, "S")], 0, 50, 47, "ACGTNAC", "IIIIHHH", b"CBZa:b\0ASc\xfdNMC\xc8CBZagain\0")
    two = alignment("r2", 4, -1, -1, 0, [], -1, -1, 0, "", "", b"")
    # the header and a record may lie across blocks
    (tmp_path / "a.bam").write_bytes(bl.compressed(head[:30]) + bl.compressed(head[30:] + one[:20]) + bl.compressed(one[20:] + two) + bl.LAST)
    want, got = rd.alignments(spark, str(tmp_path / "a.sam")), af.read(spark, str(tmp_path / "a.bam"))
    assert got.drop("end_pos").columns == want.columns
    assert sorted(got.drop("end_pos").collect()) == sorted(want.collect())
    assert sorted(r["end_pos"] for r in got.collect()) == [0, 15]
    (tmp_path / "b.bam").write_bytes(bl.compressed(head) + bl.LAST)
    assert af.read(spark, str(tmp_path / "b.bam")).count() == 0
    (tmp_path / "c.bam").write_bytes(bl.compressed(head + one[:-5]) + bl.LAST)
    with pytest.raises(Exception, match="isn't whole"):
        af.read(spark, str(tmp_path / "c.bam")).count()


def test_tag_types(spark, tmp_path):
    raw = b"XAAq" + b"XBBs" + struct.pack("<ihh", 2, -1, 7) + b"XFf" + struct.pack("<f", 1.5) + b"XII" + struct.pack("<I", 1 << 31) + b"XHH1AE3\0" + b"XGBf" + struct.pack("<if", 1, 0.25)
    assert list(af.tags(raw)) == [("XA", "q"), ("XB", "s,-1,7"), ("XF", "1.5"), ("XI", str(1 << 31)), ("XH", "1AE3"), ("XG", "f,0.25")]
    long = "v" * 1_100_000
    (tmp_path / "long.sam").write_text(f"r\t0\t*\t0\t0\t*\t*\t0\t0\t*\t*\tXX:Z:{long}\n")
    assert rd.alignments(spark, str(tmp_path / "long.sam")).first()["tags"] == {"XX": long}


def records(n, seed=1):
    r = random.Random(seed)
    rows = []
    for k in range(n):
        chrom = r.choice(["chr1", "chr1", "chr1", "chr2", "*"])
        ops = [(r.randrange(1, 200), r.choice("MIDNSHP=X")) for _ in range(r.randrange(0, 6))]
        seq = "".join(r.choice(af.BASES) for _ in range(r.choice([0, 1, 50, 151])))
        start = r.randrange(0, CONTIGS[chrom] - 1500) if chrom != "*" else -1
        qual = "*" if not seq or r.random() < 0.2 else "".join(chr(r.randrange(33, 74)) for _ in seq)
        # a tag with the bytes of a record in it must not be taken for one
        tags = {"AS": str(r.randrange(-5, 500)), "CB": "é" * r.randrange(5), "XZ": r.choice(["", "\x24" * 40, "-12x"])}
        rows.append((f"r{k}", r.randrange(4096), chrom, r.randrange(256), "".join(f"{x}{o}" for x, o in ops) or "*", r.choice(["=", "*", "chrX"]) if chrom != "*" else "*", r.randrange(1, 9999), r.randrange(-99, 99), seq or "*", qual, tags, start))
    return rows


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    rows = records(6000) + [("long", 0, "chr1", 9, "200000M", "*", 0, 0, "A" * 200_000, "*", {}, 77_000)]
    path = str(tmp_path_factory.mktemp("aligned") / "out")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files
    af.write(spark.createDataFrame(rows, af.SCHEMA.replace(", end_pos long", "")), path, CONTIGS)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return path, rows


def key(rows):
    return sorted(str([(sorted(x.items()) if isinstance(x, dict) else x) for x in r]) for r in rows)


@pytest.mark.parametrize("split", [1 << 30, 50_000, 9_001])
def test_splits(spark, written, tmp_path, split):
    path, rows = written
    got = af.read(spark, path, split)
    assert key(map(tuple, got.select(COLUMNS).collect())) == key(rows)
    if split < 10_000:
        assert got.rdd.getNumPartitions() > 40
    for f, _ in bl.listed(path, ".bam"):  # without an index, by the shape of records
        (tmp_path / f.rpartition("/")[2]).write_bytes(open(f, "rb").read())
    assert key(map(tuple, af.read(spark, str(tmp_path), split).select(COLUMNS).collect())) == key(rows)


def test_regions(spark, written):
    path, rows = written
    got = af.read(spark, path, 20_000)
    ends = {r["name"]: r["end_pos"] for r in got.collect()}
    for chrom, start, end in [("chr1", 100_000, 120_000), ("chr1", 0, 1), ("chr1", 76_999, 77_001), ("chr1", 270_000, 276_999), ("chr1", 277_000, 277_010), ("chr2", 0, 1 << 40), ("chrX", 0, 10), ("none", 0, 10), ("*", -5, 10)]:
        found = got.where((F.col("chrom") == chrom) & (F.col("start_pos") < end) & (F.col("end_pos") > start))
        assert sorted(r["name"] for r in found.collect()) == sorted(r[0] for r in rows if r[2] == chrom and r[11] < end and ends[r[0]] > start), (chrom, start, end)


def test_a_region_reads_few_blocks(written):
    """A region opens the files that hold it, and of these the blocks of its bins."""

    def read(filters):
        reader = af.AlignmentReader({"path": written[0], "split_bytes": "20000"})
        assert list(reader.pushFilters(filters)) == filters
        splits, n, rows = reader.partitions(), 0, 0
        for s in splits:
            rows += sum(b.num_rows for b in reader.read(s))
            n += reader.blocks_read
        return len(splits), n, rows

    every, few = read([]), read([EqualTo(("chrom",), "chr1"), LessThan(("start_pos",), 2_010_000), GreaterThan(("end_pos",), 2_000_000)])
    assert every[2] == 6001 and 0 < few[2] < 200
    assert few[0] < every[0] and few[1] < every[1] / 3
    assert read([EqualTo(("chrom",), "none")])[0] == 0
    reader = af.AlignmentReader({"path": written[0]})
    list(reader.pushFilters([GreaterThanOrEqual(("end_pos",), 8)]))
    assert reader.region.chrom is None and reader.region.start == 7


def test_commit_and_abort(spark, tmp_path):
    rows = spark.createDataFrame(records(50, 2), af.SCHEMA.replace(", end_pos long", ""))
    path = tmp_path / "out"
    af.write(rows, str(path), CONTIGS)
    af.write(rows, str(path), CONTIGS)
    assert af.read(spark, str(path)).count() == 100
    assert not [f for f in path.iterdir() if f.name.startswith("_temporary")]
    options = {"path": str(path), "contigs": '{"chr1": 1000}'}
    af.AlignmentWriter(options, False).abort([])
    assert af.read(spark, str(path)).count() == 100
    bad = spark.createDataFrame([(f"r{k}", 0, "chr1", 0, "5M", "*", 0, 0, "*", "*", {}, 9 - k) for k in range(3)], af.SCHEMA.replace(", end_pos long", "")).withColumn("end_pos", F.lit(0).cast("long")).coalesce(1)
    with pytest.raises(Exception, match="order"):
        bad.write.format("aligned_reads").option("contigs", '{"chr1": 1000}').mode("append").save(str(path))
    assert af.read(spark, str(path)).count() == 100 and not [f for f in path.iterdir() if f.name.startswith("_temporary")]
    bad.orderBy("start_pos").coalesce(1).write.format("aligned_reads").option("contigs", '{"chr1": 1000}').mode("overwrite").save(str(path))
    assert af.read(spark, str(path)).count() == 3


@settings(deadline=None, max_examples=200)
@given(st.integers(0, bl.LONGEST - 1), st.integers(0, 1 << 20), st.integers(0, bl.LONGEST - 1), st.integers(1, 1 << 20))
def test_bins(a, n, b, m):
    overlap = a < b + m and b < max(a + n, a + 1)
    if overlap:
        assert int(bl.bins_of(np.array([a]), np.array([min(a + n, bl.LONGEST)]))[0]) in bl.bins_over(b, b + m)


def test_blocks_are_found(tmp_path):
    data = [bytes(random.Random(k).randrange(256) for _ in range(5000)) + bytes(bl.MAGIC) * 20 for k in range(9)]
    (tmp_path / "x").write_bytes(b"".join(map(bl.compressed, data)) + bl.LAST)
    blocks = bl.Blocks(str(tmp_path / "x"))
    places, at = [], 0
    while at < blocks.size:
        places.append(at)
        got, at = blocks.get(at)
        assert got == (data[len(places) - 1] if len(places) <= 9 else b"")
    for at in range(0, blocks.size, 97):
        assert blocks.first(at) == min((p for p in places if p >= at), default=blocks.size)
