"""Indexed region tables, written and read back whole, in splits and by region."""

import gzip
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, LessThan

from lociq.sources import blocks as bl
from lociq.sources import region_files as rf

SCHEMA = "chrom string, start_pos long, end_pos long, name string, score double, n int, flag boolean"


def table(n, seed=3):
    r = random.Random(seed)
    rows = []
    for k in range(n):
        start = r.randrange(0, 3_000_000)
        rows.append((r.choice(["chr1", "chr1", "chr10", "chr2", "chrÜ"]), start, start + r.choice([0, 1, 200, 200_000]), r.choice([None, f'a "quoted" {k}', "é,;", "#x"]), r.choice([None, 0.25, -1e300]), r.choice([None, k]), r.choice([None, True, False])))
    return rows


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    rows, path = table(20_000), str(tmp_path_factory.mktemp("regions") / "out")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files
    rf.write(spark.createDataFrame(rows, SCHEMA), path)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return path, rows


@pytest.mark.parametrize("split", [1 << 30, 30_000, 7_001])
def test_splits(spark, written, tmp_path, split):
    path, rows = written
    got = rf.read(spark, path, SCHEMA, split)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, rows))
    assert got.rdd.getNumPartitions() >= (4 if split > 1 << 20 else 8)
    for k, (f, _) in enumerate(bl.listed(path, ".tsv.gz")):  # without an index, and lines cut by blocks
        raw = gzip.open(f).read()
        (tmp_path / f"x{k}.tsv.gz").write_bytes(bl.compressed(raw[: raw.index(b"\n") + 1]) + b"".join(bl.compressed(raw[a : a + 5000]) for a in range(raw.index(b"\n") + 1, len(raw), 5000)) + bl.LAST)
    assert sorted(map(str, map(tuple, rf.read(spark, str(tmp_path), SCHEMA, split).collect()))) == sorted(map(str, rows))


def test_any_reader_reads_the_files(spark, written):
    path, rows = written
    assert spark.read.option("sep", "\t").option("comment", "#").schema("chrom string").csv(f"{path}/*.tsv.gz").count() == len(rows)
    assert gzip.open(bl.listed(path, ".tsv.gz")[0][0]).readline() == b"#chrom\tstart_pos\tend_pos\tname\tscore\tn\tflag\n"


def test_regions(spark, written):
    path, rows = written
    got = rf.read(spark, path, SCHEMA, 20_000)
    for chrom, start, end in [("chr1", 1_000_000, 1_020_000), ("chr1", 0, 1), ("chrÜ", 16_383, 16_385), ("chr2", 0, 1 << 40), ("none", 0, 10)]:
        found = got.where((F.col("chrom") == chrom) & (F.col("start_pos") < end) & (F.col("end_pos") > start))
        assert sorted(map(str, map(tuple, found.collect()))) == sorted(str(r) for r in rows if r[0] == chrom and r[1] < end and r[2] > start)


def test_a_region_reads_few_blocks(spark, written):
    def read(filters):
        reader = rf.RegionReader({"path": written[0], "split_bytes": "20000"}, spark.createDataFrame([], SCHEMA).schema)
        list(reader.pushFilters(filters))
        n = 0
        for s in reader.partitions():
            list(reader.read(s))
            n += reader.blocks_read
        return n

    assert read([EqualTo(("chrom",), "chr10"), LessThan(("start_pos",), 2_010_000), GreaterThan(("end_pos",), 2_000_000)]) < read([]) / 3


def test_what_can_not_be_written(spark, tmp_path):
    for row, what in ((("chr1", None, 5), "position"), ((None, 1, 5), "position"), (("chr\t1", 1, 5), "tab")):
        with pytest.raises(Exception, match=what):
            rf.write(spark.createDataFrame([row], "chrom string, start_pos long, end_pos long"), str(tmp_path / "a"))
    with pytest.raises(Exception, match="first columns"):
        rf.write(spark.createDataFrame([(1, "c", 2)], "start_pos long, chrom string, end_pos long"), str(tmp_path / "b"))
    rf.write(spark.createDataFrame([], "chrom string, start_pos long, end_pos long"), str(tmp_path / "c"))
    assert rf.read(spark, str(tmp_path / "c"), "chrom string, start_pos long, end_pos long").count() == 0
    for k in range(2):
        rf.write(spark.createDataFrame([("c", k, 9)], "chrom string, start_pos long, end_pos long"), str(tmp_path / "d"), "overwrite")
    assert [tuple(r) for r in rf.read(spark, str(tmp_path / "d"), "chrom string, start_pos long, end_pos long").collect()] == [("c", 1, 9)]
