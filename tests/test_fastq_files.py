"""Files of four-line records in splits."""

import gzip
import random

import pytest

from lociq.sources import blocks as bl
from lociq.sources import fastq_files as fq
from lociq.sources import readers as rd


def records(n):
    r = random.Random(5)
    out = []
    for k in range(n):
        size = r.choice([0, 1, 36, 151, 151, 400])
        out.append((f"r{k} @x +{k}" + r.choice(["", " @", "/1"]), "".join(r.choice("ACGTN") for _ in range(size)), "".join(r.choice("@+IIF:,") for _ in range(size))))
    return out + [("long", "A" * 300_000, "@" * 300_000)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("kind", ["plain", "blocks"])
def test_splits(spark, tmp_path, kind, end):
    rows = records(4000)
    raw = end.join(x for n, s, q in rows for x in ("@" + n, s, "+", q)).encode()  # no line end at the end of the file
    block = lambda a: bl.compressed(raw[a : a + 7001])
    (tmp_path / "a.fastq").write_bytes(raw if kind == "plain" else b"".join(block(a) for a in range(0, len(raw), 7001)) + bl.LAST)
    for split in (1 << 30, 100_000, 33_333):
        got = fq.read(spark, str(tmp_path), split_bytes=split)
        assert [tuple(r)[:3] for r in got.collect()] == rows
    assert got.rdd.getNumPartitions() >= (40 if kind == "plain" else 12)


def test_other_files(spark, tmp_path):
    (tmp_path / "e.fastq").write_bytes(b"")
    assert fq.read(spark, str(tmp_path)).count() == 0
    (tmp_path / "a.gz").write_bytes(gzip.compress(b"@a\nAC\n+\nII\n"))
    with pytest.raises(Exception, match="one piece"):
        fq.read(spark, str(tmp_path), ".gz").count()
    assert [tuple(r)[1:] for r in rd.fastq(spark, str(tmp_path / "a.gz")).collect()] == [("a", "AC", "II")]
    for bad in (b"@a\nAC\n+\nI\n", b"a\nAC\n+\nII\n", b"@a\nAC\n+\n"):
        (tmp_path / "b.bad").write_bytes(bad)
        with pytest.raises(Exception, match="four lines|whole"):
            fq.read(spark, str(tmp_path), ".bad").count()
