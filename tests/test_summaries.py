"""Levels of a signal, chunks of sequences, grids of points."""

import random
from collections import Counter

from pyspark.sql import functions as F

from lociq.operators import summaries as sm
from lociq.sources import sequences as sq


def test_ranges(spark):
    r = random.Random(6)
    top = sm.block(sm.LEVELS - 1)
    edge = lambda: max(0, r.choice([0, 1, sm.WIDTH, sm.block(2), top, 2 * top]) * r.choice([1, 3]) + r.randrange(-2, 3))
    signal = []
    for _ in range(400):
        s = r.choice([edge(), r.randrange(3 * top)])
        signal.append((r.choice("xy"), s, s + r.choice([0, 1, 100, 5000, 300_000]), r.randrange(-50, 1000)))
    regions = []
    for k in range(150):
        a, b = sorted((r.choice([edge(), r.randrange(3 * top)]), r.choice([edge(), r.randrange(3 * top)])))
        regions.append((k, r.choice("xyz"), a, b))
    want = {}
    for k, c, a, b in regions:
        hit = [(v, min(b, e) - max(a, s)) for d, s, e, v in signal if d == c and max(a, s) < min(b, e)]
        if hit:
            want[k] = (max(v for v, _ in hit), sum(v * n for v, n in hit), sum(n for _, n in hit))
    got = sm.range_summaries(spark.createDataFrame(regions, "k int, chrom string, start_pos long, end_pos long"), "k", spark.createDataFrame(signal, "chrom string, start_pos long, end_pos long, v long"), "v")
    assert {r["k"]: (r["top"], r["total"], r["bases"]) for r in got.collect()} == want and len(want) > 60


def test_edges_of_ranges_make_no_pairs(spark):
    """A piled-up edge, null values and contigs, floats: the sums come from the bases of a block, and no pair is read from lists."""
    signal = [("x", 100 + k % 7, 4000 + k % 300, None if k % 5 == 0 else k / 4) for k in range(3000)] + [(None, 0, 9000, 1.0), ("y", 4095, 4097, None)]
    regions = [(k, c, s, e) for k, (c, s, e) in enumerate([("x", 90, 4200), ("x", 0, 8192), ("x", 4297, 9000), ("x", 4200, 4296), (None, 0, 9000), ("y", 4000, 4096), ("y", 4097, 20000), ("y", 0, 20000)])]
    out = sm.range_summaries(spark.createDataFrame(regions, "k int, chrom string, start_pos int, end_pos int"), "k", spark.createDataFrame(signal, "chrom string, start_pos long, end_pos long, v double"), "v")
    want = {}
    for k, c, a, b in regions:
        hit = [(v, min(b, e) - max(a, s)) for d, s, e, v in signal if d == c and c is not None and max(a, s) < min(b, e)]
        if hit:
            known = [(v, n) for v, n in hit if v is not None]
            want[k] = (max((v for v, _ in known), default=None), sum(v * n for v, n in known) if known else None, sum(n for _, n in hit))
    assert {r["k"]: (r["top"], r["total"], r["bases"]) for r in out.collect()} == want and len(want) == 6
    assert "inline(" not in out._jdf.queryExecution().executedPlan().toString()


def test_a_wide_range_is_few_blocks(spark):
    wide = spark.createDataFrame([(3, 3 * 10**8 + 7), (0, 2 * sm.block(5)), (5, 9), (sm.WIDTH, 2 * sm.WIDTH)], "s long, e long")
    got = wide.select(F.size(sm.blocks_of(F.col("s"), F.col("e"))).alias("n"), F.expr("0").alias("z"), sm.edges_of(F.col("s"), F.col("e")).alias("edges")).collect()
    most = 2 * (sm.FACTOR - 1) * (sm.LEVELS - 1) + 3 * 10**8 // sm.block(sm.LEVELS - 1)
    assert 1 < got[0]["n"] <= most and got[1]["n"] == 2 and got[2]["n"] == 0 and got[3]["n"] == 1
    assert [len(r["edges"]) for r in got] == [2, 0, 1, 0]


def test_sequences(spark, tmp_path):
    r = random.Random(2)
    seqs = {f"c{k}": "".join(r.choice("ACGTn") for _ in range(r.choice([0, 1, 59, 60, 61, 1000, 5000]))) for k in range(9)}
    for half in (0, 1):
        lines = [x for k, (n, s) in enumerate(seqs.items()) if k % 2 == half for x in (f">{n} some words", *(s[a : a + 60] for a in range(0, len(s), 60)))]
        (tmp_path / f"{half}.fa").write_text(("\r\n" if half else "\n").join(lines) + "\n")
    for size in (64, 100, 7000):
        spark.conf.set("spark.sql.files.maxPartitionBytes", "500")  # records over many splits
        table = sq.chunks(spark, str(tmp_path), size).cache()
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        whole = {}
        for c in table.orderBy("chrom", "chunk").collect():
            assert len(c["seq"]) <= size and c["chunk"] * size == len(whole.get(c["chrom"], ""))
            whole[c["chrom"]] = whole.get(c["chrom"], "") + c["seq"]
        assert whole == {n: s for n, s in seqs.items() if s}
        asked = [(k, r.choice([*seqs, "none"]), a, a + r.choice([0, 1, 63, 64, 65, 900])) for k in range(60) for a in [r.randrange(0, 5200)]]
        got = {x["k"]: x["seq"] for x in sq.fetch(table, spark.createDataFrame(asked, "k int, chrom string, start_pos long, end_pos long"), "k", size).collect()}
        assert got == {k: seqs.get(c, "")[a:b] for k, c, a, b in asked}
        table.unpersist()


def test_raster(spark):
    r = random.Random(3)
    points = [(r.choice([None, r.uniform(-1, 5)]), r.uniform(0, 2), r.choice(["p", "q", None])) for _ in range(2000)] + [(0.0, 0.0, "p"), (4.0, 1.0, "p")]
    got = {(x["level"], x["px"], x["py"], x["kind"]): x["n"] for x in sm.raster(spark.createDataFrame(points, "x double, y double, kind string"), "x", "y", (0, 4, 0, 1), (32, 8), "kind", 2).collect()}
    want = Counter((k, int(x / 4 * 32) >> k, int(y * 8) >> k, kind) for x, y, kind in points if x is not None and 0 <= x < 4 and 0 <= y < 1 for k in range(3))
    assert got == want
