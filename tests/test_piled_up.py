"""Operators on piled-up rows: what they exchange and hold grows with the rows, and not with pairs or frames of them."""

import random

from pyspark.sql import functions as F

from lociq.functions import alignment as al
from lociq.operators import intervals as iv
from lociq.operators import regions as rg
from lociq.plans import catalog

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_centred_counts_of_nulls_and_piles(spark):
    """Rows without a position or a contig count each other, as in SQL; no sliding frame is walked."""
    r = random.Random(3)
    rows = [(i, r.choice(["a", "b", None]), r.choice([None, 131_071, 131_072, r.randrange(400_000)])) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, chrom string, at long")
    out = rg.centred_count(df, "at", 3000, "n")
    assert "Window [count" not in plan(out) and "specifiedwindowframe(RangeFrame" not in plan(out)
    near = lambda x, y: x[1] == y[1] and (x[2] is None and y[2] is None or None not in (x[2], y[2]) and abs(x[2] - y[2]) <= 3000)
    assert {x["id"]: x["n"] for x in out.collect()} == {x[0]: sum(near(x, y) for y in rows) for x in rows}


def test_sums_without_pairs(spark):
    """j21 and j15 count and sum by sweeps: no join on the bins of pairs."""
    r = random.Random(8)
    a = [(i, r.choice("ab"), s := r.randrange(3000), s + r.randrange(1, 900)) for i in range(80)]
    b = [(r.choice("ab"), s := r.randrange(3000), s + r.randrange(0, 900), r.choice([None, -4, 9])) for _ in range(90)]
    found = iv.sum_overlaps(spark.createDataFrame(a, "id long, chrom string, start_pos long, end_pos long"), spark.createDataFrame(b, "chrom string, start_pos long, end_pos long, v long"), {"v": F.col("v")})
    want = {i: sum(v or 0 for d, s, e, v in b if c == d and x < e and s < y) for i, c, x, y in a}
    assert {x["id"]: x["v"] for x in found.collect()} == want
    for name in ("j21_strand_blind", "j15_reads_in_regions"):
        assert "sequence(" not in plan(catalog.QUERIES[name](spark, SF)), name


def test_left_overlaps_exchange_no_pairs(spark):
    """Pairs are joined once and not made distinct to find the rows without partners."""
    for name in ("j07_overlap_left", "j08_overlap_bases"):
        text = plan(catalog.QUERIES[name](spark, SF)).partition("== Initial Plan ==")[0]
        assert text.count("sequence(") == 2, name


def test_downsample_sorts_what_can_matter(spark):
    """Rows whose hash lies far beyond the last one taken never reach the sort."""
    assert "slot" in plan(catalog.QUERIES["o07_downsample"](spark, SF))


def test_donors_are_sent(spark):
    """Peaks are never dealt by their few donors, whatever Spark thinks of the donors' size."""
    from lociq.plans.learning_queries import labelled

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" not in plan(labelled(spark, SF)) and "Exchange hashpartitioning" not in plan(labelled(spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_motif_best_is_the_highest_score(spark):
    r = random.Random(1)
    weights = al.motif_weights(["ACG", "TCG"])
    rows = [(None,), ("",), ("AC",), ("ACG",), ("\U0001f600ACGé",)] + [("".join(r.choice("ACGTNacgt") for _ in range(r.randrange(9))),) for _ in range(200)]
    df = spark.createDataFrame(rows, "s string").select(F.array_max(al.motif_scores(F.col("s"), weights)).alias("a"), al.motif_best(F.col("s"), weights).alias("b"))
    assert df.where("not (a <=> b)").isEmpty()
    assert "ArrowEvalPython" in plan(catalog.QUERIES["w19_motif_score"](spark, SF))


def test_best_overlap_and_track_max_against_all_pairs(spark):
    """Tiles' edges, wide, empty and null intervals; no pairs of intervals are gathered."""
    r = random.Random(6)
    at = lambda: r.choice([0, iv.TILE - 1, iv.TILE, iv.TILE + 1, r.randrange(5 * iv.TILE)])
    span = lambda: (s := at(), s + r.choice([0, 1, 2, 300, iv.TILE, 3 * iv.TILE]))
    a = [(i, r.choice(["a", "b", None]), *span()) for i in range(150)]
    b = [(r.choice(["a", "b", None]), *span(), r.choice([None, 1, 2, 3])) for _ in range(60)]
    da = spark.createDataFrame(a, "id long, chrom string, start_pos long, end_pos long")
    db = spark.createDataFrame(b, "chrom string, start_pos long, end_pos long, v long")
    got = {x["id"]: (x["v"], -x["back"]) for x in iv.best_overlap(da, "id", db, {"v": F.col("v"), "back": -F.col("start_pos")}).collect()}
    want = {}
    for i, c, s, e in a:
        met = [(v, x) for d, x, y, v in b if c is not None and c == d and s < y and x < e]
        if met:
            want[i] = max(met, key=lambda m: (m[0] is not None, m[0] or 0, -m[1]))
    assert got == want
    bases = {}
    for d, x, y, v in b:
        for p in range(x, y) if d is not None and v is not None and v > 1 else ():
            bases[d, p] = max(bases.get((d, p), 0), v)
    runs = iv.track_max(db, "v", 1).collect()
    assert {(x["chrom"], p): x["v"] for x in runs for p in range(x["start_pos"], x["end_pos"])} == bases
    ends = {(x["chrom"], x["end_pos"], x["v"]) for x in runs}
    assert not any((x["chrom"], x["start_pos"], x["v"]) in ends for x in runs)
    for name in ("w11_peak_summit", "src17_signal_max"):
        assert "FlatMapCoGroupsInPandas" in plan(catalog.QUERIES[name](spark, SF)), name


def test_ratios_round_as_in_sql(spark):
    """Ratios that end in a five at the seventh digit: 249 of 2,000,000 is 0.000124 in SQL."""
    import duckdb

    from lociq.plans.locus_queries import D6

    rows = [(k, k / 2_000_000) for k in (249, 251, 253, 493, 507, 1_999_999, 0)] + [(None, None)]
    found = {x["k"]: x["r"] for x in spark.createDataFrame(rows, "k long, x double").select("k", D6(F.col("x"), "r")).collect()}
    assert found == {k: duckdb.execute("select round(?::double, 6)", [x]).fetchone()[0] for k, x in rows}


def test_blocks_of_ranges_are_not_sent(spark):
    """Ranges become many blocks each, so neither these nor their edges go through the driver."""
    assert "BroadcastExchange" not in plan(catalog.QUERIES["src17_range_summaries"](spark, SF))
