"""Counts, hits and gaps that rows look up in tables of marks, against all pairs."""

import random

from pyspark.sql import functions as F

from lociq.operators import intervals as iv
from lociq.plans import catalog

SF = "/root/testdata/sf0.001"
SCHEMA = "id long, chrom string, start_pos long, end_pos long, v long"
TILE = 1 << iv.STEP


def intervals(r, n, widths):
    """Edges of tiles and of words, tiles far away and below zero, and nulls."""
    at = lambda: r.choice([-1, 0, 63, 64, TILE - 1, TILE, TILE + 1, 2 * TILE + 127, -5 * TILE, 40 * TILE, None, r.randrange(6 * TILE), r.randrange(200)])
    ends = lambda s: (s, None if s is None or r.random() < 0.03 else s + r.choice(widths))
    return [(i, r.choice(["a", "b", None]), *ends(at()), r.choice([None, -4, 9])) for i in range(n)]


def meets(x, y):
    return None not in (*x[1:4], *y[1:4]) and x[1] == y[1] and x[2] < y[3] and y[2] < x[3]


def test_sums_and_gaps_against_all_pairs(spark):
    r = random.Random(11)
    widths = [1, 2, 63, 300, TILE, 3 * TILE]
    a = intervals(r, 400, widths)
    da = spark.createDataFrame(a, SCHEMA)
    for b in (intervals(r, 150, widths), intervals(r, 8, widths)):
        db = spark.createDataFrame(b, SCHEMA)
        found = {x["id"]: (x["n"], x["s"]) for x in iv.sum_overlaps(da, db, {"n": F.lit(1), "s": F.col("v")}).collect()}
        assert found == {x[0]: (sum(meets(x, y) for y in b), sum(y[4] or 0 for y in b if meets(x, y))) for x in a}
        gaps = {x["id"]: x["distance"] for x in iv.nearest(da, db).collect()}
        for i, c, s, e, _ in a:
            same = [y for y in b if c is not None and y[1] == c]
            left = [s - y[3] for y in same if None not in (s, y[3]) and y[3] <= s]
            right = [y[2] - e for y in same if None not in (e, y[2]) and y[2] >= e]
            assert gaps[i] == min(left + right, default=None)


def test_hits_are_those_of_sql(spark):
    """An empty interval within another meets it, though one at the same place does not."""
    r = random.Random(12)
    a = intervals(r, 300, [0, 1, 40, TILE]) + [(900, "a", 70, 70, 1)]
    b = intervals(r, 30, [0, 1, 40]) + [(901, "a", 70, 70, 1), (902, "a", 60, 80, 1)]
    hit = {x[0] for x in a if any(meets(x, y) for y in b)}
    da, db = spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA)
    assert 900 in hit and {x["id"] for x in iv.semi(da, db).collect()} == hit
    assert {x["id"] for x in iv.anti(da, db).collect()} == {x[0] for x in a} - hit


def test_rows_are_not_sorted_for_look_ups(spark):
    """Rows move to the tables and are read against them: no window or sort holds the rows of a bin, however many these are, and no copy of them is written."""
    for name, moves in (("j11_overlap_anti", 3), ("j13_nearest_self", 5), ("j08_label_flags", 5)):
        text = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in text and "Sort" not in text and "/lineitem.parquet" in text, name
        assert text.count("Exchange hashpartitioning") == moves, name  # tables included
