"""Clusters of rows are looked up by place; the sweeps see distinct starts only."""

import random

import pytest

from lociq.operators import loci
from lociq.plans import catalog

SF = "/root/testdata/sf0.001"


def numbers(rows, slack):
    """The cluster of each distinct (chrom, start, end)."""
    out, reach, k = {}, {}, {}
    for c, s, e in sorted({r[1:] for r in rows}):
        if c not in reach or s > reach[c] + slack:
            k[c] = k.get(c, 0) + 1
        reach[c] = max(reach.get(c, e), e)
        out[c, s, e] = k[c]
    return out


@pytest.mark.parametrize("slack", [0, 100, -3])
def test_clusters_of_piled_and_odd_loci(spark, slack):
    """Equal starts, empty loci, ends before starts, edges of bins; rows of one cell and place are kept apart."""
    r = random.Random(slack)
    rows = [(i, r.choice("ab"), s := r.choice([0, 1023, 1024, 1025, r.randrange(9000)]), s + r.choice([-40, -1, 0, 1, 2, 60, 700])) for i in range(250)]
    found = loci.clustered(spark.createDataFrame([*rows, (900, "a", None, 4), (901, "b", 4, None), (902, None, 4, 9)], "id long, chrom string, start_pos long, end_pos long").where("end_pos is not null and start_pos is not null"), slack)
    want = numbers(rows, slack)
    assert sorted((x["id"], x["cluster"]) for x in found.collect()) == [(i, want[c, s, e]) for i, c, s, e in rows]


def test_rows_are_not_joined_by_locus(spark):
    """Rows meet the clusters of their bin; they are not exchanged and sorted by their whole locus."""
    text = catalog.QUERIES["a15_cluster_representatives"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Join [chrom" in text and "end_pos" not in text.partition("Join [")[2].partition("]")[0] and "_bin" in text.partition("Join [")[2].partition("]")[0]
