"""Queries over whole tables against brute force on the smallest tables."""

import math
from bisect import bisect_left, bisect_right
from collections import defaultdict

import pytest

from lociq.plans import catalog
from lociq.plans.scalar_queries import WEIGHTS, aligned
from lociq.sources.proxies import anno, peaks, reads, table

SF = "/root/testdata/sf0.001"


def rows(df):
    return df.toArrow().to_pylist()


def found(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    return sorted((tuple(r.values()) for r in rows(df)), key=str)


@pytest.fixture(scope="module")
def peak(spark):
    return rows(peaks(spark, SF))


@pytest.fixture(scope="module")
def place(spark):
    return rows(anno(spark, SF))


@pytest.fixture(scope="module")
def dense(peak):
    top = {}
    for p in peak:
        for at in range(p["start_pos"], p["end_pos"]):
            top[p["chrom"], at] = max(top.get((p["chrom"], at), 0), p["n_reads"])
    return top


def test_region_fetch(spark, place):
    r = rows(reads(spark, SF).select("event_id", "chrom", "start_pos", "end_pos"))
    want = [(a["anno_id"], x["event_id"]) for a in place for x in r if a["chrom"] == x["chrom"] and a["start_pos"] - 500 < x["end_pos"] and x["start_pos"] < a["end_pos"] + 500]
    assert found(spark, "src14_region_fetch") == sorted(want, key=str) and len({a for a, _ in want}) > 100


def test_dense_values(spark, dense):
    got = rows(catalog.QUERIES["src16_dense_values_whole"](spark, SF))
    assert len(got) == len(dense) and {(r["chrom"], r["pos"]): r["value"] for r in got} == dense


def test_track_max(spark, dense):
    got = sorted((r["chrom"], r["start_pos"], r["end_pos"], r["n_reads"]) for r in rows(catalog.QUERIES["a17_track_max"](spark, SF)))
    assert sum(e - s for _, s, e, _ in got) == sum(v > 10 for v in dense.values())
    assert all(dense[c, at] == v for c, s, e, v in got for at in range(s, e))
    assert all(a[0] != b[0] or a[2] < b[1] or (a[2] == b[1] and a[3] != b[3]) for a, b in zip(got, got[1:], strict=False))


def test_motif_score(spark):
    def best(s):
        return max(sum(w.get(b, 0) for w, b in zip(WEIGHTS, s[i:], strict=False)) for i in range(len(s) - len(WEIGHTS) + 1))

    want = {r["event_id"]: max(best(r["seq"]), best(r["seq"][::-1].translate(str.maketrans("ACGT", "TGCA")))) for r in rows(aligned(spark, SF))}
    got = {r["event_id"]: r["best"] for r in rows(catalog.QUERIES["w19_motif_score"](spark, SF))}
    assert got.keys() == want.keys() and len(got) > 500 and all(math.isclose(got[k], want[k], abs_tol=1e-5) for k in got)


def test_allele_frequency(spark):
    li, total = rows(table(spark, SF, "lineitem")), defaultdict(float)
    for r in li:
        total[r["l_partkey"]] += float(r["l_discount"])
    got = rows(catalog.QUERIES["a33_allele_frequency"](spark, SF))
    want = sorted((r["l_orderkey"], r["l_linenumber"], r["l_suppkey"], round(total[r["l_partkey"]], 4)) for r in li)
    assert sorted((r["l_orderkey"], r["l_linenumber"], r["l_suppkey"], round(float(r["af"]), 4)) for r in got) == want


def test_membership(spark):
    bad = {r["l_suppkey"] for r in rows(table(spark, SF, "lineitem")) if r["l_quantity"] > 49}
    want = [(r["s_suppkey"], c := r["s_nationkey"] in (1, 3, 5), r["s_suppkey"] in bad, c and r["s_suppkey"] not in bad) for r in rows(table(spark, SF, "supplier"))]
    assert found(spark, "f04_membership") == sorted(want, key=str)


def overlapping(peak, place):
    by = defaultdict(list)
    for a in place:
        by[a["chrom"]].append(a)
    for p in peak:
        hit = [a for a in by[p["chrom"]] if p["start_pos"] < a["end_pos"] and a["start_pos"] < p["end_pos"]]
        yield p, hit


def test_overlap_left_and_bases(spark, peak, place):
    left, bases = [], []
    for p, hit in overlapping(peak, place):
        head = tuple(p[c] for c in ("l_orderkey", "l_linenumber", "cell_id", "start_pos", "end_pos"))
        left += [(*head, a["anno_id"], a["start_pos"], a["end_pos"]) for a in hit] or [(*head, -1, -1, -1)]
        bases += [(*head, a["anno_id"], min(p["end_pos"], a["end_pos"]) - max(p["start_pos"], a["start_pos"])) for a in hit] or [(*head, -1, 0)]
    assert found(spark, "j07_overlap_left") == sorted(left, key=str)
    assert found(spark, "j08_overlap_bases") == sorted(bases, key=str)


def gaps(a, b, by):
    ends, starts = defaultdict(list), defaultdict(list)
    for x in b:
        k = tuple(x[c] for c in by)
        ends[k].append(x["end_pos"])
        starts[k].append(x["start_pos"])
    for xs in (*ends.values(), *starts.values()):
        xs.sort()
    out = set()
    for x in a:
        k = tuple(x[c] for c in by)
        i, j = bisect_right(ends[k], x["start_pos"]), bisect_left(starts[k], x["end_pos"])
        near = [x["start_pos"] - ends[k][i - 1]] * (i > 0) + ([starts[k][j] - x["end_pos"]] if j < len(starts[k]) else [])
        out.add((*(x[c] for c in dict.fromkeys((*by, "chrom", "start_pos", "end_pos"))), min(near, default=None)))
    return sorted(out, key=str)


@pytest.mark.parametrize(("name", "own", "by"), [("j12_nearest", False, ("chrom",)), ("j13_nearest_self", True, ("chrom",)), ("j14_nearest_by_donor", False, ("donor_id", "chrom"))])
def test_nearest(spark, peak, place, name, own, by):
    names = [*dict.fromkeys((*by, "chrom", "start_pos", "end_pos")), "distance"]
    got = sorted((tuple(r[c] for c in names) for r in rows(catalog.QUERIES[name](spark, SF))), key=str)
    assert got == gaps(peak, peak if own else [a for a in place if a["anno"] == "1-URGENT"], by)
