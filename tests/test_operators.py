"""Interval edge cases, greedy peaks, readers and curves on hand-made rows."""

import gzip
import itertools
import random

import pytest

from lociq.functions import alignment as al
from lociq.functions.frames import first_label, where_query
from lociq.operators import evaluation as ev
from lociq.operators import intervals as iv
from lociq.operators import learning as ln
from lociq.operators import loci
from lociq.operators import regions as rg
from lociq.sources import readers as rd

SCHEMA = "id long, chrom string, start_pos long, end_pos long"
EDGE = [(0, "a", 0, 10), (1, "a", 10, 20), (2, "a", 0, 100), (3, "a", 0, 10), (4, "a", 5000, 9000), (5, "b", 0, 1), (6, "c", 7, 9)]


def frames(spark, seed=0):
    r = random.Random(seed)
    rows = lambda k: EDGE + [(i, r.choice("ab"), s := r.randrange(12000), s + r.randrange(1, 3000)) for i in range(10, k)]
    a, b = rows(80), rows(60)[1:]
    return a, b, spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA)


def meets(x, y):
    return x[1] == y[1] and x[2] < y[3] and y[2] < x[3]


def test_overlap_pairs_and_counts(spark):
    a, b, da, db = frames(spark)
    pairs = {(r["id"], r["b_id"], r["overlap"]) for r in iv.overlap_pairs(da, db, width=64).collect()}
    assert pairs == {(x[0], y[0], min(x[3], y[3]) - max(x[2], y[2])) for x in a for y in b if meets(x, y)}
    counts = {r["id"]: r["n"] for r in iv.count_overlaps(da, db, "n").collect()}
    assert counts == {x[0]: sum(meets(x, y) for y in b) for x in a}
    hit = {x[0] for x in a if any(meets(x, y) for y in b)}
    assert {r["id"] for r in iv.semi(da, db).collect()} == hit
    assert {r["id"] for r in iv.anti(da, db).collect()} == {x[0] for x in a} - hit
    left = iv.overlap_left(da, db, ["id"]).collect()
    assert {r["id"] for r in left if r["b_start_pos"] == -1} == {x[0] for x in a} - hit


def test_nearest(spark):
    a, b, da, db = frames(spark, 1)
    found = {r["id"]: r["distance"] for r in iv.nearest(da, db).collect()}
    for x in a:
        gaps = [x[2] - y[3] if y[3] <= x[2] else y[2] - x[3] for y in b if y[1] == x[1] and not meets(x, y)]
        assert found[x[0]] == min(gaps, default=None)


@pytest.mark.parametrize("slack", [0, 50])
def test_cluster(spark, slack):
    a, _, da, _ = frames(spark, 2)
    groups = {}
    for r in iv.cluster(da, slack, order=("id",)).collect():
        groups.setdefault((r["chrom"], r["cluster"]), set()).add(r["id"])
    want = []
    for _, rows in itertools.groupby(sorted(a, key=lambda x: x[1:]), key=lambda x: x[1]):
        reach = None
        for x in rows:
            if reach is None or x[2] > reach + slack:
                want.append(set())
                reach = x[3]
            want[-1].add(x[0])
            reach = max(reach, x[3])
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want))
    assert iv.merge(da, slack).count() == len(want)


def test_segments_cover_each_base(spark):
    rows = [(0, "a", 0, 5), (1, "a", 3, 9), (2, "a", 3, 4), (3, "b", 1, 2)]
    got = {(r["chrom"], p): r["depth"] for r in iv.depth(spark.createDataFrame(rows, SCHEMA)).collect() for p in range(r["start_pos"], r["end_pos"])}
    want = {}
    for _, c, s, e in rows:
        for p in range(s, e):
            want[c, p] = want.get((c, p), 0) + 1
    assert got == want


def test_step_one_peaks(spark):
    r = random.Random(4)
    ends = sorted(r.randrange(4000) for _ in range(150))
    df = spark.createDataFrame([(i, "a", p) for i, p in enumerate(ends)], "event_id long, chrom string, three_end long")
    got = sorted((x["start_pos"], x["end_pos"]) for x in rg.step_one_peaks(df, 50, 4, -25, 5000).collect())
    want = []
    for s in range(5000 - 50 + 1):
        if sum(s <= p < s + 50 for p in ends) >= 4:
            if want and s <= want[-1][1] - 25:
                want[-1][1] = s + 50
            else:
                want.append([s, s + 50])
    assert got == [tuple(w) for w in want]


def test_greedy_peaks(spark):
    r = random.Random(5)
    rows = [("a", s := r.randrange(3000), s + 50, r.randrange(1, 30)) for _ in range(200)]
    df = spark.createDataFrame(rows, "chrom string, start_pos long, end_pos long, n_reads long").distinct()
    chosen = []
    for c, s, e, n in sorted(set(rows), key=lambda x: (-x[3], x[1])):
        if n >= 5 and not any(s - 20 <= y and x <= e + 20 for x, y in chosen):
            chosen.append((s, e))
    assert sorted((x["start_pos"], x["end_pos"]) for x in rg.greedy_peaks(df, 5, 20).collect()) == sorted(chosen)


def test_readers(spark, tmp_path):
    (tmp_path / "a.bed").write_text("#c\nchr1\t0\t10\nchr2\t5\t6\n")
    assert rd.bed(spark, str(tmp_path / "a.bed")).count() == 2
    with gzip.open(tmp_path / "r.fastq.gz", "wt") as f:
        f.write("@M:1:FC:2:1:1:ACGT\nACGT\n+\nIIII\n@M:1:FC:3:1:1:ACGA\nAC\n+\nII\n")
    q = rd.fastq(spark, str(tmp_path / "r.fastq.gz"))
    assert [r["seq"] for r in q.collect()] == ["ACGT", "AC"]
    assert rd.read_groups(q).first()["groups"] == ["FC:2:ACGT", "FC:3:ACGA"]
    (tmp_path / "s.fa").write_text(">one x\nACG\nTT\n>two\nGG\n")
    assert {tuple(r) for r in rd.fasta(spark, str(tmp_path / "s.fa")).collect()} == {("one", "ACGTT"), ("two", "GG")}
    (tmp_path / "f.txt").write_text("100 + 0 in total\n7 + 0 secondary\n")
    assert rd.flagstat(spark, str(tmp_path / "f.txt"), {0: "total", 1: "secondary"}).first()[1:] == (100, 7)
    (tmp_path / "t.log").write_text("Total read pairs processed:   1,234\nPairs written (passing filters):  1,000 (81%)\n")
    assert rd.trim_log(spark, str(tmp_path / "t.log")).first()[1:] == (1234, 1000)
    (tmp_path / "q.txt").write_text(">>Basic\tpass\n#M\tV\nx\t1\n>>END_MODULE\n>>Other\tfail\ny\t2\n>>END_MODULE\n")
    assert {tuple(r)[1:] for r in rd.sections(spark, str(tmp_path / "q.txt")).collect()} == {("Basic", "pass", "x\t1"), ("Other", "fail", "y\t2")}
    (tmp_path / "v.vcf").write_text("##x\nchr1\t5\ti\tA\tACG\t.\tPASS\tAN=2;AC=1\tGT\t0/1\nchr1\t6\tj\tA\tT\t.\tPASS\tAC=1\tGT\t0/1\n")
    assert [tuple(r) for r in rd.vcf_intervals(rd.vcf(spark, str(tmp_path / "v.vcf"))).collect()] == [("chr1", 4, 5, "i", 1)]
    df = spark.createDataFrame([("chr1", 1, 2)], "chrom string, start_pos long, end_pos long")
    rd.parquet_by_contig(df, str(tmp_path / "out"))
    rd.table_file(df, str(tmp_path / "tab"))
    assert rd.bed(spark, str(tmp_path / "tab")).first()[0] == "chr1"


def test_curves_of_one_class(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1.0, True), (2.0, True)], "s double, y boolean")
    assert ev.roc_curve(df, F.col("y"), "s").where("fpr is not null").count() == 0
    assert ev.pr_curve(df, F.col("y"), "s").where("threshold = 1").first()["recall"] == 1


def test_helpers(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "AACGT", "10S5M"), (2, "", "5M")], "x long, s string, c string")
    assert [r[0] for r in df.select(al.reverse_complement(F.col("s"))).collect()] == ["ACGTT", ""]
    assert where_query(df, "x == @v", v=2).count() == 1
    assert where_query(df, "s == 'AACGT' and c <> '@v == 1' and s <> @o", o="it's").count() == 1
    assert {r[0] for r in df.select(first_label(df, [("one", F.col("x") == 1), ("no", "missing")], "else")).collect()} == {"one", "else"}
    with pytest.raises(ValueError):
        ln.donor_split(df.withColumn("fold", F.lit(0)), 0, [1], [1], "x")
    peaks = spark.createDataFrame([("a", 0, 10, 1, 1, 5, "OTHER"), ("a", 5, 15, 2, 1, 7, "KRGL"), ("a", 100, 110, 3, 2, 1, "OTHER")], "chrom string, start_pos long, end_pos long, cell_id long, donor_id long, n_reads long, label string")
    assert sorted((r["n_cells"], r["label"]) for r in loci.cluster_stats(peaks).collect()) == [(1, "OTHER"), (2, "KRGL")]


def test_attributions_add_up(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.sql import functions as F

    r = random.Random(2)
    df = spark.createDataFrame([(x := r.random(), r.random(), 3.0, float(x > 0.5)) for _ in range(200)], "a double, b double, c double, label double")
    model = ln.pipeline(["a", "b", "c"], LogisticRegression(maxIter=20)).fit(df)
    phi = ln.attributions(model, model.transform(df), ["a", "b", "c"])
    from pyspark.ml.functions import vector_to_array

    off = phi.select(F.max(F.abs(F.col("phi_a") + F.col("phi_b") + F.col("phi_c") + F.col("phi_0") - vector_to_array("rawPrediction")[1]))).first()[0]
    assert off < 1e-9
    assert len(ln.sampled({"x": [1, 2], "y": [3, 4]}, 3)) == 3


def test_greedy_peaks_across_stretches(spark):
    """Chains that reach over the edges of many short stretches."""
    r = random.Random(9)
    rows = [(c, s := r.randrange(60_000), s + r.randrange(20, 90), r.randrange(1, 40)) for c in "ab" for _ in range(1500)]
    df = spark.createDataFrame(rows, "chrom string, start_pos long, end_pos long, n_reads long").distinct()
    chosen = []
    for c, s, e, n in sorted(set(rows), key=lambda x: (-x[3], x[1], x[2])):
        if n >= 5 and not any(k == c and s - 20 <= y and x <= e + 20 for k, x, y in chosen):
            chosen.append((c, s, e))
    assert sorted((x["chrom"], x["start_pos"], x["end_pos"]) for x in rg.greedy_peaks(df, 5, 20, span=1000).collect()) == sorted(chosen)
    assert rg.greedy_peaks(df, 10**6, 20).count() == 0


def test_wiggle(spark, tmp_path):
    from lociq.sources import readers as rd

    (tmp_path / "a.wig").write_text("track type=wiggle_0\n# a comment\nfixedStep chrom=chr3 start=400 step=100 span=5\n11\n22.5\nvariableStep chrom=chrX\n300 -1\n7 2\nfixedStep chrom=chr4 start=1\n9\n8\n")
    assert [tuple(r) for r in rd.wig(spark, str(tmp_path / "a.wig")).collect()] == [("chr3", 400, 11.0), ("chr3", 500, 22.5), ("chrX", 300, -1.0), ("chrX", 7, 2.0), ("chr4", 1, 9.0), ("chr4", 2, 8.0)]
    rows = [(f"chr{k % 3}", k * 7, float(k)) for k in range(5000)]
    rd.write_wig(spark.createDataFrame(rows, "chrom string, start_pos long, value double"), str(tmp_path / "w"), 7)
    assert sorted(map(tuple, rd.wig(spark, str(tmp_path / "w")).collect())) == sorted((c, s + 1, v) for c, s, v in rows)
    assert sum(f.read_text().count("Step") for f in (tmp_path / "w").glob("part*")) < 40


def exchanges(df) -> int:
    """Exchanges of a plan as it stands, without adaptive changes and broadcasts."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") + df._jdf.queryExecution().executedPlan().toString().count("Exchange rangepartitioning")


def test_sweeps_move_rows_once(spark):
    """A last sweep holds one exchange of its rows, and small ones of a row for each bin; earlier sweeps are written, so plans don't grow with their powers."""
    rows = spark.createDataFrame([("c", k, k + 5, k) for k in range(50)], "chrom string, start_pos long, end_pos long, v long")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        plans = {"cluster": iv.cluster(rows), "segments": iv.segments(rows), "depth": iv.depth(rows), "runs": iv.run_lengths(rows.where("v % 5 = 0"), "v"), "count": iv.count_overlaps(rows, rows, "n"), "nearest": iv.nearest(rows, rows)}
        found = {k: exchanges(df) for k, df in plans.items()}
        assert all(n <= {"depth": 5, "runs": 5, "count": 8, "nearest": 8}.get(k, 4) for k, n in found.items()), found
    finally:
        for k in settings:
            spark.conf.unset(k)
