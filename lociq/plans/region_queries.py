"""Filters, windows, features, rolling signals and aggregations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lociq.operators import intervals as iv
from lociq.operators import regions as rg
from lociq.plans.registry import query
from lociq.sources.proxies import CONTIG, anno, peaks, reads, table

LONG = lambda c: F.col(c).cast("long").alias(c)
R6 = lambda c, name: F.round(c, 6).alias(name)
N = lambda c: F.count(F.when(c, 1))
flag = lambda: F.col("flag")


@query("f01_flag_filter", "select event_id, chrom, three_end from reads where (flag & 1412) = 0 and (flag & 1) = 1 and mapq >= 30")
def f01(spark, sf):
    return reads(spark, sf).where(rg.passing(flag(), rg.NOT_COUNTED, 1) & (F.col("mapq") >= 30)).select("event_id", "chrom", "three_end")


@query("f02_read_predicates", "select event_id, (flag & 128) = 0 as first_mate, (flag & 4) = 0 and (flag & 2048) = 0 as mapped, (flag & 2) > 0 as proper from reads")
def f02(spark, sf):
    return reads(spark, sf).select("event_id", rg.passing(flag(), 128).alias("first_mate"), rg.passing(flag(), 4 | 2048).alias("mapped"), rg.passing(flag(), 0, 2).alias("proper"))


@query("f03_dynamic_filter", "select event_id, cell_id from reads where score > 20 and not (mapq < 10 or cell_id = 3)")
def f03(spark, sf):
    from lociq.functions.frames import where_query

    return where_query(reads(spark, sf), "score > @low and not (mapq < 10 or cell_id == @cell)", low=20, cell=3).select("event_id", "cell_id")


@query("f04_membership", "select s_suppkey, s_nationkey in (1, 3, 5) as chosen, s_suppkey in (select l_suppkey from lineitem where l_quantity > 49) as listed, s_nationkey in (1, 3, 5) and s_suppkey not in (select l_suppkey from lineitem where l_quantity > 49) as kept from supplier")
def f04(spark, sf):
    """Each supplier with both memberships, as few or none are left by the two together."""
    bad = table(spark, sf, "lineitem").where("l_quantity > 49").select(F.col("l_suppkey").alias("s_suppkey"), F.lit(True).alias("bad")).distinct()
    chosen, listed = F.col("s_nationkey").isin(1, 3, 5), F.coalesce("bad", F.lit(False))
    return table(spark, sf, "supplier").join(bad, "s_suppkey", "left").select("s_suppkey", chosen.alias("chosen"), listed.alias("listed"), (chosen & ~listed).alias("kept"))


@query("f05_substring_class", "select c_custkey, case when c_mktsegment like '%MACH%' or c_mktsegment like '%BUILD%' then 'bulk' else 'cell' end as kind from customer")
def f05(spark, sf):
    seg = F.col("c_mktsegment")
    return table(spark, sf, "customer").select("c_custkey", F.when(seg.contains("MACH") | seg.contains("BUILD"), "bulk").otherwise("cell").alias("kind"))


@query("f06_contig_whitelist", "select chrom, count(*) as n from reads where chrom in ('chr1', 'chr2', 'chr3') group by 1")
def f06(spark, sf):
    return reads(spark, sf).where(F.col("chrom").isin("chr1", "chr2", "chr3")).groupBy("chrom").agg(F.count("*").alias("n"))


@query("f07_label_regions", "select distinct concat(chrom, ':', start_pos, '-', end_pos) as locus, end_pos - start_pos as width, case when cell_id % 3 = 0 then 'DLPFC' when cell_id % 3 = 1 then 'HIPPO' else 'other' end as tissue, n_reads > 0 as has_reads from peaks")
def f07(spark, sf):
    tissue = F.when(F.col("cell_id") % 3 == 0, "DLPFC").when(F.col("cell_id") % 3 == 1, "HIPPO").otherwise("other")
    return peaks(spark, sf).select(iv.locus().alias("locus"), (F.col("end_pos") - F.col("start_pos")).alias("width"), tissue.alias("tissue"), F.col("n_reads").cast("boolean").alias("has_reads")).distinct()


@query("f08_precedence_label", "select event_id, case when flag & 1024 > 0 then 'DUP' when flag & 2 > 0 then 'PROPER' when mapq < 10 then 'LOWQ' else 'OTHER' end as label from reads")
def f08(spark, sf):
    from lociq.functions.frames import first_label

    r = reads(spark, sf)
    return r.select("event_id", first_label(r, [("DUP", flag().bitwiseAND(1024) > 0), ("PROPER", flag().bitwiseAND(2) > 0), ("LOWQ", F.col("mapq") < 10)], "OTHER").alias("label"))


@query("f09_bulk_relabel", "select distinct l_orderkey, l_linenumber, cell_id, case when n_reads > 25 then label when label = 'KNRGL' then 'bulk_absent' else 'OTHER' end as label from peaks")
def f09(spark, sf):
    return peaks(spark, sf).select("l_orderkey", "l_linenumber", "cell_id", F.when(F.col("n_reads") > 25, F.col("label")).when(F.col("label") == "KNRGL", "bulk_absent").otherwise("OTHER").alias("label")).distinct()


@query("f10_masked_overwrite", "select label, count(*) as n from (select case when n_reads > 45 then 'CLONAL' when n_reads > 40 and label = 'OTHER' then 'KNRGL' when n_reads < 3 then 'KRGL' else label end as label from peaks) group by 1")
def f10(spark, sf):
    from lociq.functions.frames import overwrite

    p = overwrite(peaks(spark, sf), "label", [(F.col("n_reads") < 3, "KRGL"), ((F.col("n_reads") > 40) & (F.col("label") == "OTHER"), "KNRGL"), (F.col("n_reads") > 45, "CLONAL")])
    return p.groupBy("label").agg(F.count("*").alias("n"))


@query("f11_legacy_label", "select anno_id, case when anno = '1-URGENT' then 'RMSK' when anno = '2-HIGH' then 'KNRGL' when strand is null then 'blacklist' else 'other' end as label from anno")
def f11(spark, sf):
    return anno(spark, sf).select("anno_id", F.when(F.col("anno") == "1-URGENT", "RMSK").when(F.col("anno") == "2-HIGH", "KNRGL").when(F.col("strand").isNull(), "blacklist").otherwise("other").alias("label"))


COUNTS = "select cell_id, count(*) as n, count(*) filter (flag & 16 = 0) as fwd, count(*) filter (flag & 16 > 0) as rev, count(*) filter (flag & 2 > 0) as proper from reads group by 1"


def cell_counts(spark, sf):
    return reads(spark, sf).groupBy("cell_id").agg(F.count("*").alias("n"), N(flag().bitwiseAND(16) == 0).alias("fwd"), N(flag().bitwiseAND(16) > 0).alias("rev"), N(flag().bitwiseAND(2) > 0).alias("proper"))


@query("f12_feature_ratios", f"select cell_id, round(abs(fwd - rev) / n, 6) as orientation_bias, round(proper / n, 6) as frac_proper, round(case when rev = 0 then null else fwd / rev end, 6) as fold from ({COUNTS})")
def f12(spark, sf):
    c = cell_counts(spark, sf)
    return c.select("cell_id", R6(F.try_divide(F.abs(F.col("fwd") - F.col("rev")), F.col("n")), "orientation_bias"), R6(F.try_divide("proper", "n"), "frac_proper"), R6(F.try_divide("fwd", "rev"), "fold"))


@query("f13_max_orientation", f"select cell_id, round(greatest(fwd, rev) / n, 6) as orientation_bias_max from ({COUNTS})")
def f13(spark, sf):
    return cell_counts(spark, sf).select("cell_id", R6(F.greatest("fwd", "rev") / F.col("n"), "orientation_bias_max"))


@query("f14_rpm", "select r.chrom, r.cell_id, round(count(*) / (any_value(s.n) / 1e6), 4) as rpm from reads r join (select cell_id, count(*) as n from reads group by 1) s using (cell_id) group by 1, 2")
def f14(spark, sf):
    r = reads(spark, sf)
    lib = r.groupBy("cell_id").agg(F.count("*").alias("lib"))
    return r.groupBy("chrom", "cell_id").agg(F.count("*").alias("n")).join(lib, "cell_id").select("chrom", "cell_id", F.round(F.col("n") / (F.col("lib") / 1e6), 4).alias("rpm"))


@query("f15_rename", "select n_nationkey as nation_id, lower(n_name) as name from nation")
def f15(spark, sf):
    return table(spark, sf, "nation").withColumnsRenamed({"n_nationkey": "nation_id"}).drop("n_regionkey").select("nation_id", F.lower("n_name").alias("name"))


@query("f16_clip_fill", "select event_id, least(greatest(score, 5.0), 50.0) as clipped, coalesce(case when mapq > 50 then null else mapq end, 0) as filled, least(score * 1e9, 4e9) as capped from reads")
def f16(spark, sf):
    r = reads(spark, sf).withColumn("filled", F.when(F.col("mapq") <= 50, F.col("mapq"))).na.fill(0, ["filled"])
    return r.select("event_id", F.least(F.greatest("score", F.lit(5.0)), F.lit(50.0)).alias("clipped"), "filled", F.least(F.col("score") * 1e9, F.lit(4e9)).alias("capped"))


@query("f17_label_encode", "select distinct cell_id, n_reads, case label when 'KNRGL' then 1 when 'KRGL' then 2 else 0 end as code from peaks")
def f17(spark, sf):
    code = F.coalesce(F.create_map(*map(F.lit, ("KNRGL", 1, "KRGL", 2)))[F.col("label")], F.lit(0))
    return peaks(spark, sf).select("cell_id", "n_reads", code.alias("code")).distinct()


@query("f21_min_length", "select doc_id, length(text) as n from documents where length(text) >= 100")
def f21(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.length("text").cast("long").alias("n")).where("n >= 100")


PAIR = "from anno a join reads r on a.chrom = r.chrom and a.start_pos - 500 < r.end_pos and r.start_pos < a.end_pos + 500"
REAL = "(r.flag & 1024) = 0"


QSQL = ", ".join(f"round(quantile_cont(r.mapq::double, {q}) filter ({REAL}), 6) as mapq_q{str(q).replace('.', '_')}" for q in ("0", "0.25", "0.5", "0.75", "1"))


@query(
    "a02_region_features",
    f"select a.anno_id, count(*) filter (not {REAL}) as n_duplicates, count(*) filter ({REAL}) as n_reads, count(*) filter ({REAL} and r.flag & 16 = 0) as n_fwd, count(*) filter ({REAL} and r.flag & 16 > 0) as n_rev, count(*) filter ({REAL} and r.flag & 2 > 0) as n_proper_pairs, "
    f"count(distinct r.three_end) filter ({REAL}) as n_unique_3end, round(avg(r.mapq) filter ({REAL}), 6) as mapq_mean, {QSQL}, round(avg(r.score) filter ({REAL}), 6) as score_mean {PAIR} group by 1 having count(*) filter ({REAL}) > 0",
)
def a02(spark, sf):
    r = reads(spark, sf).select(*iv.KEY, "flag", "mapq", "score", "three_end")
    out = rg.regions_with_features(iv.extend(anno(spark, sf), 500).select("anno_id", *iv.KEY), "anno_id", r)
    return out.select("anno_id", *(LONG(c) for c in ("n_duplicates", "n_reads", "n_fwd", "n_rev", "n_proper_pairs", "n_unique_3end")), *(R6(F.col(c), c) for c in ("mapq_mean", "mapq_q0", "mapq_q0_25", "mapq_q0_5", "mapq_q0_75", "mapq_q1", "score_mean")))


@query("j15_reads_in_regions", f"select a.anno_id, count(*) as n, sum(r.mapq)::bigint as mapq {PAIR} group by 1")
def j15(spark, sf):
    a = iv.extend(anno(spark, sf), 500).select("anno_id", *iv.KEY)
    found = iv.sum_overlaps(a, reads(spark, sf).select("mapq", *iv.KEY), {"n": F.lit(1), "known": F.when(F.col("mapq").isNotNull(), 1), "mapq": F.col("mapq")})
    sums = found.where("n > 0").groupBy("anno_id").agg(*(F.sum(c).alias(c) for c in ("n", "known", "mapq")))
    return sums.select("anno_id", "n", F.when(F.col("known") > 0, F.col("mapq")).alias("mapq"))


@query("src14_region_fetch", f"select a.anno_id, r.event_id {PAIR}")
def src14(spark, sf):
    pair = iv.overlap_pairs(iv.extend(anno(spark, sf), 500).select("anno_id", *iv.KEY), reads(spark, sf).select("event_id", *iv.KEY))
    return pair.select("anno_id", F.col("b_event_id").alias("event_id"))


@query("src15_callback_counts", "select cell_id, count(*) filter (flag & 1412 = 0) as kept, count(*) filter (flag & 1024 > 0) as duplicates from reads group by 1")
def src15(spark, sf):
    return reads(spark, sf).groupBy("cell_id").agg(N(rg.passing(flag(), rg.NOT_COUNTED)).alias("kept"), N(rg.passing(flag(), 0, 1024)).alias("duplicates"))


@query("src17_signal_max", "select a.anno_id, max(p.n_reads) as top from anno a join peaks p on a.chrom = p.chrom and a.start_pos < p.end_pos and p.start_pos < a.end_pos group by 1")
def src17(spark, sf):
    return iv.best_overlap(anno(spark, sf), "anno_id", peaks(spark, sf), {"top": F.col("n_reads")})


@query(
    "src16_dense_values",
    "select anno_id, string_agg(value, ',' order by pos) as signal from (select a.anno_id, a.pos, coalesce(max(p.n_reads), 0) as value from (select *, pos // 1024 as bin from (select anno_id, chrom, unnest(generate_series(start_pos, end_pos - 1)) as pos from anno)) a "
    "left join (select *, unnest(generate_series(start_pos // 1024, (end_pos - 1) // 1024)) as bin from peaks) p on p.chrom = a.chrom and p.bin = a.bin and p.start_pos <= a.pos and a.pos < p.end_pos group by 1, 2) group by 1",
)
def src16(spark, sf):
    """The signal at each base of each annotation, 0 where there is none; equal neighbouring values are joined as runs."""
    runs = iv.track_max(peaks(spark, sf), "n_reads", float("-inf"))
    a = anno(spark, sf).select("anno_id", *iv.KEY)
    first, last = F.greatest("start_pos", "b_start_pos"), F.least("end_pos", "b_end_pos")
    part = iv.overlap_pairs(a, runs).groupBy("anno_id").agg(F.array_sort(F.collect_list(F.struct(first.alias("s"), last.alias("e"), F.col("b_n_reads").alias("v")))).alias("runs"))
    # the gap before each run and its values, then what is left
    dense = F.expr(
        "concat(flatten(transform(runs, (r, i) -> concat(array_repeat('0', int(r.s - if(i = 0, start_pos, runs[i - 1].e))), array_repeat(string(r.v), int(r.e - r.s))))),"
        " array_repeat('0', int(end_pos - if(size(runs) = 0, start_pos, runs[size(runs) - 1].e))))"
    )
    found = a.join(part, "anno_id", "left").withColumn("runs", F.coalesce("runs", F.array().cast(part.schema["runs"].dataType)))
    return found.select("anno_id", F.array_join(dense, ",").alias("signal"))


@query("a03_exact_quantiles", "select l_returnflag, " + ", ".join(f"round(quantile_cont(l_extendedprice, {q}), 6) as price_q{str(q).replace('.', '_')}" for q in ("0", "0.25", "0.5", "0.75", "1")) + " from lineitem group by 1")
def a03(spark, sf):
    out = rg.exact_quantiles(table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice", "price")
    return out.select("l_returnflag", *(R6(F.col(c), c) for c in out.columns[1:]))


@query("a04_gini", "select cell_id, round(sum((2 * i - n - 1) * x) / (any_value(n) * sum(x)), 6) as gini from (select cell_id, score - least(min(score) over (partition by cell_id), 0) + 1e-7 as x, row_number() over (partition by cell_id order by score) as i, count(*) over (partition by cell_id) as n from reads) group by 1")
def a04(spark, sf):
    n = reads(spark, sf).groupBy("cell_id", "score").agg(F.count("*").alias("c"))
    return n.groupBy("cell_id").agg(F.collect_list(F.struct(F.col("score").alias("x"), "c")).alias("xs")).select("cell_id", R6(rg.gini("xs"), "gini"))


@query("w01_sliding_windows", "select chrom, k * 250 as start_pos, k * 250 + 750 as end_pos, count(*) as n_reads from (select chrom, unnest(generate_series(greatest(0, (floor((three_end - 750) / 250) + 1)::bigint), least((2592000 - 750) // 250, floor(three_end / 250)::bigint))) as k from reads where flag & 1412 = 0) group by 1, 2 having count(*) >= 5")
def w01(spark, sf):
    return rg.sliding_windows(reads(spark, sf).where(rg.passing(flag(), rg.NOT_COUNTED)), 750, 250, 5, CONTIG)


@query("w02_least_reads", "select cell_id, greatest(3, ceil(20000 * count(*) / 1e6))::bigint as least from reads group by 1")
def w02(spark, sf):
    return reads(spark, sf).groupBy("cell_id").agg(F.greatest(F.lit(3), F.ceil(F.lit(20000) * F.count("*") / 1e6)).cast("long").alias("least"))


@query("w03_background_fold", "select event_id, n, bg_n, round(n * 20000.0 / (bg_n * 400.0), 6) as fold from (select event_id, count(*) over (partition by chrom order by three_end range between 200 preceding and 200 following) as n, count(*) over (partition by chrom order by three_end range between 10000 preceding and 10000 following) as bg_n from reads) where n * 20000.0 / (bg_n * 400.0) > 5")
def w03(spark, sf):
    return rg.background_fold(reads(spark, sf).select("event_id", "chrom", "three_end"), 400, 20000, 5).select("event_id", "n", "bg_n", R6(F.col("fold"), "fold"))


@query("w05_step_one_peaks", "with s as (select chrom, greatest(0, last - 200 + 1) as s0, least(three_end, 2592000 - 200) as s1 from (select chrom, three_end, lead(three_end, 2) over (partition by chrom order by three_end, event_id) as last from reads where flag & 1412 = 0) where last - three_end < 200), g as (select *, max(s1) over (partition by chrom order by s0, s1 rows between unbounded preceding and 1 preceding) as reach from s where s0 <= s1), h as (select *, sum(case when reach is null or s0 > reach + 100 then 1 else 0 end) over (partition by chrom order by s0, s1 rows unbounded preceding) as grp from g) select chrom, min(s0) as start_pos, max(s1) + 200 as end_pos from h group by chrom, grp")
def w05(spark, sf):
    return rg.step_one_peaks(reads(spark, sf).where(rg.passing(flag(), rg.NOT_COUNTED)), 200, 3, -100, CONTIG).select("chrom", LONG("start_pos"), LONG("end_pos"))


SPOTS = """with hot as (select * from (select *, count(*) over (partition by chrom order by three_end range between 100 preceding and 100 following) as n, count(*) over (partition by chrom order by three_end range between 5000 preceding and 5000 following) as bg_n
from reads where flag & 1412 = 0) where n * 10000.0 / (bg_n * 200.0) > 4), s as (select chrom, greatest(0, three_end - 199) as s0, least(three_end, 2592000 - 200) as s1 from hot),
g as (select *, max(s1) over (partition by chrom order by s0, s1 rows between unbounded preceding and 1 preceding) as reach from s where s0 <= s1),
h as (select *, sum(case when reach is null or s0 > reach + 100 then 1 else 0 end) over (partition by chrom order by s0, s1 rows unbounded preceding) as grp from g),
spots as (select chrom, min(s0) as start_pos, max(s1) + 200 as end_pos from h group by chrom, grp),
pair as (select s.chrom, s.start_pos, s.end_pos, r.flag, r.mapq, r.score, r.three_end, r.five_end from spots s join reads r on r.chrom = s.chrom and s.start_pos < r.end_pos and r.start_pos < s.end_pos),
x as (select *, three_end + 1e-7 as v, row_number() over (partition by chrom, start_pos, end_pos order by three_end) as i, count(*) over (partition by chrom, start_pos, end_pos) as m from pair where (flag & 1024) = 0),
gini as (select chrom, start_pos, end_pos, round(sum((2 * i - m - 1) * v) / (any_value(m) * sum(v)), 6) as three_end_gini from x group by 1, 2, 3) """
REGION = ", ".join(f"round(quantile_cont(mapq::double, {q}) filter ((flag & 1024) = 0), 6) as mapq_q{str(q).replace('.', '_')}" for q in ("0", "0.25", "0.5", "0.75", "1"))


@query(
    "w06_make_regions",
    SPOTS + "select chrom, start_pos, end_pos, three_end_gini, f.* exclude (chrom, start_pos, end_pos) from gini join (select chrom, start_pos, end_pos, count(*) filter ((flag & 1024) > 0) as n_duplicates, count(*) filter ((flag & 1024) = 0) as n_reads, count(distinct three_end) filter ((flag & 1024) = 0) as n_unique_3end, "
    "count(distinct five_end) filter ((flag & 1024) = 0) as n_unique_5end, round(avg(mapq) filter ((flag & 1024) = 0), 6) as mapq_mean, round(avg(score) filter ((flag & 1024) = 0), 6) as score_mean, "
    "round(abs(count(*) filter ((flag & 1040) = 0) - count(*) filter ((flag & 1040) = 16)) / count(*) filter ((flag & 1024) = 0), 6) as orientation_bias, round(count(*) filter ((flag & 1026) = 2) / count(*) filter ((flag & 1024) = 0), 6) as frac_proper_pairs, "
    + REGION + " from pair group by 1, 2, 3) f using (chrom, start_pos, end_pos)",
)
def w06(spark, sf):
    """Windows that pass the fold test, merged into peaks, with features of their reads."""
    real = reads(spark, sf).where(rg.passing(flag(), rg.NOT_COUNTED))
    hot = rg.background_fold(real, 200, 10000, 4).select(*real.columns)
    spots = rg.step_one_peaks(hot, 200, 1, -100, CONTIG)
    pair = iv.overlap_pairs(spots, reads(spark, sf))
    pair = pair.select("chrom", "start_pos", "end_pos", *(F.col(f"b_{c}").alias(c) for c in ("flag", "mapq", "score", "three_end", "five_end")))
    out = rg.region_features(pair, list(iv.KEY))
    rounded = ("three_end_gini", "mapq_mean", "score_mean", "orientation_bias", "frac_proper_pairs", "mapq_q0", "mapq_q0_25", "mapq_q0_5", "mapq_q0_75", "mapq_q1")
    return out.select("chrom", LONG("start_pos"), LONG("end_pos"), "n_duplicates", "n_reads", "n_unique_3end", "n_unique_5end", *(R6(F.col(c), c) for c in rounded))


@query("w10_greedy_peaks")
def w10(spark, sf):
    """Greedy choice has no plain SQL form: held against brute force in tests."""
    best = peaks(spark, sf).groupBy("chrom", "start_pos", "end_pos").agg(F.max("n_reads").alias("n_reads"))
    return rg.greedy_peaks(best, 10, 500)


@query("w11_peak_summit", "select a.anno_id, min_by(p.start_pos, (-p.n_reads, p.start_pos)) - 250 as start_pos, min_by(p.start_pos, (-p.n_reads, p.start_pos)) + 251 as end_pos from anno a join peaks p on a.chrom = p.chrom and a.start_pos < p.end_pos and p.start_pos < a.end_pos group by 1")
def w11(spark, sf):
    top = iv.best_overlap(anno(spark, sf), "anno_id", peaks(spark, sf), {"n_reads": F.col("n_reads"), "back": -F.col("start_pos")})
    return top.select("anno_id", (-F.col("back") - 250).alias("start_pos"), (-F.col("back") + 251).alias("end_pos"))


DAILY = "select chrom, start_pos // 3600 as hour, count(*) as n from reads group by 1, 2"


def hourly(spark, sf):
    return reads(spark, sf).groupBy("chrom", F.expr("start_pos div 3600").alias("hour")).agg(F.count("*").alias("n"))


MEANS = ", ".join(f"case when count(*) over (partition by chrom order by hour rows between {w // 2} preceding and {(w - 1) // 2} following) = {w} then avg(n) over (partition by chrom order by hour rows between {w // 2} preceding and {(w - 1) // 2} following) end as mean_{w}" for w in (5, 8, 24))


@query("w12_rolling_signal", f"select chrom, hour, round(mean_5, 6) as mean_5, round(mean_8, 6) as mean_8, round(mean_24, 6) as mean_24, round(greatest(coalesce(mean_5, 0), coalesce(mean_8, 0), coalesce(mean_24, 0)), 6) as background, peak from (select chrom, hour, {MEANS}, case when count(*) over w = 5 then max(n) over w else 0 end as peak from ({DAILY}) window w as (partition by chrom order by hour rows between 2 preceding and 2 following))")
def w12(spark, sf):
    out = rg.rolling(hourly(spark, sf), "n", [5, 8, 24], ["hour"])
    return out.select("chrom", "hour", *(R6(F.col(c), c) for c in ("mean_5", "mean_8", "mean_24", "background")), LONG("peak"))


TWO = "select chrom, start_pos // 3600 as hour, count(*) filter (flag & 16 = 0)::double as x, count(*) filter (flag & 16 > 0)::double as y from reads group by 1, 2"


@query("w15_track_difference", f"select chrom, hour, round(x * (ln(x + 1) - ln(y + 1)) + y - x, 6) as llr, x > 0 and y = 0 as exclusive from ({TWO})")
def w15(spark, sf):
    t = reads(spark, sf).groupBy("chrom", F.expr("start_pos div 3600").alias("hour")).agg(N(flag().bitwiseAND(16) == 0).cast("double").alias("x"), N(flag().bitwiseAND(16) > 0).cast("double").alias("y"))
    x, y = F.col("x"), F.col("y")
    return t.select("chrom", "hour", R6(x * (F.ln(x + 1) - F.ln(y + 1)) + y - x, "llr"), ((x > 0) & (y == 0)).alias("exclusive"))


@query(
    "w16_poisson_bh",
    f"with h as ({DAILY}), t as (select h.*, greatest(0.0, 1 - list_sum(list_transform(range(0, n), lambda k: exp(k * ln(m) - m - lgamma(k + 1))))) as p from h join (select chrom, avg(n) as m from h group by 1) using (chrom)), "
    "k as (select *, p * count(*) over (partition by chrom) / row_number() over (partition by chrom order by n desc, hour) as raw from t) "
    "select chrom, hour, n, round(p, 6) as p, round(least(1.0, min(raw) over (partition by chrom order by n desc, hour rows between current row and unbounded following)), 6) as q from k",
)
def w16(spark, sf):
    """Upper Poisson tail of hourly counts against the contig mean, and Benjamini-Hochberg q values; within a contig, the larger count has the smaller p."""
    h = hourly(spark, sf)
    mean = h.groupBy("chrom").agg(F.avg("n").alias("m"))
    # P(X >= n) = 1 - sum of the n first terms, each from the one before, as logarithms
    tail = F.expr("1 - aggregate(sequence(0, n - 1), named_struct('t', -m, 's', 0D), (a, k) -> named_struct('t', a.t + ln(m) - ln(k + 1D), 's', a.s + exp(a.t)), a -> a.s)")
    p = h.join(mean, "chrom").withColumn("p", F.when(F.col("n") > 0, F.greatest(tail, F.lit(0.0))).otherwise(1.0))
    rank = F.row_number().over(Window.partitionBy("chrom").orderBy(F.desc("n"), "hour"))
    p = p.withColumn("raw", F.col("p") * F.count("*").over(Window.partitionBy("chrom")) / rank)
    upwards = Window.partitionBy("chrom").orderBy("n", F.desc("hour")).rowsBetween(Window.unboundedPreceding, 0)  # the same frame as from here to the last rank, without its cost
    return p.withColumn("q", F.least(F.lit(1.0), F.min("raw").over(upwards))).select("chrom", "hour", "n", R6(F.col("p"), "p"), R6(F.col("q"), "q"))


@query("w17_running_totals", "select event_id, sum(mapq) over (partition by cell_id order by start_pos, event_id)::bigint as total, row_number() over (partition by cell_id order by start_pos, event_id) as i from reads")
def w17(spark, sf):
    out = iv.running(reads(spark, sf).select("cell_id", "start_pos", "event_id", "mapq"), ("cell_id",), F.col("start_pos"), ["start_pos", "event_id"], {"total": ("sum", F.col("mapq")), "i": ("sum", F.lit(1))})
    return out.select("event_id", F.col("total").cast("long").alias("total"), F.col("i").cast("long").alias("i"))


@query("w07_ecdf", "select distinct donor_id, n_reads, count(*) over (partition by donor_id order by n_reads) as upto, round(cume_dist() over (partition by donor_id order by n_reads), 6) as ecdf, round(1 - cume_dist() over (partition by donor_id order by n_reads), 6) as complement from peaks")
def w07(spark, sf):
    n = peaks(spark, sf).groupBy("donor_id", "n_reads").agg(F.count("*").alias("n"))
    upto, total = F.sum("n").over(Window.partitionBy("donor_id").orderBy("n_reads")), F.sum("n").over(Window.partitionBy("donor_id"))
    return n.select("donor_id", "n_reads", upto.alias("upto"), R6(upto / total, "ecdf"), R6(1 - upto / total, "complement"))


@query("j17_centred_background", "select event_id, count(*) over (partition by cell_id order by start_pos range between 50000 preceding and 50000 following) as background from reads")
def j17(spark, sf):
    return rg.centred_count(reads(spark, sf), "start_pos", 50000, "background", ("cell_id",)).select("event_id", "background")
