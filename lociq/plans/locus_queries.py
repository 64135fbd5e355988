"""Equi joins, aggregations, loci, evaluation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lociq.operators import evaluation as ev
from lociq.operators import intervals as iv
from lociq.operators import loci
from lociq.plans.registry import query
from lociq.plans.region_queries import LONG, R6, N
from lociq.sources.proxies import anno, peaks, reads, table

flag = lambda: F.col("flag")


@query("j01_sample_donor", "select s_suppkey, s_name, n_name, r_name from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey")
def j01(spark, sf):
    s, n, r = (table(spark, sf, t) for t in ("supplier", "nation", "region"))
    return s.join(n, s.s_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == F.col("r_regionkey")).select("s_suppkey", "s_name", "n_name", "r_name")


@query("j02_left_fill", "select c_custkey, coalesce(n, 0) as n_orders from customer left join (select o_custkey, count(*) as n from orders group by 1) on c_custkey = o_custkey")
def j02(spark, sf):
    n = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return table(spark, sf, "customer").join(n, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n_orders"))


@query("j03_map_lookup", "select n_nationkey, case n_regionkey when 0 then 'AF' when 1 then 'AM' when 2 then 'AS' end as code from nation")
def j03(spark, sf):
    return table(spark, sf, "nation").select("n_nationkey", F.create_map(*map(F.lit, (0, "AF", 1, "AM", 2, "AS")))[F.col("n_regionkey")].alias("code"))


@query("j04_semi_ids", "select event_id from reads where cell_id in (select o_custkey from orders where o_orderstatus = 'F')")
def j04(spark, sf):
    ids = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("cell_id"))
    return reads(spark, sf).join(ids, "cell_id", "left_semi").select("event_id")


@query("j05_anti_ids", "select c_custkey from customer where c_custkey not in (select o_custkey from orders)")
def j05(spark, sf):
    return table(spark, sf, "customer").join(table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey")


@query("j06_three_way_merge", "select a.l_orderkey, a.n as lines, b.n as returned, coalesce(c.n, 0) as late from (select l_orderkey, count(*) as n from lineitem group by 1) a join (select l_orderkey, count(*) as n from lineitem where l_returnflag = 'R' group by 1) b using (l_orderkey) left join (select l_orderkey, count(*) as n from lineitem where l_linestatus = 'F' group by 1) c using (l_orderkey)")
def j06(spark, sf):
    li = table(spark, sf, "lineitem")
    n = lambda df, name: df.groupBy("l_orderkey").agg(F.count("*").alias(name))
    out = n(li, "lines").join(n(li.where("l_returnflag = 'R'"), "returned"), "l_orderkey").join(n(li.where("l_linestatus = 'F'"), "late"), "l_orderkey", "left")
    return out.withColumn("late", F.coalesce("late", F.lit(0)))


@query("j18_dimension_product", "select r_name, k.kind, count(n_nationkey) as n from region cross join (select unnest(['bulk', 'cell']) as kind) k left join nation on n_regionkey = r_regionkey group by 1, 2")
def j18(spark, sf):
    kinds = table(spark, sf, "region").withColumn("kind", F.explode(F.array(F.lit("bulk"), F.lit("cell"))))
    n = table(spark, sf, "nation").groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(F.count("*").alias("n"))
    return kinds.join(n, "r_regionkey", "left").select("r_name", "kind", F.coalesce("n", F.lit(0)).alias("n"))


@query("j19_update_join", "select p.p_partkey, coalesce(l.price, p.p_retailprice) as price from part p left join (select l_partkey, max(l_extendedprice) as price from lineitem where l_quantity > 45 group by 1) l on p.p_partkey = l.l_partkey")
def j19(spark, sf):
    new = table(spark, sf, "lineitem").where("l_quantity > 45").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.max("l_extendedprice").alias("new"))
    return table(spark, sf, "part").join(new, "p_partkey", "left").select("p_partkey", F.coalesce("new", "p_retailprice").alias("price"))


@query("j20_keyed_zip", "select a.p_partkey, a.p_size, b.n from part a join (select l_partkey, count(*) as n from lineitem group by 1) b on a.p_partkey = b.l_partkey")
def j20(spark, sf):
    n = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("n"))
    return table(spark, sf, "part").select("p_partkey", "p_size").join(n, "p_partkey")


@query("a01_group_aggregates", "select l_returnflag, count(*) as n, round(sum(l_quantity), 4) as total, round(avg(l_extendedprice), 4) as mean, min(l_tax) as low, max(l_tax) as high, round(stddev_samp(l_discount), 6) as sd from lineitem group by 1")
def a01(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 4).alias("total"), F.round(F.avg("l_extendedprice"), 4).alias("mean"), F.min("l_tax").alias("low"), F.max("l_tax").alias("high"), R6(F.stddev_samp("l_discount"), "sd"))


@query("a05_distinct_counts", "select chrom, count(distinct three_end) as ends, count(distinct cell_id) as cells, count(distinct donor_id) as donors from reads group by 1")
def a05(spark, sf):
    return reads(spark, sf).groupBy("chrom").agg(F.count_distinct("three_end").alias("ends"), F.count_distinct("cell_id").alias("cells"), F.count_distinct("donor_id").alias("donors"))


@query("a06_any_all", "select cell_id, bool_or(flag & 2 > 0) as any_proper, bool_and(mapq < 60) as all_low, bool_or(flag & 2 > 0 or mapq > 58) as either from reads group by 1")
def a06(spark, sf):
    proper = flag().bitwiseAND(2) > 0
    return reads(spark, sf).groupBy("cell_id").agg(F.bool_or(proper).alias("any_proper"), F.bool_and(F.col("mapq") < 60).alias("all_low"), F.bool_or(iv.any_of([proper, F.col("mapq") > 58])).alias("either"))


@query("a07_arg_extremes", "select cell_id, arg_min(event_id, struct_pack(a := score, b := event_id)) as lowest, arg_max(event_id, struct_pack(a := score, b := -event_id)) as highest from reads group by 1")
def a07(spark, sf):
    return reads(spark, sf).groupBy("cell_id").agg(F.min_by("event_id", F.struct("score", "event_id")).alias("lowest"), F.max_by("event_id", F.struct(F.col("score"), -F.col("event_id"))).alias("highest"))


ORDERED = "select *, sum(new) over (partition by anno, chrom order by start_pos, end_pos, anno_id rows unbounded preceding) as c from (select *, case when reach is null or start_pos > reach then 1 else 0 end as new from (select *, max(end_pos) over (partition by anno, chrom order by start_pos, end_pos, anno_id rows between unbounded preceding and 1 preceding) as reach from anno))"


@query("a08_repeat_merge", f"select anno, chrom, min(start_pos) as start_pos, max(end_pos) as end_pos, case when count(distinct strand) = 1 then min(strand) when count(distinct strand) > 1 then '+/-' end as strand, arg_min(anno_id, struct_pack(a := start_pos, b := anno_id)) as first_id from ({ORDERED}) group by anno, chrom, c")
def a08(spark, sf):
    c = iv.cluster(anno(spark, sf), 0, ("anno", "chrom"), "c", ("anno_id",))
    strand = F.when(F.count_distinct("strand") == 1, F.min("strand")).when(F.count_distinct("strand") > 1, "+/-")
    return c.groupBy("anno", "chrom", "c").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"), strand.alias("strand"), F.min_by("anno_id", F.struct("start_pos", "anno_id")).alias("first_id")).drop("c")


@query("a09_describe", "select label, count(*) as n, round(avg(n_reads), 6) as mean, round(stddev_samp(n_reads), 6) as sd, min(n_reads) as low, " + ", ".join(f"quantile_cont(n_reads::double, {q}) as q{int(q * 100)}" for q in (0.25, 0.5, 0.75)) + ", max(n_reads) as high from peaks group by 1")
def a09(spark, sf):
    x = F.col("n_reads").cast("double")
    return peaks(spark, sf).groupBy("label").agg(F.count("*").alias("n"), R6(F.avg(x), "mean"), R6(F.stddev_samp(x), "sd"), F.min("n_reads").alias("low"), *(F.percentile(x, F.lit(q)).alias(f"q{int(q * 100)}") for q in (0.25, 0.5, 0.75)), F.max("n_reads").alias("high"))


@query("a10_value_counts", "select m.kind, coalesce(n, 0) as n from (select unnest(['view', 'click', 'signup', 'refund']) as kind) m left join (select event_type, count(*) as n from events group by 1) on kind = event_type")
def a10(spark, sf):
    n = table(spark, sf, "events").groupBy(F.col("event_type").alias("kind")).agg(F.count("*").alias("n"))
    kinds = spark.createDataFrame([(k,) for k in ("view", "click", "signup", "refund")], "kind string")
    return kinds.join(n, "kind", "left").select("kind", F.coalesce("n", F.lit(0)).alias("n"))


@query("a11_pivot", "select cell_id, count(*) filter (label = 'KNRGL') as \"KNRGL\", count(*) filter (label = 'KRGL') as \"KRGL\", count(*) filter (label = 'OTHER') as \"OTHER\" from peaks group by 1")
def a11(spark, sf):
    return peaks(spark, sf).groupBy("cell_id").pivot("label", ["KNRGL", "KRGL", "OTHER"]).agg(F.count(F.lit(1))).na.fill(0)


@query("a12_melt", "select p_partkey, 'p_size' as field, p_size::double as value from part union all select p_partkey, 'p_retailprice', p_retailprice from part")
def a12(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    return p.unpivot("p_partkey", ["p_size", "p_retailprice"], "field", "value")


CL = "select p.*, c.cluster from peaks p join (select *, sum(new) over (partition by chrom order by start_pos, end_pos rows unbounded preceding) as cluster from (select *, case when reach is null or start_pos > reach + {slack} then 1 else 0 end as new from (select *, max(end_pos) over (partition by chrom order by start_pos, end_pos rows between unbounded preceding and 1 preceding) as reach from (select distinct chrom, start_pos, end_pos from peaks)))) c using (chrom, start_pos, end_pos)"
QS = ", ".join(f"quantile_cont(n_reads::double, {q}) as n_reads_q{n}" for q, n in ((0, "0"), (0.25, "0_25"), (0.5, "0_5"), (0.75, "0_75"), (1, "1")))
STATS = "select chrom, case {case} else 'OTHER' end as label, count(*) as n_regions, count(distinct cell_id) as n_cells, count(distinct donor_id) as n_donors, {qs}, min(start_pos) as start_pos, max(end_pos) as end_pos, max(end_pos) - min(start_pos) as width, concat(chrom, ':', min(start_pos), '-', max(end_pos)) as locus from ({cl}) group by chrom, cluster"


@query("a13_cluster_stats", STATS.format(case="when bool_or(label = 'KNRGL') then 'KNRGL' when bool_or(label = 'KRGL') then 'KRGL'", qs=QS, cl=CL.format(slack=100)))
def a13(spark, sf):
    return loci.cluster_stats(peaks(spark, sf), 100)


@query("a14_cluster_stats_variant", STATS.format(case="when bool_or(label = 'KRGL') then 'KRGL' when bool_or(label = 'KNRGL') then 'KNRGL'", qs=QS, cl=CL.format(slack=0)))
def a14(spark, sf):
    return loci.cluster_stats(peaks(spark, sf), 0, ("KRGL", "KNRGL", "OTHER"))


@query("a15_cluster_representatives", f"select chrom, cluster, max(n_reads) as max_reads, min(n_reads) as min_reads, count(distinct cell_id) as n_cells, arg_min(cell_id, pick) as cell_id, arg_min(n_reads, pick) as n_reads from (select *, struct_pack(h := md5(concat_ws(':', 0, cell_id, start_pos, end_pos, n_reads)), c := cell_id, s := start_pos) as pick from ({CL.format(slack=0)})) group by 1, 2")
def a15(spark, sf):
    return loci.representatives(peaks(spark, sf), 0)


@query("a18_concordance", "with l as (select distinct start_pos - start_pos % 1000 as locus, donor_id as d1 from peaks), t as (select d1, count(*) as n from l group by 1), v as (select start_pos - start_pos % 1000 as locus, donor_id as d2, max(n_reads) as v from peaks group by 1, 2) select d1, d2, round(count(*) / any_value(n), 6) as share from l join v using (locus) join t using (d1) where v >= 10 group by 1, 2")
def a18(spark, sf):
    p = peaks(spark, sf).withColumn("locus", F.expr("start_pos - start_pos % 1000"))
    return ev.concordance(p, "locus", "donor_id", "n_reads", 10).select("d1", "d2", R6(F.col("share"), "share"))


@query("a19_cells_at_thresholds", "select chrom, " + ", ".join(f"count(distinct {c}_id) filter (n_reads >= {t}) as {c}s_{t}" for t in (1, 5, 10, 50) for c in ("cell", "donor")) + " from peaks group by 1")
def a19(spark, sf):
    return loci.sharing(peaks(spark, sf), ["chrom"])


@query("a20_strand_coverage", "select a.anno_id, count(r.event_id) filter (r.flag & 16 = 0) as fwd, count(r.event_id) filter (r.flag & 16 > 0) as rev, round(coalesce(abs(count(r.event_id) filter (r.flag & 16 = 0) - count(r.event_id) filter (r.flag & 16 > 0)) / nullif(count(r.event_id), 0), 0), 6) as bias from anno a left join reads r on a.chrom = r.chrom and a.start_pos < r.end_pos and r.start_pos < a.end_pos group by 1")
def a20(spark, sf):
    r = reads(spark, sf)
    out = iv.count_kinds(anno(spark, sf), r, {"fwd": flag().bitwiseAND(16) == 0, "rev": flag().bitwiseAND(16) > 0})
    bias = F.coalesce(F.try_divide(F.abs(F.col("fwd") - F.col("rev")), F.col("fwd") + F.col("rev")), F.lit(0.0))
    return out.select("anno_id", "fwd", "rev", R6(bias, "bias"))


@query("a21_weighted_mean", "select l_returnflag, round(sum(l_discount * l_quantity) / sum(l_quantity), 6) as mean from lineitem group by 1")
def a21(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(R6(F.try_divide(F.sum(F.col("l_discount") * F.col("l_quantity")), F.sum("l_quantity")), "mean"))


@query("a22_qc_funnel", "select cell_id, count(*) as raw, count(*) filter (mapq >= 10) as filtered, count(*) filter (mapq >= 10 and flag & 128 = 0) as mapped, count(*) filter (mapq >= 10 and flag & 128 = 0 and flag & 1024 = 0) as dedup, round(1 - count(*) filter (mapq >= 10) / count(*), 6) as lost, round(count(*) filter (flag & 1024 > 0) / count(*), 6) as saturation from reads group by 1")
def a22(spark, sf):
    ok = F.col("mapq") >= 10
    first, unique = flag().bitwiseAND(128) == 0, flag().bitwiseAND(1024) == 0
    return reads(spark, sf).groupBy("cell_id").agg(F.count("*").alias("raw"), N(ok).alias("filtered"), N(ok & first).alias("mapped"), N(ok & first & unique).alias("dedup"), R6(1 - N(ok) / F.count("*"), "lost"), R6(N(~unique) / F.count("*"), "saturation"))


@query("a23_sensitivity", "with c as (select a.anno, a.anno_id, count(p.cell_id) as n from anno a left join peaks p on a.chrom = p.chrom and a.start_pos < p.end_pos and p.start_pos < a.end_pos group by 1, 2) select anno, round(avg((n > 0)::int), 6) as any_reads, round(avg((n > 5)::int), 6) as many_reads from c group by 1")
def a23(spark, sf):
    n = iv.count_overlaps(anno(spark, sf), peaks(spark, sf), "n")
    return n.groupBy("anno").agg(R6(F.avg((F.col("n") > 0).cast("int")), "any_reads"), R6(F.avg((F.col("n") > 5).cast("int")), "many_reads"))


@query("a24_calls_at_thresholds", "select cell_id, t as threshold, count(*) filter (s >= t) as calls, round(count(*) filter (s >= t and y) / nullif(count(*) filter (s >= t), 0), 6) as precision, round(count(*) filter (s >= t and y) / nullif(count(*) filter (y), 0), 6) as recall, round(count(*) filter (s >= t) * (count(*) filter (s >= t and y) / nullif(count(*) filter (s >= t), 0)) / nullif(count(*) filter (s >= t and y) / nullif(count(*) filter (y), 0), 0), 4) as expected from (select cell_id, score / 100 as s, event_id % 2 = 1 as y from reads) cross join (select unnest([0.05, 0.1, 0.2, 0.5])::double as t) group by 1, 2")
def a24(spark, sf):
    r = reads(spark, sf).select("cell_id", (F.col("score") / 100).alias("s"), (F.col("event_id") % 2 == 1).alias("y"))
    out = ev.at_thresholds(r, [0.05, 0.1, 0.2, 0.5], F.col("y"), "s", ["cell_id"])
    return out.select("cell_id", "threshold", "calls", R6(F.col("precision"), "precision"), R6(F.col("recall"), "recall"), F.round("expected", 4).alias("expected"))


@query("a25_clonal_sharing", "select t as threshold, chrom, start_pos // 100000 as bucket, count(distinct cell_id) as cells, count(*) as regions, count(distinct donor_id) as donors from peaks cross join (select unnest([10, 30, 45])::bigint as t) where n_reads >= t group by 1, 2, 3")
def a25(spark, sf):
    p = peaks(spark, sf).withColumn("threshold", F.explode(F.array(*(F.lit(t).cast("long") for t in (10, 30, 45))))).where("n_reads >= threshold")
    return p.groupBy("threshold", "chrom", F.expr("start_pos div 100000").alias("bucket")).agg(F.count_distinct("cell_id").alias("cells"), F.count("*").alias("regions"), F.count_distinct("donor_id").alias("donors"))


@query("a26_donor_means", "select n_name, round(avg(m), 4) as mean from (select s_suppkey, s_nationkey, avg(l_quantity) as m from supplier join lineitem on s_suppkey = l_suppkey group by 1, 2) join nation on s_nationkey = n_nationkey group by 1")
def a26(spark, sf):
    s, n = table(spark, sf, "supplier"), table(spark, sf, "nation")
    m = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.avg("l_quantity").alias("m"))
    return s.join(m, "s_suppkey").join(n, s.s_nationkey == n.n_nationkey).groupBy("n_name").agg(F.round(F.avg("m"), 4).alias("mean"))


@query("a27_t_test", "with m as (select avg(score) filter (cell_id < 50) ma, var_samp(score) filter (cell_id < 50) / count(*) filter (cell_id < 50) ea, count(*) filter (cell_id < 50) na, avg(score) filter (cell_id >= 50) mb, var_samp(score) filter (cell_id >= 50) / count(*) filter (cell_id >= 50) eb, count(*) filter (cell_id >= 50) nb from reads) select round((ma - mb) / sqrt(ea + eb), 6) as t, round((ea + eb) * (ea + eb) / (ea * ea / (na - 1) + eb * eb / (nb - 1)), 4) as df from m")
def a27(spark, sf):
    r = reads(spark, sf).withColumn("grp", F.col("cell_id") < 50)
    return ev.welch_t(r, "score", "grp", True, False).select(R6(F.col("t"), "t"), F.round("df", 4).alias("df"))


@query("a27_correlations", "with r as (select mapq, score, rank() over (order by mapq) + (count(*) over (partition by mapq) - 1) / 2 as rx, rank() over (order by score) + (count(*) over (partition by score) - 1) / 2 as ry from reads) select round(corr(mapq, score), 6) as pearson, round(corr(rx, ry), 6) as rho from r")
def a27c(spark, sf):
    r = reads(spark, sf).select("mapq", "score")
    return r.agg(R6(F.corr("mapq", "score"), "pearson")).crossJoin(ev.spearman(r, "mapq", "score").select(R6(F.col("rho"), "rho")))  # one row each


@query("a27_binomial", "select cell_id, n, k, round(1 - list_sum(list_transform(range(0, k), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.2) + (n - i) * ln(0.8)))), 6) as p from (select cell_id, count(*) as n, count(*) filter (flag & 2 > 0) as k from reads group by 1) where k > 0")
def a27b(spark, sf):
    c = reads(spark, sf).groupBy("cell_id").agg(F.count("*").alias("n"), N(flag().bitwiseAND(2) > 0).alias("k")).where("k > 0")
    return c.withColumn("p", F.round(ev.binomial_tail("k", "n", 0.2), 6))


@query("a28_correlation_matrix", "select round(corr(log2(l_quantity), log2(l_extendedprice)), 5) as quantity_price, round(corr(log2(l_quantity), log2(1 + l_tax)), 5) as quantity_tax, round(corr(log2(l_extendedprice), log2(1 + l_tax)), 5) as price_tax from lineitem")
def a28(spark, sf):
    a, b, c = F.log2("l_quantity"), F.log2("l_extendedprice"), F.log2(1 + F.col("l_tax"))
    k = lambda x, y, n: F.round(F.corr(x, y), 5).alias(n)
    return table(spark, sf, "lineitem").agg(k(a, b, "quantity_price"), k(a, c, "quantity_tax"), k(b, c, "price_tax"))


@query("a29_shared_keys", "select l_partkey, count(distinct l_suppkey) as n_suppliers from lineitem group by 1 having count(distinct l_suppkey) > 1")
def a29(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count_distinct("l_suppkey").alias("n_suppliers")).where("n_suppliers > 1")


@query("a30_percent_of_total", "select cell_id, label, round(100.0 * count(*) / sum(count(*)) over (partition by cell_id), 6) as percent from peaks group by 1, 2")
def a30(spark, sf):
    n = peaks(spark, sf).groupBy("cell_id", "label").agg(F.count("*").alias("n"))
    return n.select("cell_id", "label", R6(F.lit(100.0) * F.col("n") / F.sum("n").over(Window.partitionBy("cell_id")), "percent"))


@query("a31_sharing_table", "select start_pos // 50000 as bucket, count(distinct cell_id) filter (cell_id % 3 = 0) as dlpfc, count(distinct cell_id) filter (cell_id % 3 = 1) as hippo, count(distinct donor_id) as donors, round(least(count(distinct cell_id) / count(distinct donor_id), 37), 6) as cells_per_donor from peaks group by 1")
def a31(spark, sf):
    n = lambda k: F.count_distinct(F.when(F.col("cell_id") % 3 == k, F.col("cell_id")))
    per = F.least(F.coalesce(F.try_divide(F.count_distinct("cell_id"), F.count_distinct("donor_id")), F.lit(0.0)), F.lit(37.0))
    return peaks(spark, sf).groupBy(F.expr("start_pos div 50000").alias("bucket")).agg(n(0).alias("dlpfc"), n(1).alias("hippo"), F.count_distinct("donor_id").alias("donors"), R6(per, "cells_per_donor"))


@query("a32_known_coverage", "with c as (select a.chrom, a.anno_id, count(p.cell_id) as n from anno a left join peaks p on a.chrom = p.chrom and a.start_pos < p.end_pos and p.start_pos < a.end_pos group by 1, 2) select chrom, count(*) filter (n > 0) as covered, count(*) filter (n = 0) as missing, round(count(*) filter (n > 0) / count(*), 6) as fraction from c group by 1")
def a32(spark, sf):
    n = iv.count_overlaps(anno(spark, sf), peaks(spark, sf), "n")
    return n.groupBy("chrom").agg(N(F.col("n") > 0).alias("covered"), N(F.col("n") == 0).alias("missing"), R6(N(F.col("n") > 0) / F.count("*"), "fraction"))


@query("a33_allele_frequency", "select l_orderkey, l_linenumber, l_suppkey, round(sum(l_discount) over (partition by l_partkey), 6) as af from lineitem")
def a33(spark, sf):
    """Sums of parts, mapped back; a part with many lines is summed in all tasks before it meets in one."""
    li = table(spark, sf, "lineitem")
    total = li.groupBy("l_partkey").agg(R6(F.sum("l_discount"), "af"))
    return li.join(total, "l_partkey", "left").select("l_orderkey", "l_linenumber", "l_suppkey", "af")


@query("a34_evenness", "select cell_id, round(stddev_samp(mapq), 6) as sd, round(avg(mapq), 6) as mean, count(*) filter (mapq = 0) as zeros, count(*) < 60 and count(*) filter (mapq = 0) > 0 as bad from reads group by 1")
def a34(spark, sf):
    zero = N(F.col("mapq") == 0)
    return reads(spark, sf).groupBy("cell_id").agg(R6(F.stddev_samp("mapq"), "sd"), R6(F.avg("mapq"), "mean"), zero.alias("zeros"), ((F.count("*") < 60) & (zero > 0)).alias("bad"))


@query("a35_base_frequencies", "select lang, " + ", ".join(f"round(avg((length(text) - length(replace(text, '{b}', ''))) / length(text)), 6) as {b}" for b in "acgt") + " from documents where length(text) > 0 group by 1")
def a35(spark, sf):
    from lociq.functions.alignment import count_of

    return table(spark, sf, "documents").where("length(text) > 0").groupBy("lang").agg(*(R6(F.avg(count_of(F.col("text"), b) / F.length("text")), b) for b in "acgt"))


@query("a36_interval_precision_recall", "with hit as (select a.anno_id, exists (select 1 from peaks p where p.n_reads > 30 and p.chrom = a.chrom and a.start_pos < p.end_pos and p.start_pos < a.end_pos) as hit from anno a), pred as (select distinct chrom, start_pos, end_pos from peaks where n_reads > 30), tp as (select count(*) filter (exists (select 1 from anno a where p.chrom = a.chrom and a.start_pos < p.end_pos and p.start_pos < a.end_pos)) as good, count(*) as n from pred p) select round(good / n, 6) as precision, round((select avg(hit::int) from hit), 6) as recall, (select count(*) filter (not hit) from hit) as legacy_missed from tp")
def a36(spark, sf):
    p = peaks(spark, sf).where("n_reads > 30").select(*iv.KEY).distinct()
    found = iv.count_overlaps(anno(spark, sf), p, "n").agg(R6(F.avg((F.col("n") > 0).cast("int")), "recall"), N(F.col("n") == 0).alias("legacy_missed"))
    return iv.count_overlaps(p, anno(spark, sf), "n").agg(R6(F.avg((F.col("n") > 0).cast("int")), "precision")).crossJoin(found)  # one row each


SCORED = "(select value as s, event_id % 2 = 1 as y from events)"
CUM = f"select s as threshold, sum(p) over (order by s desc) as tp, sum(n) over (order by s desc) as fp, sum(p) over () as np, sum(n) over () as nn from (select s, count(*) filter (y) as p, count(*) filter (not y) as n from {SCORED} group by 1)"


def scored(spark, sf):
    return table(spark, sf, "events").select(F.col("value").alias("s"), (F.col("event_id") % 2 == 1).alias("y"))


def D6(c, name):
    """A double to six digits as DuckDB rounds it, by the binary product; Spark's own rounding goes by the decimal digits and parts from it at ties."""
    return (F.round(c * 1e6) / 1e6).alias(name)


@query("w08_pr_curve", f"select threshold, round(tp / (tp + fp), 6) as precision, round(tp / (np + 100), 6) as recall from ({CUM}) union all select null, 1.0, 0.0")
def w08(spark, sf):
    c = ev.pr_curve(scored(spark, sf), F.col("y"), "s", 100)
    return c.select("threshold", D6(F.col("precision"), "precision"), D6(F.col("recall"), "recall"))


@query("w09_recall_extra", f"select round(count(*) filter (y and s >= 10) / (count(*) filter (y) + 100), 6) as recall from {SCORED}")
def w09(spark, sf):
    return scored(spark, sf).agg(D6(ev.recall(F.col("y"), F.col("s") >= 10, 100), "recall"))


@query("w18_roc_curve", f"select threshold, round(tp / np, 6) as tpr, round(fp / nn, 6) as fpr from ({CUM})")
def w18(spark, sf):
    c = ev.roc_curve(scored(spark, sf), F.col("y"), "s")
    return c.select("threshold", D6(F.col("tpr"), "tpr"), D6(F.col("fpr"), "fpr"))


@query("w18_areas", f"select round(sum((fp - fp0) * (tp + tp0) / 2) / any_value(np * nn), 6) as auc, round(sum((tp - tp0) * tp / (tp + fp)) / any_value(np), 6) as average_precision from (select *, coalesce(lag(tp) over (order by threshold desc), 0) as tp0, coalesce(lag(fp) over (order by threshold desc), 0) as fp0 from ({CUM}))")
def w18a(spark, sf):
    return ev.areas(scored(spark, sf), F.col("y"), "s").select(R6(F.col("auc"), "auc"), R6(F.col("average_precision"), "average_precision"))
