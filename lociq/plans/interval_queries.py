"""Interval shapes, joins, clusters and tracks."""

from __future__ import annotations

from pyspark.sql import functions as F

from lociq.operators import intervals as iv
from lociq.plans.registry import query
from lociq.sources.proxies import CONTIG, anno, peaks, reads, table

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SHAPE = "select anno_id, chrom, {s} as start_pos, {e} as end_pos from anno"


def shaped(df):
    return df.select("anno_id", "chrom", F.col("start_pos").cast("long").alias("start_pos"), F.col("end_pos").cast("long").alias("end_pos"))


def sizes(spark):
    return spark.createDataFrame([(f"chr{i}", CONTIG) for i in range(5)], "chrom string, size long")


@query("i01_extend", SHAPE.format(s="greatest(0, start_pos - 500)", e="end_pos + 500"))
def i01(spark, sf):
    return shaped(iv.extend(anno(spark, sf), 500))


@query("i02_extend_stranded", SHAPE.format(s="greatest(0, start_pos - case when strand = '-' then 750 else 100 end)", e="end_pos + case when strand = '-' then 100 else 750 end"))
def i02(spark, sf):
    return shaped(iv.extend_stranded(anno(spark, sf), 100, 750))


@query("i03_three_end", "select anno_id, chrom, case when strand = '-' then start_pos else end_pos - 1 end as start_pos, case when strand = '-' then start_pos + 1 else end_pos end as end_pos from anno where strand is not null")
def i03(spark, sf):
    return shaped(iv.three_prime(anno(spark, sf).where("strand is not null")))


@query("i04_slop", SHAPE.format(s="greatest(0, start_pos - 1000)", e="least(2592000, end_pos - 50)"))
def i04(spark, sf):
    return shaped(iv.slop(anno(spark, sf), 1000, -50, sizes(spark)))


@query("i05_last_bases", SHAPE.format(s="case strand when '+' then greatest(0, end_pos - 300) when '-' then greatest(0, start_pos - 300) else start_pos end", e="case strand when '+' then end_pos + 300 when '-' then start_pos + 300 else end_pos end"))
def i05(spark, sf):
    return shaped(iv.last_bases(anno(spark, sf)))


@query("i06_switch_ends", "select event_id, least(three_end, five_end) as start_pos, greatest(three_end, five_end) as end_pos from reads")
def i06(spark, sf):
    return reads(spark, sf).select("event_id", F.least("three_end", "five_end").alias("start_pos"), F.greatest("three_end", "five_end").alias("end_pos"))


@query("i07_clamp", SHAPE.format(s="greatest(1, start_pos - 5000)", e="least(2592000, end_pos + 5000)"))
def i07(spark, sf):
    return shaped(anno(spark, sf).withColumns({"start_pos": F.greatest(F.lit(1), F.col("start_pos") - 5000), "end_pos": F.least(F.lit(CONTIG), F.col("end_pos") + 5000)}))


@query("i08_flanks", "select anno_id, 'left' as side, greatest(0, start_pos - 1000) as start_pos, start_pos as end_pos from anno union all select anno_id, 'right', end_pos, end_pos + 1000 from anno")
def i08(spark, sf):
    return iv.flanks(anno(spark, sf), 1000).select("anno_id", "side", F.col("start_pos").cast("long").alias("start_pos"), "end_pos")


@query("i09_locus", "select anno_id, concat(chrom, ':', start_pos, '-', end_pos) as locus, chrom, start_pos, end_pos from anno")
def i09(spark, sf):
    return anno(spark, sf).select("anno_id", iv.locus().alias("locus")).select("anno_id", "locus", *iv.parse_locus("locus"))


@query("i10_shift", SHAPE.format(s="start_pos - 1", e="end_pos + 1"))
def i10(spark, sf):
    return shaped(anno(spark, sf).withColumns({"start_pos": F.col("start_pos") - 1, "end_pos": F.col("end_pos") + 1}))


JOIN = "peaks p {kind} join anno a on p.chrom = a.chrom and p.start_pos < a.end_pos and a.start_pos < p.end_pos"
ROW = "p.l_orderkey, p.l_linenumber, p.cell_id, p.start_pos, p.end_pos"




@query("j07_overlap_left", f"select {ROW}, coalesce(a.anno_id, -1) as b_anno_id, coalesce(a.start_pos, -1) as b_start_pos, coalesce(a.end_pos, -1) as b_end_pos from {JOIN.format(kind='left')}")
def j07(spark, sf):
    p = peaks(spark, sf).select("l_orderkey", "l_linenumber", "cell_id", "n_reads", "chrom", "start_pos", "end_pos")
    out = iv.overlap_left(p, anno(spark, sf).select("anno_id", "chrom", "start_pos", "end_pos"), p.columns)
    return out.na.fill(-1, ["b_anno_id"]).select("l_orderkey", "l_linenumber", "cell_id", "start_pos", "end_pos", "b_anno_id", "b_start_pos", "b_end_pos")


@query("j08_overlap_bases", f"select {ROW}, coalesce(a.anno_id, -1) as b_anno_id, case when a.anno_id is null then 0 else least(p.end_pos, a.end_pos) - greatest(p.start_pos, a.start_pos) end as overlap from {JOIN.format(kind='left')}")
def j08(spark, sf):
    p = peaks(spark, sf).select("l_orderkey", "l_linenumber", "cell_id", "n_reads", "chrom", "start_pos", "end_pos")
    out = iv.overlap_left(p, anno(spark, sf).select("anno_id", "chrom", "start_pos", "end_pos"), p.columns)
    return out.na.fill(-1, ["b_anno_id"]).select("l_orderkey", "l_linenumber", "cell_id", "start_pos", "end_pos", "b_anno_id", "overlap")


FLAGS = ", ".join(f"count(a.anno_id) filter (a.anno = '{n}') as {'n_' + ''.join(c if c.isalnum() else '_' for c in n.lower()).strip('_')}" for n in PRIORITIES)


@query("j08_label_flags", f"select p.chrom, p.start_pos, p.end_pos, {FLAGS} from (select distinct chrom, start_pos, end_pos from peaks) p left join anno a on p.chrom = a.chrom and p.start_pos < a.end_pos and a.start_pos < p.end_pos group by all")
def label_flags(spark, sf):
    return iv.label_flags(peaks(spark, sf).select(*iv.KEY).distinct(), anno(spark, sf).select("anno", *iv.KEY), PRIORITIES)


@query("j09_count_overlaps", f"select {ROW}, count(a.anno_id) as n_anno from (select distinct l_orderkey, l_linenumber, cell_id, chrom, start_pos, end_pos from {JOIN.format(kind='left').replace('peaks p', 'peaks) p', 1)} group by all")
def j09(spark, sf):
    p = peaks(spark, sf).select("l_orderkey", "l_linenumber", "cell_id", *iv.KEY).distinct()
    return iv.count_overlaps(p, anno(spark, sf), "n_anno").select("l_orderkey", "l_linenumber", "cell_id", "start_pos", "end_pos", "n_anno")


HIT = "exists (select 1 from anno a where p.chrom = a.chrom and p.start_pos < a.end_pos and a.start_pos < p.end_pos)"


@query("j10_overlap_semi", f"select distinct {ROW} from peaks p where {HIT}")
def j10(spark, sf):
    p = peaks(spark, sf).select("l_orderkey", "l_linenumber", "cell_id", *iv.KEY)
    return iv.semi(p, anno(spark, sf)).distinct().drop("chrom")


@query("j11_overlap_anti", f"select distinct {ROW} from peaks p where not {HIT}")
def j11(spark, sf):
    p = peaks(spark, sf).select("l_orderkey", "l_linenumber", "cell_id", *iv.KEY)
    return iv.anti(p, anno(spark, sf)).distinct().drop("chrom")


@query("f20_blacklist_subtraction", f"select p.label, count(*) as n from (select distinct l_orderkey, l_linenumber, cell_id, chrom, start_pos, end_pos, label from peaks) p where not exists (select 1 from anno a where a.anno = '1-URGENT' and p.chrom = a.chrom and p.start_pos < a.end_pos and a.start_pos < p.end_pos) group by 1")
def f20(spark, sf):
    p = peaks(spark, sf).select("l_orderkey", "l_linenumber", "cell_id", *iv.KEY, "label")
    return iv.anti(p, anno(spark, sf).where("anno = '1-URGENT'")).distinct().groupBy("label").agg(F.count("*").alias("n"))


NEAR = """select p.*, least(p.start_pos - u.end_pos, d.start_pos - p.end_pos) as distance from (select distinct {by}, start_pos, end_pos from peaks) p
asof left join (select distinct {by}, end_pos from {b}) u on {on_u} and p.start_pos >= u.end_pos asof left join (select distinct {by}, start_pos from {b}) d on {on_d} and p.end_pos <= d.start_pos"""
URGENT = "(select * from anno where anno = '1-URGENT')"


def near_sql(b: str, *by: str) -> str:
    on = lambda t: " and ".join(f"p.{c} = {t}.{c}" for c in by)
    return NEAR.format(b=b, by=", ".join(by), on_u=on("u"), on_d=on("d"))


@query("j12_nearest", near_sql(URGENT, "chrom"))
def j12(spark, sf):
    return iv.nearest(peaks(spark, sf).select(*iv.KEY).distinct(), anno(spark, sf).where("anno = '1-URGENT'"))


@query("j13_nearest_self", near_sql("(select * from peaks)", "chrom"))
def j13(spark, sf):
    p = peaks(spark, sf).select(*iv.KEY)
    return iv.nearest(p.distinct(), p)


@query("j14_nearest_by_donor", near_sql(URGENT, "donor_id", "chrom"))
def j14(spark, sf):
    p = peaks(spark, sf).select("donor_id", *iv.KEY).distinct()
    return iv.nearest(p, anno(spark, sf).where("anno = '1-URGENT'"), by=("donor_id", "chrom"))


@query("j16_coverage_rpm", "with n as (select count(*) as total from reads) select a.anno_id, count(r.event_id) as n_reads, round(count(r.event_id) / ((select total from n) / 1e6), 6) as rpm from anno a left join reads r on a.chrom = r.chrom and a.start_pos < r.end_pos and r.start_pos < a.end_pos group by 1")
def j16(spark, sf):
    r = reads(spark, sf)
    total = r.agg(F.count("*").alias("total"))
    out = iv.count_overlaps(anno(spark, sf), r, "n_reads").crossJoin(F.broadcast(total))  # one row
    return out.select("anno_id", "n_reads", F.round(F.col("n_reads") / (F.col("total") / 1e6), 6).alias("rpm"))


@query("j21_strand_blind", "select count(*) filter (a.strand = '+') as plus, count(*) filter (a.strand = '-') as minus, count(*) filter (a.strand is null) as none from " + JOIN.format(kind="inner"))
def j21(spark, sf):
    p = peaks(spark, sf).groupBy(*iv.KEY).agg(F.count("*").alias("same"))
    kinds = {"plus": F.col("strand") == "+", "minus": F.col("strand") == "-", "none": F.col("strand").isNull()}
    found = iv.count_kinds(p, anno(spark, sf).select("strand", *iv.KEY), kinds)
    return found.agg(*(F.coalesce(F.sum(F.col(k) * F.col("same")), F.lit(0)).cast("long").alias(k) for k in kinds))


CLUSTERED = """select *, sum(new) over (partition by chrom order by start_pos, end_pos, anno_id rows unbounded preceding)::bigint as cluster from (select *, case when reach is null or start_pos > reach + {slack} then 1 else 0 end as new from (
select *, max(end_pos) over (partition by chrom order by start_pos, end_pos, anno_id rows between unbounded preceding and 1 preceding) as reach from anno))"""


@query("w04_cluster", f"select anno_id, chrom, cluster from ({CLUSTERED.format(slack=1000)})")
def w04(spark, sf):
    return iv.cluster(anno(spark, sf), 1000, order=("anno_id",)).select("anno_id", "chrom", "cluster")


@query("w04_merge", f"select chrom, min(start_pos) as start_pos, max(end_pos) as end_pos, count(*) as n from ({CLUSTERED.format(slack=0)}) group by chrom, cluster")
def w04_merge(spark, sf):
    return iv.merge(anno(spark, sf))


SEGMENTS = """select chrom, pos as start_pos, lead(pos) over (partition by chrom order by pos) as end_pos, sum(d) over (partition by chrom order by pos)::bigint as depth from (
select chrom, pos, sum(d) as d from (select chrom, start_pos as pos, 1 as d from {t} union all select chrom, end_pos, -1 from {t}) group by 1, 2)"""
DEPTH = "select * from (" + SEGMENTS + ") where depth > 0 and end_pos is not null"
ISLANDS = """select chrom, min(start_pos) as start_pos, max(end_pos) as end_pos, {v} from (select *, sum(new) over (partition by chrom order by start_pos) as run from (
select *, case when lag(end_pos) over w = start_pos and lag({v}) over w = {v} then 0 else 1 end as new from ({t}) window w as (partition by chrom order by start_pos))) group by chrom, run, {v}"""


@query("w13_segments", DEPTH.format(t="anno"))
def w13_segments(spark, sf):
    return iv.segments(anno(spark, sf))


@query(
    "w13_multi_intersect",
    "with cuts as (select chrom, pos as start_pos, lead(pos) over (partition by chrom order by pos) as end_pos from (select distinct chrom, start_pos as pos from anno union select chrom, end_pos from anno)) "
    "select c.chrom, c.start_pos, c.end_pos, string_agg(distinct a.anno, ',' order by a.anno) as sources, count(distinct a.anno) as n_sources from cuts c join anno a on a.chrom = c.chrom and a.start_pos < c.end_pos and c.start_pos < a.end_pos where c.end_pos is not null group by 1, 2, 3",
)
def w13(spark, sf):
    return iv.multi_intersect(anno(spark, sf).select("anno", *iv.KEY), "anno")


@query("w14_run_lengths", ISLANDS.format(v="depth", t=DEPTH.format(t="reads")))
def w14(spark, sf):
    return iv.depth(reads(spark, sf))


@query("a16_end_depth", ISLANDS.format(v="depth", t="select chrom, three_end as start_pos, three_end + 1 as end_pos, count(*) as depth from reads where (flag & 1412) = 0 group by 1, 2"))
def a16(spark, sf):
    from lociq.operators.regions import NOT_COUNTED, passing

    return iv.end_depth(reads(spark, sf).where(passing(F.col("flag"), NOT_COUNTED)))


TOP = (
    "select c.chrom, c.start_pos, c.end_pos, max(p.n_reads) as n_reads from (select chrom, pos as start_pos, lead(pos) over (partition by chrom order by pos) as end_pos from (select chrom, start_pos as pos from peaks union select chrom, end_pos from peaks)) c "
    "join (select *, unnest(generate_series(start_pos // 1024, (end_pos - 1) // 1024)) as bin from peaks) p on p.chrom = c.chrom and p.bin = c.start_pos // 1024 and p.start_pos <= c.start_pos and c.start_pos < p.end_pos where c.end_pos is not null group by 1, 2, 3"
)


@query("a17_track_max", ISLANDS.format(v="n_reads", t=TOP + " having max(p.n_reads) > 10"))
def a17(spark, sf):
    return iv.track_max(peaks(spark, sf), "n_reads", 10)


@query("w20_primer_pairs", "select a.anno_id, a.start_pos, case when strand = '-' then greatest(0, a.start_pos - 750) else a.start_pos end as target_start, case when strand = '-' then end_pos else end_pos + 750 end as target_end from anno a where strand is not null and exists (select 1 from peaks p where p.chrom = a.chrom and p.start_pos < case when a.strand = '-' then a.end_pos else a.end_pos + 1200 end and case when a.strand = '-' then greatest(0, a.start_pos - 1200) else a.start_pos end < p.end_pos)")
def w20(spark, sf):
    hits = anno(spark, sf).where("strand is not null").select("anno_id", "strand", *iv.KEY)
    near = iv.semi(iv.extend_stranded(hits, 0, 1200), peaks(spark, sf)).select("anno_id")
    target = iv.extend_stranded(hits, 0, 750).select("anno_id", F.col("start_pos").alias("target_start"), F.col("end_pos").alias("target_end"))
    return hits.join(near, "anno_id").join(target, "anno_id").select("anno_id", "start_pos", F.col("target_start").cast("long").alias("target_start"), "target_end")
