"""Sorting, sets, scalar functions, sources and sinks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lociq.functions import alignment as al
from lociq.functions.staging import staged
from lociq.operators import intervals as iv
from lociq.plans.registry import query
from lociq.plans.region_queries import R6
from lociq.sources import readers as rd
from lociq.sources.proxies import anno, peaks, reads, table

flag = lambda: F.col("flag")


@query("o01_coordinate_sort", "select chrom, start_pos, end_pos, row_number() over (partition by chrom order by start_pos, end_pos, l_orderkey, l_linenumber, cell_id, n_reads) as i from peaks")
def o01(spark, sf):
    p = iv.numbered(peaks(spark, sf), ("chrom",), "start_pos", ["start_pos", "end_pos", "l_orderkey", "l_linenumber", "cell_id", "n_reads"], "i")
    return p.select("chrom", "start_pos", "end_pos", F.col("i").cast("long").alias("i"))


@query("o02_natural_order", "select chrom, row_number() over (order by case when chrom = 'chrX' then 23 when chrom = 'chrY' then 24 else cast(substr(chrom, 4) as int) end) as i from (select distinct chrom from reads)")
def o02(spark, sf):
    key = F.when(F.col("chrom") == "chrX", 23).when(F.col("chrom") == "chrY", 24).otherwise(F.substring("chrom", 4, 10).cast("int"))
    return reads(spark, sf).select("chrom").distinct().select("chrom", F.row_number().over(Window.orderBy(key)).cast("long").alias("i"))  # a row for each contig


@query("o03_order_by_aggregate", "select l_suppkey, row_number() over (order by m desc, l_suppkey) as i from (select l_suppkey, avg(l_quantity) as m from lineitem group by 1)")
def o03(spark, sf):
    m = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.avg("l_quantity").alias("m"))
    return iv.row_numbers(m, [F.desc("m"), "l_suppkey"], "i").select("l_suppkey", "i")


@query("o04_top_k", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 25")
def o04(spark, sf):
    return table(spark, sf, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25).select("o_orderkey", "o_totalprice")


@query("o05_dedup_first", "select l_orderkey, l_linenumber, l_suppkey, n > 1 as repeated from (select *, row_number() over (partition by l_orderkey, l_linenumber order by l_suppkey, l_partkey, l_quantity, l_extendedprice) as i, count(*) over (partition by l_orderkey, l_linenumber) as n from lineitem) where i = 1")
def o05(spark, sf):
    w = Window.partitionBy("l_orderkey", "l_linenumber")
    li = table(spark, sf, "lineitem").withColumn("i", F.row_number().over(w.orderBy("l_suppkey", "l_partkey", "l_quantity", "l_extendedprice"))).withColumn("n", F.count("*").over(w))
    return li.where("i = 1").select("l_orderkey", "l_linenumber", "l_suppkey", (F.col("n") > 1).alias("repeated"))


@query("o06_uniqueness", "select count(*) = count(distinct o_orderkey) as orders_unique, (select count(*) = count(distinct l_orderkey) from lineitem) as lines_unique from orders")
def o06(spark, sf):
    u = lambda t, k, n: table(spark, sf, t).agg((F.count("*") == F.count_distinct(k)).alias(n))
    return u("orders", "o_orderkey", "orders_unique").crossJoin(u("lineitem", "l_orderkey", "lines_unique"))  # one row each


@query("o07_downsample", "select label, cell_id, start_pos, n_reads from (select *, row_number() over (partition by label order by md5(concat_ws(':', cell_id, start_pos, n_reads)), cell_id, start_pos, n_reads) as i from peaks) where i <= least(10000, (select min(n) from (select count(*) as n from peaks group by label)))")
def o07(spark, sf):
    """As many rows of each label as the smallest label has, 10,000 at most, in hash order."""
    names = ["label", "cell_id", "start_pos", "n_reads"]
    p = peaks(spark, sf).select(*names).withColumn("h", F.md5(F.concat_ws(":", *names[1:]))).withColumn("slot", F.substring("h", 1, 4))
    # counts by the hash's beginning show up to where each label's rows can matter; only these are sorted
    n = staged(p.groupBy("label", "slot").agg(F.count("*").alias("n")), "slots")
    least = n.groupBy("label").agg(F.sum("n").alias("n")).agg(F.least(F.min("n"), F.lit(10_000))).first()[0] or 0
    before = F.coalesce(F.sum("n").over(Window.partitionBy("label").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = n.withColumn("before", before).where(F.col("before") < least).groupBy(F.col("label").alias("of")).agg(F.max("slot").alias("last"))
    near = p.join(F.broadcast(last), F.col("label").eqNullSafe(F.col("of"))).where("slot <= last")  # a row for each label
    w = Window.partitionBy("label").orderBy("h", *names[1:])
    return near.withColumn("i", F.row_number().over(w)).where(F.col("i") <= least).select(*names)  # a literal limit, so each task passes on no more rows than that


@query("o08_concat_sort", "select k, row_number() over (order by k) as i from (select s_suppkey as k from supplier union all select c_custkey + 100000 from customer)")
def o08(spark, sf):
    k = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k")).union(table(spark, sf, "customer").select(F.col("c_custkey") + 100000))
    return iv.row_numbers(k, ["k"], "i").select("k", "i")


@query("u01_union_all", "select kind, count(*) as n from (select 'c' as kind, c_custkey as k from customer union all select 's', s_suppkey from supplier) group by 1")
def u01(spark, sf):
    c = table(spark, sf, "customer").select(F.lit("c").alias("kind"), F.col("c_custkey").alias("k"))
    return c.unionByName(table(spark, sf, "supplier").select(F.lit("s").alias("kind"), F.col("s_suppkey").alias("k"))).groupBy("kind").agg(F.count("*").alias("n"))


KEYS = ("select s_nationkey as k from supplier", "select c_nationkey as k from customer where c_acctbal > 5000", "select n_nationkey as k from nation where n_regionkey < 3")


def key_sets(spark, sf):
    return (
        table(spark, sf, "supplier").select(F.col("s_nationkey").alias("k")),
        table(spark, sf, "customer").where("c_acctbal > 5000").select(F.col("c_nationkey").alias("k")),
        table(spark, sf, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").alias("k")),
    )


@query("u02_union_distinct", f"{KEYS[0]} union {KEYS[1]}")
def u02(spark, sf):
    a, b, _ = key_sets(spark, sf)
    return a.union(b).distinct()


@query("u03_intersect", f"{KEYS[0]} intersect {KEYS[2]}")
def u03(spark, sf):
    a, _, c = key_sets(spark, sf)
    return a.intersect(c)


@query("u04_except", f"{KEYS[1]} except {KEYS[2]}")
def u04(spark, sf):
    _, b, c = key_sets(spark, sf)
    return b.subtract(c)


@query("u05_venn", "select a, b, c, count(*) as n from (select k, bool_or(s = 'a') as a, bool_or(s = 'b') as b, bool_or(s = 'c') as c from (" + " union all ".join(f"select k, '{n}' as s from ({q})" for n, q in zip("abc", KEYS, strict=True)) + ") group by 1) group by 1, 2, 3")
def u05(spark, sf):
    tagged = None
    for n, df in zip("abc", key_sets(spark, sf), strict=True):
        df = df.withColumn("s", F.lit(n))
        tagged = df if tagged is None else tagged.union(df)
    return tagged.groupBy("k").agg(*(F.bool_or(F.col("s") == n).alias(n) for n in "abc")).groupBy("a", "b", "c").agg(F.count("*").alias("n"))


CIGAR = "concat(cast(event_id % 60 as {s}), case when event_id % 3 = 0 then 'S' when event_id % 3 = 1 then 'M' else 'H' end, '70M', cast(event_id % 45 as {s}), case when event_id % 2 = 0 then 'S' else 'M' end)"
SEQ = "substring(concat('AAAATTTTACGTAAAAAACCGGTTTTTTTA', 'ACGTTTTTAAAAAGC', 'AAAAAAAATTTTTTTTTTCG'), cast(1 + event_id % 20 as int), 40)"


def aligned(spark, sf):
    return reads(spark, sf).select("event_id", "flag", F.expr(CIGAR.format(s="string")).alias("cigar"), F.expr(SEQ).alias("seq"))


ALIGNED = f"(select event_id, flag, {CIGAR.format(s='varchar')} as cigar, {SEQ} as seq from reads)"


@query("s01_is_reference_read", f"select event_id, case when flag & 128 > 0 then coalesce(try_cast(nullif(case when flag & 16 = 0 then regexp_extract(cigar, '([0-9]+)[HS]$', 1) else regexp_extract(cigar, '^([0-9]+)[HS]', 1) end, '') as int), 0) < 30 else flag & 2 > 0 and coalesce(try_cast(nullif(case when flag & 16 = 0 then regexp_extract(cigar, '([0-9]+)[HS]$', 1) else regexp_extract(cigar, '^([0-9]+)[HS]', 1) end, '') as int), 0) < 30 end as fits from {ALIGNED}")
def s01(spark, sf):
    r = aligned(spark, sf)
    fits = al.is_reference_read(F.col("cigar"), F.col("cigar"), flag().bitwiseAND(16) == 0, flag().bitwiseAND(2) > 0, flag().bitwiseAND(128) > 0)
    return r.select("event_id", fits.alias("fits"))


PIECE = "case when f then substring(seq, 1, n) else substring(seq, length(seq) - n + 1, n) end"


@query("s02_clipped_run", f"select event_id, n as clip, case when n > 0 then coalesce(list_max(list_transform(regexp_extract_all({PIECE}, case when f then 'A+' else 'T+' end), lambda x: length(x))), 0) else 0 end::int as run from (select *, coalesce(try_cast(nullif(case when f then regexp_extract(cigar, '^([0-9]+)S', 1) else regexp_extract(cigar, '([0-9]+)S$', 1) end, '') as int), 0) as n from (select *, (flag & 128 > 0) <> (flag & 16 > 0) as f from {ALIGNED}))")
def s02(spark, sf):
    n, run = al.clipped_run(F.col("cigar"), F.col("seq"), flag().bitwiseAND(128) > 0, flag().bitwiseAND(16) > 0)
    return aligned(spark, sf).select("event_id", n.alias("clip"), run.alias("run"))


@query("s03_cigar_operations", f"select event_id, array_to_string(regexp_extract_all(cigar, '\\d+[MIDNSHP=X]'), '|') as operations from {ALIGNED}")
def s03(spark, sf):
    return aligned(spark, sf).select("event_id", F.array_join(al.cigar_operations(F.col("cigar")), "|").alias("operations"))


@query("s04_count_character", "select doc_id, length(text) - length(replace(text, 'a', '')) as n from documents")
def s04(spark, sf):
    return table(spark, sf, "documents").select("doc_id", al.count_of(F.col("text"), "a").cast("long").alias("n"))


@query("s05_supplementary", "select event_id, case when event_id % 7 = 0 then 0 else event_id % 4 end as n from events")
def s05(spark, sf):
    sa = F.expr("case when event_id % 7 = 0 then null else repeat('chr1,1,+;', cast(event_id % 4 as int)) end")
    return table(spark, sf, "events").select("event_id", al.supplementary(sa).cast("long").alias("n"))


@query("s06_read_ends", "select event_id, three_end, five_end, case when (flag & 128 > 0) <> (flag & 16 > 0) then end_pos else start_pos end as breakpoint_end from reads")
def s06(spark, sf):
    other = (flag().bitwiseAND(128) > 0) != (flag().bitwiseAND(16) > 0)
    return reads(spark, sf).select("event_id", "three_end", "five_end", F.when(other, F.col("end_pos")).otherwise(F.col("start_pos")).alias("breakpoint_end"))


@query("s07_reverse_complement", f"select event_id, reverse(translate(seq, 'ACGTN', 'TGCAN')) as rc from {ALIGNED}")
def s07(spark, sf):
    return aligned(spark, sf).select("event_id", al.reverse_complement(F.col("seq")).alias("rc"))


@query("s08_packed_fields", "select event_id, event_id % 50 as ref_pos, user_id as chimeric, nullif(case when event_type = 'view' then 'yes' else '' end, '') as is_unique, event_type as status from events")
def s08(spark, sf):
    e = table(spark, sf, "events").selectExpr("event_id", "concat('ref_pos=', event_id % 50, ',chimeric=', user_id, ',hybrid=1') as p", "case when event_type = 'view' then 'unique:yes,50bp_or_longer:no,orig_conf:high' else '-' end as q", "concat('status=', event_type, ',MEI=L1') as s")
    out = rd.insertions(e, "p", "q", "s")
    return out.select("event_id", F.col("ref_pos").cast("long").alias("ref_pos"), F.col("chimeric").cast("long").alias("chimeric"), "is_unique", "status")


@query("s09_split_index", "select p_partkey, split_part(p_name, ' ', 1) as first, nullif(split_part(p_name, ' ', 5), '') as fifth from part")
def s09(spark, sf):
    w = F.split("p_name", " ")
    return table(spark, sf, "part").select("p_partkey", F.get(w, F.lit(0)).alias("first"), F.get(w, F.lit(4)).alias("fifth"))


@query("s10_parentheses", "select p_partkey, p_size as left_bases from part")
def s10(spark, sf):
    return table(spark, sf, "part").select("p_partkey", rd.unparenthesised(F.concat(F.lit("("), F.col("p_size").cast("string"), F.lit(")"))).alias("left_bases"))


@query("s11_file_fields", "select s_suppkey, lpad(cast(s_suppkey as varchar), 6, '0') as padded, cast(s_suppkey as varchar) as stripped, case when s_name ilike '%1' then 'bulk' else 'cell' end as kind from supplier where s_suppkey > 0")
def s11(spark, sf):
    number = F.regexp_extract("s_name", r"(?i)supplier#(\d+)", 1)
    plain = F.regexp_replace(number, "^0+", "")
    return table(spark, sf, "supplier").where("s_suppkey > 0").select("s_suppkey", F.lpad(plain, 6, "0").alias("padded"), plain.alias("stripped"), F.when(F.col("s_name").rlike("(?i)1$"), "bulk").otherwise("cell").alias("kind"))


@query("s12_base_names", "select page_id, regexp_extract(url, '([^/]+)$', 1) as base, regexp_replace(url, '#top$', '') as plain from pages")
def s12(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.regexp_extract("url", "([^/]+)$", 1).alias("base"), F.regexp_replace("url", "#top$", "").alias("plain"))


@query("s13_string_functions", "select p_partkey, replace(p_name, ' ', '_') as joined, upper(p_type) as loud, starts_with(p_brand, 'Brand#1') as first, contains(p_name, 'ring') as has_ring from part")
def s13(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.replace("p_name", F.lit(" "), F.lit("_")).alias("joined"), F.upper("p_type").alias("loud"), F.startswith("p_brand", F.lit("Brand#1")).alias("first"), F.contains("p_name", F.lit("ring")).alias("has_ring"))


@query("s14_logarithms", "select p_partkey, round(log10(p_retailprice), 6) as l10, round(log2(p_size), 6) as l2, round(ln(p_size + 0.5), 6) as le from part")
def s14(spark, sf):
    return table(spark, sf, "part").select("p_partkey", R6(F.log10("p_retailprice"), "l10"), R6(F.log2("p_size"), "l2"), R6(F.ln(F.col("p_size") + 0.5), "le"))


@query("s15_arithmetic", "select p_partkey, abs(p_size - 25) as away, least(p_size, 10) as low, ceil(p_retailprice)::bigint as up, p_partkey // 7 as whole from part")
def s15(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.abs(F.col("p_size") - 25).alias("away"), F.least("p_size", F.lit(10)).alias("low"), F.ceil("p_retailprice").cast("long").alias("up"), F.expr("p_partkey div 7").alias("whole"))


@query("s16_least_of_known", "select event_id, least(case when event_id % 3 = 0 then null else value end, case when event_id % 5 = 0 then null else 20.0 end) as distance from events")
def s16(spark, sf):
    a, b = F.when(F.col("event_id") % 3 != 0, F.col("value")), F.when(F.col("event_id") % 5 != 0, F.lit(20.0))
    return table(spark, sf, "events").select("event_id", F.least(a, b).alias("distance"))


@query("s17_dates", "select o_orderkey, strftime(date_trunc('month', o_orderdate) + interval 12 year, '%Y-%m-%d') as day from orders")
def s17(spark, sf):
    when = F.add_months(F.trunc("o_orderdate", "month"), 144)  # into this century, as two-digit years are read
    text = F.when(F.col("o_orderkey") % 2 == 0, F.date_format(when, "MMddyyyy")).otherwise(F.date_format(when, "yyMMdd"))
    day = F.when(F.length("t") == 8, F.to_date("t", "MMddyyyy")).when(F.length("t") == 6, F.to_date("t", "yyMMdd")).otherwise(F.raise_error(F.lit("unknown date")).cast("date"))
    return table(spark, sf, "orders").withColumn("t", text).select("o_orderkey", day.cast("string").alias("day"))


@query("s18_arrays", "select o_custkey, round(avg(o_totalprice), 4) as mean, count(distinct o_orderstatus) as kinds, count(*) filter (o_orderpriority like '%URGENT%') as urgent from orders group by 1")
def s18(spark, sf):
    o = table(spark, sf, "orders").groupBy("o_custkey").agg(F.collect_list("o_totalprice").alias("xs"), F.collect_list("o_orderstatus").alias("ks"), F.collect_list("o_orderpriority").alias("ps"))
    mean = F.aggregate(F.array_sort("xs"), F.lit(0.0), lambda a, x: a + x) / F.size("xs")
    return o.select("o_custkey", F.round(mean, 4).alias("mean"), F.size(F.array_distinct("ks")).cast("long").alias("kinds"), F.size(F.filter("ps", lambda x: x.contains("URGENT"))).cast("long").alias("urgent"))


@query("s19_set_intersection", "select o_custkey, count(distinct o_orderstatus) filter (o_orderstatus in ('O', 'F')) as shared from orders group by 1")
def s19(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.size(F.array_intersect(F.collect_set("o_orderstatus"), F.array(F.lit("O"), F.lit("F")))).cast("long").alias("shared"))


@query("s20_json_field", "select event_id, cast(json_extract_string(props, '$.k') as int) as k from events")
def s20(spark, sf):
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


INSTANCES = ["TT/AAAA", "TC/AAAA", "TT/AAGA", "CT/AAAA", "TT/GAAA"]
WEIGHTS = al.motif_weights(INSTANCES)


@query("s21_motif_weights", "select * from (values " + ", ".join(f"({i}::bigint, '{b}', {round(v, 6)}::double)" for i, w in enumerate(WEIGHTS) for b, v in w.items()) + ") t(place, base, weight)")
def s21(spark, sf):
    chars = spark.createDataFrame([(s,) for s in INSTANCES], "s string").select(F.posexplode(F.split(F.replace("s", F.lit("/"), F.lit("")), "(?!^)(?!$)")).alias("place", "base"))
    n = chars.groupBy("place").pivot("base", list("ACGT")).agg(F.count(F.lit(1))).na.fill(0)
    long = n.unpivot("place", list("ACGT"), "base", "n")
    return long.select(F.col("place").cast("long").alias("place"), "base", R6(F.log2((F.col("n") + 0.5) / (len(INSTANCES) + 2.0) / 0.25), "weight"))


MOTIF = " + ".join("case substring(seq, i + {j}, 1) {c} else 0 end".format(j=j, c=" ".join(f"when '{b}' then {v!r}" for b, v in w.items())) for j, w in enumerate(WEIGHTS))


STRANDS = f"(select event_id, seq from {ALIGNED} union all select event_id, reverse(translate(seq, 'ACGTN', 'TGCAN')) from {ALIGNED})"


@query("w19_motif_score", f"select event_id, round(max({MOTIF})::double, 6) as best from (select event_id, seq, unnest(generate_series(1, length(seq) - {len(WEIGHTS) - 1})) as i from {STRANDS}) group by 1")
def w19(spark, sf):
    """Best score of the motif on either strand."""
    best = lambda s: al.motif_best(s, WEIGHTS)
    return aligned(spark, sf).select("event_id", R6(F.greatest(best(F.col("seq")), best(al.reverse_complement(F.col("seq")))), "best"))


@query("src04_column_pruning", "select o_orderkey, o_orderstatus from orders where o_totalprice > 100000")
def src04(spark, sf):
    return table(spark, sf, "orders").where("o_totalprice > 100000").select("o_orderkey", "o_orderstatus")


@query("src05_tabix_locus", "select anno_id, concat(chrom, ':', start_pos, '-', end_pos) as locus, n_name as region from anno join nation on n_nationkey = anno_id % 25")
def src05(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("k"), F.col("n_name").alias("region"))
    return anno(spark, sf).withColumn("k", F.col("anno_id") % 25).join(n, "k").select("anno_id", iv.locus().alias("locus"), "region")


@query("src09_filtered_calls", "select p_partkey, p_size as ac from part where p_type like '%ECONOMY%' and p_size > 10")
def src09(spark, sf):
    packed = F.concat_ws(";", F.col("p_size").cast("string"), F.lit("PASS"))
    ac = F.split(packed, ";")[0].cast("int")
    return table(spark, sf, "part").where(F.col("p_type").contains("ECONOMY")).select("p_partkey", ac.alias("ac")).where("ac > 10")


@query("src11_vcf_intervals", "select concat('chr', o_orderkey % 5) as chrom, o_custkey - 1 as start_pos, o_custkey as end_pos, cast(o_orderkey as varchar) as id, (o_orderkey % 4)::int as ac from orders where o_orderkey % 4 > 0 and o_orderkey % 3 = 1")
def src11(spark, sf):
    rows = table(spark, sf, "orders").selectExpr("concat('chr', o_orderkey % 5) as chrom", "o_custkey as pos", "cast(o_orderkey as string) as id", "'A' as ref", "case when o_orderkey % 3 = 1 then 'ACG' else 'T' end as alt", "concat('AN=2;AC=', o_orderkey % 4) as info")
    return rd.vcf_intervals(rows)


@query("src18_subsequence", "select doc_id, substring(text, 11, 20) as piece from documents")
def src18(spark, sf):
    return table(spark, sf, "documents").select("doc_id", rd.subsequence(F.col("text"), F.lit(10), F.lit(30)).alias("piece"))


@query("src20_read_groups", "select event_type as path, count(distinct user_id % 4) as n from events group by 1")
def src20(spark, sf):
    r = table(spark, sf, "events").selectExpr("event_type as path", "concat('M:1:F', user_id % 2, ':', user_id % 4, ':9:9:ACGT') as name")
    return rd.read_groups(r).select("path", F.size("groups").cast("long").alias("n"))


@query("src21_pushed_predicate", "select count(*) as n from lineitem where l_quantity >= 10 and l_returnflag not in ('N')")
def src21(spark, sf):
    return table(spark, sf, "lineitem").where("l_quantity >= 10 and l_returnflag not in ('N')").agg(F.count("*").alias("n"))


@query("src27_breakpoints", "select o_custkey, count(*) filter (o_orderstatus = 'F') as n_items, round(avg(o_orderkey) filter (o_orderstatus = 'F'), 4) as mean_start, coalesce(string_agg(distinct case when o_orderkey % 2 = 0 then '+' else '-' end, '' order by case when o_orderkey % 2 = 0 then '+' else '-' end) filter (o_orderstatus = 'F'), '') as strands from orders group by 1")
def src27(spark, sf):
    rows = table(spark, sf, "orders").selectExpr("o_custkey", "concat_ws(',', concat('x', o_orderstatus), o_orderkey, 0, case when o_orderkey % 2 = 0 then '+' else '-' end) as item").groupBy("o_custkey").agg(F.concat_ws(";", F.collect_list("item")).alias("packed"))
    out = rd.breakpoints(rows, "packed", "xF")
    return out.select("o_custkey", F.col("n_items").cast("long").alias("n_items"), F.round("mean_start", 4).alias("mean_start"), "strands")


@query("src31_links", "select page_id, len(regexp_extract_all(html, 'href=\"([^\"]+)\"')) as n from pages")
def src31(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.size(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1))).cast("long").alias("n"))


@query("snk07_snapshot_lines", "select concat('goto ', chrom, ':', start_pos - 100, '-', end_pos + 100, chr(10), 'snapshot ', chrom, '_', start_pos - 100, '_', end_pos + 100, '.png') as command from anno where start_pos > 100")
def snk07(spark, sf):
    return rd.snapshot_lines(anno(spark, sf).where("start_pos > 100"))


@query("snk09_thirds", "select s_suppkey, ntile(3) over (order by s_suppkey) as third from supplier")
def snk09(spark, sf):
    return rd.thirds(table(spark, sf, "supplier"), "s_suppkey").select("s_suppkey", F.col("third").cast("long").alias("third"))
