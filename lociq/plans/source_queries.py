"""Readers and sinks: each query writes a file of its format into the shared folder and reads it back; SQL says what must come out."""

from __future__ import annotations

from pyspark.sql import functions as F

from lociq.functions.staging import written_once
from lociq.operators import learning as ln
from lociq.operators import loci
from lociq.operators import summaries as sm
from lociq.plans.registry import query
from lociq.plans.region_queries import R6
from lociq.sources import alignment_files as af
from lociq.sources import fastq_files as fq
from lociq.sources import genotypes as gt
from lociq.sources import readers as rd
from lociq.sources import region_files as rf
from lociq.sources import sequences as sq
from lociq.sources import validation as va
from lociq.sources import variants as vr
from lociq.sources.proxies import anno, peaks, reads, table


def written(df, sf: str, name: str) -> str:
    """The path of a text file of the only column of ``df``, in tasks' order, written once an application."""
    return written_once(df.sparkSession, f"{name}-{sf}", lambda path: df.write.text(path))


@query("src01_delimited", "select lpad(cast(c_custkey as varchar), 8, '0') as sample_id, c_mktsegment as tissue_id, cast(c_nationkey as varchar) as donor_id from customer")
def src01(spark, sf):
    """Ids keep their leading zeros, as their columns are pinned to strings."""
    path = written_once(spark, f"sheet-{sf}", lambda path: table(spark, sf, "customer").select(F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("sample_id"), F.col("c_mktsegment").alias("tissue_id"), F.col("c_nationkey").alias("donor_id")).write.option("sep", "\t").option("header", True).csv(path))
    return rd.delimited(spark, path, "sample_id string, tissue_id string, donor_id string")


@query("src02_lines", "select s_name as line from supplier")
def src02(spark, sf):
    s = table(spark, sf, "supplier").select(F.explode(F.array(F.concat(F.lit("  "), "s_name", F.lit(" ")), F.lit(""), F.lit("   "))).alias("value"))
    return rd.lines(spark, written(s, sf, "lines"))


@query("src03_validated_sheet", "select 'c_name' as field, count(*) filter (c_name is null) as missing, 0 as unknown from customer union all select 'c_mktsegment', count(*) filter (c_mktsegment is null), count(*) filter (c_mktsegment not in ('BUILDING', 'MACHINERY')) from customer")
def src03(spark, sf):
    return rd.violations(table(spark, sf, "customer"), {"c_name": None, "c_mktsegment": ["BUILDING", "MACHINERY"]})


SHEET_RULES = {
    "properties": {"c_name": {"type": "string", "pattern": "[02468]$"}, "c_mktsegment": {"enum": ["BUILDING", "MACHINERY", "AUTOMOBILE", "FURNITURE"]}, "c_acctbal": {"type": "number", "minimum": 0, "exclusiveMaximum": 9000}, "c_nationkey": {"type": "integer", "maximum": 20}, "c_phone": {"type": "string"}, "c_custkey": {"type": "string"}},
    "required": ["c_custkey", "c_phone"],
}
BROKEN = {"c_name": {"pattern": "not regexp_matches(c_name, '[02468]$')"}, "c_mktsegment": {"enum": "c_mktsegment not in ('BUILDING', 'MACHINERY', 'AUTOMOBILE', 'FURNITURE')"}, "c_acctbal": {"minimum": "c_acctbal < 0", "exclusiveMaximum": "c_acctbal >= 9000"}, "c_nationkey": {"maximum": "c_nationkey > 20"}, "c_custkey": {"type": "true"}, "c_phone": {"required": "true"}}


@query("src03_schema_violations", " union all ".join(f"select c_custkey, '{c}' as field, '{rule}' as rule from customer where {wrong}" for c, rules in BROKEN.items() for rule, wrong in rules.items()))
def src03_schema(spark, sf):
    """A sheet against a schema, every rule in one pass: types, patterns, enumerations, bounds, and a required column that the sheet lacks."""
    sheet = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    return va.violations(sheet, SHEET_RULES, ["c_custkey"]).drop("value")


@query("src06_bed", "select chrom, start_pos, end_pos, cast(anno_id as varchar) as name, 0.0::double as score, strand from anno where strand is not null")
def src06(spark, sf):
    a = anno(spark, sf).where("strand is not null").select("chrom", "start_pos", "end_pos", F.col("anno_id").alias("name"), F.lit(0.0).alias("score"), "strand")
    path = written_once(spark, f"bed-{sf}", lambda path: rd.write_bed(a, path))
    return rd.bed(spark, path, 6)


@query("src07_insertions", "select p_partkey, p_size as ref_pos, case when p_size > 25 then p_size end as chimeric, case when p_type like '%STEEL%' then 'yes' else 'no' end as is_unique, split_part(p_type, ' ', 1) as status, 'L1' as family from part")
def src07(spark, sf):
    """Packed fields of a text file; a field that isn't there is null."""
    line = F.concat_ws("\t", F.col("p_partkey").cast("string"), F.concat(F.lit("ref_pos="), "p_size", F.when(F.col("p_size") > 25, F.concat(F.lit(",chimeric="), "p_size")).otherwise(F.lit(",hybrid=0"))), F.concat(F.lit("unique:"), F.when(F.col("p_type").contains("STEEL"), "yes").otherwise("no"), F.lit(",50bp_or_longer:no")), F.concat(F.lit("status="), F.split("p_type", " ")[0], F.lit(",MEI=L1")))
    rows = rd.delimited(spark, written(table(spark, sf, "part").select(line), sf, "insertions"), "p_partkey long, p string, q string, s string", header=False)
    return rd.insertions(rows, "p", "q", "s").select("p_partkey", F.col("ref_pos"), "chimeric", "is_unique", "status", "family")


@query("src08_absences", "select l_orderkey, l_linenumber, 'AluY' || l_suppkey % 3 as subfamily, 'Alu' as family, l_quantity::bigint as tsd_length, l_returnflag as genotype, l_linestatus = 'F' as passed from lineitem")
def src08(spark, sf):
    """Absence genotypes: 'subfamily:family', 'name=length' and 'genotype;filter'."""
    li = table(spark, sf, "lineitem")
    line = F.concat_ws("\t", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.concat(F.lit("AluY"), F.col("l_suppkey") % 3, F.lit(":Alu")), F.concat(F.lit("TSD_len="), F.col("l_quantity").cast("long")), F.concat("l_returnflag", F.lit(";"), F.when(F.col("l_linestatus") == "F", "PASS").otherwise("LOW")))
    rows = rd.delimited(spark, written(li.select(line), sf, "absences"), "l_orderkey long, l_linenumber int, repeat string, tsd string, call string", header=False)
    return rd.absences(rows, "repeat", "tsd", "call").select("l_orderkey", "l_linenumber", "subfamily", "family", "tsd_length", "genotype", "passed")


@query("src10_sources_by_donor", "select cast(donor_id as varchar) as donor, chrom, count(*) as n from anno group by 1, 2")
def src10(spark, sf):
    """A file for each donor, all read at once with the donor as a column."""
    path = written_once(spark, f"donors-{sf}", lambda path: anno(spark, sf).select(F.col("donor_id").alias("donor"), "chrom", "start_pos", "end_pos").write.partitionBy("donor").option("sep", "\t").csv(path))
    return rd.sources(spark, f"{path}/donor=*", "chrom string, start_pos long, end_pos long", r"donor=(\d+)", "donor").groupBy("donor", "chrom").agg(F.count("*").alias("n"))


@query(
    "src10_donor_genotypes",
    "with e as (select chrom, greatest(0, case when strand = '-' then start_pos - 100 else end_pos - 201 end) as s, case when strand = '-' then start_pos + 201 else end_pos + 100 end as e from anno where anno = '2-HIGH' and anno_id % 3 = 2 and strand is not null), "
    "d as (select distinct donor_id from peaks), x as (select e.chrom, e.s, e.e, d.donor_id, row_number() over () as i from e cross join d), "
    "n as (select x.i, count(p.cell_id) filter (p.l_linenumber % 3 = 1) as het, count(p.cell_id) filter (p.l_linenumber % 3 = 2) as hom from x left join (select * from peaks where label = 'KRGL' and n_reads > 3 and cell_id % 2 = 0) p on p.donor_id = x.donor_id and p.chrom = x.chrom and p.start_pos < x.e and x.s < p.end_pos group by 1) "
    "select donor_id, chrom, s as start_pos, e as end_pos, case when het > 0 then 'reference_het' else 'reference_hom' end as class from x join n using (i) where hom = 0 union all "
    "select donor_id, chrom, greatest(0, start_pos - 10), end_pos + 10, case when l_linenumber % 3 = 1 then 'inserted_het' else 'inserted_hom' end from peaks where label = 'KNRGL' and n_reads > 3 and cell_id % 2 = 0 and l_linenumber % 3 > 0",
)
def src10_genotypes(spark, sf):
    """Genotypes of all donors from files of repeats and of calls, each parsed once."""
    repeat = anno(spark, sf).where("strand is not null").select("chrom", "start_pos", "end_pos", "anno", F.lit(0.0), "strand", F.lit(1), F.lit(1), F.lit(1), F.lit("(5)"), F.lit("LINE"), F.lit("1"), (5999 + F.col("anno_id") % 3).cast("string"), F.lit("(0)"))
    calls = peaks(spark, sf).select("chrom", "start_pos", "end_pos", "donor_id", F.when(F.col("cell_id") % 2 == 0, "x").otherwise("y"), F.col("l_linenumber") % 3, (F.col("n_reads") > 3).cast("string"), "label")
    at = lambda df, name: written_once(spark, f"{name}-{sf}", lambda path: df.write.option("sep", "\t").csv(path))
    call_rows = lambda label: rd.delimited(spark, at(calls, "calls"), "chrom string, start_pos long, end_pos long, donor_id long, family string, genotype int, passed boolean, label string", header=False).where(F.col("label") == label)
    repeats = gt.loaded(spark, f"repeats-{sf}", lambda: rd.repeats(spark, at(repeat, "repeat-file"))).withColumns({"rep_end": F.col("rep_end").cast("int"), "family": F.lit("x")})
    parts = [gt.loaded(spark, f"calls-{label}-{sf}", lambda label=label: call_rows(label)) for label in ("KNRGL", "KRGL")]
    named = repeats.withColumn("rep_name", F.when(F.col("rep_name") == "2-HIGH", "x").otherwise(F.col("rep_name")))
    return gt.donor_genotypes(named, *parts, "x")


@query("src12_vcf", "select concat('chr', o_custkey % 5) as chrom, o_orderkey - 1 as start_pos, o_orderkey as end_pos, cast(o_orderkey as varchar) as id, (o_orderkey % 4)::int as ac, case when o_orderstatus = 'F' then '0/1' else '1/1' end as genotype from orders where o_orderkey % 4 > 0")
def src12(spark, sf):
    line = "concat_ws('\t', concat('chr', o_custkey % 5), o_orderkey, o_orderkey, 'A', 'ACG', '.', 'PASS', concat('AN=2;AC=', o_orderkey % 4), 'GT:DP', concat(case when o_orderstatus = 'F' then '0/1' else '1/1' end, ':30')) as value"
    rows = rd.vcf(spark, written(table(spark, sf, "orders").selectExpr(line), sf, "vcf"))
    called = rd.vcf_intervals(rows, keep=("sample",))
    return called.withColumn("genotype", F.split("sample", ":")[0]).drop("sample")


@query("src13_alignment_text", "select cast(event_id as varchar) as name, flag, chrom, start_pos, mapq, cast(cell_id as varchar) as cell, score > 50 as strong from reads")
def src13(spark, sf):
    """Alignment records of text: eleven fixed fields and typed tags."""
    r = reads(spark, sf)
    line = F.concat_ws("\t", F.col("event_id").cast("string"), F.col("flag").cast("string"), "chrom", (F.col("start_pos") + 1).cast("string"), F.col("mapq").cast("string"), F.lit("50M"), F.lit("="), F.lit("1"), F.lit("0"), F.lit("ACGT"), F.lit("IIII"), F.concat(F.lit("CB:Z:"), "cell_id"), F.concat(F.lit("AS:f:"), F.col("score").cast("string")))
    head = spark.createDataFrame([("@HD\tVN:1.6",), ("@SQ\tSN:chr0\tLN:2592000",)], "value string")
    s = rd.alignments(spark, written(head.union(r.select(line.alias("value"))), sf, "sam"))
    return s.select("name", "flag", "chrom", "start_pos", "mapq", F.col("tags")["CB"].alias("cell"), (F.col("tags")["AS"].cast("double") > 50).alias("strong"))


def cohort(spark, sf):
    """A variant file of three samples, written once an application: its path."""
    head = ["##fileformat=VCFv4.2", '##INFO=<ID=END,Number=1,Type=Integer,Description="x">', '##INFO=<ID=SUBTYPE,Number=1,Type=String,Description="x, y">', '##INFO=<ID=SVTYPE,Number=1,Type=String,Description="x">', '##INFO=<ID=0START,Number=1,Type=Integer,Description="x">', '##INFO=<ID=0END,Number=1,Type=Integer,Description="x">', '##INFO=<ID=AF,Number=A,Type=Float,Description="x">', '##INFO=<ID=PRECISE,Number=0,Type=Flag,Description="x">', '##FORMAT=<ID=GT,Number=1,Type=String,Description="x">', "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", "A.md", "B.md", "C"])]
    line = (
        "concat_ws('\t', concat('chr', o_custkey % 5), o_orderkey, o_orderkey, 'A', if(o_orderkey % 3 = 1, 'ACG,T', 'T'), '.', if(o_orderkey % 2 = 0, 'PASS', 'LOW'), concat('SUBTYPE=', o_orderpriority, ';END=', o_orderkey + o_custkey % 7, if(o_orderkey % 2 = 0, ';PRECISE', ''), ';SVTYPE=', if(o_orderstatus = 'F', 'LINE/L1', 'SVA'), ';0START=', o_orderkey - 5, ';0END=', o_orderkey + 5, ';AF=0.5,.'), 'GT:DP', "
        "concat('0/', o_orderkey % 2, ':30'), concat(if(o_custkey % 4 = 0, '.', '0'), '|', case when o_orderkey % 3 = 1 then o_custkey % 3 else o_custkey % 2 end, ':', o_custkey), './.')"
    )
    rows = spark.createDataFrame([("\n".join(head),)], "value string").union(table(spark, sf, "orders").selectExpr(f"{line} as value"))
    return written_once(spark, f"cohort-{sf}", lambda path: rows.write.text(path))


@query("src11_sample_calls", "select concat('chr', o_custkey % 5) as chrom, o_orderkey - 1 as start_pos, o_orderkey + o_custkey % 7 as end_pos, case when o_orderkey % 2 = 0 then 'PASS' else 'LOW' end as filter, o_orderpriority as subtype, case when o_custkey % 4 = 0 then 1 else 2 end as an, o_custkey as dp from orders where o_orderpriority not like '%URGENT%' and case when o_orderkey % 3 = 1 then o_custkey % 3 else o_custkey % 2 end > 0")
def src11_sample(spark, sf):
    """Calls of one sample of three, by name: alleles counted over it alone, a pattern on a typed tag, the END tag."""
    rows = vr.called(vr.read(spark, cohort(spark, sf), ["B.md"])).where("not info.SUBTYPE rlike 'URGENT'")
    return vr.intervals(rows, filter=F.col("filter"), subtype=F.col("info.SUBTYPE"), an=F.col("an"), dp=F.try_element_at(F.col("calls")[0]["fields"], F.lit("DP")).cast("long"))


@query("src12_tag_intervals", "select concat('chr', o_custkey % 5) as chrom, o_orderkey - 5 as start_pos, o_orderkey + 5 as end_pos, o_orderkey % 2 = 0 as precise, (o_orderkey % 2)::int as carriers, 0.5::double as first_frequency from orders where o_orderstatus = 'F' and o_orderkey % 3 = 1")
def src12_tags(spark, sf):
    """Intervals that tags give, of records with a longer alternative; flags and lists of numbers are typed."""
    rows = vr.longer(vr.read(spark, cohort(spark, sf), ["A.md", "C"])).where("info.SVTYPE = 'LINE/L1'")
    return vr.intervals(rows, F.col("info.0START"), F.col("info.0END"), precise=F.col("info.PRECISE"), carriers=F.col("ac")[0], first_frequency=F.col("info.AF")[0])


def aligned(spark, sf):
    """The reads as block-compressed, indexed alignment files, written once an application."""
    r = reads(spark, sf)
    width, back = (F.col("end_pos") - F.col("start_pos")).cast("string"), (F.col("flag").bitwiseAND(16) > 0)
    rows = r.select(
        F.col("event_id").cast("string").alias("name"), "flag", F.coalesce("chrom", F.lit("*")).alias("chrom"), "mapq", F.when(back, F.concat(F.lit("3S"), width, F.lit("M"))).otherwise(F.concat(width, F.lit("M2S"))).alias("cigar"), F.lit("=").alias("next_chrom"), (F.col("start_pos") + 1).alias("next_pos"),
        F.lit(0).cast("long").alias("length"), F.lit("ACGTN").alias("seq"), F.lit("IIIHH").alias("qual"), F.create_map(F.lit("CB"), F.col("cell_id").cast("string"), F.lit("XS"), F.col("score").cast("string")).alias("tags"), "start_pos",
    )
    return af.read(spark, written_once(spark, f"aligned-{sf}", lambda path: af.write(rows, path, {f"chr{k}": 2_592_000 for k in range(5)})), 1 << 18)


@query("src13_alignment_files", "select cast(event_id as varchar) as name, flag, chrom, start_pos, end_pos, mapq, case when flag & 16 > 0 then '3S' || (end_pos - start_pos) || 'M' else (end_pos - start_pos) || 'M2S' end as cigar, cast(cell_id as varchar) as cell, score > 50 as strong from reads")
def src13_files(spark, sf):
    """Binary alignment files in splits: fixed fields, packed bases, operations and tags."""
    return aligned(spark, sf).where("seq = 'ACGTN' and qual = 'IIIHH'").select("name", "flag", "chrom", "start_pos", "end_pos", "mapq", "cigar", F.col("tags")["CB"].alias("cell"), (F.col("tags")["XS"].cast("double") > 50).alias("strong"))


@query("src14_indexed_fetch", "select cast(event_id as varchar) as name, start_pos, end_pos from reads where chrom = 'chr2' and start_pos < 1400000 and end_pos > 1200000")
def src14_fetch(spark, sf):
    """One region by the files' index: the filters are pushed, and only the blocks of the region's bins are read."""
    return aligned(spark, sf).where("chrom = 'chr2' and start_pos < 1400000 and end_pos > 1200000").select("name", "start_pos", "end_pos")


@query("src19_fastq_reads", "select count(*) as n_reads, count(*) filter (doc_id % 2 = 0) as n_even, sum(length(source)) as bases from documents")
def src19(spark, sf):
    """Compressed records of four lines, read as a stream; those of a list of names are counted by a semi join."""
    d = table(spark, sf, "documents").select("doc_id", "source")
    path = written_once(spark, f"fastq-{sf}", lambda path: d.select(F.concat_ws("\n", F.concat(F.lit("@"), "doc_id"), F.col("source"), F.lit("+"), F.regexp_replace("source", ".", "I"))).write.option("compression", "gzip").text(path))
    q = rd.fastq(spark, f"{path}/*.gz")
    listed = d.where("doc_id % 2 = 0").select(F.col("doc_id").cast("string").alias("name"), F.lit(1).alias("listed")).distinct()
    return q.join(listed, "name", "left").agg(F.count("*").alias("n_reads"), F.count("listed").alias("n_even"), F.sum(F.length("seq")).alias("bases"))


@query("src19_fastq_splits", "select cast(doc_id as varchar) as name, source as seq, length(source) as n_qual, lang from documents")
def src19_splits(spark, sf):
    """Plain files of reads in splits that find their first record by themselves; qualities begin with the mark of a name."""
    d = table(spark, sf, "documents").select(F.concat_ws("\n", F.concat(F.lit("@"), "doc_id", F.lit(" "), "lang"), F.col("source"), F.lit("+"), F.rpad(F.lit("@"), F.length("source"), F.lit("+"))).alias("value"))
    q = fq.read(spark, written_once(spark, f"reads-{sf}", lambda path: d.write.text(path)), ".txt", 1 << 16)
    return q.select(F.substring_index("name", " ", 1).alias("name"), "seq", F.length("qual").cast("long").alias("n_qual"), F.substring_index("name", " ", -1).alias("lang"))


WIDE = "(select anno_id, chrom, greatest(0, start_pos - 60000) as start_pos, end_pos + 60000 as end_pos from anno)"


@query("src17_range_summaries", f"select anno_id, max(n_reads) as top, sum(n_reads * (least(a.end_pos, p.end_pos) - greatest(a.start_pos, p.start_pos)))::bigint as total, sum(least(a.end_pos, p.end_pos) - greatest(a.start_pos, p.start_pos))::bigint as bases from {WIDE} a join peaks p on a.chrom = p.chrom and a.start_pos < p.end_pos and p.start_pos < a.end_pos group by 1")
def src17_ranges(spark, sf):
    """Maxima and sums of a signal over wide regions, from blocks of several levels and the intervals at their edges."""
    a = anno(spark, sf).select("anno_id", "chrom", F.greatest(F.lit(0), F.col("start_pos") - 60_000).alias("start_pos"), (F.col("end_pos") + 60_000).alias("end_pos"))
    return sm.range_summaries(a, "anno_id", peaks(spark, sf), "n_reads")


@query("src18_region_sequences", "select doc_id, substring(regexp_replace(text, '[^acgt]', 'n', 'g'), 1 + 30 * (doc_id % 11)::int, 700) as seq from documents")
def src18_regions(spark, sf):
    """Regions across the lines and chunks of a sequence file; those beyond a record's end are cut."""
    d = table(spark, sf, "documents").select("doc_id", F.regexp_replace("text", "[^acgt]", "n").alias("bases"))
    lines = d.select(F.concat(F.lit(">d"), "doc_id", F.lit(" a document\n"), F.regexp_replace("bases", "(.{60})", "$1\n")).alias("value"))
    path = written_once(spark, f"sequences-{sf}", lambda path: lines.write.text(path))
    start = 30 * (F.col("doc_id") % 11)
    asked = d.select("doc_id", F.concat(F.lit("d"), "doc_id").alias("chrom"), start.alias("start_pos"), (start + 700).alias("end_pos"))
    return sq.fetch(sq.chunks(spark, path, 256), asked, "doc_id", 256).select("doc_id", "seq")


@query("snk08_raster", "select level, px // (1 << level) as px, py // (1 << level) as py, kind, count(*) as n from (select start_pos * 512 // 2592000 as px, n_reads * 64 // 64 as py, label as kind from peaks where start_pos < 2592000 and n_reads < 64), (select unnest([0, 1, 2, 3]) as level) group by 1, 2, 3, 4")
def snk08_raster(spark, sf):
    """A grid of counts by label over position and reads, at four resolutions."""
    return sm.raster(peaks(spark, sf), "start_pos", "n_reads", (0, 2_592_000, 0, 64), (512, 64), "label")


@query("snk01_indexed_regions", "select chrom, start_pos, end_pos, n_reads, label from peaks where chrom = 'chr3' and start_pos < 1500000 and end_pos > 1400000")
def snk01_indexed(spark, sf):
    """A table written in blocks with an index beside each file, and a region of it read back through the index."""
    rows = peaks(spark, sf).select("chrom", "start_pos", "end_pos", "n_reads", "label").where("chrom is not null")
    path = written_once(spark, f"regions-{sf}", lambda path: rf.write(rows, path))
    return rf.read(spark, path, "chrom string, start_pos long, end_pos long, n_reads long, label string", 1 << 17).where("chrom = 'chr3' and start_pos < 1500000 and end_pos > 1400000")


@query("src22_parquet", "select n_nationkey, n_name, n_regionkey from nation")
def src22(spark, sf):
    path = written_once(spark, f"plain-{sf}", lambda path: table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey").write.parquet(path))
    return spark.read.parquet(path)


@query("src24_report_sections", "select 'Module ' || r_regionkey as section, case when r_regionkey % 2 = 0 then 'pass' else 'warn' end as status, count(n_nationkey) as n from region join nation on n_regionkey = r_regionkey group by 1, 2")
def src24(spark, sf):
    n = table(spark, sf, "nation").groupBy("n_regionkey").agg(F.concat_ws("\n", F.array_sort(F.collect_list(F.concat("n_name", F.lit("\t"), "n_nationkey")))).alias("rows"))
    part = F.concat(F.lit(">>Module "), "n_regionkey", F.lit("\t"), F.when(F.col("n_regionkey") % 2 == 0, "pass").otherwise("warn"), F.lit("\n#Name\tValue\n"), "rows", F.lit("\n>>END_MODULE"))
    return rd.sections(spark, written(n.select(part), sf, "report")).groupBy("section", "status").agg(F.count("*").alias("n"))


@query("src25_flagstat", "select count(*) as total, count(*) filter (flag & 1024 > 0) as duplicates from reads")
def src25(spark, sf):
    n = reads(spark, sf).agg(F.count("*").alias("a"), F.count(F.when(F.col("flag").bitwiseAND(1024) > 0, 1)).alias("b"))
    text = n.select(F.concat("a", F.lit(" + 0 in total\n0 + 0 secondary\n0 + 0 supplementary\n"), "b", F.lit(" + 0 duplicates")))
    return rd.flagstat(spark, written(text.coalesce(1), sf, "flagstat") + "/*.txt", {0: "total", 3: "duplicates"}).drop("path")


@query("src26_trim_log", "select count(*) as pairs, count(*) filter (mapq >= 10) as written from reads")
def src26(spark, sf):
    n = reads(spark, sf).agg(F.count("*").alias("a"), F.count(F.when(F.col("mapq") >= 10, 1)).alias("b"))
    text = n.select(F.concat(F.lit("Total read pairs processed:   "), F.format_number("a", 0), F.lit("\nPairs written (passing filters):   "), F.format_number("b", 0), F.lit(" (9.9%)")))
    return rd.trim_log(spark, written(text.coalesce(1), sf, "trim") + "/*.txt").drop("path")


@query("src28_last_columns", "select chrom, start_pos, end_pos, n_reads as reads, round(n_reads / 60.0, 6) as rpm from peaks")
def src28(spark, sf):
    """The last two of a number of columns that isn't known, after the first three."""
    line = F.concat_ws("\t", "chrom", F.col("start_pos").cast("string"), F.col("end_pos").cast("string"), F.when(F.col("n_reads") > 25, F.lit("x\ty")).otherwise("z"), F.col("n_reads").cast("string"), F.round(F.col("n_reads") / 60.0, 6).cast("string"))
    return rd.last_columns(spark, written(peaks(spark, sf).select(line), sf, "coverage"), {"reads": "long", "rpm": "double"})


@query("src29_blast", "select concat('chr', s_nationkey % 5) as chrom, s_suppkey - 1 as start_pos, s_suppkey + 20 as end_pos, s_name as name, case when s_suppkey % 2 = 0 then '+' else '-' end as strand from supplier")
def src29(spark, sf):
    even = F.col("s_suppkey") % 2 == 0
    ends = F.when(even, F.concat_ws("\t", "s_suppkey", F.col("s_suppkey") + 20)).otherwise(F.concat_ws("\t", F.col("s_suppkey") + 20, "s_suppkey"))
    line = F.concat_ws("\t", "s_name", F.concat(F.lit("chr"), F.col("s_nationkey") % 5), F.lit("99.0\t20\t0\t0\t1\t20"), ends, F.lit("1e-5\t40.0"), F.when(even, "plus").otherwise("minus"), F.lit("100.0"))
    return rd.blast_intervals(rd.delimited(spark, written(table(spark, sf, "supplier").select(line), sf, "blast"), rd.BLAST, header=False))


@query("src32_values_of_paths", "select event_type as kind, count(*) as n from events group by 1")
def src32(spark, sf):
    path = written_once(spark, f"kinds-{sf}", lambda path: table(spark, sf, "events").select("event_type", "event_id").write.partitionBy("event_type").parquet(path))
    files = spark.read.option("recursiveFileLookup", True).schema("event_id long").parquet(path)
    return rd.from_paths(files, r"event_type=([^/]+)/", "kind").groupBy("kind").agg(F.count("*").alias("n"))


@query("snk01_region_table", "select chrom, start_pos, end_pos, anno_id, concat(chrom, ':', start_pos, '-', end_pos) as locus from anno")
def snk01(spark, sf):
    path = written_once(spark, f"table-{sf}", lambda path: rd.table_file(anno(spark, sf).select("chrom", "start_pos", "end_pos", "anno_id"), path))
    return rd.tabix(spark, path, "chrom string, start_pos long, end_pos long, anno_id long")


@query("snk02_parquet_by_contig", "select chrom, count(*) as n, sum(start_pos)::bigint as total from anno group by 1")
def snk02(spark, sf):
    path = written_once(spark, f"contigs-{sf}", lambda path: rd.parquet_by_contig(anno(spark, sf), path, 1000))
    return spark.read.parquet(path).groupBy("chrom").agg(F.count("*").alias("n"), F.sum("start_pos").alias("total"))


@query("snk05_signal_text", "select chrom, hour * 3600 + 1 as start_pos, n::double as value from (select chrom, start_pos // 3600 as hour, count(*) as n from reads group by 1, 2)")
def snk05(spark, sf):
    """A signal as wiggle text, with a header before each contig's lines, and read back."""
    h = reads(spark, sf).groupBy("chrom", F.expr("start_pos div 3600").alias("hour")).agg(F.count("*").alias("n"))
    signal = h.select("chrom", (F.col("hour") * 3600).alias("start_pos"), F.col("n").alias("value"))
    path = written_once(spark, f"wig-{sf}", lambda path: rd.write_wig(signal, path, 3600))
    return rd.wig(spark, path)


@query("snk06_json", "select c_custkey, c_name, round(c_acctbal, 2) as c_acctbal from customer")
def snk06(spark, sf):
    path = written_once(spark, f"json-{sf}", lambda path: table(spark, sf, "customer").select("c_custkey", "c_name", F.round("c_acctbal", 2).alias("c_acctbal")).write.json(path))
    return spark.read.schema("c_custkey long, c_name string, c_acctbal double").json(path)


@query("snk08_histogram", "select label, least(n_reads // 5, 9) as bin, count(*) as n from peaks group by 1, 2")
def snk08(spark, sf):
    """The counts behind a histogram by class."""
    return loci.histogram(peaks(spark, sf), "n_reads", 5, 10, ["label"])


@query("snk08_combinations", "select proper, duplicate, weak, count(*) as n from (select flag & 2 > 0 as proper, flag & 1024 > 0 as duplicate, mapq < 10 as weak from reads) group by 1, 2, 3")
def snk08_sets(spark, sf):
    """The sizes of all combinations of sets, behind an intersection plot."""
    f = F.col("flag")
    return reads(spark, sf).groupBy((f.bitwiseAND(2) > 0).alias("proper"), (f.bitwiseAND(1024) > 0).alias("duplicate"), (F.col("mapq") < 10).alias("weak")).agg(F.count("*").alias("n"))


@query("f18_feature_names", "select cell_id, count(*) as n_reads, count(*) filter (flag & 2 > 0) as n_proper, round(avg(mapq), 6) as mapq_mean from reads group by 1")
def f18(spark, sf):
    """Columns chosen by parts of their names: counts and qualities, but no ids of donors and no totals."""
    wide = reads(spark, sf).groupBy("cell_id").agg(F.count("*").alias("n_reads"), F.count(F.when(F.col("flag").bitwiseAND(2) > 0, 1)).alias("n_proper"), R6(F.avg("mapq"), "mapq_mean"), F.min("donor_id").alias("n_donor_id"), F.sum("score").alias("score_total"))
    return wide.select("cell_id", *ln.feature_names(wide.columns, any_of=("n_", "mapq"), none_of=("donor",)))


@query("f19_feature_sets", "select * from (values ('set1', 'n_reads'), ('set1', 'width'), ('set2', 'n_reads'), ('set2', 'width'), ('set2', 'bg5000_n_reads'), ('set2', 'bg10000_n_reads'), ('set3', 'n_reads'), ('set3', 'width'), ('set3', 'bg5000_n_reads'), ('set3', 'bg10000_n_reads'), ('set3', 'germline_distance')) t(feature_set, feature)")
def f19(spark, sf):
    sets = ln.feature_sets(["n_reads", "width"], ["n_reads"], ["bg5000", "bg10000"], ["germline_distance"])
    return spark.createDataFrame([(k, f) for k, fs in sets.items() for f in fs], "feature_set string, feature string")


@query("m05_search_space", "select d.depth, r.rate, s.subsample from (select unnest([2, 4, 6]) as depth) d, (select unnest([0.05, 0.1])::double as rate) r, (select unnest([0.7, 1.0])::double as subsample) s")
def m05(spark, sf):
    """All settings of a search space; ``sampled`` picks some of a large one."""
    grid = ln.settings({"depth": [2, 4, 6], "rate": [0.05, 0.1], "subsample": [0.7, 1.0]})
    return spark.createDataFrame([(g["depth"], g["rate"], g["subsample"]) for g in grid], "depth int, rate double, subsample double")
