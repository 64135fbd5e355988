"""Readers of the formats around interval pipelines: delimited tables, packed fields, VCF, FASTQ, FASTA, QC reports."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociq.operators import intervals as iv

SHEET = "sample_id string, tissue_id string, donor_id string, dna_type string, R1 string, R2 string, sra string"
BED = ("chrom string", "start_pos bigint", "end_pos bigint", "name string", "score double", "strand string")
REPEATS = "chrom string, start_pos bigint, end_pos bigint, rep_name string, score double, strand string, milli_div int, milli_del int, milli_ins int, geno_left string, rep_class_family string, rep_start string, rep_end string, rep_left string"
VCF = "chrom string, pos bigint, id string, ref string, alt string, qual string, filter string, info string, format string, sample string"
BLAST = "qseqid string, sseqid string, pident double, length bigint, mismatch int, gapopen int, qstart bigint, qend bigint, sstart bigint, send bigint, evalue double, bitscore double, sstrand string, qcov double"


def delimited(spark: SparkSession, path: str, schema: str, header: bool = True, sep: str = "\t", comment: str | None = None) -> DataFrame:
    """A delimited file with a pinned schema; nothing is inferred."""
    reader = spark.read.schema(schema).option("sep", sep).option("header", header)
    return (reader.option("comment", comment) if comment else reader).csv(path)


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-empty trimmed lines."""
    return spark.read.text(path).select(F.trim("value").alias("line")).where("line <> ''")


def bed(spark: SparkSession, path: str, columns: int = 3) -> DataFrame:
    return delimited(spark, path, ", ".join(BED[:columns]), header=False, comment="#")


def tabix(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A tab-separated region table whose header begins with #; adds the locus."""
    names = [c.split()[0] for c in schema.split(", ")]
    df = delimited(spark, path, schema, header=False, comment="#")
    return df.withColumn("locus", F.concat(F.col(names[0]), F.lit(":"), F.col(names[1]).cast("string"), F.lit("-"), F.col(names[2]).cast("string")))


def repeats(spark: SparkSession, path: str) -> DataFrame:
    """Repeat annotation; parenthesised numbers become integers."""
    df = delimited(spark, path, REPEATS, header=False)
    return df.withColumns({c: unparenthesised(F.col(c)) for c in ("geno_left", "rep_start", "rep_left")})


def unparenthesised(c: Column) -> Column:
    return F.regexp_replace(c, "[()]", "").cast("int")


def packed(c: Column, pattern: str, group: int = 1) -> Column:
    """A group of a regular expression, null where it doesn't match."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def insertions(rows: DataFrame, position: str, confidence: str, status: str) -> DataFrame:
    """Parse the packed fields of genotyped insertions into columns."""
    p, q, s = F.col(position), F.col(confidence), F.col(status)
    return rows.withColumns(
        {
            "ref_pos": packed(p, r"ref_pos=(\d+)").cast("int"), "chimeric": packed(p, r"chimeric=(\d+)").cast("int"), "hybrid": packed(p, r"hybrid=(\d+)").cast("int"),
            "is_unique": packed(q, r"unique:(\w+)"), "long": packed(q, r"50bp_or_longer:(\w+)"), "orig_conf": packed(q, r"orig_conf:(\w+)"),
            "status": packed(s, r"status=(\w+)"), "family": packed(s, r"MEI=(\w+)"),
        }
    )


def vcf(spark: SparkSession, path: str) -> DataFrame:
    return delimited(spark, path, VCF, header=False, comment="#")


def vcf_intervals(rows: DataFrame, longer_alt: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """0-based intervals of called variants: allele count above 0 and, if asked for, an alternative longer than the reference."""
    out = rows.withColumn("ac", packed(F.col("info"), r"(?:^|;)AC=(\d+)").cast("int")).where("ac > 0")
    if longer_alt:
        out = out.where(F.length("alt") > F.length("ref"))
    return out.select("chrom", (F.col("pos") - 1).alias("start_pos"), F.col("pos").alias("end_pos"), "id", "ac", *keep)




def fastq(spark: SparkSession, path: str) -> DataFrame:
    """Records of four lines: path, name, seq, qual. A file is read by one task, since records are only told by line number, line by line as it is decompressed."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches):
        import gzip
        import io

        import pyarrow as pa

        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                raw = pa.BufferReader(content.as_buffer())
                packed_file = content.as_buffer()[:2].to_pybytes() == b"\x1f\x8b"
                lines = io.TextIOWrapper(gzip.open(raw) if packed_file else raw)
                held = []
                for head, seq, _, qual in zip(*[map(str.rstrip, lines, itertools.repeat("\r\n"))] * 4, strict=False):
                    held.append({"path": name, "name": head[1:], "seq": seq, "qual": qual})
                    if len(held) == 10_000:
                        yield pa.RecordBatch.from_pylist(held)
                        held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held)

    return files.mapInArrow(run, "path string, name string, seq string, qual string")


def read_groups(reads: DataFrame) -> DataFrame:
    """Flow cell, lane and index of each FASTQ name, distinct by file."""
    part = F.split("name", ":")
    return reads.groupBy("path").agg(F.array_sort(F.collect_set(F.concat_ws(":", F.get(part, F.lit(2)), F.get(part, F.lit(3)), F.get(part, F.size(part) - 1)))).alias("groups"))


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """Records of FASTA files: name and joined sequence, split at '>' by the text reader."""
    raw = spark.read.option("lineSep", ">").text(path).where(F.trim("value") != "")
    head = F.regexp_extract("value", r"^([^\s]+)", 1)
    return raw.select(head.alias("name"), F.regexp_replace(F.regexp_replace("value", r"^[^\n]*\n", ""), r"\s", "").alias("seq"))


def subsequence(seq: Column, start: Column, end: Column) -> Column:
    return F.substring(seq, start + 1, end - start)


def flagstat(spark: SparkSession, path: str, names: dict[int, str]) -> DataFrame:
    """The first number of given lines of flagstat reports, a row for each file."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.split("value", "\n").alias("rows"))
    return files.select("path", *(F.split(F.get("rows", F.lit(i)), " ")[0].cast("long").alias(n) for i, n in names.items()))


def trim_log(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.text(path, wholetext=True)
    number = lambda label: F.regexp_replace(packed(F.col("value"), label + r"[^:]*:\s*([\d,]+)"), ",", "").cast("long")
    return files.select(F.col("_metadata.file_path").alias("path"), number("Total read pairs").alias("pairs"), number("Pairs written").alias("written"))


def sections(spark: SparkSession, path: str) -> DataFrame:
    """Rows of sectioned reports (>>Name status ... >>END_MODULE): path, section, status, row."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.explode(F.split("value", ">>END_MODULE")).alias("part"))
    body = F.regexp_extract("part", r"(?s)>>([^\t\n]+)\t(\w+)\n(.*)", 3)
    out = files.select("path", F.regexp_extract("part", r">>([^\t\n]+)\t", 1).alias("section"), F.regexp_extract("part", r">>[^\t\n]+\t(\w+)", 1).alias("status"), F.explode(F.split(body, "\n")).alias("row"))
    return out.where("section <> '' and row <> '' and not startswith(row, '#')")


def breakpoints(rows: DataFrame, packed_column: str, keep: str) -> DataFrame:
    """Lists of name,start,end,strand: filtered by name, mean start and distinct strands."""
    items = F.filter(F.split(packed_column, ";"), lambda x: x.contains(keep))
    out = rows.withColumn("items", F.transform(items, lambda x: F.split(x, ",")))
    mean = F.aggregate("items", F.lit(0.0), lambda a, x: a + F.get(x, F.lit(1)).cast("double"), lambda a: F.try_divide(a, F.size("items")))
    return out.select("*", F.size("items").alias("n_items"), mean.alias("mean_start"), F.concat_ws("", F.array_sort(F.array_distinct(F.transform("items", lambda x: F.get(x, F.lit(3)))))).alias("strands")).drop("items")


def blast_intervals(hits: DataFrame) -> DataFrame:
    """BLAST hits as intervals with ordered ends."""
    return hits.select(F.col("sseqid").alias("chrom"), (F.least("sstart", "send") - 1).alias("start_pos"), F.greatest("sstart", "send").alias("end_pos"), F.col("qseqid").alias("name"), F.when(F.col("sstrand") == "minus", "-").otherwise("+").alias("strand"))


def from_paths(df: DataFrame, pattern: str, name: str) -> DataFrame:
    """Add a value taken from each row's file path."""
    return df.withColumn(name, F.regexp_extract(F.col("_metadata.file_path"), pattern, 1))


def table_file(df: DataFrame, path: str, header: bool = True) -> None:
    """Write a coordinate-sorted, compressed table whose header begins with #."""
    first = df.columns[0]
    out = df.withColumnRenamed(first, f"#{first}") if header else df
    # with # as comment mark, which is the writer's default, the header's first name would be quoted
    out.orderBy(*out.columns[:3]).write.option("comment", "~").option("sep", "\t").option("header", header).option("compression", "gzip").csv(path)


def parquet_by_contig(df: DataFrame, path: str, rows: int = 1_000_000) -> None:
    df.write.option("maxRecordsPerFile", rows).partitionBy("chrom").parquet(path)


def snapshot_lines(df: DataFrame, flank: int = 100) -> DataFrame:
    """Browser batch commands for each region."""
    at = F.concat(F.col("chrom"), F.lit(":"), (F.col("start_pos") - flank).cast("string"), F.lit("-"), (F.col("end_pos") + flank).cast("string"))
    return df.select(F.concat_ws("\n", F.concat(F.lit("goto "), at), F.concat(F.lit("snapshot "), F.regexp_replace(at, "[:-]", "_"), F.lit(".png"))).alias("command"))


def thirds(df: DataFrame, order: str) -> DataFrame:
    """Add the third that a row falls into by its rank; the first thirds take what is left over."""
    total = df.agg(F.count("*").alias("_n"))
    ranked = iv.row_numbers(df, [order], "_i").crossJoin(F.broadcast(total))  # one row
    each, over = F.floor(F.col("_n") / 3), F.col("_n") % 3
    early = F.ceil(F.col("_i") / (each + 1))
    return ranked.withColumn("third", F.when(F.col("_i") <= over * (each + 1), early).otherwise(over + F.ceil((F.col("_i") - over * (each + 1)) / each))).drop("_i", "_n")


def violations(rows: DataFrame, rules: dict[str, list | None]) -> DataFrame:
    """Rows that break a sheet's rules, for each column: values that are missing, and values outside of a list (None: any value), in one pass."""
    n = lambda c: F.count(F.when(c, 1))
    found = [F.struct(F.lit(c).alias("field"), n(F.col(c).isNull()).alias("missing"), (n(~F.col(c).isin(allowed)) if allowed else F.lit(0).cast("long")).alias("unknown")) for c, allowed in rules.items()]
    return rows.agg(F.array(*found).alias("x")).select(F.explode("x").alias("x")).select("x.*")


def absences(rows: DataFrame, repeat: str, target_site: str, call: str) -> DataFrame:
    """Parse the packed fields of genotyped absences: 'subfamily:family', 'name=length' and 'genotype;filter'. What a field lacks is null."""
    part = lambda c, sep, k: F.get(F.split(c, sep), F.lit(k))
    return rows.withColumns(
        {"subfamily": part(repeat, ":", 0), "family": part(repeat, ":", 1), "tsd_length": part(target_site, "=", 1).try_cast("long"), "genotype": part(call, ";", 0), "passed": part(call, ";", 1) == "PASS"}
    )


def sources(spark: SparkSession, path: str, schema: str, pattern: str, name: str) -> DataFrame:
    """Files of many sources in one frame, with the source that each path tells as a column."""
    return from_paths(delimited(spark, path, schema, header=False), pattern, name)


# fixed values: the eleven fields of an alignment line
ALIGNMENT = ("name", "flag", "chrom", "pos", "mapq", "cigar", "next_chrom", "next_pos", "length", "seq", "qual")


def alignments(spark: SparkSession, path: str) -> DataFrame:
    """Alignment records of text: fixed fields, 0-based start_pos, and tags as a map of name to value (of a repeated one the first). Header lines begin with @."""
    f = F.split("value", "\t")
    rows = spark.read.text(path).where("not startswith(value, '@') and value <> ''")
    number = {"flag": "int", "pos": "long", "mapq": "int", "next_pos": "long", "length": "long"}
    fixed = [F.get(f, F.lit(i)).cast(number.get(c, "string")).alias(c) for i, c in enumerate(ALIGNMENT)]
    own = F.slice(f, len(ALIGNMENT) + 1, F.greatest(F.size(f) - len(ALIGNMENT), F.lit(0)))
    tags = F.transform(own, lambda t: F.struct(F.substring_index(t, ":", 1).alias("tag"), F.substr(t, F.lit(6)).alias("value")))
    first = F.filter(tags, lambda t, i: F.array_position(F.transform(tags, lambda x: x["tag"]), t["tag"]) == i + 1)
    out = rows.select(*fixed, F.map_from_entries(first).alias("tags"))
    return out.withColumn("start_pos", F.col("pos") - 1).drop("pos")


def last_columns(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """The first three columns of an interval table and its last ones, whose number of columns isn't known."""
    f, n = F.split("value", "\t"), len(columns)
    last = [F.element_at(f, i - n).cast(kind).alias(c) for i, (c, kind) in enumerate(columns.items())]
    return spark.read.text(path).select(F.get(f, F.lit(0)).alias("chrom"), F.get(f, F.lit(1)).cast("long").alias("start_pos"), F.get(f, F.lit(2)).cast("long").alias("end_pos"), *last)


def write_bed(df: DataFrame, path: str) -> None:
    """Write intervals without a header, sorted by position."""
    df.orderBy(*df.columns[:3]).write.option("sep", "\t").csv(path)


HEADER_EACH = 1000  # lines of a wiggle file under one header, so that files can be split


def write_wig(signal: DataFrame, path: str, span: int) -> None:
    """Write (chrom, start_pos, value) as wiggle text of 1-based positions: a header with contig and span where a task's contig changes, and every ``HEADER_EACH`` lines."""

    def run(batches):
        import pyarrow as pa

        last, n = None, 0
        for batch in batches:
            out = []
            for chrom, at, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if chrom != last or n % HEADER_EACH == 0:
                    out.append(f"variableStep chrom={chrom} span={span}")
                    last, n = chrom, 0
                out.append(f"{at} {value}")
                n += 1
            yield pa.RecordBatch.from_pydict({"value": pa.array(out, pa.string())})

    sorted_ = signal.repartitionByRange("chrom", "start_pos").sortWithinPartitions("chrom", "start_pos")
    sorted_.select("chrom", F.col("start_pos") + 1, F.col("value").cast("string")).mapInArrow(run, "value string").write.text(path)


def wig(spark: SparkSession, path: str) -> DataFrame:
    """Read wiggle text, blocks of variable or of fixed steps that each name their contig: chrom, 1-based start_pos, value. Lines that are no data (tracks, comments) go."""
    block = spark.read.option("lineSep", "Step ").text(path)
    # a block ends with the word that begins the next one's header
    lines = F.filter(F.split("value", "\r?\n"), lambda x: x.rlike(r"^[\d.+-]"))
    named = block.where(F.col("value").startswith("chrom=") | F.col("value").rlike("^[^\n]*chrom=")).select(packed(F.col("value"), r"chrom=(\S+)").alias("chrom"), packed(F.col("value"), r"^[^\n]*start=(\d+)").cast("long").alias("first"), packed(F.col("value"), r"^[^\n]*step=(\d+)").cast("long").alias("step"), F.posexplode(lines).alias("k", "line"))
    cells = F.split(F.trim("line"), r"\s+")
    fixed = F.col("first").isNotNull()
    return named.select("chrom", F.when(fixed, F.col("first") + F.col("k") * F.coalesce("step", F.lit(1))).otherwise(F.get(cells, F.lit(0)).try_cast("long")).alias("start_pos"), F.when(fixed, F.get(cells, F.lit(0))).otherwise(F.get(cells, F.lit(1))).try_cast("double").alias("value"))
