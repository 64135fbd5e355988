"""Sequence files as tables of fixed chunks, and regions of them by joins: no contig is ever one string."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociq.operators.intervals import cumulated

CHUNK = 1 << 16


def chunks(spark: SparkSession, path: str, size: int = CHUNK) -> DataFrame:
    """Sequence files (records of a line '>name ...' and lines of bases) in chunks of ``size`` bases: chrom, chunk (from 0), seq, and the record's number.

    Lines get their place from running sums in order of files and lines, so records of any length spread over tasks. A name that comes twice keeps both records apart by
    their number. Records without bases have no chunk; blanks around lines go, and so do lines before the first name.
    """
    lines = spark.read.text(path).select(F.trim(F.regexp_replace("value", "\r$", "")).alias("line"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("row"))
    head = F.col("line").startswith(">")
    placed = cumulated(lines, ["path", "split", "row"], {"record": F.when(head, 1).otherwise(0), "upto": F.when(head, 0).otherwise(F.length("line"))})
    bases = F.when(head, 0).otherwise(F.length("line"))
    names = placed.where(head).select("record", F.regexp_extract("line", r"^>\s*(\S*)", 1).alias("chrom"), F.col("upto").alias("before"))  # a row for each record
    body = placed.where(~head & (F.length("line") > 0)).select("record", "line", (F.col("upto") - bases).alias("at")).join(names, "record").withColumn("at", F.col("at") - F.col("before"))
    first, last = F.floor(F.col("at") / size), F.floor((F.col("at") + F.length("line") - 1) / size)
    piece = body.withColumn("chunk", F.explode(F.sequence(first, last)))
    begin, end = F.greatest("at", F.col("chunk") * size), F.least(F.col("at") + F.length("line"), (F.col("chunk") + 1) * size)
    piece = piece.select("chrom", "record", "chunk", F.struct(begin.alias("begin"), F.substr("line", (begin - F.col("at") + 1).cast("int"), (end - begin).cast("int")).alias("bases")).alias("x"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["bases"]), "")  # no more than a chunk
    return piece.groupBy("chrom", "record", "chunk").agg(joined.alias("seq"))


def fetch(table: DataFrame, regions: DataFrame, key: str, size: int = CHUNK) -> DataFrame:
    """The bases of each region (``key``, chrom, start_pos, end_pos): ``regions`` with seq, cut at the contig's end; an empty or unknown place has an empty one.

    Regions meet the chunks that they touch, and only the touched bases of each chunk move on. Chunks must be of ``size`` bases, as made by ``chunks``.
    """
    asked = regions.where("end_pos > start_pos").select(key, "chrom", "start_pos", "end_pos", F.explode(F.sequence(F.floor(F.greatest(F.lit(0), "start_pos") / size), F.floor((F.col("end_pos") - 1) / size))).alias("chunk"))
    begin = F.greatest(F.col("start_pos") - F.col("chunk") * size, F.lit(0))
    part = asked.join(table.select("chrom", "chunk", "seq"), ["chrom", "chunk"]).select(key, F.struct("chunk", F.substr("seq", (begin + 1).cast("int"), (F.least(F.col("end_pos") - F.col("chunk") * size, F.lit(size)) - begin).cast("int")).alias("bases")).alias("x"))
    found = part.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["bases"]), "").alias("seq"))  # no more than the region
    return regions.join(found, key, "left").withColumn("seq", F.coalesce("seq", F.lit("")))
