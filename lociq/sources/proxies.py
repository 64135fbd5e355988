"""Interval views over the bundled star-schema tables: reads (events), peaks (lineitem), anno (orders)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CONTIG = 2_592_000  # length of every proxy contig: 30 days of seconds
BIN = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    second = "cast(floor(unix_micros(cast(ts as timestamp)) / 1000000) as bigint) - 1704067200"
    base = table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id as cell_id", "user_id % 10 as donor_id", "concat('chr', cast(user_id % 5 as string)) as chrom", f"{second} as start_pos", "event_type", "value as score", "props",
        "cast(1 + case when event_type = 'signup' then 128 else 64 end + 16 * (event_id % 2) + case when event_type = 'purchase' then 2 else 0 end + case when event_type = 'error' then 1024 else 0 end as int) as flag",
        "cast(event_id % 61 as int) as mapq",
    )
    base = base.withColumn("end_pos", F.expr("start_pos + 50 + event_id % 100"))
    backward = F.col("flag").bitwiseAND(16) > 0
    return base.withColumn("three_end", F.when(backward, F.col("start_pos")).otherwise(F.col("end_pos"))).withColumn("five_end", F.when(backward, F.col("end_pos")).otherwise(F.col("start_pos")))


READS = """reads as (select *, case when event_id % 2 = 1 then start_pos else end_pos end as three_end, case when event_id % 2 = 1 then end_pos else start_pos end as five_end from (
select event_id, user_id as cell_id, user_id % 10 as donor_id, concat('chr', cast(user_id % 5 as varchar)) as chrom, cast(floor(epoch_us(ts) / 1000000) as bigint) - 1704067200 as start_pos,
cast(floor(epoch_us(ts) / 1000000) as bigint) - 1704067200 + 50 + event_id % 100 as end_pos, event_type, value as score, props,
cast(1 + case when event_type = 'signup' then 128 else 64 end + 16 * (event_id % 2) + case when event_type = 'purchase' then 2 else 0 end + case when event_type = 'error' then 1024 else 0 end as int) as flag,
cast(event_id % 61 as int) as mapq from events))"""


def peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_suppkey as cell_id", "l_suppkey % 10 as donor_id", "concat('chr', cast(l_suppkey % 5 as string)) as chrom",
        "(l_orderkey * 7919 + l_linenumber * 104729) % 2592000 as start_pos", "cast(l_quantity as bigint) as n_reads",
        "case l_returnflag when 'A' then 'KNRGL' when 'R' then 'KRGL' else 'OTHER' end as label",
    )
    return base.withColumn("end_pos", F.expr("start_pos + n_reads * 10"))


PEAKS = """peaks as (select *, start_pos + n_reads * 10 as end_pos from (
select l_orderkey, l_linenumber, l_suppkey as cell_id, l_suppkey % 10 as donor_id, concat('chr', cast(l_suppkey % 5 as varchar)) as chrom,
(l_orderkey * 7919 + l_linenumber * 104729) % 2592000 as start_pos, cast(l_quantity as bigint) as n_reads,
case l_returnflag when 'A' then 'KNRGL' when 'R' then 'KRGL' else 'OTHER' end as label from lineitem))"""


def anno(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as anno_id", "o_orderpriority as anno", "concat('chr', cast(o_custkey % 5 as string)) as chrom", "(o_orderkey * 15485863) % 2592000 as start_pos",
        "(o_orderkey * 15485863) % 2592000 + 200 as end_pos", "case o_orderstatus when 'O' then '+' when 'F' then '-' end as strand", "o_custkey % 10 as donor_id",
    )


ANNO = """anno as (select o_orderkey as anno_id, o_orderpriority as anno, concat('chr', cast(o_custkey % 5 as varchar)) as chrom, (o_orderkey * 15485863) % 2592000 as start_pos,
(o_orderkey * 15485863) % 2592000 + 200 as end_pos, case o_orderstatus when 'O' then '+' when 'F' then '-' end as strand, o_custkey % 10 as donor_id from orders)"""


def with_views(sql: str) -> str:
    """The statement with the views that it names in front."""
    used = [v for n, v in (("reads", READS), ("peaks", PEAKS), ("anno", ANNO)) if f" {n}" in sql]
    head, sep, rest = sql.strip().partition("with ")
    body = f", {rest}" if sep and not head else f" {sql.strip()}"
    return "with " + ", ".join(used) + body if used else sql.strip()
