"""Locus tables: clusters of regions across cells and their statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociq.functions.staging import staged
from lociq.operators.intervals import cluster, locus
from lociq.operators.regions import quantile_columns, quantiles

PRECEDENCE = ("KNRGL", "KRGL", "OTHER")


def best_label(column: str, precedence: tuple[str, ...]) -> Column:
    """The first label of ``precedence`` that the group holds, the last one otherwise."""
    out = None
    for name in precedence[:-1]:
        has = F.bool_or(F.col(column) == name)
        out = F.when(has, name) if out is None else out.when(has, name)
    return out.otherwise(precedence[-1])


def cluster_places(df: DataFrame, slack: int = 0, width: int = 1024) -> DataFrame:
    """Written table of a row for each cluster and bin of ``width`` bases: chrom, _bin, cluster and its first and last place (start, end) in order.

    Loci of one start that are not apart fold before they are swept, so the sweeps grow with the distinct starts, of which a contig has at most its length.
    """
    fits = F.coalesce(F.col("end_pos") >= F.col("start_pos") - slack, F.lit(False))  # a locus of the same start that follows is of the same cluster
    loci = df.groupBy("chrom", "start_pos", fits.alias("_fits"), F.when(~fits, F.col("end_pos")).alias("_end")).agg(F.min("end_pos").alias("_least"), F.max("end_pos").alias("end_pos")).drop("_fits", "_end")
    place = lambda end: F.struct(F.col("start_pos").alias("s"), F.col(end).alias("e"))
    spans = cluster(staged(loci, "places"), slack, order=("_least",)).groupBy("chrom", "cluster").agg(F.min(place("_least")).alias("_first"), F.max(place("end_pos")).alias("_last"))
    return staged(spans.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("_first.s") / width), F.floor(F.col("_last.s") / width)))), "clusters")


def clustered(df: DataFrame, slack: int = 0, width: int = 1024) -> DataFrame:
    """Add the cluster of each row's locus: clusters are found among distinct places, and a row looks up the one whose first and last place hold its own. Rows without a place are left out."""
    own = F.struct(F.col("start_pos").alias("s"), F.col("end_pos").alias("e"))
    rows = df.where("start_pos is not null and end_pos is not null").withColumn("_bin", F.floor(F.col("start_pos") / width))
    return rows.join(cluster_places(df, slack, width), ["chrom", "_bin"]).where((F.col("_first") <= own) & (own <= F.col("_last"))).select(*df.columns, "cluster")


def cluster_stats(df: DataFrame, slack: int = 0, precedence: tuple[str, ...] = PRECEDENCE) -> DataFrame:
    """One row for each cluster: label, counts, n_reads quantiles, extent and locus."""
    c = clustered(df, slack)
    out = c.groupBy("chrom", "cluster").agg(
        best_label("label", precedence).alias("label"), F.count("*").alias("n_regions"), F.count_distinct("cell_id").alias("n_cells"), F.size(F.collect_set("donor_id")).cast("long").alias("n_donors"),  # one distinct count alone doesn't multiply rows; donors are few
        quantiles(F.col("n_reads").cast("double")).alias("quantiles"), F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"),
    )
    return out.withColumn("width", F.col("end_pos") - F.col("start_pos")).withColumn("locus", locus()).withColumns(quantile_columns("quantiles", "n_reads")).drop("cluster", "quantiles")


def representatives(df: DataFrame, slack: int = 0, seed: int = 0) -> DataFrame:
    """One row of each cluster, picked by hash, with the cluster's extremes."""
    c = clustered(df, slack)
    pick = F.struct(F.md5(F.concat_ws(":", F.lit(seed), "cell_id", "start_pos", "end_pos", "n_reads")), "cell_id", "start_pos")
    return c.groupBy("chrom", "cluster").agg(F.max("n_reads").alias("max_reads"), F.min("n_reads").alias("min_reads"), F.count_distinct("cell_id").alias("n_cells"), F.min_by("cell_id", pick).alias("cell_id"), F.min_by("n_reads", pick).alias("n_reads"))


def sharing(df: DataFrame, key: list[str], thresholds: tuple[int, ...] = (1, 5, 10, 50)) -> DataFrame:
    """Distinct cells and donors of each locus at read thresholds."""
    return df.groupBy(*key).agg(*(F.count_distinct(F.when(F.col("n_reads") >= t, F.col(c))).alias(f"{c.removesuffix('_id')}s_{t}") for t in thresholds for c in ("cell_id", "donor_id")))


def histogram(df: DataFrame, value: str, width: int, most: int, by: list[str]) -> DataFrame:
    """Counts of a whole number in ``most`` bins of ``width``, the last one open, for each group."""
    return df.groupBy(*by, F.least(F.expr(f"`{value}` div {width}"), F.lit(most - 1)).alias("bin")).agg(F.count("*").alias("n"))
