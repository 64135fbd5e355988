"""A query whose result is too large for a comparison with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from lociq.operators import intervals as iv
from lociq.plans.registry import query
from lociq.sources.proxies import peaks


@query("src16_dense_values_whole")
def src16(spark, sf):
    """Every covered base of every contig: too many rows to hold against SQL, so tests hold it against brute force."""
    runs = iv.track_max(peaks(spark, sf), "n_reads", float("-inf"))  # of equal values, so overlapping peaks are not spelt out each
    return runs.select("chrom", F.explode(F.sequence("start_pos", F.col("end_pos") - 1)).alias("pos"), F.col("n_reads").alias("value"))
