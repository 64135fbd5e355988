"""Genotypes of donors from three kinds of files, each parsed once an application: repeats of the reference, insertions that it lacks, and absences of what it holds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociq.functions.staging import written_once
from lociq.operators import intervals as iv

PLACE = ("donor_id", "chrom", "start_pos", "end_pos")


def loaded(spark: SparkSession, name: str, load: Callable[[], DataFrame]) -> DataFrame:
    """The table that ``load`` parses from its files, as columns in the shared folder: parsed at the first call, and later calls of the name read only the columns that they use."""
    return spark.read.parquet(written_once(spark, f"loaded-{name}", lambda path: load().write.parquet(path)))


def repeat_ends(repeats: DataFrame, family: str, least_end: int = 6000) -> DataFrame:
    """The 3' ends of a family's repeats that reach beyond ``least_end`` of its consensus, widened by 200 bases upstream and 100 downstream."""
    own = repeats.where((F.col("rep_name") == family) & (F.col("rep_end") > least_end))
    return iv.extend_stranded(iv.three_prime(own), 200, 100)


def donor_genotypes(repeats: DataFrame, insertions: DataFrame, absences: DataFrame, family: str, margin: int = 10) -> DataFrame:
    """Places of each donor by class: donor_id, chrom, start_pos, end_pos, class.

    ``insertions`` and ``absences`` have the place columns, family, genotype (1 or 2 alleles) and passed. Insertions of the family that passed, widened by ``margin``, are inserted_het or inserted_hom.
    A reference repeat (``repeat_ends``) is reference_hom in a donor without an absence of the family there, and reference_het where all that overlap are of one allele; one that is absent from both
    alleles has no row. Donors are those of either table; all are done in one pass.
    """
    good = lambda df: df.where((F.col("family") == family) & F.col("passed"))
    inserted = iv.extend(good(insertions).where("genotype in (1, 2)"), margin).select(*PLACE, F.when(F.col("genotype") == 1, "inserted_het").otherwise("inserted_hom").alias("class"))
    donors = insertions.select("donor_id").union(absences.select("donor_id")).where("donor_id is not null").distinct()
    ends = repeat_ends(repeats, family).select("chrom", "start_pos", "end_pos").crossJoin(F.broadcast(donors))  # a row for each donor and repeat is what comes out
    counted = iv.count_kinds(ends, good(absences), {"het": F.col("genotype") == 1, "hom": F.col("genotype") == 2}, ("donor_id", "chrom"))
    reference = counted.where("hom = 0").select(*PLACE, F.when(F.col("het") > 0, "reference_het").otherwise("reference_hom").alias("class"))
    return inserted.unionByName(reference)
