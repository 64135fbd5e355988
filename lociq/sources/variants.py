"""Variant files with any number of samples: schema from the header, samples by name, typed tags, allele counts of the chosen samples."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values of the format: the columns before the samples, and the types of tags
FIXED = ("chrom", "pos", "id", "ref", "alt", "qual", "filter", "info", "format")
TYPES = {"Integer": "long", "Float": "double", "Flag": "boolean", "Character": "string", "String": "string"}


@dataclass
class Header:
    samples: list[str] = field(default_factory=list)
    info: dict[str, tuple[str, str]] = field(default_factory=dict)  # tag -> (number, type)
    format: dict[str, tuple[str, str]] = field(default_factory=dict)


def _head(batches):
    """The header lines of a partition, if they reach the line of column names; the small files of a folder may come in any order."""
    held = []
    for batch in batches:
        for line in batch.filter(pc.starts_with(batch.column(0), "#")).column(0).to_pylist():
            held.append(line)
            if line.startswith("#CHROM"):
                yield pa.RecordBatch.from_pydict({"header": ["\n".join(held)]})
                return


def header(spark: SparkSession, path: str) -> Header:
    """Samples and declared tags of a file, or of the first file of a folder; no more than its first split is read."""
    found = spark.read.text(path).mapInArrow(_head, "header string").first()
    if found is None:
        raise ValueError(f"{path} has no line of column names")
    out = Header()
    for line in found["header"].split("\n"):
        declared = re.match(r"##(INFO|FORMAT)=<ID=([^,>]+),Number=([^,>]+),Type=([^,>]+)", line)
        if declared:
            kind, tag, number, type_ = declared.groups()
            (out.info if kind == "INFO" else out.format)[tag] = (number, type_)
    out.samples = found["header"].rsplit("\n", 1)[-1].split("\t")[len(FIXED) :]
    return out


def typed(text: Column, number: str, kind: str) -> Column:
    """A tag's text as its type, a list where it may hold several; what is absent or '.' is null."""
    to = TYPES.get(kind, "string")
    value = lambda x: F.nullif(x, F.lit(".")).try_cast(to)
    return value(text) if number == "1" else F.when(text.isNotNull() & (text != "."), F.transform(F.split(text, ","), value))


def tag(info: Column, name: str, number: str, kind: str) -> Column:
    """A tag of the INFO field by its declaration; flags are true or false."""
    at = rf"(?:^|;){re.escape(name)}"
    if kind == "Flag" or number == "0":
        return info.rlike(at + "(?:[;=]|$)")
    return typed(F.when(info.rlike(at + "="), F.regexp_extract(info, at + "=([^;]*)", 1)), number, kind)


def read(spark: SparkSession, path: str, samples: Sequence[str] | None = None) -> DataFrame:
    """Records with the chosen samples (None: all, []: none): chrom, pos (from 1), id, ref, alt, qual, filter, info, calls, ac, an, end_pos.

    ``info`` is a struct of the declared tags, typed; only those that a query uses are parsed. ``calls`` is an array of sample, genotype and fields (of
    the record's format, by name). ``ac`` counts each alternative allele among the chosen samples' genotypes and ``an`` the alleles that are known, so they are those of
    the selection and not of the INFO field; without samples they are null. ``end_pos`` is the last base: the END tag, or by the length of ref. A sample that the header
    doesn't name is an error. Absent values ('.') are null.
    """
    h = header(spark, path)
    chosen = h.samples if samples is None else list(samples)
    if unknown := [s for s in chosen if s not in h.samples]:
        raise ValueError(f"no sample {', '.join(unknown)}, only {', '.join(h.samples)}")
    f = F.split("value", "\t")
    cell = lambda k: F.nullif(F.get(f, F.lit(k)), F.lit("."))
    rows = spark.read.text(path).where("not startswith(value, '#') and value <> ''")
    rows = rows.select(*(cell(k).cast({"pos": "long", "qual": "double"}.get(c, "string")).alias(c) for k, c in enumerate(FIXED)), F.array(*(F.get(f, F.lit(len(FIXED) + h.samples.index(s))) for s in chosen)).alias("own"))
    info = F.struct(*(tag(F.coalesce("info", F.lit("")), t, *kind).alias(t) for t, kind in h.info.items())) if h.info else F.struct(F.lit(None).cast("string").alias("none"))
    keys = F.split(F.coalesce("format", F.lit("")), ":")
    fields = lambda x: F.map_from_arrays(F.slice(keys, 1, F.least(F.size(keys), F.size(F.split(x, ":")))), F.slice(F.split(x, ":"), 1, F.size(keys)))
    genotype = lambda x: F.nullif(F.get(F.split(x, ":"), F.array_position(keys, "GT").cast("int") - 1), F.lit("."))
    names = F.array(*map(F.lit, chosen)) if chosen else F.array().cast("array<string>")
    calls = F.zip_with(names, F.col("own") if chosen else F.array().cast("array<string>"), lambda s, x: F.struct(s.alias("sample"), genotype(x).alias("genotype"), fields(x).alias("fields")))
    out = rows.select(*FIXED[:7], info.alias("info"), calls.alias("calls"))
    alleles = F.filter(F.flatten(F.transform("calls", lambda c: F.split(F.coalesce(c["genotype"], F.lit("")), "[/|]"))), lambda a: a.rlike("^[0-9]+$"))
    count = F.transform(F.split("alt", ","), lambda _, k: F.size(F.filter(alleles, lambda a: a.cast("int") == k + 1)))
    last = F.col("pos") + F.length("ref") - 1
    return out.withColumns({"ac": count if chosen else F.lit(None).cast("array<int>"), "an": F.size(alleles) if chosen else F.lit(None).cast("int"), "end_pos": F.coalesce(F.col("info.END").cast("long"), last) if h.info.get("END", ("", ""))[0] == "1" else last})


def called(rows: DataFrame) -> DataFrame:
    """Records of which a chosen sample carries an alternative allele."""
    return rows.where(F.exists("ac", lambda n: n > 0))


def longer(rows: DataFrame) -> DataFrame:
    """Records of which an alternative is longer than the reference."""
    return rows.where(F.exists(F.split("alt", ","), lambda a: F.length(a) > F.length("ref")))


def intervals(rows: DataFrame, start: Column | None = None, end: Column | None = None, **columns: Column) -> DataFrame:
    """chrom, start_pos, end_pos and ``columns``; by default the half-open interval of a record's bases, or what tags say of it."""
    first = F.col("pos") - 1 if start is None else start.cast("long")
    return rows.select("chrom", first.alias("start_pos"), (F.col("end_pos") if end is None else end.cast("long")).alias("end_pos"), *(c.alias(n) for n, c in columns.items()))
