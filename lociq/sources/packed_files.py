"""Workbooks, and interval files chosen by checked names."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociq.sources import readers as rd

ROWS = 10_000


def _by_file(spark: SparkSession, path: str, kind: pa.Schema, ddl: str, rows) -> DataFrame:
    """Rows of each file of ``path``, read as a stream in one task a file, in bounded batches."""

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                held = []
                for row in rows(content.as_buffer()):
                    held.append(row)
                    if len(held) == ROWS:
                        yield pa.RecordBatch.from_pylist(held, kind)
                        held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, kind)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, ddl)


def _place(reference: str) -> int:
    """0-based column of a cell reference such as 'AB12'."""
    n = 0
    for c in re.match("[A-Z]+", reference)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def _cells(raw, sheet: str | int) -> Iterator[dict]:
    """Row number (from 0) and texts by column of a sheet, given by name or by position."""
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        plain = lambda e: e.tag.rpartition("}")[2]
        text = lambda e: "".join(x.text or "" for x in e.iter() if plain(x) == "t")
        shared = [text(x) for x in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in z.namelist() else []
        sheets = [x for x in ElementTree.fromstring(z.read("xl/workbook.xml")).iter() if plain(x) == "sheet"]
        chosen = sheets[sheet] if isinstance(sheet, int) else next((x for x in sheets if x.get("name") == sheet), None)
        if chosen is None:
            raise ValueError(f"no sheet {sheet!r}, only {[x.get('name') for x in sheets]}")
        rel = next(v for k, v in chosen.attrib.items() if k.endswith("}id"))
        target = next(x.get("Target") for x in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels")) if x.get("Id") == rel)
        member = target.lstrip("/") if target.startswith("/") else "xl/" + target
        with z.open(member) as f:
            for _, row in ElementTree.iterparse(f):
                if plain(row) != "row":
                    continue
                found = []
                for c in row:
                    value = text(c) if c.get("t") == "inlineStr" else next((x.text for x in c if plain(x) == "v"), None)
                    found.append((_place(c.get("r")), shared[int(value)] if c.get("t") == "s" and value else value))
                yield {"row": int(row.get("r")) - 1, "cells": found}
                row.clear()


def workbook(spark: SparkSession, path: str, columns: dict[str, tuple[int, str]], sheet: str | int = 0, skip: int = 0) -> DataFrame:
    """Rows of a sheet of xlsx files behind the first ``skip``: columns are name -> (0-based place, type), as text cast to their types.

    Empty cells and what doesn't fit its type are null. A workbook is read by one task.
    """
    kind = pa.schema([("row", pa.int64()), ("cells", pa.map_(pa.int32(), pa.string()))])
    rows = _by_file(spark, path, kind, "row long, cells map<int,string>", lambda raw: _cells(raw, sheet))
    return rows.where(F.col("row") >= skip).select(*[F.col("cells")[F.lit(k)].try_cast(t).alias(c) for c, (k, t) in columns.items()])


def stratification(spark: SparkSession, known: dict[str, dict[str, str]], genome: str, name: str) -> DataFrame:
    """Intervals of one of the ``known`` files (genome -> name -> path, wherever Spark can read), behind their first line; names are checked."""
    if genome not in known:
        raise ValueError(f"no genome {genome!r}, only {sorted(known)}")
    if name not in known[genome]:
        raise ValueError(f"no stratification {name!r} of {genome}, only {sorted(known[genome])}")
    return rd.delimited(spark, known[genome][name], "chrom string, start_pos long, end_pos long", header=True)
