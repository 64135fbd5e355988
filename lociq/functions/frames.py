"""Helpers over whole frames: dynamic filters, precedence labels, masked overwrites."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def where_query(df: DataFrame, text: str, **values) -> DataFrame:
    """Filter by a query string with pandas-style comparison (==) and @name references to ``values``; string literals in it stay as they are."""

    def literal(m: re.Match) -> str:
        v = values[m[1]]
        return str(v) if isinstance(v, (int, float)) else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"

    parts = re.split(r"""('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")""", text)
    return df.where("".join(p if i % 2 else re.sub(r"@(\w+)", literal, p).replace("==", "=") for i, p in enumerate(parts)))


def first_label(df: DataFrame, cases: list[tuple[str, Column | str]], otherwise: str) -> Column:
    """The label of the first case that holds; a case given by a column name counts only if the frame has that column."""
    out = None
    for name, case in cases:
        if isinstance(case, str):
            if case not in df.columns:
                continue
            case = F.col(case)
        out = F.when(case, name) if out is None else out.when(case, name)
    return F.lit(otherwise) if out is None else out.otherwise(otherwise)


def overwrite(df: DataFrame, column: str, masks: list[tuple[Column, str]]) -> DataFrame:
    """Set a column where a mask holds; the last mask that holds wins, all masks see the frame as it was."""
    out = F.col(column)
    for mask, value in masks:
        out = F.when(mask, value).otherwise(out)
    return df.withColumn(column, out)
