"""File sinks: rows as delimited or tuple text. Paths may be any URI that Spark writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_tuples(rows: DataFrame, *columns: str) -> DataFrame:
    """``value``: the columns in round brackets, ``(1,2,3.0,4)``, as ``files.tuples`` reads them; null is an empty field."""
    fields = F.concat_ws(",", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (columns or rows.columns)))
    return rows.select(F.concat(F.lit("("), fields, F.lit(")")).alias("value"))


def save_lines(rows: DataFrame, path: str, value: str = "value", mode: str = "error") -> None:
    """One line of text for each row; a retried job replaces its output with mode ``overwrite``."""
    rows.select(F.col(value).cast("string")).write.mode(mode).text(path)
