"""File sources: text lines, delimited and tuple text, JSON, and models. Paths may be any URI that Spark reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions.text import split_kept, split_spaces, strict, worked_out


def lines(spark: SparkSession, path: str) -> DataFrame:
    """``value`` of each line of the files (a glob may be given)."""
    return spark.read.text(path)


def _typed(rows: DataFrame, parts, fields: list[tuple[str, str]]) -> tuple[DataFrame, DataFrame]:
    parsed = worked_out(rows.select(F.col("value").alias("line__")), parts__=parts(F.col("line__")))
    cols = {n: F.get("parts__", i) if k == "string" else strict(F.get("parts__", i), k) for i, (n, k) in enumerate(fields)}
    parsed = worked_out(parsed, **cols)
    good = F.lit(True)
    for n, _ in fields:
        good = good & F.col(n).isNotNull()
    return parsed.filter(good).select([n for n, _ in fields]), parsed.filter(~good).select(F.col("line__").alias("value"), F.when(F.size("parts__") < len(fields), "fields").otherwise("number").alias("reason"))


def delimited(rows: DataFrame, sep: str | None, fields: list[tuple[str, str]]) -> tuple[DataFrame, DataFrame]:
    """(good, rejects) of lines in ``value``: positional fields of the kinds string, int, bigint, double; sep None is white space."""
    return _typed(rows, lambda line: split_spaces(line) if sep is None else split_kept(line, sep), fields)


def tuples(rows: DataFrame, fields: list[tuple[str, str]]) -> tuple[DataFrame, DataFrame]:
    """(good, rejects) of lines written as tuples: ``(1,2,3.0,4)``."""
    return _typed(rows, lambda line: F.when(line.rlike(r"\A\(.*\)\z"), split_kept(F.substring(line, F.lit(2), F.length(line) - 2), ",")).otherwise(F.array()), fields)


def json_rows(rows: DataFrame, schema: str, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(good, rejects) of JSON messages in ``value``, one object each; a message without a required field, or with anything behind the object, is rejected.

    A parser stops at the end of an object, so the message is read inside an array with a mark behind it: one element and the mark must come out. The mark is a digest of
    the message, which the message itself cannot hold.
    """
    mark = F.md5(F.encode("value", "UTF-8"))
    kind = StructType([StructField("all", ArrayType(StructType.fromDDL(schema))), StructField("mark", StringType())])
    parsed = rows.withColumn("m__", F.from_json(F.concat(F.lit('{"all":['), "value", F.lit('],"mark":"'), mark, F.lit('"}')), kind))
    whole = (F.col("m__.mark") == mark) & (F.size("m__.all") == 1)
    parsed = worked_out(parsed, j__=F.when(whole, F.get("m__.all", 0)))
    bad = F.col("j__").isNull()
    for n in required:
        bad = bad | F.col(f"j__.{n}").isNull()
    return parsed.filter(~bad).select("j__.*"), parsed.filter(bad).select("value", F.lit("json").alias("reason"))


def labelled_files(spark: SparkSession, path: str) -> DataFrame:
    """path, label, text of every file under a folder of folders: the label is the name of the file's folder, the text the whole file."""
    rows = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    return rows.select("path", F.url_decode(F.replace(F.element_at(F.split("path", "/"), -2), F.lit("+"), F.lit("%2B"))).alias("label"), "text")


def json_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)
