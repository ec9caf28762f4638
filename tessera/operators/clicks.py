"""Web click logs: cleaning, and counts per day and course or referring host. The same functions serve batches and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import before_last, part, referer_host, split_kept, strict, strict_time, trimmed, worked_out


def parse(lines: DataFrame, value: str = "value", any_path: bool = False) -> DataFrame:
    """The line with ip, time, course_id, status, referer and ``reason``, which is null for good lines.

    A line has at least five tab-separated fields. The second word of the request is the address; if it starts with
    ``/class``, its third segment up to the last dot is the course, else the course is 0. With ``any_path`` every address is read like that, so those without
    such a number are rejects.
    """
    f = worked_out(lines, f__=split_kept(F.col(value), "\t"))
    f = worked_out(
        f, ip=part(F.col("f__"), 0), time=strict_time(part(F.col("f__"), 1)), url__=part(split_kept(trimmed(part(F.col("f__"), 2)), " "), 1),
        status=strict(part(F.col("f__"), 3), "int"), referer=part(F.col("f__"), 4),
    )
    course = strict(before_last(part(split_kept(F.col("url__"), "/"), 2), "."), "int")
    f = worked_out(f, course_id=course if any_path else F.when(F.startswith("url__", F.lit("/class")), course).otherwise(F.lit(0)))
    reason = (
        F.when(F.size("f__") < 5, "fields").when(F.col("url__").isNull(), "request").when(F.col("course_id").isNull(), "course")
        .when(F.col("time").isNull(), "time").when(F.col("status").isNull(), "status")
    )
    return f.withColumn("reason", reason).drop("f__", "url__")


def clean(lines: DataFrame, value: str = "value", any_path: bool = False) -> DataFrame:
    """ip, time, course_id, status, referer of the good lines with a course; with ``any_path`` a course may have the number 0."""
    good = parse(lines, value, any_path).filter("reason is null")
    return (good if any_path else good.filter("course_id <> 0")).select("ip", "time", "course_id", "status", "referer")


def rejects(lines: DataFrame, value: str = "value", any_path: bool = False) -> DataFrame:
    """The lines that cannot be read, with the reason."""
    return parse(lines, value, any_path).filter("reason is not null").select(value, "reason")


def per_day(clicks: DataFrame) -> DataFrame:
    """day_course (yyyyMMdd_course), clicks."""
    key = F.concat_ws("_", F.date_format("time", "yyyyMMdd"), F.col("course_id").cast("string"))
    return clicks.groupBy(key.alias("day_course")).agg(F.count("*").alias("clicks"))


def per_day_and_host(clicks: DataFrame) -> DataFrame:
    """day_host_course, clicks; only referers with a host and a path count."""
    rows = worked_out(clicks, host__=referer_host(F.col("referer"))).filter("host__ <> ''")
    key = F.concat_ws("_", F.date_format("time", "yyyyMMdd"), "host__", F.col("course_id").cast("string"))
    return rows.groupBy(key.alias("day_host_course")).agg(F.count("*").alias("clicks"))


def address_host(url: Column) -> Column:
    """What stands between ``//`` and the next ``/``, ``?`` or ``#``, without user and port, in lower case; null for an address without it."""
    host = F.regexp_extract(url, r"\A[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#@:]+)", 1)
    return F.when(host != "", F.lower(host))


def top_addresses(visits: DataFrame, k: int = 3, url: str = "url") -> DataFrame:
    """host, rank, url, visits: the k most visited addresses of each host, equal ones by address; ``visits`` has a row for each visit.

    Addresses without a host (``without_host``) are not counted. Visits are counted before hosts meet, and a task hands on k addresses of a host, so one host may hold most visits.
    """
    counts = worked_out(visits.select(F.col(url).alias("url")), host=address_host(F.col("url"))).filter("host is not null").groupBy("host", "url").agg(F.count("*").alias("visits"))
    first = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("visits"), "url"))
    return counts.withColumn("rank", first).filter(F.col("rank") <= k).select("host", "rank", "url", "visits")


def without_host(visits: DataFrame, url: str = "url") -> DataFrame:
    """The rows whose address has no host."""
    return visits.filter(address_host(F.col(url)).isNull())


def address_lists(top: DataFrame) -> DataFrame:
    """host, addresses: what ``top_addresses`` gives as one list of (url, visits) for each host, the most visited first."""
    listed = F.sort_array(F.collect_list(F.struct("rank", "url", "visits")))
    return top.groupBy("host").agg(F.transform(listed, lambda a: F.struct(a["url"].alias("url"), a["visits"].alias("visits"))).alias("addresses"))
