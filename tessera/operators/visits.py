"""Visits of phones to stations: enter and leave events paired into intervals, and the time spent at each station."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import part, split_kept, strict, worked_out

ENTER, LEAVE = 1, 0


def parse(lines: DataFrame, value: str = "value") -> DataFrame:
    """The line with phone, time, station, flag and ``reason``, which is null for good lines ``phone,yyyyMMddHHmmss,station,flag`` (1 enters, 0 leaves)."""
    f = worked_out(lines, f__=split_kept(F.col(value), ","))
    time = part(F.col("f__"), 1)
    f = worked_out(
        f, phone=part(F.col("f__"), 0), time=F.when(time.rlike(r"\A[0-9]{14}\z"), F.try_to_timestamp(time, F.lit("yyyyMMddHHmmss"))), station=part(F.col("f__"), 2), flag=strict(part(F.col("f__"), 3), "int")
    )
    reason = (
        F.when(F.col("f__").isNull() | (F.size("f__") < 4), "fields").when((F.col("phone") == "") | (F.col("station") == ""), "key")
        .when(F.col("time").isNull(), "time").when(F.col("flag").isNull() | ~F.col("flag").isin(ENTER, LEAVE), "flag")
    )
    return f.withColumn("reason", reason).drop("f__")


def events(lines: DataFrame) -> DataFrame:
    return parse(lines).filter("reason is null").select("phone", "station", "time", "flag")


def with_neighbours(rows: DataFrame, slot: str = "day") -> DataFrame:
    """phone, station, time, flag with ``before`` and ``after``: (time, flag) of the events next to each in the order of time, then flag.

    Events are ordered within a slot of time; the ends of a slot look at the nearest slot that has events. So a phone at a station with very many events is
    spread over its slots, and only one row a slot is ordered as a whole.
    """
    key = ["phone", "station"]
    rows = rows.withColumn("slot", F.date_trunc(slot, "time"))
    inside = Window.partitionBy(*key, "slot").orderBy("time", "flag")
    own = F.struct("time", "flag")
    ends = rows.groupBy(*key, "slot").agg(F.min(own).alias("first"), F.max(own).alias("last"))
    over = Window.partitionBy(*key).orderBy("slot")
    ends = ends.select(*key, "slot", F.lag("last").over(over).alias("earlier"), F.lead("first").over(over).alias("later"))
    rows = rows.withColumn("before", F.lag(own).over(inside)).withColumn("after", F.lead(own).over(inside)).join(ends, [*key, "slot"])
    return rows.select(*key, "time", "flag", F.coalesce("before", "earlier").alias("before"), F.coalesce("after", "later").alias("after"))


def visits(rows: DataFrame) -> DataFrame:
    """phone, station, enter, leave: each enter event that a leave event follows directly. Of equal times, leaving comes first."""
    return with_neighbours(rows).filter((F.col("flag") == ENTER) & (F.col("after.flag") == LEAVE)).select("phone", "station", F.col("time").alias("enter"), F.col("after.time").alias("leave"))


def unmatched(rows: DataFrame) -> DataFrame:
    """phone, station, time, flag, reason of the events that belong to no visit: ``no leave`` or ``no enter``."""
    found = with_neighbours(rows)
    no_leave = (F.col("flag") == ENTER) & (F.col("after").isNull() | (F.col("after.flag") == ENTER))
    no_enter = (F.col("flag") == LEAVE) & (F.col("before").isNull() | (F.col("before.flag") == LEAVE))
    reason = F.when(no_leave, "no leave").when(no_enter, "no enter")
    return found.withColumn("reason", reason).filter("reason is not null").select("phone", "station", "time", "flag", "reason")


def dwell(found: DataFrame) -> DataFrame:
    """phone, station, visits and seconds spent there."""
    spent = F.unix_timestamp("leave") - F.unix_timestamp("enter")
    return found.groupBy("phone", "station").agg(F.count("*").alias("visits"), F.sum(spent).alias("seconds"))


def top_stations(spent: DataFrame, stations: DataFrame, n: int = 2) -> DataFrame:
    """phone, rank, station, visits, seconds and the columns of ``stations`` (null if the station is not listed): the n stations with most time of each phone, ties by station."""
    order = Window.partitionBy("phone").orderBy(F.desc("seconds"), "station")
    top = spent.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
    return top.join(stations, "station", "left")


def station_list(lines: DataFrame) -> DataFrame:
    """station, longitude, latitude of lines ``station,longitude,latitude,kind``."""
    f = worked_out(lines, f__=split_kept(F.col("value"), ","))
    return f.select(part(F.col("f__"), 0).alias("station"), strict(part(F.col("f__"), 1), "double").alias("longitude"), strict(part(F.col("f__"), 2), "double").alias("latitude")).filter("station <> ''")
