"""Queries on visits to stations, ranks in categories, and labelled texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import categories, labelled, visits
from .inputs import cents, table
from .registry import query

#: Lines for the oracle: views, clicks and purchases enter, errors leave, other events have a flag that is none.
_VISITS = """
lines AS (SELECT CAST(user_id AS VARCHAR) AS phone, date_trunc('second', ts) AS time, 's' || (user_id % 5 + event_id // 7 % 3) AS station,
  CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 1 WHEN 'error' THEN 0 WHEN 'purchase' THEN 0 ELSE 2 END AS flag FROM events WHERE event_id % 41 <> 0),
near AS (SELECT *, lead(flag) OVER w AS next_flag, lead(time) OVER w AS next_time, lag(flag) OVER w AS last_flag FROM lines WHERE flag < 2 WINDOW w AS (PARTITION BY phone, station ORDER BY time, flag))"""


def _visit_lines(spark: SparkSession, d: str) -> DataFrame:
    """A log line for each event; some lack the flag."""
    flag = F.expr("case event_type when 'click' then '1' when 'view' then '1' when 'error' then '0' when 'purchase' then '0' else '2' end")
    station = F.expr("concat('s', user_id % 5 + event_id div 7 % 3)")
    line = F.concat_ws(",", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMddHHmmss"), station, F.when(F.col("event_id") % 41 != 0, flag))
    return table(spark, d, "events").select(line.alias("value"))


@query(f"""WITH {_VISITS}, spent AS (SELECT phone, station, count(*) AS visits, CAST(sum(epoch(next_time) - epoch(time)) AS BIGINT) AS seconds FROM near WHERE flag = 1 AND next_flag = 0 GROUP BY 1, 2)
SELECT phone, CAST(row_number() OVER (PARTITION BY phone ORDER BY seconds DESC, station) AS INTEGER) AS rank, station, visits, seconds, n_name
FROM spent LEFT JOIN nation ON station = 's' || n_nationkey QUALIFY rank <= 2""")
def station_visits(spark: SparkSession, d: str) -> DataFrame:
    """The two stations where each phone spent most time."""
    stations = table(spark, d, "nation").select(F.concat(F.lit("s"), F.col("n_nationkey").cast("string")).alias("station"), "n_name")
    return visits.top_stations(visits.dwell(visits.visits(visits.events(_visit_lines(spark, d)))), stations, 2)


@query(f"""WITH {_VISITS} SELECT phone, station, strftime(time, '%Y%m%d%H%M%S') AS time, flag, CASE flag WHEN 1 THEN 'no leave' ELSE 'no enter' END AS reason FROM near
WHERE (flag = 1 AND coalesce(next_flag, 1) = 1) OR (flag = 0 AND coalesce(last_flag, 0) = 0)""")
def unmatched_visits(spark: SparkSession, d: str) -> DataFrame:
    """Enter and leave events that belong to no visit."""
    return visits.unmatched(visits.events(_visit_lines(spark, d))).withColumn("time", F.date_format("time", "yyyyMMddHHmmss"))


#: The categories of the lines.
CATEGORIES = ["STANDARD", "ECONOMY LINE", "LINE", "MEDIUM", "PROMO", "LARGE"]


def _sale_lines(spark: SparkSession, d: str) -> DataFrame:
    """A line ``product category amount`` for each part, with one or more spaces between; SMALL is not a known category."""
    category = F.expr("case when p_type = 'ECONOMY' and p_partkey % 2 = 0 then 'ECONOMY LINE' when p_type = 'ECONOMY' then 'LINE' else p_type end")
    gap = F.expr("if(p_partkey % 3 = 0, ' ', '    ')")
    amount = F.when(F.col("p_partkey") % 11 == 0, F.lit("n/a")).otherwise(F.floor(cents("p_retailprice") / 1000).cast("string"))
    return table(spark, d, "part").select(F.concat(F.col("p_name"), F.lit("#"), F.col("p_partkey").cast("string"), gap, category, gap, amount).alias("value"))


_SALES = """sales AS (SELECT p_name || '#' || p_partkey AS product, CASE WHEN p_type = 'ECONOMY' AND p_partkey % 2 = 0 THEN 'ECONOMY LINE' WHEN p_type = 'ECONOMY' THEN 'LINE' ELSE p_type END AS category,
  CAST(floor(CAST(round(p_retailprice * 100) AS BIGINT) / 1000) AS BIGINT) AS amount, p_partkey FROM part)"""


@query(f"""WITH {_SALES} SELECT product, category, amount, dense_rank() OVER (PARTITION BY category ORDER BY amount DESC) AS rank, max(amount) OVER (PARTITION BY category) - amount AS gap
FROM sales WHERE category <> 'SMALL' AND p_partkey % 11 <> 0""")
def category_ranks(spark: SparkSession, d: str) -> DataFrame:
    """The rank of each product's amount in its category, and how far it is from the best."""
    good = categories.parse(_sale_lines(spark, d), CATEGORIES).filter("reason is null").select("product", "category", "amount")
    return categories.ranked(good)


@query(f"""WITH {_SALES} SELECT CASE WHEN p_partkey % 11 = 0 THEN 'amount' ELSE 'category' END AS reason, count(*) AS n FROM sales WHERE category = 'SMALL' OR p_partkey % 11 = 0 GROUP BY 1""")
def category_rejects(spark: SparkSession, d: str) -> DataFrame:
    return categories.parse(_sale_lines(spark, d), CATEGORIES).filter("reason is not null").groupBy("reason").agg(F.count("*").alias("n"))


@query()
def labelled_texts(spark: SparkSession, d: str) -> DataFrame:
    """doc_id, label, prediction of a quarter of the documents by a model of the others, the language as the label."""
    docs = table(spark, d, "documents").select("doc_id", "text", F.col("lang").alias("label"))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    return labelled.predict(labelled.train(docs.filter(~held)), docs.filter(held)).select("doc_id", "label", "prediction")
