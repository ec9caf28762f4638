"""Inputs of the queries: the given tables, and lines and pairs that Spark derives from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def click_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tab-separated log line (value) for each event; the number of the event decides which lines are malformed and how."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    events = events.join(F.broadcast(pages.agg(F.count("*").alias("pages"))))  # one row
    rows = events.withColumn("page_id", F.col("event_id") % F.col("pages")).join(pages, "page_id", "left")
    request = F.expr(
        """case event_id % 23 when 0 then 'GET /classics/7.html HTTP/1.1' when 1 then 'GET /class/abc.html HTTP/1.1' when 2 then 'GET /class/12 HTTP/1.1'
        when 3 then 'GET /class/0.html HTTP/1.1' when 4 then 'GET' when 5 then '  GET /learn/5 HTTP/1.1 ' when 6 then 'GET /class HTTP/1.1'
        else concat('GET /class/', event_id % 10 + 1, '.html HTTP/1.1') end"""
    )
    referer = F.expr("case when event_id % 5 = 0 then '-' when event_id % 7 = 0 then 'http://a.com' when event_id % 11 = 0 then '' else coalesce(url, '') end")
    time = F.expr("if(event_id % 31 = 3, '2024/01/01', date_format(ts, 'yyyy-MM-dd HH:mm:ss'))")
    ip = F.expr("concat('10.0.', user_id % 256, '.', event_id % 256)")
    return rows.select(F.concat_ws("\t", ip, time, request, F.expr("if(event_id % 29 = 7, '2x0', '200')"), referer).alias("value"))


#: The same lines for the oracle.
CLICK_LINES = """
lines AS (
  SELECT concat_ws(chr(9), '10.0.' || (user_id % 256) || '.' || (event_id % 256),
    CASE WHEN event_id % 31 = 3 THEN '2024/01/01' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END,
    CASE event_id % 23 WHEN 0 THEN 'GET /classics/7.html HTTP/1.1' WHEN 1 THEN 'GET /class/abc.html HTTP/1.1' WHEN 2 THEN 'GET /class/12 HTTP/1.1'
      WHEN 3 THEN 'GET /class/0.html HTTP/1.1' WHEN 4 THEN 'GET' WHEN 5 THEN '  GET /learn/5 HTTP/1.1 ' WHEN 6 THEN 'GET /class HTTP/1.1'
      ELSE 'GET /class/' || (event_id % 10 + 1) || '.html HTTP/1.1' END,
    CASE WHEN event_id % 29 = 7 THEN '2x0' ELSE '200' END,
    CASE WHEN event_id % 5 = 0 THEN '-' WHEN event_id % 7 = 0 THEN 'http://a.com' WHEN event_id % 11 = 0 THEN '' ELSE coalesce(url, '') END) AS value
  FROM events LEFT JOIN pages ON page_id = event_id % (SELECT count(*) FROM pages)
),
fields AS (SELECT value, string_split(rtrim(value, chr(9)), chr(9)) AS f FROM lines),
urls AS (SELECT value, f, string_split(trim(f[3], ' '), ' ')[2] AS url FROM fields),
parsed AS (
  SELECT value, f, f[5] AS referer, CASE WHEN regexp_full_match(f[2], '[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}') THEN strptime(f[2], '%Y-%m-%d %H:%M:%S') END AS time,
    CASE WHEN regexp_full_match(f[4], '[+-]?[0-9]+') THEN CAST(f[4] AS INTEGER) END AS status, url,
    CASE WHEN starts_with(url, '/class') THEN
      CASE WHEN regexp_full_match(regexp_extract(string_split(rtrim(url, '/'), '/')[3], '^(.*)[.]', 1), '[+-]?[0-9]+')
        THEN CAST(regexp_extract(string_split(rtrim(url, '/'), '/')[3], '^(.*)[.]', 1) AS INTEGER) END
    ELSE 0 END AS course_id
  FROM urls
),
judged AS (
  SELECT *, CASE WHEN len(f) < 5 THEN 'fields' WHEN url IS NULL THEN 'request' WHEN course_id IS NULL THEN 'course' WHEN time IS NULL THEN 'time' WHEN status IS NULL THEN 'status' END AS reason
  FROM parsed
)
"""


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user, item, rating, ts of the events: the item is the number in the props, the rating follows the value (1 to 5)."""
    rating = (F.floor(F.least(F.col("value"), F.lit(199.99)) / 40) + 1).cast("double")
    item = F.get_json_object("props", "$.k").cast("bigint")
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("user"), item.alias("item"), rating.alias("rating"), "ts", "event_id").filter("item is not null and rating >= 1")


RATINGS = """
ratings AS (
  SELECT user_id AS "user", CAST(json_extract_string(props, '$.k') AS BIGINT) AS item, CAST(floor(least(value, 199.99) / 40) + 1 AS DOUBLE) AS rating, ts, event_id
  FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL AND floor(least(value, 199.99) / 40) + 1 >= 1
)
"""


def cents(column: str):
    return F.round(F.col(column) * 100).cast("bigint")


def page_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id and the address of the page it visits: the visits of a user stay within few pages, and some addresses lack a host."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    events = table(spark, sf_dir, "events").select("event_id", "user_id").join(F.broadcast(pages.agg(F.count("*").alias("pages"))))  # one row
    rows = events.withColumn("page_id", (F.col("user_id") * 7 + F.col("event_id") % 3) % F.col("pages")).join(pages, "page_id", "left")
    return rows.select("event_id", F.expr("case event_id % 17 when 0 then replace(url, '://', ':') when 1 then replace(url, '://', '://User@') when 2 then upper(url) else url end").alias("url"))


PAGE_VISITS = """
visits AS (
  SELECT event_id, CASE event_id % 17 WHEN 0 THEN replace(url, '://', ':') WHEN 1 THEN replace(url, '://', '://User@') WHEN 2 THEN upper(url) ELSE url END AS url
  FROM events LEFT JOIN pages ON page_id = (user_id * 7 + event_id % 3) % (SELECT count(*) FROM pages)
)
"""
