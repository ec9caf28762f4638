"""Queries over the given tables and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as fn
from ..operators import clicks, orders, ranking, ratings, recommend, relational, rerank, similar
from ..sources import files, sinks
from .inputs import CLICK_LINES, PAGE_VISITS, RATINGS, cents, click_lines, page_visits, table
from .inputs import ratings as rating_rows
from .registry import ORACLES, QUERIES, query

# Click logs


@query(f"WITH {CLICK_LINES} SELECT strftime(time, '%Y%m%d') || '_' || course_id AS day_course, count(*) AS clicks FROM judged WHERE reason IS NULL AND course_id <> 0 GROUP BY 1")
def course_clicks_per_day(spark: SparkSession, d: str) -> DataFrame:
    return clicks.per_day(clicks.clean(click_lines(spark, d)))


@query(f"WITH {CLICK_LINES} SELECT value, reason FROM judged WHERE reason IS NOT NULL")
def click_log_rejects(spark: SparkSession, d: str) -> DataFrame:
    return clicks.rejects(click_lines(spark, d))


@query(f"""WITH {CLICK_LINES}, hosts AS (
  SELECT time, course_id, string_split(rtrim(replace(referer, '//', '/'), '/'), '/') AS parts FROM judged WHERE reason IS NULL AND course_id <> 0)
SELECT strftime(time, '%Y%m%d') || '_' || parts[2] || '_' || course_id AS day_host_course, count(*) AS clicks FROM hosts WHERE len(parts) > 2 AND parts[2] <> '' GROUP BY 1""")
def course_clicks_by_host(spark: SparkSession, d: str) -> DataFrame:
    return clicks.per_day_and_host(clicks.clean(click_lines(spark, d)))


#: The third segment of any address, as the looser variant reads it.
ANY_COURSE = "regexp_extract(string_split(rtrim(url, '/'), '/')[3], '^(.*)[.]', 1)"


@query(f"""WITH {CLICK_LINES}, loose AS (
  SELECT value, time, CASE WHEN regexp_full_match({ANY_COURSE}, '[+-]?[0-9]+') THEN CAST({ANY_COURSE} AS INTEGER) END AS course, f, url, status FROM parsed),
sorted AS (SELECT *, CASE WHEN len(f) < 5 THEN 'fields' WHEN url IS NULL THEN 'request' WHEN course IS NULL THEN 'course' WHEN time IS NULL THEN 'time' WHEN status IS NULL THEN 'status' END AS why FROM loose)
SELECT strftime(time, '%Y%m%d') || '_' || course AS day_course, count(*) AS clicks FROM sorted WHERE why IS NULL GROUP BY 1
UNION ALL SELECT 'rejected_' || why, count(*) FROM sorted WHERE why IS NOT NULL GROUP BY 1""")
def any_course_clicks_per_day(spark: SparkSession, d: str) -> DataFrame:
    lines = click_lines(spark, d)
    left_out = clicks.rejects(lines, any_path=True).groupBy(F.concat(F.lit("rejected_"), "reason").alias("day_course")).agg(F.count("*").alias("clicks"))
    return clicks.per_day(clicks.clean(lines, any_path=True)).unionByName(left_out)


_HOST = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*@)?([^/?#@:]+)', 2))"


@query(f"""WITH {PAGE_VISITS}, counts AS (SELECT {_HOST} AS host, url, count(*) AS visits FROM visits WHERE {_HOST} <> '' GROUP BY 1, 2)
SELECT host, CAST(row_number() OVER (PARTITION BY host ORDER BY visits DESC, url) AS INTEGER) AS rank, url, visits FROM counts QUALIFY rank <= 3""")
def top_addresses_by_host(spark: SparkSession, d: str) -> DataFrame:
    return clicks.top_addresses(page_visits(spark, d))


@query(f"""WITH {PAGE_VISITS} SELECT event_id, url FROM visits WHERE NOT coalesce({_HOST} <> '', false)""")
def visits_without_host(spark: SparkSession, d: str) -> DataFrame:
    return clicks.without_host(page_visits(spark, d))


@query(f"""WITH {CLICK_LINES}, counts AS (
  SELECT strftime(time, '%Y%m%d') || '_' || course_id AS day_course, count(*) AS clicks FROM judged WHERE reason IS NULL AND course_id <> 0 GROUP BY 1),
keys AS (SELECT DISTINCT strftime(ts, '%Y%m%d') || '_' || (event_id % 13) AS day_course FROM events)
SELECT day_course, coalesce(clicks, 0) AS clicks FROM keys LEFT JOIN counts USING (day_course)""")
def click_count_lookup(spark: SparkSession, d: str) -> DataFrame:
    keys = table(spark, d, "events").select(F.concat_ws("_", F.date_format("ts", "yyyyMMdd"), (F.col("event_id") % 13).cast("string")).alias("day_course")).distinct()
    return relational.lookup(keys, course_clicks_per_day(spark, d), "day_course", "clicks")


@query("SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS compact, strftime(ts, '%Y%m%d') AS day, epoch_us(ts) // 1000 AS millis, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_id % 10 AS digit, round(log2(value + 1), 9) AS bits FROM events")
def event_times(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events")
    compact = fn.compact_time(F.col("ts"))
    return rows.select(
        "event_id", compact.alias("compact"), F.substring(compact, 1, 8).alias("day"), fn.epoch_millis(F.col("ts")).alias("millis"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"), (F.col("event_id") % 10).alias("digit"), F.round(fn.log2(F.col("value") + 1), 9).alias("bits"),
    )


# Counts, sorts, tops


@query("""WITH lines AS (SELECT unnest(regexp_split_to_array(text, '\\r\\n|\\n|\\r')) AS line FROM documents),
tokens AS (SELECT unnest(CASE WHEN line = '' THEN [''] WHEN rtrim(line, ' ') = '' THEN [] ELSE string_split(rtrim(line, ' '), ' ') END) AS word FROM lines)
SELECT word, count(*) AS n FROM tokens GROUP BY word""")
def word_count(spark: SparkSession, d: str) -> DataFrame:
    return relational.word_count(table(spark, d, "documents").select("text"))


@query("SELECT o_custkey, o_totalprice, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS INTEGER) AS place FROM orders")
def secondary_sort(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_custkey", "o_totalprice", "o_orderkey")
    return relational.secondary_sort(rows.withColumn("place", F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_totalprice", "o_orderkey"))), "o_custkey", "o_totalprice", "o_orderkey")


@query("SELECT o_custkey, o_orderkey, o_totalprice, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rank FROM orders) WHERE rank <= 2")
def top_orders_per_customer(spark: SparkSession, d: str) -> DataFrame:
    return relational.top_n_per_group(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), "o_custkey", "o_totalprice", 2, "o_orderkey")


@query("SELECT l_partkey, CAST(sum(l_quantity) AS BIGINT) AS total FROM lineitem GROUP BY 1 ORDER BY total DESC, l_partkey LIMIT 20")
def top_parts_by_quantity(spark: SparkSession, d: str) -> DataFrame:
    return relational.top_n_keys(table(spark, d, "lineitem"), "l_partkey", F.col("l_quantity").cast("bigint"), 20)


@query("""WITH sums AS (SELECT l_suppkey % 40 AS grp, count(*) AS total FROM lineitem GROUP BY 1), r AS (SELECT *, rank() OVER (ORDER BY total DESC) AS r FROM sums)
SELECT grp, CAST(total AS BIGINT) AS total FROM r WHERE r <= 10""")
def top_groups_with_ties(spark: SparkSession, d: str) -> DataFrame:
    return relational.top_n_keys(table(spark, d, "lineitem").select((F.col("l_suppkey") % 40).alias("grp"), F.lit(1).alias("one")), "grp", "one", 10, with_ties=True)


@query("SELECT l_suppkey, l_linenumber, CAST(sum(l_quantity) AS BIGINT) AS l_quantity FROM lineitem GROUP BY 1, 2")
def value_sums(spark: SparkSession, d: str) -> DataFrame:
    return relational.value_sums(table(spark, d, "lineitem").withColumn("l_quantity", F.col("l_quantity").cast("bigint")), "l_suppkey", "l_linenumber", "l_quantity")


@query("""WITH s AS (SELECT l_suppkey, l_linenumber, CAST(sum(l_quantity) AS BIGINT) AS q FROM lineitem GROUP BY 1, 2)
SELECT l_suppkey, string_agg(l_linenumber || ':' || q, ',' ORDER BY l_linenumber) AS times FROM s GROUP BY 1""")
def value_map(spark: SparkSession, d: str) -> DataFrame:
    rows = relational.value_map(table(spark, d, "lineitem").withColumn("l_quantity", F.col("l_quantity").cast("bigint")), "l_suppkey", "l_linenumber", "l_quantity")
    return rows.select("l_suppkey", F.expr("array_join(transform(map_entries(times), e -> concat(e.key, ':', e.value)), ',')").alias("times"))


@query("SELECT l_suppkey, l_orderkey, l_linenumber, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey) AS INTEGER) AS place FROM lineitem")
def sorted_within_supplier(spark: SparkSession, d: str) -> DataFrame:
    rows = relational.sorted_within_key(table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey"), "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey")
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("l_suppkey").orderBy("l_orderkey", "l_linenumber", "l_partkey"))).drop("l_partkey")


@query("SELECT c_name AS name, CAST(floor(c_acctbal / 100) AS BIGINT) AS age FROM customer WHERE floor(c_acctbal / 100) > 21")
def people_filter(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "customer").select(F.to_json(F.struct(F.col("c_name").alias("name"), F.floor(F.col("c_acctbal") / 100).alias("age"))).alias("value"))
    good, _ = files.json_rows(lines, "name string, age bigint", ["name"])
    return good.filter(F.col("age") > 21)


@query("SELECT o_orderpriority, avg(n) AS mean_orders, count(*) AS customers FROM (SELECT o_orderpriority, o_custkey, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY 1")
def mean_over_groups(spark: SparkSession, d: str) -> DataFrame:
    per = table(spark, d, "orders").groupBy("o_orderpriority", "o_custkey").agg(F.count("*").alias("n"))
    return per.groupBy("o_orderpriority").agg(F.avg("n").alias("mean_orders"), F.count("*").alias("customers"))


# Joins and filters

_BLOCKED = """blocked AS (SELECT DISTINCT user_id, user_id % 3 = 0 AS flag FROM events WHERE user_id % 4 = 0 UNION ALL SELECT DISTINCT user_id, true FROM events WHERE user_id % 10 = 0)"""
_UNBLOCKED = f"WITH {_BLOCKED} SELECT event_id, user_id FROM events WHERE user_id NOT IN (SELECT user_id FROM blocked WHERE flag)"


def _blocked(spark: SparkSession, d: str) -> DataFrame:
    """A list with true, false and repeated flags, derived from the users."""
    users = table(spark, d, "events").select("user_id").distinct()
    return users.filter("user_id % 4 = 0").select("user_id", (F.col("user_id") % 3 == 0).alias("flag")).unionByName(users.filter("user_id % 10 = 0").select("user_id", F.lit(True).alias("flag")))


@query(_UNBLOCKED)
def blocked_by_join(spark: SparkSession, d: str) -> DataFrame:
    return relational.blocked_by_join(table(spark, d, "events").select("event_id", "user_id"), _blocked(spark, d), "user_id")


@query(_UNBLOCKED)
def blocked_by_anti_join(spark: SparkSession, d: str) -> DataFrame:
    return relational.blocked_by_anti_join(table(spark, d, "events").select("event_id", "user_id"), _blocked(spark, d), "user_id")


@query("SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM (SELECT event_type, user_id FROM events WHERE event_id % 2 = 0 UNION ALL SELECT event_type, user_id FROM events WHERE event_id % 2 = 1) GROUP BY 1")
def union_and_distinct(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select("event_type", "user_id", "event_id")
    both = rows.filter("event_id % 2 = 0").unionByName(rows.filter("event_id % 2 = 1"))
    pairs = both.groupBy("event_type", "user_id").agg(F.count("*").alias("n"))
    return pairs.groupBy("event_type").agg(F.sum("n").alias("n"), F.count("*").alias("users"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def membership(spark: SparkSession, d: str) -> DataFrame:
    late = table(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").select("c_custkey", "c_name").join(late, "c_custkey", "left_semi")


@query("""SELECT event_id, CASE WHEN x < 70 THEN 0 WHEN x < 90 THEN 1 ELSE 2 END AS part FROM (SELECT event_id, CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 AS x FROM events)""")
def hash_split(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select("event_id")
    return rows.withColumn("part", relational.hash_split(F.col("event_id"), [70, 20, 10]))


# Ratings and movies


def _rating_lines(spark: SparkSession, d: str) -> DataFrame:
    """user,item,rating,seconds for each event; some lines are short, not numeric or of user 0."""
    return table(spark, d, "events").select(
        F.expr("""case when event_id % 41 = 0 then concat(user_id, ',', event_id % 97) when event_id % 43 = 0 then concat(user_id, ',x,3.0,5') when event_id % 47 = 0 then concat(' ', user_id, ',7,3.0,5')
        else concat(user_id, ',', event_id % 97, ',', event_id % 5 + 1, '.5,', unix_timestamp(ts)) end""").alias("value")
    )


_RATING_LINES = """lines AS (SELECT CASE WHEN event_id % 41 = 0 THEN user_id || ',' || (event_id % 97) WHEN event_id % 43 = 0 THEN user_id || ',x,3.0,5' WHEN event_id % 47 = 0 THEN ' ' || user_id || ',7,3.0,5'
  ELSE user_id || ',' || (event_id % 97) || ',' || (event_id % 5 + 1) || '.5,' || CAST(floor(epoch(ts)) AS BIGINT) END AS value FROM events),
f AS (SELECT value, string_split(value, ',') AS f FROM lines),
p AS (SELECT value, f, CASE WHEN regexp_full_match(f[1], '[+-]?[0-9]+') THEN CAST(f[1] AS INTEGER) END AS u, CASE WHEN regexp_full_match(f[2], '[+-]?[0-9]+') THEN CAST(f[2] AS INTEGER) END AS i,
  CASE WHEN regexp_full_match(f[3], '[0-9]+[.]?[0-9]*') THEN CAST(f[3] AS DOUBLE) END AS r, CASE WHEN regexp_full_match(f[4], '[0-9]+') THEN CAST(f[4] AS BIGINT) % 10 END AS digit FROM f),
j AS (SELECT *, CASE WHEN len(f) < 4 THEN 'fields' WHEN u IS NULL OR i IS NULL OR r IS NULL OR digit IS NULL THEN 'number' WHEN u = 0 THEN 'user' END AS reason FROM p)"""


@query(f"""WITH {_RATING_LINES} SELECT CASE WHEN digit <= 5 THEN 'train' WHEN digit <= 7 THEN 'validation' ELSE 'test' END AS split, u AS "user", i AS item, r AS rating, digit FROM j WHERE reason IS NULL""")
def rating_split(spark: SparkSession, d: str) -> DataFrame:
    return ratings.parse_ratings(_rating_lines(spark, d)).filter("reason is null").select("split", "user", "item", "rating", "digit")


@query(f"WITH {_RATING_LINES} SELECT value, reason FROM j WHERE reason IS NOT NULL")
def rating_rejects(spark: SparkSession, d: str) -> DataFrame:
    return ratings.parse_ratings(_rating_lines(spark, d)).filter("reason is not null").select("value", "reason")


def _movie_lines(spark: SparkSession, d: str) -> DataFrame:
    """id,title (year),genres for each part; titles with commas, quotes or no year, and lines without an id or commas."""
    return table(spark, d, "part").select(
        F.expr("""case p_partkey % 11 when 0 then concat(p_partkey, ',"', p_name, ', The (', 1950 + p_size, ')",', p_type, '|', replace(p_name, ' ', '|')) when 1 then concat(p_partkey, ',', p_name, ',', p_type)
        when 2 then concat('movieId,', p_name, ' (1999),', p_type) when 3 then concat(p_partkey, ' ', p_name) when 4 then concat(p_partkey, ',', p_name, ', A (', 1950 + p_size, '),', p_type, '||')
        else concat(p_partkey, ',', p_name, ' (', 1950 + p_size, '),', p_type, '|', replace(p_name, ' ', '|')) end""").alias("value")
    )


_MOVIES = """lines AS (SELECT CASE p_partkey % 11 WHEN 0 THEN p_partkey || ',"' || p_name || ', The (' || (1950 + p_size) || ')",' || p_type || '|' || replace(p_name, ' ', '|') WHEN 1 THEN p_partkey || ',' || p_name || ',' || p_type
  WHEN 2 THEN 'movieId,' || p_name || ' (1999),' || p_type WHEN 3 THEN p_partkey || ' ' || p_name WHEN 4 THEN p_partkey || ',' || p_name || ', A (' || (1950 + p_size) || '),' || p_type || '||'
  ELSE p_partkey || ',' || p_name || ' (' || (1950 + p_size) || '),' || p_type || '|' || replace(p_name, ' ', '|') END AS value FROM part),
m AS (SELECT value, regexp_extract(value, '^([^,]*),', 1) AS head, regexp_matches(value, ',.*,') AS ok, regexp_extract(value, '^[^,]*,(.*),[^,]*$', 1) AS t, regexp_extract(value, ',([^,]*)$', 1) AS g FROM lines),
q AS (SELECT *, regexp_replace(t, '^"(.*)"$', '\\1') AS full_title FROM m),
movies AS (SELECT value, CASE WHEN regexp_full_match(head, '[+-]?[0-9]+') THEN CAST(head AS INTEGER) END AS id, rtrim(regexp_replace(full_title, '\\([0-9]{4}\\)$', '')) AS title,
  coalesce(TRY_CAST(nullif(regexp_extract(full_title, '\\(([0-9]{4})\\)$', 1), '') AS INTEGER), 0) AS year, rtrim(g, '|') AS g, CASE WHEN NOT ok THEN 'fields' WHEN NOT regexp_full_match(head, '[+-]?[0-9]+') THEN 'id' END AS reason FROM q)"""


@query(f"WITH {_MOVIES} SELECT id, title, year, g AS genres FROM movies WHERE reason IS NULL")
def movies_clean(spark: SparkSession, d: str) -> DataFrame:
    return ratings.movies(_movie_lines(spark, d)).filter("reason is null").select("id", "title", "year", F.array_join("genres", "|").alias("genres"))


@query(f"WITH {_MOVIES} SELECT value, reason FROM movies WHERE reason IS NOT NULL")
def movie_rejects(spark: SparkSession, d: str) -> DataFrame:
    return ratings.movies(_movie_lines(spark, d)).filter("reason is not null").select("value", "reason")


@query("SELECT label, count(*) AS n FROM (SELECT unnest(string_split(p_type || '||' || replace(p_name, ' ', '|') || '|', '|')) AS label FROM part) WHERE label <> '' GROUP BY 1")
def genre_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select(F.concat("p_type", F.lit("||"), F.replace("p_name", F.lit(" "), F.lit("|")), F.lit("|")).alias("genres"))
    return relational.distinct_labels(rows, "genres")


@query("""SELECT 'l_partkey' AS "column", count(l_partkey) AS n, round(avg(l_partkey), 6) AS mean, round(stddev_pop(l_partkey), 6) AS stdev, CAST(max(l_partkey) AS DOUBLE) AS largest, CAST(min(l_partkey) AS DOUBLE) AS least FROM lineitem
UNION ALL SELECT 'l_suppkey', count(l_suppkey), round(avg(l_suppkey), 6), round(stddev_pop(l_suppkey), 6), CAST(max(l_suppkey) AS DOUBLE), CAST(min(l_suppkey) AS DOUBLE) FROM lineitem""")
def id_statistics(spark: SparkSession, d: str) -> DataFrame:
    rows = relational.statistics(table(spark, d, "lineitem"), "l_partkey", "l_suppkey")
    return rows.withColumns({"mean": F.round("mean", 6), "stdev": F.round("stdev", 6)})


_PLAYS = """plays AS (SELECT l_suppkey AS "user", l_partkey AS item, CAST(l_quantity AS BIGINT) AS plays FROM lineitem),
alias AS (SELECT bad, max(good) AS good FROM (SELECT p_partkey AS bad, p_partkey // 7 AS good FROM part WHERE p_partkey % 5 = 0 UNION ALL SELECT p_partkey, p_partkey // 9 FROM part WHERE p_partkey % 5 = 0 AND p_size > 25) GROUP BY bad),
resolved AS (SELECT "user", coalesce(good, item) AS item, plays FROM plays LEFT JOIN alias ON item = bad)"""


def _plays(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    plays = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("user"), F.col("l_partkey").alias("item"), F.col("l_quantity").cast("bigint").alias("plays"))
    parts = table(spark, d, "part").filter("p_partkey % 5 = 0")
    lines = parts.select(F.expr("concat(p_partkey, '\t', p_partkey div 7)").alias("value")).unionByName(parts.filter("p_size > 25").select(F.expr("concat(p_partkey, '\t', p_partkey div 9)").alias("value")))
    lines = lines.unionByName(parts.select(F.expr("concat('\t', p_partkey)").alias("value")))  # entries without a first id
    return plays, ratings.aliases(lines)


@query(f"""WITH {_PLAYS} SELECT "user", item, plays FROM resolved""")
def play_counts(spark: SparkSession, d: str) -> DataFrame:
    return ratings.resolve(*_plays(spark, d))


@query(f"""WITH {_PLAYS} SELECT "user", item, CAST(sum(plays) AS BIGINT) AS plays FROM resolved GROUP BY 1, 2""")
def play_counts_added(spark: SparkSession, d: str) -> DataFrame:
    return ratings.resolve(*_plays(spark, d), aggregate=True)


@query("SELECT CAST(c_custkey AS INTEGER) AS id, CASE WHEN c_custkey % 6 = 0 THEN '' ELSE c_name || chr(9) || c_mktsegment END AS name FROM customer WHERE c_custkey % 7 <> 0")
def artists(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "customer").select(
        F.expr("case when c_custkey % 7 = 0 then concat(c_custkey, ' ', c_name) when c_custkey % 6 = 0 then concat(c_custkey, '\t ') else concat(c_custkey, '\t  ', c_name, '\t', c_mktsegment, ' ') end").alias("value")
    )
    return ratings.artists(lines)


@query(f"""WITH {RATINGS} SELECT CAST("user" AS INTEGER) AS "user", CAST(item AS INTEGER) AS item, rating, CAST(event_id % 10 AS INTEGER) AS digit FROM ratings WHERE event_id % 37 <> 0""")
def tuple_ratings(spark: SparkSession, d: str) -> DataFrame:
    """Ratings written as tuple text and read again; some lines are damaged and rejected."""
    rows = rating_rows(spark, d).withColumn("digit", F.col("event_id") % 10)
    lines = sinks.as_tuples(rows.filter("event_id % 37 <> 0"), "user", "item", "rating", "digit")
    damaged = sinks.as_tuples(rows.filter("event_id % 37 = 0"), "user", "rating", "item", "digit")
    good, _ = files.tuples(lines.unionByName(damaged), [("user", "int"), ("item", "int"), ("rating", "double"), ("digit", "int")])
    return good


@query("""SELECT o_custkey AS "user", string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY rank) AS items FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 5 GROUP BY 1""")
def top_id_lists(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select(F.col("o_custkey").alias("user"), F.col("o_orderkey").alias("item"), "o_totalprice")
    return recommend.id_lists(relational.top_n_per_group(rows, "user", "o_totalprice", 5, "item"))


# Orders


@query("""SELECT CASE WHEN l_orderkey % 50 = 0 THEN 'no json ' || l_orderkey WHEN l_orderkey % 50 = 1 THEN '{"id":' || l_partkey || '}' END AS value, 'json' AS reason FROM lineitem WHERE l_orderkey % 50 <= 1""")
def order_message_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Order messages as JSON; what cannot be read or lacks a field."""
    line = F.expr("""case when l_orderkey % 50 = 0 then concat('no json ', l_orderkey) when l_orderkey % 50 = 1 then concat('{"id":', l_partkey, '}')
        else to_json(named_struct('id', l_partkey, 'price', bigint(round(l_extendedprice * 100)))) end""")
    return files.json_rows(table(spark, d, "lineitem").select(line.alias("value")), orders.ORDER_SCHEMA, ["id", "price"])[1]


def _batches(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("batch_id"), F.col("l_partkey").alias("id"), cents("l_extendedprice").alias("price"))
    return orders.per_batch(rows, "batch_id")


_BATCHES = "b AS (SELECT CAST(l_shipdate AS DATE) AS batch_id, l_partkey AS id, count(*) AS n, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS total FROM lineitem GROUP BY 1, 2)"


@query(f"WITH {_BATCHES} SELECT id, CAST(sum(n) AS BIGINT) AS n, CAST(sum(total) AS BIGINT) AS total, max_by(total, batch_id) AS last FROM b GROUP BY 1")
def order_totals(spark: SparkSession, d: str) -> DataFrame:
    return orders.running(_batches(spark, d))


@query(f"WITH {_BATCHES} SELECT CAST(sum(n) AS BIGINT) AS n, CAST(sum(total) AS BIGINT) AS total FROM b")
def order_grand_total(spark: SparkSession, d: str) -> DataFrame:
    return orders.grand_total(_batches(spark, d))


# Recommender


@query(f"""WITH {RATINGS} SELECT "user", item, rating FROM (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY ts DESC, item) AS r FROM ratings) WHERE r <= 5""")
def latest_ratings(spark: SparkSession, d: str) -> DataFrame:
    return rerank.latest_ratings(rating_rows(spark, d))


_PAIR_RATINGS = f"""{RATINGS}, truth AS (SELECT "user", item, avg(rating) AS rating FROM ratings GROUP BY 1, 2)"""


@query(f"""WITH {_PAIR_RATINGS}, pred AS (SELECT "user", item, ("user" * 7 + item * 3) % 5 + 1.0 AS prediction FROM truth WHERE ("user" + item) % 6 <> 0)
SELECT count(*) AS n, round(sqrt(avg((rating - prediction) * (rating - prediction))), 9) AS rmse FROM truth JOIN pred USING ("user", item)""")
def rmse(spark: SparkSession, d: str) -> DataFrame:
    truth = rating_rows(spark, d).groupBy("user", "item").agg(F.avg("rating").alias("rating"))
    predicted = truth.filter("(user + item) % 6 <> 0").select("user", "item", F.expr("double((user * 7 + item * 3) % 5 + 1)").alias("prediction"))
    return ranking.rmse(truth, predicted, ["user", "item"]).withColumn("rmse", F.round("rmse", 9))


@query("""WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings), s AS (
  SELECT a.vec_id AS item, b.vec_id AS other, round(list_inner_product(a.x, b.x) / sqrt(list_inner_product(a.x, a.x)) / sqrt(list_inner_product(b.x, b.x)), 9) AS similarity
  FROM v a JOIN v b ON a.vec_id <> b.vec_id), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY similarity DESC, other) AS INTEGER) AS rank FROM s)
SELECT item, rank, other, round(similarity, 6) AS similarity FROM r WHERE rank <= 10""")
def similar_items(spark: SparkSession, d: str) -> DataFrame:
    return similar.nearest(table(spark, d, "embeddings")).withColumn("similarity", F.round("similarity", 6))


@query("""WITH x AS (SELECT source, n_chars, quality FROM documents JOIN labels USING (doc_id)), pairs AS (
  SELECT p.source AS source, avg(CASE WHEN p.n_chars > n.n_chars THEN 1.0 ELSE 0.0 END) AS auc FROM x p JOIN x n ON p.source = n.source AND p.quality = 1 AND n.quality = 0 GROUP BY 1)
SELECT count(*) AS users, round(avg(auc), 9) AS mean_auc FROM pairs""")
def mean_auc_of_length(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", "source", "n_chars").join(table(spark, d, "labels"), "doc_id")
    rows = rows.select(F.col("source").alias("user"), F.col("n_chars").alias("score"), "quality")
    return ranking.mean_auc(rows.filter("quality = 1"), rows.filter("quality = 0")).withColumn("mean_auc", F.round("mean_auc", 9))


_HELD = f"""{RATINGS}, train AS (SELECT * FROM ratings WHERE event_id % 10 <> 9), held AS (SELECT DISTINCT "user", item FROM ratings WHERE event_id % 10 = 9),
items AS (SELECT item, row_number() OVER (ORDER BY item) - 1 AS idx FROM (SELECT DISTINCT item FROM ratings)),
pos AS (SELECT "user", idx, row_number() OVER (PARTITION BY "user" ORDER BY idx) - 1 AS k, count(*) OVER (PARTITION BY "user") AS n FROM held JOIN items USING (item)),
draws AS (SELECT "user", k AS draw, CAST('0x' || substr(md5("user" || ':' || k || ':0'), 1, 8) AS BIGINT) % ((SELECT count(*) FROM items) - n) AS r FROM pos WHERE n < (SELECT count(*) FROM items)),
neg AS (SELECT d."user", d.draw, d.r + (SELECT count(*) FROM pos p WHERE p."user" = d."user" AND p.idx - p.k <= d.r) AS idx FROM draws d)"""


def _held_out(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    rows = rating_rows(spark, d)
    items = rows.select("item")
    held = rows.filter("event_id % 10 = 9").select("user", "item").distinct()
    return rows.filter("event_id % 10 <> 9"), held, items, ranking.sample_negatives(held, items)


@query(f"""WITH {_HELD} SELECT neg."user" AS "user", CAST(draw AS INTEGER) AS draw, items.item AS item FROM neg JOIN items USING (idx)""")
def negative_samples(spark: SparkSession, d: str) -> DataFrame:
    return _held_out(spark, d)[3]


@query(f"WITH {RATINGS} SELECT item, sum(rating) AS score FROM ratings WHERE event_id % 10 <> 9 GROUP BY 1")
def popularity(spark: SparkSession, d: str) -> DataFrame:
    return ranking.popularity(_held_out(spark, d)[0])


@query(f"""WITH {_HELD}, pop AS (SELECT item, sum(rating) AS score FROM train GROUP BY 1),
p AS (SELECT "user", coalesce(score, 0) AS score FROM held LEFT JOIN pop USING (item)), n AS (SELECT neg."user", coalesce(score, 0) AS score FROM neg JOIN items USING (idx) LEFT JOIN pop USING (item)),
a AS (SELECT p."user", avg(CASE WHEN p.score > n.score THEN 1.0 ELSE 0.0 END) AS auc FROM p JOIN n USING ("user") GROUP BY 1)
SELECT count(*) AS users, round(avg(auc), 9) AS mean_auc FROM a""")
def popularity_auc(spark: SparkSession, d: str) -> DataFrame:
    train, held, _, negatives = _held_out(spark, d)
    scores = ranking.popularity(train)
    return recommend.auc_of(held, negatives, lambda pairs: ranking.predict_popularity(pairs, scores)).withColumn("mean_auc", F.round("mean_auc", 9))


_SIMILAR = """sims AS (SELECT DISTINCT a.i AS item1, (a.i * 5 + b.k * 11 + 1) % 100 AS item2, 0.3 + ((a.i * 7 + b.k * 13) % 70) / 100.0 AS similarity
  FROM (SELECT DISTINCT item AS i FROM ratings) a, (SELECT unnest(range(6)) AS k) b WHERE (a.i * 5 + b.k * 11 + 1) % 100 <> a.i)"""


def _similar(spark: SparkSession, d: str) -> DataFrame:
    items = rating_rows(spark, d).select("item").distinct()
    rows = items.select("item", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("k"))
    rows = rows.selectExpr("item as item1", "(item * 5 + k * 11 + 1) % 100 as item2", "0.3D + ((item * 7 + k * 13) % 70) / 100.0D as similarity")
    return rows.filter("item1 <> item2").distinct()


@query(f"""WITH {RATINGS}, {_SIMILAR}, asked AS (SELECT event_id, "user", item AS src FROM ratings),
recent AS (SELECT "user", item AS recent, rating FROM (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY ts DESC, item) AS r FROM ratings) WHERE r <= 5),
cand AS (SELECT event_id, "user", item2 AS item FROM asked JOIN sims ON src = item1 UNION ALL SELECT event_id, "user", src FROM asked WHERE src IN (SELECT item1 FROM sims)),
pairs AS (SELECT event_id, c."user", c.item, rating, CASE WHEN c.item = recent THEN 1.0 ELSE coalesce((SELECT max(similarity) FROM sims s WHERE s.item1 = c.item AND s.item2 = recent), 0.6) END AS s FROM cand c JOIN recent r ON c."user" = r."user"),
kept AS (SELECT * FROM pairs WHERE CAST(s AS DOUBLE) > 0.5),
g AS (SELECT event_id, "user", item, sum(CAST(s AS DOUBLE) * rating) AS total, count(*) AS n, count(*) FILTER (WHERE rating >= 3) AS up, count(*) FILTER (WHERE rating < 3) AS down FROM kept GROUP BY 1, 2, 3)
SELECT event_id, "user", item, round(total / sum(n) OVER (PARTITION BY event_id) + log2(greatest(up, 1)) - log2(greatest(down, 1)), 9) AS score FROM g""")
def rerank_candidates(spark: SparkSession, d: str) -> DataFrame:
    rows = rating_rows(spark, d)
    return rerank.rerank(rows.select("event_id", "user", "item"), rows, _similar(spark, d)).withColumn("score", F.round("score", 9))


def _als_input(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows, _ = recommend.int_ids(rating_rows(spark, d), "user", "item")
    rows = rows.withColumn("digit", F.unix_timestamp("ts") % 10)
    return tuple(rows.filter(c).select("user", "item", "rating") for c in ("digit <= 5", "digit between 6 and 7", "digit >= 8"))


def _all_ratings(spark: SparkSession, d: str) -> DataFrame:
    return recommend.int_ids(rating_rows(spark, d), "user", "item")[0].select("user", "item", "rating")


@query()
def als_grid_by_rmse(spark: SparkSession, d: str) -> DataFrame:
    """Each setting of a small grid with its validation RMSE, and the test RMSE of the best."""
    train, validation, test = _als_input(spark, d)
    best, log = recommend.tune_by_rmse(train, validation, (3, 5), (0.1, 0.3), (5,))
    tested = ranking.rmse(test, recommend.predict(best, test.select("user", "item")), ["user", "item"])
    grid = spark.createDataFrame(log, "rank int, reg double, iterations int, validation_rmse double")
    return grid.join(F.broadcast(tested.select(F.col("rmse").alias("test_rmse"))))


@query()
def als_recommend_all(spark: SparkSession, d: str) -> DataFrame:
    """The ten best items of every user, by a model of all ratings."""
    return recommend.recommend_all(recommend.explicit(_all_ratings(spark, d)), 10)


@query()
def implicit_grid_by_auc(spark: SparkSession, d: str) -> DataFrame:
    train, _, test = _als_input(spark, d)
    train = train.groupBy("user", "item").agg(F.sum("rating").alias("rating"))
    log = recommend.tune_by_auc(train, test.select("user", "item").distinct(), train.select("item"), (5, 10), (1.0, 0.0001), (1.0,), iterations=4)
    return spark.createDataFrame(log, "rank int, reg double, alpha double, mean_auc double")


@query()
def implicit_recommend_named(spark: SparkSession, d: str) -> DataFrame:
    """The five best items of every user with their names, by an implicit model of all ratings."""
    train = _all_ratings(spark, d).groupBy("user", "item").agg(F.sum("rating").alias("rating"))
    found = recommend.recommend_all(recommend.implicit(train), 5)
    names = table(spark, d, "part").select(F.col("p_partkey").cast("int").alias("id"), F.col("p_name").alias("name"))
    return recommend.with_names(found, names).join(recommend.id_lists(found), "user")


from . import places, stored  # noqa: E402, F401  (they register their queries)
