"""Queries over stored increments: written in batches, compacted in between, read by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clicks
from ..sources.shared import scratch_path
from ..streaming.increments import Increments
from .inputs import CLICK_LINES, click_lines, table
from .registry import query


@query("""WITH b AS (SELECT l_partkey, year(l_shipdate) AS y, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem GROUP BY 1, 2)
SELECT l_partkey, CAST(sum(n) AS BIGINT) AS n, CAST(sum(quantity) AS BIGINT) AS quantity, max_by(quantity, y) AS last_quantity, max_by(n, y) AS last_n FROM b GROUP BY 1""")
def stored_part_totals(spark: SparkSession, d: str) -> DataFrame:
    """Shipments of each part: a batch for each year of the ship day, compacted twice on the way; totals, and the values of the part's last year."""
    rows = table(spark, d, "lineitem").groupBy("l_partkey", F.year("l_shipdate").alias("y")).agg(F.count("*").alias("n"), F.sum("l_quantity").cast("bigint").alias("quantity")).persist()
    store = Increments(spark, scratch_path(spark, "part-totals"), {"l_partkey": "bigint"}, {"n": "bigint", "quantity": "bigint"}, buckets=8)
    years = [r.y for r in rows.select("y").distinct().orderBy("y").collect()]  # the batches
    for batch, year in enumerate(years):
        store.write(rows.filter(F.col("y") == year), "years", batch)
        if batch % 3 == 2:
            store.compact({"years": batch - 1})
    rows.unpersist()
    return store.state().select("l_partkey", "n", "quantity", F.col("last.quantity").alias("last_quantity"), F.col("last.n").alias("last_n"))


@query(f"""WITH {CLICK_LINES}, counts AS (
  SELECT strftime(time, '%Y%m%d') || '_' || course_id AS day_course, count(*) AS clicks FROM judged WHERE reason IS NULL AND course_id <> 0 GROUP BY 1),
keys AS (SELECT DISTINCT strftime(ts, '%Y%m%d') || '_' || (event_id % 13) AS day_course FROM events)
SELECT day_course, coalesce(clicks, 0) AS clicks FROM keys LEFT JOIN counts USING (day_course)""")
def stored_click_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Clicks of given days and courses, read by key from counters that three batches have written and one compaction has folded."""
    lines = clicks.clean(click_lines(spark, d)).persist()
    store = Increments(spark, scratch_path(spark, "clicks"), {"day_course": "string"}, {"clicks": "bigint"}, buckets=8)
    for batch in range(3):
        store.write(clicks.per_day(lines.filter(F.pmod(F.xxhash64("ip"), F.lit(3)) == batch)), "lines", batch)
    store.compact({"lines": 1})
    lines.unpersist()
    keys = table(spark, d, "events").select(F.concat_ws("_", F.date_format("ts", "yyyyMMdd"), (F.col("event_id") % 13).cast("string")).alias("day_course")).distinct()
    return store.lookup(keys)
