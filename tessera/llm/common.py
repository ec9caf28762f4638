"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of a text: what lies between ASCII white space (space, tab to carriage return).
WORD_SPLIT = "[\\x20\\x09-\\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Bound the Arrow batches handed to Python, as a text may be of any length; a smaller setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or the one set for checkpoints already.

    Without either, a local session (as in tests) takes a folder under the warehouse; a cluster is refused.
    """
    own = spark.conf.get("spark.checkpoint.dir", None)
    if not own:
        chosen = spark.sparkContext._jsc.sc().getCheckpointDir()
        if not chosen.isDefined() and not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        own = chosen.get() if chosen.isDefined() else spark.conf.get("spark.sql.warehouse.dir") + "/shared"
    return own.rstrip("/")


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage by a reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def settled(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """A checkpoint read in as few partitions as its rows ask for, so that later steps over small tables deal out little."""
    done = checkpoint(df)
    return done.coalesce(max(1, -(-done.count() // rows)))


def scratch_path(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def is_blank(text):
    """True for null and for text without any word."""
    return text.isNull() | ~text.rlike("[^\\x20\\x09-\\x0D]")


def words(text):
    """Column of words; null text gives an empty array, leading and trailing white space no empty word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_SPLIT), lambda w: w != "")
