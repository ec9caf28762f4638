"""Files that all tasks and all drivers see: a shared scratch folder, and small files that the first writer owns."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, what: str) -> str:
    """A new path in spark.checkpoint.dir, or the folder set for checkpoints; a local session without either takes its warehouse."""
    own = spark.conf.get("spark.checkpoint.dir", None)
    if not own:
        chosen = spark.sparkContext._jsc.sc().getCheckpointDir()
        if chosen.isDefined():
            own = chosen.get()
        elif spark.sparkContext.master.startswith("local"):
            own = spark.conf.get("spark.sql.warehouse.dir") + "/shared"
        else:
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{own.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def _place(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole, unless it is there: of several writers one gets True. (A rename that does not overwrite, which file systems such as HDFS do in one step.)"""
    jvm = spark._jvm
    target, fs = _place(spark, path)
    folder = target.getParent()
    fs.mkdirs(folder)
    temporary = jvm.org.apache.hadoop.fs.Path(folder, f".{target.getName()}.{uuid.uuid4().hex}")
    out = fs.create(temporary, False)
    out.write(bytearray(text.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(folder).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(temporary), fs.makeQualified(target), plain)
        return True
    except Exception as e:
        fs.delete(temporary, False)
        if "FileAlreadyExistsException" not in str(e):
            raise
        return False


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; hidden ones and those of a missing folder left out."""
    where, fs = _place(spark, folder)
    if not fs.exists(where):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(where)]
    return sorted(n for n in found if n[0] not in "._")


def age_seconds(spark: SparkSession, path: str) -> float:
    where, fs = _place(spark, path)
    return spark._jvm.java.lang.System.currentTimeMillis() / 1000 - fs.getFileStatus(where).getModificationTime() / 1000


def read_file(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first().value


def remove(spark: SparkSession, path: str) -> None:
    where, fs = _place(spark, path)
    fs.delete(where, True)
