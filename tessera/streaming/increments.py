"""Running totals and last values that stay right when a batch is retried, and that are read by key.

Each micro-batch writes its increments to a folder of its own, named by the query and the batch, and overwrites it when it is retried. The query is the
id that Spark keeps in the checkpoint; queries are numbered in the order of their first write, so a fresh checkpoint, whose batch numbers start at 0
again, adds folders and overwrites none, and its values count as later ones. A reader adds all folders up; the last value of a key is that of the latest
batch that has it (query number, then batch).

Rows lie in buckets of a hash of the key. A read of given keys opens the folders of their buckets only.

Compaction folds the batches up to some batch of each query into a new folder: sums, and for each key the last values with their version, so that nothing
is lost to it. It ends with a commit, a numbered file that only the first writer can create: folder and last batch covered of each query. A compactor that comes second begins
again from the commit that won. A reader takes the newest commit, its folder, and of the batches those that it does not cover, so nothing counts
twice while or after compaction runs. ``remove_covered`` deletes what the last few commits do not need.

Defined cases: null keys are keys; a batch without rows leaves none; a key that was never written is missing in ``totals`` and 0 in ``lookup``; a batch that is retried after it
was compacted, or after its folder was removed, stays covered. A retry replaces its folder in two steps, so a read at that moment may miss the batch.
All paths are parameters and may be any URI that Spark writes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import age_seconds, create_if_absent, names, read_file, remove

BUCKETS = 32
#: Bits of a batch number in a version; the query's number has the others.
BATCH_BITS = 40


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the streaming query that owns a checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first().value)["id"]


class Increments:
    """A table of increments: key columns, value columns that are added up, query and batch."""

    def __init__(self, spark: SparkSession, path: str, keys: dict[str, str], values: dict[str, str], buckets: int = BUCKETS):
        self.spark, self.path, self.keys, self.values = spark, path.rstrip("/"), keys, values
        self.schema = ", ".join(f"`{n}` {k}" for n, k in (keys | values).items())
        self._asked, self._buckets, self._numbers = buckets, None, {}

    @property
    def buckets(self) -> int:
        """The number the table was made with; the first writer's holds."""
        if self._buckets is None:
            create_if_absent(self.spark, f"{self.path}/table/0", json.dumps({"buckets": self._asked}))
            self._buckets = json.loads(read_file(self.spark, f"{self.path}/table/0"))["buckets"]
        return self._buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*(F.col(n).cast(k) for n, k in self.keys.items())), F.lit(self.buckets)).cast("int").alias("bucket")

    # Writing

    def version(self, query: str, batch: int) -> int:
        """A number that rises with the query's first write, then with the batch."""
        while query not in self._numbers:
            found = names(self.spark, f"{self.path}/queries")
            self._numbers = {read_file(self.spark, f"{self.path}/queries/{n}"): int(n) for n in found}  # one small file for each fresh checkpoint
            if query not in self._numbers:
                create_if_absent(self.spark, f"{self.path}/queries/{len(found):08}", query)
        return self._numbers[query] << BATCH_BITS | batch

    def write(self, rows: DataFrame, query: str, batch: int) -> None:
        """Store the increments of one batch; writing it again replaces it."""
        own = rows.select(*(F.col(n).cast(k) for n, k in (self.keys | self.values).items()), F.lit(self.version(query, batch)).alias("version"), self._bucket())
        own.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/increments/query_id={query}/batch_id={batch}")

    def sink(self, checkpoint: str, totals: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
        """Function for foreachBatch: the totals of each batch go to the table."""
        return lambda rows, batch: self.write(totals(rows), query_id(self.spark, checkpoint), batch)

    # Reading

    def _read(self, folder: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{folder}")
        except Exception as e:  # nothing written yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], schema)

    def commit(self, at: int | None = None) -> tuple[int, str | None, dict[str, int]]:
        """(number, folder, last batch covered of each query) of the newest commit or the given one; number 0 is the empty one."""
        found = names(self.spark, f"{self.path}/commits")
        if at is None:
            at = int(found[-1]) if found else 0
        if not at:
            return 0, None, {}
        entry = json.loads(read_file(self.spark, f"{self.path}/commits/{at:012}"))
        return at, entry["folder"], entry["covered"]

    def _live(self, covered: dict[str, int]) -> DataFrame:
        rows = self._read("increments", f"{self.schema}, version bigint, query_id string, batch_id bigint, bucket int")
        for query, batch in covered.items():  # of folder names, so covered folders are not opened
            rows = rows.filter((F.col("query_id") != query) | (F.col("batch_id") > batch))
        return rows

    def batches(self) -> DataFrame:
        """Keys, values, query_id and batch_id of all batches that no compaction covers."""
        return self._live(self.commit()[2]).drop("version", "bucket")

    def _state(self, folder: str | None, live: DataFrame, keys: DataFrame | None = None) -> DataFrame:
        """Keys, sums, ``last`` (struct of the last values), ``version``, ``bucket``."""
        state = live.select(*self.keys, *self.values, F.struct(*self.values).alias("last"), "version", "bucket")
        if folder:
            last = ", ".join(f"`{n}`: {k}" for n, k in self.values.items())
            state = state.unionByName(self._read(folder, f"{self.schema}, last struct<{last}>, version bigint, bucket int"))
        if keys is not None:
            found = [r.bucket for r in keys.select(self._bucket()).distinct().collect()]  # at most the number of buckets
            state = state.filter(F.col("bucket").isin(found)).join(keys.select(*(F.col(n).cast(k).alias(f"{n}__") for n, k in self.keys.items())).distinct(), [F.col(n).eqNullSafe(F.col(f"{n}__")) for n in self.keys], "left_semi")
        sums = (F.sum(v).cast(k).alias(v) for v, k in self.values.items())
        return state.groupBy(*self.keys, "bucket").agg(*sums, F.max_by("last", "version").alias("last"), F.max("version").alias("version"))

    def state(self, keys: DataFrame | None = None) -> DataFrame:
        """Keys, sums, last (struct), version and bucket; of the given keys only, if given."""
        _, folder, covered = self.commit()
        return self._state(folder, self._live(covered), keys)

    def totals(self, keys: DataFrame | None = None) -> DataFrame:
        """Keys and the sums of the values."""
        return self.state(keys).select(*self.keys, *self.values)

    def last(self, value: str, keys: DataFrame | None = None) -> DataFrame:
        """Keys and the value of the latest batch that has the key."""
        return self.state(keys).select(*self.keys, F.col("last")[value].alias(value))

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The given keys, each row once, with the sums of the values; 0 for keys that were never written."""
        found = self.totals(keys)
        for n in self.keys:
            found = found.withColumnRenamed(n, f"{n}__")
        asked = keys.select(*(F.col(n).cast(k) for n, k in self.keys.items()))
        joined = asked.join(found, [F.col(n).eqNullSafe(F.col(f"{n}__")) for n in self.keys], "left")
        return joined.select(*self.keys, *(F.coalesce(F.col(v), F.lit(0).cast(k)).alias(v) for v, k in self.values.items()))

    # Compaction

    def compaction(self, upto: dict[str, int]) -> Compaction:
        return Compaction(self, upto)

    def compact(self, upto: dict[str, int]) -> None:
        """Fold the batches up to the given one of each query (which must be complete) into one folder, whoever else compacts."""
        while True:
            step = self.compaction(upto)
            if not step.needed():
                return
            step.write()
            if step.commit():
                return

    def remove_covered(self, keep: int = 2, unfinished: float = 86_400) -> None:
        """Delete batches that the last ``keep`` commits all cover, folders of older commits, and folders without a commit that are older than ``unfinished`` seconds.

        Readers that began under one of the kept commits are not disturbed.
        """
        newest = self.commit()[0]
        oldest = max(newest - keep + 1, 0)
        kept = {self.commit(n)[1] for n in range(max(oldest, 1), newest + 1)}
        committed = {self.commit(int(n))[1] for n in names(self.spark, f"{self.path}/commits")}
        for name in names(self.spark, f"{self.path}/compacted"):
            folder = f"compacted/{name}"
            if folder not in kept and (folder in committed or age_seconds(self.spark, f"{self.path}/{folder}") > unfinished):
                remove(self.spark, f"{self.path}/{folder}")
        for query, upto in self.commit(oldest)[2].items():
            for name in names(self.spark, f"{self.path}/increments/query_id={query}"):
                if int(name.removeprefix("batch_id=")) <= upto:
                    remove(self.spark, f"{self.path}/increments/query_id={query}/{name}")


class Compaction:
    """One try: it reads a commit, writes a folder of its own, and commits unless another compactor has since."""

    def __init__(self, table: Increments, upto: dict[str, int]):
        self.table, self.folder = table, f"compacted/{uuid.uuid4().hex}"
        self.base, self.before, self.covered = table.commit()
        self.upto = self.covered | {q: max(b, self.covered.get(q, -1)) for q, b in upto.items()}

    def needed(self) -> bool:
        return self.upto != self.covered

    def write(self) -> None:
        within = F.lit(False)
        for query, batch in self.upto.items():
            within = within | ((F.col("query_id") == query) & (F.col("batch_id") <= batch))
        state = self.table._state(self.before, self.table._live(self.covered).filter(within))
        state.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.table.path}/{self.folder}")

    def commit(self) -> bool:
        done = create_if_absent(self.table.spark, f"{self.table.path}/commits/{self.base + 1:012}", json.dumps({"folder": self.folder, "covered": self.upto}))
        if not done:
            remove(self.table.spark, f"{self.table.path}/{self.folder}")
        return done
