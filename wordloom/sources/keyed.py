"""Stored tables of one row a key that take changes: hash buckets, of which only the touched ones are written again."""

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.sources import manifest
from wordloom.sources.workspace import staged

_BUCKET = "_bucket"
_PUSHED_KEYS = 1000


@dataclass(frozen=True)
class KeyedTable:
    """A table at ``path``, dealt to buckets by the hash of its column ``key`` and sorted by it within them.

    ``buckets`` counts when the table is first written; later it has those it was made with. ``keep_seconds`` is how long
    files of older versions stay for readers that began before a change.
    """

    path: str
    schema: T.StructType
    key: str
    buckets: int = 64
    keep_seconds: float = 86_400.0
    row_group_bytes: int = 8 << 20

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int")

    def _read(self, spark: SparkSession, said: dict, wanted: set[int] | None = None) -> DataFrame:
        files = [f"{self.path}/data/{run}/{_BUCKET}={bucket}" for bucket, run in said.get("files", {}).items()
                 if wanted is None or int(bucket) in wanted]
        return spark.read.schema(self.schema).parquet(*files) if files else spark.createDataFrame([], self.schema)

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows; none if nothing was stored."""
        return self._read(spark, manifest.latest(spark, self.path))

    def rows_of(self, keys: DataFrame) -> DataFrame:
        """A part of the table that has all rows of the given keys (column ``key``), and few others.

        Only the buckets of the keys are read. Of few keys the values go into the scan's filter, which passes over row
        groups by their statistics and Bloom filters; the table is sorted by key, so a key is in one or two of a bucket. What
        reaches the driver is at most one number a bucket, or ``_PUSHED_KEYS`` values.
        """
        spark, said = keys.sparkSession, manifest.latest(keys.sparkSession, self.path)
        if not said.get("files"):
            return self._read(spark, said)
        own = keys.select(self.key).where(F.col(self.key).isNotNull())
        few = [row[0] for row in own.distinct().limit(_PUSHED_KEYS + 1).collect()]
        if len(few) > _PUSHED_KEYS:
            found = own.select(self._bucket(said["buckets"]).alias(_BUCKET)).distinct().collect()
            return self._read(spark, said, {row[0] for row in found})
        listed = spark.createDataFrame([(value,) for value in few], T.StructType([self.schema[self.key]]))
        buckets = {row[0] for row in listed.select(self._bucket(said["buckets"])).collect()}
        rows = self._read(spark, said, buckets)
        # Sorted runs of the keys as ranges: Spark pushes long lists as one range from the first to the last value only.
        few.sort()
        step = max(1, -(-len(few) // 100))
        ranges = F.lit(False)
        for part in (few[i:i + step] for i in range(0, len(few), step)):
            ranges = ranges | (F.col(self.key) == part[0] if len(part) == 1 else F.col(self.key).between(part[0], part[-1]))
        return rows.where(ranges)

    def upsert(self, changes: DataFrame, merge: Callable[[DataFrame], DataFrame], run_id: str | None = None) -> int:
        """Merge ``changes``, rows of the table's schema, into the stored rows of the same buckets.

        ``merge`` makes one row a key of old and new rows together. Buckets that no change touches keep their files; the
        new version counts once its manifest is there, and a change that breaks off before leaves the old one. The
        names of runs are kept: see :meth:`run_number`. Returns the version.
        """
        spark = changes.sparkSession
        said = manifest.latest(spark, self.path)
        buckets = said.setdefault("buckets", self.buckets)
        changes = staged(changes.select(*self.schema.names).withColumn(_BUCKET, self._bucket(buckets)), "changes")
        touched = {row[0] for row in changes.select(_BUCKET).distinct().collect()}
        old = self._read(spark, said, touched)
        self._write(merge(old.unionByName(changes.drop(_BUCKET))), said, touched)
        if run_id is not None:
            said.setdefault("runs", {}).setdefault(run_id, len(said["runs"]))
        return self._switch(spark, said)

    def rebucket(self, spark: SparkSession, buckets: int) -> int:
        """Write the whole table again in another number of buckets, as it should have when it has grown."""
        said = manifest.latest(spark, self.path)
        rows = self._read(spark, said)
        said["buckets"] = buckets
        self._write(rows, said, set(map(int, said.get("files", {}))) | set(range(buckets)))
        return self._switch(spark, said)

    def run_number(self, spark: SparkSession, run_id: str) -> int:
        """The place of a run in the order of runs: that of its first change, or the next one. A rerun keeps its place."""
        runs = manifest.latest(spark, self.path).get("runs", {})
        return runs.get(run_id, len(runs))

    def _write(self, rows: DataFrame, said: dict, touched: set[int]) -> None:
        run = uuid.uuid4().hex
        folder = f"{self.path}/data/{run}"
        dealt = rows.withColumn(_BUCKET, self._bucket(said["buckets"])).repartition(_BUCKET)
        (
            dealt.sortWithinPartitions(_BUCKET, self.key).write.partitionBy(_BUCKET)
            .option(f"parquet.bloom.filter.enabled#{self.key}", "true").option("parquet.block.size", self.row_group_bytes)
            .parquet(folder)
        )
        stored = rows.sparkSession.read.schema(f"{_BUCKET} int").parquet(folder).select(_BUCKET).distinct().collect()
        files = said.setdefault("files", {})
        gone = [f"{self.path}/data/{files.pop(str(b))}/{_BUCKET}={b}" for b in touched if str(b) in files]
        files.update({str(row[0]): run for row in stored})
        said["_gone"] = gone

    def _switch(self, spark: SparkSession, said: dict) -> int:
        outdated = manifest.retire(said, said.pop("_gone"), self.keep_seconds)
        version = manifest.commit(spark, self.path, said)["version"]
        manifest.delete(spark, outdated)
        return version
