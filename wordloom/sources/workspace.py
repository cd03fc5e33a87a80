"""The shared folder in which intermediate tables and stream state live."""

import tempfile
import uuid
from collections import Counter

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only where driver and executors are one process."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if context.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    return context.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/wordloom/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str, rows_a_file: int | None = None) -> DataFrame:
    """Write ``df`` to ``path``, replacing what is there, and read it back; a file has at most ``rows_a_file`` rows, if given."""
    writer = df.write.mode("overwrite")
    (writer if rows_a_file is None else writer.option("maxRecordsPerFile", rows_a_file)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where a result is needed more than once or must not be recomputed differently. Unlike a cache it
    outlives lost executors, and later plans see its real size.
    """
    return written(df, new_path(df.sparkSession, name))


def files_for(rows: int, rows_a_file: int = 500_000, fewest: int = 8) -> int:
    """How many files, and so tasks, a table of short rows is worth: more as it grows, few while it is small."""
    return max(fewest, -(-rows // rows_a_file))


class RoundTables:
    """Like :func:`staged`, for loops in which each result depends on the one before.

    The results of one name go to two folders in turn, so that a loop of any length keeps two of them; :meth:`finish`
    deletes those that nothing reads any more. Each is written to at most ``files`` files, if that is given. With
    ``rows_a_file`` they hold at most so many rows: repetitive rows take so few bytes that one task would read many
    millions of them, and the others few.
    """

    def __init__(self, spark: SparkSession, files: int | None = None, rows_a_file: int | None = None):
        self._spark, self._base, self._turns, self._files = spark, new_path(spark, "rounds"), Counter(), files
        self._rows_a_file = rows_a_file

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        self._turns[name] += 1
        return written(df if self._files is None else df.coalesce(self._files), self._path(name, self._turns[name]), self._rows_a_file)

    def _path(self, name: str, turn: int) -> str:
        return f"{self._base}/{name}-{turn % 2}"

    def finish(self, *kept: str) -> None:
        """Delete all tables but the last of each name in ``kept``. Missing ones are no error."""
        path = self._spark._jvm.org.apache.hadoop.fs.Path
        files = path(self._base).getFileSystem(self._spark._jsparkSession.sessionState().newHadoopConf())
        last = {self._path(name, self._turns[name]) for name in kept}
        for name, turns in self._turns.items():
            for folder in {self._path(name, t) for t in (turns, turns - 1)} - last:
                files.delete(path(folder), True)


def spread(df: DataFrame) -> DataFrame:
    """Give a table with fewer input splits than cores to all cores before CPU-heavy text work.

    Large tables already have more splits than cores and pass through without a shuffle. Meant for scans: the
    number of partitions of a plan with shuffles is only known by running them.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
