"""CSV interchange, id ranges and keyed count tables."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.sources.runs import RunLog

# One option set for both directions; quotes, line breaks and outer spaces inside values survive.
CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "lineSep": "\n",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_csv(df: DataFrame, path: str, bytes_per_file: int = 64 << 20) -> None:
    """Quoted CSV with header. A file with line breaks in values has one reader, so files are kept small.

    The rows a file may have follow from the mean size of a row, which takes a pass over the table.
    """
    size = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 3 for c in df.columns), F.lit(0))
    mean = df.agg(F.coalesce(F.avg(size), F.lit(1.0))).first()[0]
    (
        df.write.mode("overwrite").options(**CSV_OPTIONS)
        .option("quoteAll", True).option("maxRecordsPerFile", max(1, int(bytes_per_file / max(mean, 1.0)))).csv(path)
    )


def write_plain_csv(df: DataFrame, path: str) -> None:
    """CSV with header that quotes only where needed."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Header CSV with a given schema; an empty cell is null."""
    return spark.read.options(**CSV_OPTIONS).option("multiLine", True).schema(schema).csv(path)


def rows(spark: SparkSession, values: list, schema: T.StructType | str) -> DataFrame:
    """A small driver-side list as a DataFrame; the schema is given, so the list may be empty."""
    return spark.createDataFrame(values, schema)


def id_range(spark: SparkSession, start: int, end: int, name: str = "page_id") -> DataFrame:
    """Ids from ``start`` up to, not including, ``end``."""
    return spark.range(start, end).withColumnRenamed("id", name)


def in_id_range(stored: DataFrame, start: int, end: int, name: str = "page_id") -> DataFrame:
    """The stored rows with an id in the range; the bounds reach the scan, which passes over row groups without such ids."""
    return stored.where((F.col(name) >= start) & (F.col(name) < end))


def id_coverage(stored: DataFrame, start: int, end: int, name: str = "page_id") -> DataFrame:
    """``(id, in_range, is_stored)`` of every id that is asked for or stored.

    The cost follows the length of the range and the stored rows, not how far apart stored ids are. Repeated ids repeat;
    rows without an id are left out.
    """
    asked = id_range(stored.sparkSession, start, end, name).withColumn("in_range", F.lit(True))
    known = stored.where(F.col(name).isNotNull()).select(name, F.lit(True).alias("is_stored"))
    return asked.join(known, name, "full").select(
        name, *[F.coalesce(c, F.lit(False)).alias(c) for c in ("in_range", "is_stored")])


def stored_or_none(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame | None:
    """The table at ``path``, or None if nothing is stored there yet."""
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _log(spark: SparkSession, path: str, key: str, count: str) -> RunLog:
    return RunLog(spark, path, f"`{key}` string, `{count}` bigint")


def write_counts(df: DataFrame, path: str, run_id: int | str) -> None:
    """Store one run's counts ``(key, count)`` under its id. Writing the same run again replaces it, so a rerun adds nothing.

    Runs are merged as they come (:class:`RunLog`), so reading does not grow with their number.
    """
    _log(df.sparkSession, path, *df.columns).write(df, run_id)


def read_counts(spark: SparkSession, path: str, key: str = "word", count: str = "frequency") -> DataFrame:
    """Counts added up over all stored runs; nothing stored yet gives no rows."""
    return _log(spark, path, key, count).read()


def fold_counts(spark: SparkSession, path: str, key: str = "word", count: str = "frequency") -> None:
    """Merge all stored runs, whatever their ids are, into one table. Merging again changes nothing."""
    _log(spark, path, key, count).compact(everything=True)
