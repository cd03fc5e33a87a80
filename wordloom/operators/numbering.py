"""Dense numbering and bounded grouping without a one-task window."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.sources.workspace import staged

_ROW_BITS = 33  # fixed value: monotonically_increasing_id keeps the row index in its low 33 bits


def ordered_ids(df: DataFrame, *order_by, name: str = "id") -> DataFrame:
    """Unique ids that follow the order given by ``order_by``, a unique key, but have gaps.

    The rows are range-partitioned and sorted by Spark and written once, so that the ids cannot shift when a task is
    repeated.
    """
    return staged(df.sort(*order_by).withColumn(name, F.monotonically_increasing_id()), "ordered")


def number_rows(df: DataFrame, *order_by, name: str = "row_number") -> DataFrame:
    """Consecutive numbers from 1 in the order given by ``order_by``, which must be a unique key.

    Each sort partition's offset is added to the row's place in it. The table of offsets has one row per sort
    partition; that bound is what makes the window over it and its broadcast safe.
    """
    ordered = ordered_ids(df, *order_by, name="_id")
    part = F.shiftright("_id", _ROW_BITS)
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    index = F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        ordered.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(*df.columns, (F.col("_offset") + index + 1).alias(name))
    )


def batches(words: DataFrame, size: int = 80, first: int = 0) -> DataFrame:
    """``(batch_id, word)``: every word in exactly one batch of at most ``size`` words, in word order, from ``first`` on."""
    numbered = number_rows(words.select("word"), "word", name="_n")
    return numbered.select((F.floor((F.col("_n") - 1) / size) + first).alias("batch_id"), "word")


def more_batches(words: DataFrame, stored: DataFrame | None, size: int = 80) -> DataFrame:
    """``(batch_id, word)`` of the words that are in no stored batch, numbered on from the last stored one.

    Stored batches stay as they are, so a vocabulary that grows by one word gets one new batch.
    """
    if stored is None:
        return batches(words, size)
    last = stored.agg(F.max("batch_id")).first()[0]
    return batches(words.select("word").join(stored.select("word"), "word", "left_anti"), size, 0 if last is None else last + 1)


def collect_in_parts(df: DataFrame, keys: list[str], value: str, part_size: int = 1000,
                     broadcast_keys: int = 100_000) -> DataFrame:
    """``(*keys, part, values)``: the distinct, sorted values of each key in lists of at most ``part_size``.

    Nearly every key fits one list and takes one aggregation. Keys with more values are found first by counting;
    only their rows are numbered over a range-partitioned sort and cut into parts, so no task and no row ever
    holds more than ``part_size`` values of a key. Up to ``broadcast_keys`` such keys are broadcast. Beyond that both
    sides are shuffled; the repartition keeps the grouping from relying on the join's partitions, which is what lets
    Spark split the partition of a hot key.
    """
    rows = df.select(*keys, value)
    listed = F.sort_array(F.collect_set(value)).alias("values")
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    large = staged(counts.where(F.col("_n") > part_size).select(*keys), "large-keys")
    first_part = F.lit(0).cast("bigint").alias("part")
    large_count = large.count()
    if large_count == 0:
        return rows.groupBy(*keys).agg(listed).select(*keys, first_part, "values")
    if large_count <= broadcast_keys:
        sized, small = F.broadcast, rows.join(F.broadcast(large), keys, "left_anti")
    else:
        sized, small = lambda table: table, rows.join(large, keys, "left_anti").repartition(*keys, value)
    small_lists = small.groupBy(*keys).agg(listed).select(*keys, first_part, "values")
    numbered = number_rows(rows.join(sized(large), keys, "left_semi").distinct(), *keys, value, name="_n")
    first = staged(numbered.groupBy(*keys).agg(F.min("_n").alias("_first")), "first-numbers")
    part = F.floor((F.col("_n") - F.col("_first")) / part_size).alias("part")
    parts = numbered.join(sized(first), keys).select(*keys, part, value)
    return small_lists.unionByName(parts.repartition(*keys, "part").groupBy(*keys, "part").agg(listed))
