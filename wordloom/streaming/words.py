"""Word streams. The same DataFrame functions serve batch and stream."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wordloom.functions.text import ASCII, Profile
from wordloom.operators.words import text_words, word_freq
from wordloom.sources.files import fold_counts, read_counts, write_counts
from wordloom.sources.messages import from_messages

OBSERVED = "stream_words"


def message_words(messages: DataFrame, profile: Profile = ASCII) -> DataFrame:
    """Messages to words; unreadable messages and missing contents give none."""
    return text_words(from_messages(messages), "Content", profile)


def _trigger(interval: str | None) -> dict:
    return {"processingTime": interval} if interval else {"availableNow": True}


def write_stream(words: DataFrame, checkpoint: str, *sinks: Callable[[DataFrame, int], None],
                 interval: str | None = None) -> StreamingQuery:
    """Run every sink on each micro-batch of one query, so the source is read once.

    Without ``interval`` it processes what is available and ends, and continues from the checkpoint when started
    again; with one, such as ``"1 minute"``, it runs until stopped. The rows of each micro-batch are counted on the way:
    see :func:`rows_seen`.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        if len(sinks) > 1:
            batch.persist()
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    counted = words.observe(OBSERVED, F.count(F.lit(1)).alias("rows"))
    return (
        counted.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval)).start()
    )


def rows_seen(query: StreamingQuery) -> dict[int, int]:
    """Rows by micro-batch, as the pass that fed the sinks counted them; batches that the query no longer reports are left out."""
    return {p.batchId: p.observedMetrics[OBSERVED].rows for p in query.recentProgress if OBSERVED in p.observedMetrics}


def word_sink(path: str, file_format: str = "parquet") -> Callable[[DataFrame, int], None]:
    """Appends words under the batch's own folder; a replayed batch replaces itself."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(file_format).option("header", True).save(f"{path}/run_id={batch_id}")

    return sink


def count_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Stores each batch's word counts under the batch id.

    The stream keeps no state: the running total is the sum over the stored batches, a replayed batch replaces
    itself, and a frequent word is counted before it is shuffled.
    """
    return lambda batch, batch_id: write_counts(word_freq(batch), path, batch_id)


def fold_sink(path: str, every: int = 1000) -> Callable[[DataFrame, int], None]:
    """Folds all counts into one table whenever ``every`` more batches have come; a replay folds nothing twice."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        if batch_id and batch_id % every == 0:
            fold_counts(batch.sparkSession, path)

    return sink


def console_sink(rows: int = 20) -> Callable[[DataFrame, int], None]:
    """Prints the first rows of each batch, for debugging."""
    return lambda batch, batch_id: batch.show(rows)


def csv_stream(words: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Spark's own exactly-once file sink: header CSV, append."""
    return (
        words.writeStream.outputMode("append").format("csv").option("header", True).option("path", path)
        .option("checkpointLocation", checkpoint).trigger(**_trigger(interval)).start()
    )


def console_stream(words: DataFrame, interval: str | None = None) -> StreamingQuery:
    """Spark's own console sink, append and without checkpoint."""
    return words.writeStream.outputMode("append").format("console").trigger(**_trigger(interval)).start()


def stream_word_freq(spark: SparkSession, messages: DataFrame, path: str, checkpoint: str, *more_sinks,
                     fold_every: int | None = None) -> DataFrame:
    """Run the message stream to its current end and return the accumulated frequencies.

    ``more_sinks`` get the same micro-batches. ``fold_every`` folds the stored counts each time so many have come.
    """
    sinks = [count_sink(path), *more_sinks]
    if fold_every:
        sinks.append(fold_sink(path, fold_every))
    write_stream(message_words(messages), checkpoint, *sinks).awaitTermination()
    return read_counts(spark, path)
