"""JSON messages, stored API responses and the message bus."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.schemas import MESSAGE, PAGES_RESPONSE, SEARCH_RESPONSE


def to_messages(pages: DataFrame) -> DataFrame:
    """``(Title, Content)`` to one JSON object per row, in the column ``value``."""
    return pages.select(F.to_json(F.struct("Title", "Content")).alias("value"))


def from_messages(messages: DataFrame) -> DataFrame:
    """JSON in ``value`` (text or bytes) to ``(Title, Content)``; unreadable messages become nulls."""
    decoded = F.from_json(F.col("value").cast("string"), MESSAGE)
    return messages.select(decoded.alias("data")).select("data.*")


def search_titles(responses: DataFrame, limit: int | None = None) -> DataFrame:
    """The listed titles of each search response in listed order: all of them, or the first ``limit``."""
    hits = F.from_json("response", SEARCH_RESPONSE)["query"]["search"]
    if limit is not None:
        hits = F.slice(hits, 1, limit)
    return (
        responses.select("response_id", F.posexplode(hits).alias("position", "hit"))
        .select("response_id", "position", F.col("hit.title").alias("title"))
    )


def page_extracts(responses: DataFrame) -> DataFrame:
    """``(Title, Content)`` of every page that has an extract."""
    pages = F.map_values(F.from_json("response", PAGES_RESPONSE)["query"]["pages"])
    return (
        responses.select(F.explode(pages).alias("page")).where("page.extract IS NOT NULL")
        .select(F.col("page.title").alias("Title"), F.col("page.extract").alias("Content"))
    )


def kafka_stream(spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None) -> DataFrame:
    """The topic as a stream of ``value`` bytes. Needs the Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select("value")


def write_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Send the messages to a topic. Needs the Kafka connector on the class path."""
    (
        messages.select("value").write.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    )


def file_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A folder of message files, one JSON object a line, as a stream of ``value``."""
    reader = spark.readStream.schema("value string")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def write_message_files(messages: DataFrame, path: str) -> None:
    messages.select("value").write.mode("overwrite").text(path)
