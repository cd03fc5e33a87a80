"""Words and their frequencies."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions import text as X


def tokens(texts: DataFrame, column: str = "text") -> DataFrame:
    """One row per raw token of each text."""
    return texts.select(F.explode(X.raw_tokens(F.col(column))).alias("word"))


def article_words(articles: DataFrame, comments: DataFrame | None = None, separator: str | None = " ") -> DataFrame:
    """Raw tokens of viewed articles (title and content) and, where given, of comments."""
    viewed = articles.where(X.positive(F.col("Views")))
    words = tokens(viewed.select(X.combined_text("Title", "Content", separator).alias("text")))
    if comments is not None:
        words = words.unionByName(tokens(comments, "Comment_Text"))
    return words


def clean_tokens(words: DataFrame) -> DataFrame:
    """Raw tokens to cleaned words: split on comma and semicolon, keep letters, drop empties."""
    pieces = words.select(F.explode(F.split("word", "[,;]")).alias("word"))
    return pieces.select(X.clean_word("word").alias("word")).where("word != ''")


def text_words(texts: DataFrame, column: str = "text", profile: X.Profile = X.UNICODE) -> DataFrame:
    """Cleaned words of whole texts; same rows as ``clean_tokens(tokens(texts))`` in fewer passes."""
    return texts.select(F.explode(X.text_words(F.col(column), profile)).alias("word")).where("word != ''")


def union_words(*words: DataFrame) -> DataFrame:
    """Bag union: duplicates stay."""
    result = words[0]
    for more in words[1:]:
        result = result.unionByName(more)
    return result


def word_freq(words: DataFrame) -> DataFrame:
    """Occurrences per word. Partial aggregation keeps frequent words from becoming hot shuffle keys."""
    return words.groupBy("word").agg(F.count("*").alias("frequency"))


def distinct_words(freq: DataFrame) -> DataFrame:
    """The vocabulary. Taken from the frequency table, so it costs no second distinct."""
    return freq.select("word")


def vocab_size(freq: DataFrame) -> DataFrame:
    return freq.agg(F.count("*").alias("words"), F.coalesce(F.sum("frequency"), F.lit(0)).alias("occurrences"))


def top_words(freq: DataFrame, n: int = 10) -> DataFrame:
    return freq.orderBy(F.desc("frequency"), "word").limit(n)


def bottom_words(freq: DataFrame, n: int = 10) -> DataFrame:
    return freq.orderBy("frequency", "word").limit(n)


def hapax_words(freq: DataFrame) -> DataFrame:
    """Words used exactly once."""
    return freq.where("frequency = 1").select("word")


def merge_counts(existing: DataFrame, delta: DataFrame, key: str = "word", count: str = "frequency") -> DataFrame:
    """Add two keyed counters."""
    return existing.unionByName(delta).groupBy(key).agg(F.sum(count).alias(count))
