"""Lexicon tables: nodes, edges, counters, lookups, profiles and repair.

Row order matters when several labels write the same word, so labels carry an explicit ``seq``; the highest wins.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.operators.labelling import UNKNOWN
from wordloom.operators.numbering import collect_in_parts
from wordloom.sources.workspace import staged

SYNONYM, ANTONYM = "SYNONYM", "ANTONYM"

SKETCH_BITS = 14  # 16,384 registers: a standard error of 0.8 percent, whatever the number of words

# The part-of-speech names that are counted under their own name.
VALID_POS = (
    "kata nama", "kata kerja", "kata adjektif", "kata sendi", "kata keterangan", "tidak diketahui",
    "kata singkatan", "kata nama khas", "kata sendi nama", "kata ganti nama diri", "kata nama jamak",
    "kata ganti nama", "kata kerja pasif", "kata seru", "kata sifat", "kata ganti nama diri tunggal",
    "singkatan", "kata ganti", "kata nama waktu", "kata tanya", "kata hubung", "kata tunjuk",
    "kata keterangan masa",
)


def _links(column: str) -> Column:
    """Whether a synonym or antonym value names another word."""
    return (F.col(column) != UNKNOWN) & (F.col(column) != F.col("word"))


def last_wins(df: DataFrame, keys: list[str], values: list[str], order: Column) -> DataFrame:
    """One row per key: the values of the row that comes last in ``order``.

    An aggregate rather than a window: rows of a frequent key are reduced before the shuffle.
    """
    if len(values) == 1:
        return df.groupBy(*keys).agg(F.max_by(values[0], order).alias(values[0]))
    return df.groupBy(*keys).agg(F.max_by(F.struct(*values), order).alias("_last")).select(*keys, "_last.*")


def node_writes(labels: DataFrame, synonym_props: str = "overwrite", *before: Column) -> DataFrame:
    """``(word, definition, pos, written)``: what each label writes, and ``written``, the order of writes.

    A label writes its word, then gives its synonym the same definition and part of speech; an antonym only comes
    into being, which has no order (null). With ``synonym_props="keep"`` a word's own label beats anything written to it as
    a synonym. ``before`` are fields that come before ``seq`` in the order, such as the number of a run.
    """
    def write(node: str, step: int, sets: bool) -> Column:
        own = F.lit(step == 0 if synonym_props == "keep" else True)
        order = F.struct(own.alias("own"), *before, F.col("seq").alias("seq"), F.lit(step).alias("step"))
        return F.struct(F.col(node).alias("word"), F.when(F.lit(sets), F.col("definition")).alias("definition"),
                        F.when(F.lit(sets), F.col("pos")).alias("pos"), F.when(F.lit(sets), order).alias("written"))

    writes = F.array(
        write("word", 0, True),
        F.when(_links("synonym"), write("synonym", 1, True)),
        F.when(_links("antonym"), write("antonym", 2, False)),
    )
    return labels.select(F.inline(F.array_compact(writes)))


def lexicon_nodes(labels: DataFrame, synonym_props: str = "overwrite") -> DataFrame:
    """``(word, definition, pos)`` after applying every label in ``seq`` order, see :func:`node_writes`."""
    # A null order never wins, so words that only occur as antonyms end with null properties.
    return last_wins(node_writes(labels, synonym_props), ["word"], ["definition", "pos"], F.col("written"))


def last_nodes(writes: DataFrame) -> DataFrame:
    """One row a word: the last of its writes, with its order, so that later writes can be compared with it."""
    return last_wins(writes, ["word"], ["definition", "pos", "written"], F.col("written"))


def node_sketch(labels: DataFrame) -> DataFrame:
    """``(name, sketch)``: one row, the words that the labels write, as a sketch of distinct values."""
    words = node_writes(labels).select("word")
    return words.agg(F.hll_sketch_agg("word", SKETCH_BITS).alias("sketch")).select(F.lit("words").alias("name"), "sketch")


def lexicon_edges(labels: DataFrame) -> DataFrame:
    """Distinct directed ``(src, rel, dst)``."""
    def edge(column: str, rel: str) -> Column:
        return F.when(_links(column), F.struct(F.col("word").alias("src"), F.lit(rel).alias("rel"),
                                               F.col(column).alias("dst")))

    pairs = F.array_compact(F.array(edge("synonym", SYNONYM), edge("antonym", ANTONYM)))
    return labels.select(F.inline(pairs)).distinct()


def lexicon_coverage(nodes: DataFrame, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct("word") if approximate else F.count_distinct("word")
    return nodes.agg(count.alias("unique_entries"))


def pos_counts(labels: DataFrame, valid: tuple[str, ...] = VALID_POS) -> DataFrame:
    """Labels per part of speech, duplicates included; unlisted values count as unknown."""
    pos = F.when(F.col("pos").isin(*valid), F.col("pos")).otherwise(UNKNOWN)
    return labels.groupBy(pos.alias("pos")).agg(F.count("*").alias("n"))


def sentiment_bucket(sentiment) -> Column:
    """NaN is neither above nor below 0 here, although Spark orders it above every number."""
    number = F.nanvl(sentiment, F.lit(0.0))
    return F.when(number > 0, "positive").when(number < 0, "negative").otherwise("neutral")


def sentiment_counts(labels: DataFrame) -> DataFrame:
    return labels.groupBy(sentiment_bucket(F.col("sentiment")).alias("bucket")).agg(F.count("*").alias("n"))


def word_sentiment(labels: DataFrame) -> DataFrame:
    """The last sentiment written for each word."""
    return last_wins(labels, ["word"], ["sentiment"], F.col("seq"))


def lookup_words(keys: DataFrame, nodes: DataFrame) -> DataFrame:
    """Nodes of the given words; unknown words vanish, a repeated key repeats its row."""
    return keys.select("word").join(nodes, "word")


def neighbours_out(keys: DataFrame, edges: DataFrame, rel: str) -> DataFrame:
    """Distinct ``(word, neighbour)`` along outgoing edges of one kind; a repeated key counts once."""
    linked = edges.where(F.col("rel") == rel).select(F.col("src").alias("word"), F.col("dst").alias("neighbour"))
    return keys.select("word").distinct().join(linked, "word")


def word_profile(keys: DataFrame, freq: DataFrame, sentiment: DataFrame, edges: DataFrame,
                 part_size: int = 1000) -> DataFrame:
    """Frequency, sentiment, synonyms and antonyms of each given word, known or not.

    A word with more than ``part_size`` synonyms or antonyms gets further rows, numbered by ``part``.
    """
    # The semi join takes the keys as they come and the lists get their own partitions, so that Spark may split the
    # join partition that holds a hub's edges.
    wanted = edges.withColumnRenamed("src", "word").join(keys.select("word"), "word", "left_semi")
    wanted = staged(wanted.repartition("word", "rel", "dst"), "wanted-edges")  # read up to three times below
    keys = keys.select("word").distinct()
    lists = collect_in_parts(wanted, ["word", "rel"], "dst", part_size)

    def listing(rel: str) -> Column:
        return F.max(F.when(F.col("rel") == rel, F.array_join("values", ", ")))

    neighbours = lists.groupBy("word", "part").agg(listing(SYNONYM).alias("synonyms"),
                                                   listing(ANTONYM).alias("antonyms"))
    return (
        keys.join(freq, "word", "left").join(sentiment, "word", "left").join(neighbours, "word", "left")
        .select(
            "word",
            F.coalesce("part", F.lit(0)).alias("part"),
            F.coalesce("frequency", F.lit(0)).alias("frequency"),
            "sentiment",
            F.coalesce("synonyms", F.lit("")).alias("synonyms"),
            F.coalesce("antonyms", F.lit("")).alias("antonyms"),
        )
    )


def words_missing_props(nodes: DataFrame) -> DataFrame:
    return nodes.where(F.col("definition").isNull() & F.col("pos").isNull()).select("word")


def repair_lexicon(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """Replace definition and part of speech where a label exists; labels of unknown words create nothing."""
    latest = last_wins(labels, ["word"], ["definition", "pos"], F.col("seq"))
    latest = latest.select("word", F.struct("definition", "pos").alias("_new"))

    def pick(name: str) -> Column:
        return F.when(F.col("_new").isNotNull(), F.col(f"_new.{name}")).otherwise(F.col(name)).alias(name)

    return nodes.join(latest, "word", "left").select("word", pick("definition"), pick("pos"))
