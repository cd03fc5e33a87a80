"""The work from stored pages to an enriched lexicon, step by step.

Each step takes DataFrames, writes its tables below ``path`` and returns them as tables, so that no step is computed
twice and a later step starts from files. Writing again replaces the tables.
"""

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.operators import labelling, lexicon, network, pages, words
from wordloom.operators.labelling import Labeller
from wordloom.operators.numbering import more_batches
from wordloom.schemas import ANSWER, COMPONENT, EDGE, PROPS, WORD_BATCH
from wordloom.sources import manifest
from wordloom.sources.files import read_counts, stored_or_none, write_counts
from wordloom.sources.keyed import KeyedTable
from wordloom.sources.runs import RunLog
from wordloom.sources.workspace import staged, written


def collect_articles(stored_pages: DataFrame, path: str, extractor: pages.Extractor | None = None,
                     spec: pages.PageSpec = pages.PageSpec()) -> tuple[DataFrame, DataFrame]:
    """Pages ``(page_id, html)`` to articles and comments; the pages are parsed once for both."""
    records = written(pages.extract_pages(stored_pages, extractor, spec), f"{path}/records")
    return pages.articles(records), pages.comments(records)


def build_vocabulary(articles: DataFrame, comments: DataFrame | None, streamed: DataFrame | None,
                     path: str) -> DataFrame:
    """Frequencies of the cleaned words of articles, comments and streamed words."""
    found = words.article_words(articles, comments)
    if streamed is not None:
        found = words.union_words(found, streamed.select("word"))
    return written(words.word_freq(words.clean_tokens(found)), f"{path}/word_freq")


def answer_batches(vocabulary: DataFrame, labeller: Labeller, path: str, batch_size: int = 80,
                   calls_at_once: int = 64) -> DataFrame:
    """``(batch_id, response, error)`` of the batches that hold words of the vocabulary.

    Batches and answers are only ever added to: words that are in no stored batch get new ones, numbered on, and the
    batches that have no answer yet are asked, those that failed again. So one new word costs one call.
    """
    spark = vocabulary.sparkSession
    more = more_batches(vocabulary, stored_or_none(spark, f"{path}/batches", WORD_BATCH), batch_size)
    more.write.mode("append").parquet(f"{path}/batches")
    batches = spark.read.schema(WORD_BATCH).parquet(f"{path}/batches")
    asked = labelling.unanswered(batches, stored_or_none(spark, f"{path}/answers", ANSWER))
    labelling.responses(asked, labeller, calls_at_once).write.mode("append").parquet(f"{path}/answers")
    answers = spark.read.schema(ANSWER).parquet(f"{path}/answers")
    # A batch that failed and was asked again counts by its answer.
    best = F.min_by(F.struct("response", "error"), F.struct(F.col("error").isNotNull(), "response", "error")).alias("answer")
    latest = answers.groupBy("batch_id").agg(best)
    wanted = batches.join(vocabulary.select("word"), "word", "left_semi").select("batch_id").distinct()
    return latest.join(wanted, "batch_id", "left_semi").select("batch_id", "answer.*")


def label_words(vocabulary: DataFrame, labeller: Labeller, path: str, batch_size: int = 80, strict: bool = False,
                calls_at_once: int = 64, counts: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """``(labels, rejects)`` of the words; batches and raw answers stay in tables of their own.

    ``seq`` of a label is its batch and line, which is the order in which labels overwrite each other. A batch whose call
    failed is a reject with the error as its line. ``counts``, if given, observes lines, labels and rejects by reason in the
    pass that writes them (:func:`labelling.label_counts`).
    """
    answers = answer_batches(vocabulary, labeller, path, batch_size, calls_at_once)
    lines = labelling.checked_labels(labelling.parsed_answers(answers, strict))
    if counts is not None:
        lines = lines.observe(counts, *labelling.label_counts())
    checked = written(lines, f"{path}/checked").withColumn("seq", F.struct("batch_id", "line_no"))
    labels = checked.where("reason IS NULL").select("seq", *labelling.LABEL_FIELDS)
    failed = answers.where("error IS NOT NULL").select(
        F.struct("batch_id", F.lit(0).alias("line_no")).alias("seq"), F.col("error").alias("line"), F.lit("call").alias("reason"))
    return labels, checked.where("reason IS NOT NULL").select("seq", "line", "reason").unionByName(failed)


def node_table(path: str, seq: T.DataType | None = None, **options) -> KeyedTable:
    """The stored nodes; without the type of ``seq`` their words and properties alone."""
    fields = [*PROPS]
    if seq is not None:
        order = [("own", T.BooleanType()), ("run", T.LongType()), ("version", T.LongType()), ("seq", seq), ("step", T.IntegerType())]
        fields.append(T.StructField("written", T.StructType([T.StructField(*field) for field in order])))
    return KeyedTable(f"{path}/nodes", T.StructType(fields), "word", **options)


def edge_table(path: str, **options) -> KeyedTable:
    """The stored edges, kept by the word they start from."""
    return KeyedTable(f"{path}/edges", EDGE, "src", **options)


def _write_nodes(labels: DataFrame, path: str, run_id: str, synonym_props: str, only: DataFrame | None = None, **options) -> None:
    spark, table = labels.sparkSession, node_table(path, labels.schema["seq"].dataType, **options)
    run, version = table.run_number(spark, run_id), manifest.latest(spark, table.path)["version"] + 1
    before = [F.lit(n).cast("bigint").alias(name) for name, n in (("run", run), ("version", version))]
    writes = lexicon.last_nodes(lexicon.node_writes(labels, synonym_props, *before))
    if only is not None:
        writes = writes.join(only.select("word"), "word", "left_semi")
    table.upsert(writes, lexicon.last_nodes, run_id)


def enrich(labels: DataFrame, path: str, run_id: str = "labels", synonym_props: str = "overwrite", **options) -> dict[str, DataFrame]:
    """Add the usable labels of a run to the stored lexicon and its counters; returns all tables as they then are.

    Runs write in the order in which they first came, so after several runs the tables are those of one replay of all
    labels. The same run again writes after its own first time and leaves other runs' places alone; what it wrote before and
    does not write again stays. Nodes, edges and counters are switched one after the other: if a run breaks off in
    between, running it again completes it.
    """
    usable = staged(labelling.usable_words(labels), "usable-labels")  # read six times below
    spark = usable.sparkSession
    _write_nodes(usable, path, run_id, synonym_props, **options)
    edge_table(path, **options).upsert(lexicon.lexicon_edges(usable), lambda rows: rows.distinct(), run_id)
    count_labels(usable, path, run_id)
    _coverage(spark, path).write(lexicon.node_sketch(usable), run_id)
    return stored_lexicon(spark, path)


def stored_lexicon(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Nodes, edges and counters of all runs so far."""
    return {"nodes": node_table(path).read(spark), "edges": edge_table(path).read(spark), **counters(spark, path)}


def _coverage(spark: SparkSession, path: str) -> RunLog:
    return RunLog(spark, f"{path}/coverage", "name string, sketch binary", "sketch")


def coverage(spark: SparkSession, path: str) -> DataFrame:
    """About how many words the stored lexicon has, from one sketch a run: the nodes are not read.

    The standard error is 0.8 percent (:data:`lexicon.SKETCH_BITS`).
    """
    return _coverage(spark, path).read().select(F.hll_sketch_estimate("sketch").alias("unique_entries"))


def _sentiments(spark: SparkSession, path: str) -> RunLog:
    return RunLog(spark, f"{path}/word_sentiment", "word string, sentiment double", "last")


def grow_components(pairs: DataFrame, path: str, **options) -> DataFrame:
    """``(word, component)`` of the stored graph at ``path`` with undirected ``pairs`` added to it.

    Only new pairs are worked on, and only buckets with a word whose component changes are written again. Names only get
    smaller, so of an old and a new row of a word the smaller name is right.
    """
    table = KeyedTable(f"{path}/components", COMPONENT, "word", **options)
    spark = pairs.sparkSession
    changes = network.added_to_components(table.read(spark), pairs)
    table.upsert(changes, lambda rows: rows.groupBy("word").agg(F.min("component").alias("component")))
    return table.read(spark)


def count_labels(labels: DataFrame, path: str, run_id: str) -> None:
    """Add the labels of one run to the counters. The same run again replaces its own counts and adds nothing.

    A word's sentiment is that of the run that first came last.
    """
    write_counts(lexicon.pos_counts(labels), f"{path}/pos_counts", run_id)
    write_counts(lexicon.sentiment_counts(labels), f"{path}/sentiment_counts", run_id)
    _sentiments(labels.sparkSession, path).write(lexicon.word_sentiment(labels), run_id)


def counters(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Labels per part of speech and per sentiment over all runs, and each word's latest sentiment."""
    return {
        "pos_counts": read_counts(spark, f"{path}/pos_counts", "pos", "n"),
        "sentiment_counts": read_counts(spark, f"{path}/sentiment_counts", "bucket", "n"),
        "word_sentiment": _sentiments(spark, path).read(),
    }


def repair(nodes: DataFrame, labeller: Labeller, path: str, batch_size: int = 80, counter_path: str | None = None,
           run_id: str = "repair") -> tuple[DataFrame, DataFrame]:
    """Label the words without properties: the repaired nodes, and the labels.

    The labels are added to the counters at ``counter_path`` as a run of their own.
    """
    labels, _ = label_words(lexicon.words_missing_props(nodes), labeller, path, batch_size)
    if counter_path is not None:
        count_labels(labels, counter_path, run_id)
    return lexicon.repair_lexicon(nodes, labels), labels


def repair_stored(spark: SparkSession, path: str, labeller: Labeller, batch_size: int = 80, run_id: str = "repair", **options) -> DataFrame:
    """The same for the stored lexicon at ``path``: only the buckets of the answered words are written again.

    Labels of words that were not asked for create nothing, but count. A rerun has the words that the run asked for
    before besides those still missing, so its counts are complete. Returns the nodes.
    """
    missing = lexicon.words_missing_props(node_table(path).read(spark))
    before = stored_or_none(spark, f"{path}/{run_id}/batches", WORD_BATCH)
    if before is not None:
        missing = missing.unionByName(before.select("word")).distinct()
    missing = staged(missing, "repaired-words")
    labels, _ = label_words(missing, labeller, f"{path}/{run_id}", batch_size)
    count_labels(labels, path, run_id)
    own = labels.withColumns({name: F.lit(labelling.UNKNOWN) for name in ("synonym", "antonym")})  # words alone are written
    _write_nodes(own, path, run_id, "overwrite", missing, **options)
    return node_table(path).read(spark)
