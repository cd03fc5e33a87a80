"""Tables that several queries start from, written once per session and input folder."""

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.operators import labelling, lexicon, network, pages, words
from wordloom.operators.numbering import batches, number_rows
from wordloom.plans.stub import stub_labeller
from wordloom.sources.workspace import new_path, spread, written

_stored: dict[tuple[str, str, str], tuple[str, T.StructType]] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The stage table ``name`` for this session and input folder, built on first use."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        path = new_path(spark, name)
        _stored[key] = path, written(build(), path).schema
    path, schema = _stored[key]
    return spark.read.schema(schema).parquet(path)


def folder(spark: SparkSession, sf_dir: str, name: str, fill: Callable[[str], object]) -> str:
    """A folder of stage tables for this session and input folder, filled on first use."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        path = new_path(spark, name)
        fill(path)
        _stored[key] = path, T.StructType()
    return _stored[key][0]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def document_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spread(table(spark, sf_dir, "documents").select("text"))
    return words.word_freq(words.text_words(documents))


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "vocabulary", lambda: document_freq(spark, sf_dir))


def ranked_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the vocabulary with its rank from 0 in word order."""
    numbered = number_rows(vocabulary(spark, sf_dir).select("word"), "word", name="n")
    return numbered.select("word", (F.col("n") - 1).alias("r"))


def label_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels made by arithmetic on word rank: ``seq`` and the six label fields as text.

    Words link only to words of their own block of eight ranks, so one small aggregate per block resolves them.
    """
    ranked = ranked_words(spark, sf_dir)
    blocks = ranked.groupBy(F.floor(F.col("r") / 8).alias("block")).agg(
        F.map_from_entries(F.collect_list(F.struct("r", "word"))).alias("members")
    )
    member = blocks.select("block", "members", F.explode("members").alias("r", "word"))

    def linked(every: int, itself: int, factor: int, shift: int):
        target = F.col("block") * 8 + (F.col("r") * factor + shift) % 8
        return (
            F.when(F.col("r") % every == 0, labelling.UNKNOWN).when(F.col("r") % itself == 0, F.col("word"))
            .otherwise(F.coalesce(F.element_at("members", target), F.lit(labelling.UNKNOWN)))
        )

    # The parts of speech of the derived labels.
    pos = F.array(*map(F.lit, (
        "kata nama", "kata kerja", "kata adjektif", "kata sendi", "kata keterangan", "bukan kategori")))
    first = member.select(
        F.col("r").alias("seq"),
        "word",
        F.concat(F.lit("def "), F.col("r").cast("string")).alias("definition"),
        linked(5, 11, 5, 2).alias("antonym"),
        linked(4, 7, 3, 1).alias("synonym"),
        F.get(pos, (F.col("r") % 6).cast("int")).alias("pos"),
        F.when(F.col("r") % 13 == 0, "n/a").otherwise((F.col("r") * 37 % 201 - 100).cast("string")).alias("sentiment"),
    )
    # Every tenth label comes twice; the second copy has a later seq.
    copies = F.when(F.col("seq") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return first.withColumn("copy", F.explode(copies)).select(
        (F.col("seq") + F.col("copy") * 1000000).alias("seq"),
        "word",
        F.when(F.col("copy") == 1, F.concat("definition", F.lit(" v2"))).otherwise(F.col("definition")).alias("definition"),
        "antonym", "synonym", "pos", "sentiment",
    )


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "labels", lambda: label_table(spark, sf_dir))


def valid_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelling.valid_labels(labels(spark, sf_dir))


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "nodes", lambda: lexicon.lexicon_nodes(valid_labels(spark, sf_dir)))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "edges", lambda: lexicon.lexicon_edges(valid_labels(spark, sf_dir)))


def synonym_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "synonym_pairs",
                  lambda: network.network_edges(edges(spark, sf_dir), lexicon.SYNONYM))


def antonym_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "antonym_pairs",
                  lambda: network.network_edges(edges(spark, sf_dir), lexicon.ANTONYM))


def planted_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A network ``(a, b)`` of known structure over the vocabulary, with place ``q = r // 10`` for rank r.

    Ranks ending in 0: cliques of ``size`` words, each linked to the next by one edge, so all are one component.
    Ranks ending in 1: a hub, the first word, linked to all others. Ranks ending in 2: chains of ``4 * size`` words.
    Words left over from whole cliques and chains have no edges. The size grows with the cube root of the words, which
    keeps the cliques above the resolution of modularity.
    """
    ranked = ranked_words(spark, sf_dir).select("word", F.floor(F.col("r") / 10).alias("q"), (F.col("r") % 10).alias("kind"))
    ranked = stored(spark, sf_dir, "planted_places", lambda places=ranked: places.where("kind < 3"))
    words = ranked.where("kind = 0").count()
    size = planted_size(words)
    cliques = ranked.where("kind = 0").withColumn("g", F.floor(F.col("q") / size)).where(F.col("g") < words // size)
    inside = cliques.select("g", "q", F.col("word").alias("a")).join(
        cliques.select("g", F.col("q").alias("p"), F.col("word").alias("b")), "g").where("q < p").select("a", "b")

    def steps(rows: DataFrame, same_chain: Column) -> DataFrame:
        after = rows.select((F.col("q") - 1).alias("q"), F.col("word").alias("b"))
        return rows.where(same_chain).select("q", F.col("word").alias("a")).join(after, "q").select("a", "b")

    bridges = steps(cliques, F.col("q") % size == size - 1)
    leaves = ranked.where("kind = 1 AND q > 0").select(F.col("word").alias("b"))
    hub = leaves.join(F.broadcast(ranked.where("kind = 1 AND q = 0").select(F.col("word").alias("a")))).select("a", "b")
    whole = ranked.where("kind = 2").where(F.col("q") < words // (4 * size) * (4 * size))
    chains = steps(whole, F.col("q") % (4 * size) != 4 * size - 1)
    pairs = inside.unionByName(bridges).unionByName(hub).unionByName(chains)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def planted_size(words: int) -> int:
    return math.ceil(1.3 * words ** (1 / 3)) + 4


def planted_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "planted_pairs", lambda: planted_table(spark, sf_dir))


def forum_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(page_id, html)``: documents in the page layout of the forum, with parts missing by the number of the document."""
    def escaped(column: str) -> str:
        return f"replace(replace(replace({column}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"

    comment = f"""concat('<dl id="comment_', CASE WHEN k % 2 = 1 THEN 'x' ELSE string(doc_id * 10 + k + 3000000000) END, '_li">',
      CASE WHEN k = 2 THEN '' ELSE concat('<a class=xi2> user', k, ' </a>') END,
      CASE WHEN k = 1 THEN '' ELSE concat('<dd><div class="quote">', {escaped("source")}, '</div> says &eacute; ', k, '</dd>') END,
      '</dl>')"""
    html = f"""concat('<html><head><title> ', {escaped("source")}, ' ', lang, '</title></head><body>',
      CASE WHEN doc_id % 5 = 0 THEN '' ELSE concat('<p class="date xg1">2024-1-', doc_id % 28 + 1, ' | <a href=/u>',
        {escaped("source")}, '</a></p>') END,
      CASE WHEN doc_id % 7 = 0 THEN '' ELSE concat('<em id="_viewnum">', format_number(n_chars * 1000003, 0), '</em>') END,
      '<em id="_commentnum">', doc_id % 4, '</em>',
      CASE WHEN doc_id % 11 = 0 THEN '' ELSE concat('<table><tr><td id="article_content">', {escaped("text")},
        '<script>x()</script><p title="a > b">', lang, '</p></td></tr></table>') END,
      '<div id="comment_ul">',
      CASE WHEN doc_id % 4 = 0 THEN '' ELSE array_join(transform(sequence(0, doc_id % 4 - 1), k -> {comment}), '') END,
      '</div></body></html>')"""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return spread(documents).select(F.col("doc_id").alias("page_id"), F.expr(html).alias("html"))


def forum_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "forum_records", lambda: pages.extract_pages(forum_pages(spark, sf_dir)))


def word_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "word_batches", lambda: batches(vocabulary(spark, sf_dir)))


def label_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stub's answers for the whole vocabulary as lines; raw answers are written before they are parsed."""
    answers = stored(spark, sf_dir, "answers",
                     lambda: labelling.responses(labelling.word_lists(word_batches(spark, sf_dir)), stub_labeller))
    return labelling.response_lines(spread(answers))
