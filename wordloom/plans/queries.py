"""One query per operator over the supplied tables. Every query reads its whole tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions import text as X
from wordloom.operators import communities, labelling, lexicon, network, pages, words
from wordloom.operators.numbering import batches, number_rows
from wordloom.plans import fixture, flows
from wordloom.plans.fixture import table
from wordloom.plans.stub import stub_labeller
from wordloom.schemas import COMPONENT, PROPS
from wordloom.sources import files, messages
from wordloom.sources.keyed import KeyedTable
from wordloom.sources.workspace import new_path, spread, staged, written
from wordloom.streaming import words as streams

# The test pages have a navigation list instead of a forum's byline and comments.
PAGE_LAYOUT = pages.PageSpec(
    byline=pages.Selector("nav"),
    content=pages.Selector("article"),
    comments=pages.Selector("nav"),
    comment=pages.Selector("li"),
    user=pages.Selector("a"),
    body=pages.Selector("a"),
)


def _documents(spark, sf_dir):
    return spread(table(spark, sf_dir, "documents").select("source", "text"))


def _document_words(spark, sf_dir):
    return words.text_words(spread(table(spark, sf_dir, "documents").select("text")))


def _page_words(spark, sf_dir):
    return words.text_words(pages.page_text(spread(table(spark, sf_dir, "pages").select("page_id", "html"))))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    return words.tokens(documents.select(X.combined_text("source", "text").alias("text")))


def tokens_glued(spark, sf_dir):
    documents = _documents(spark, sf_dir)
    return words.tokens(documents.select(X.combined_text("source", "text", None).alias("text")))


def article_words(spark, sf_dir):
    documents = spread(table(spark, sf_dir, "documents").select("source", "text", "n_chars"))
    articles = documents.select(F.col("source").alias("Title"), F.col("text").alias("Content"),
                                F.col("n_chars").cast("string").alias("Views"))
    comments = table(spark, sf_dir, "conversations").select(F.col("text").alias("Comment_Text"))
    return words.article_words(articles, comments)


def clean_words(spark, sf_dir):
    return words.distinct_words(fixture.document_freq(spark, sf_dir))


def word_freq(spark, sf_dir):
    return fixture.document_freq(spark, sf_dir)


def word_freq_by_token(spark, sf_dir):
    """Tokenize first, then clean each token: the two steps that ``word_freq`` fuses."""
    return words.word_freq(words.clean_tokens(words.tokens(_documents(spark, sf_dir))))


def vocab_size(spark, sf_dir):
    return words.vocab_size(fixture.document_freq(spark, sf_dir))


def top_words(spark, sf_dir):
    return words.top_words(fixture.document_freq(spark, sf_dir))


def bottom_words(spark, sf_dir):
    return words.bottom_words(fixture.document_freq(spark, sf_dir))


def hapax_words(spark, sf_dir):
    return words.hapax_words(fixture.document_freq(spark, sf_dir))


def words_union(spark, sf_dir):
    return words.union_words(_document_words(spark, sf_dir), _page_words(spark, sf_dir))


def merge_counts(spark, sf_dir):
    return words.merge_counts(fixture.document_freq(spark, sf_dir), words.word_freq(_page_words(spark, sf_dir)))


def positive_views(spark, sf_dir):
    """Views as text: the number in ``props``, beyond 32 bits for every third event, but words for error events."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "props")
    views = F.when(F.col("event_type") == "error", F.col("event_type"))
    number = F.get_json_object("props", "$.k")
    views = views.when(F.col("event_id") % 3 == 0, F.concat(number, F.lit("0000000000"))).otherwise(number)
    articles = events.select("event_id", views.alias("Views")).where(X.positive(F.col("Views")))
    return articles.select("event_id", F.col("Views").try_cast("bigint").alias("views"))


def csv_roundtrip(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    path = new_path(spark, "csv")
    files.write_csv(documents, path)
    return files.read_csv(spark, path, documents.schema)


def page_ids_range(spark, sf_dir):
    """Ids asked for, 100 up to 300 as in a run over a forum, and all stored ones: their addresses, and what is stored.

    Stored ids are spread over 64 bits here, and so far apart that no range could list them.
    """
    stored = table(spark, sf_dir, "pages").select(
        F.when(F.col("page_id") % 2 == 0, F.col("page_id")).otherwise(F.col("page_id") * 5_000_000_000).alias("page_id"))
    url = X.page_url("https://forum.example.com/view?aid=", F.col("page_id"))
    return files.id_coverage(stored, 100, 300).select(
        "page_id", url.alias("url"), "in_range", "is_stored", X.page_id_of(url).alias("aid"))


def _pages(spark, sf_dir):
    return spread(table(spark, sf_dir, "pages").select("page_id", "html"))


def page_fields(spark, sf_dir):
    return pages.articles(pages.extract_pages(_pages(spark, sf_dir), spec=PAGE_LAYOUT))


def page_comments(spark, sf_dir):
    return pages.comments(pages.extract_pages(_pages(spark, sf_dir), spec=PAGE_LAYOUT))


def forum_fields(spark, sf_dir):
    return pages.articles(fixture.forum_records(spark, sf_dir))


def forum_comments(spark, sf_dir):
    return pages.comments(fixture.forum_records(spark, sf_dir))


def page_rejects(spark, sf_dir):
    """Pages without HTML, every ninth one here, cannot be read."""
    some = _pages(spark, sf_dir).withColumn("html", F.when(F.col("page_id") % 9 != 0, F.col("html")))
    return pages.page_rejects(pages.extract_pages(some, spec=PAGE_LAYOUT))


def page_titles(spark, sf_dir):
    return pages.page_titles(_pages(spark, sf_dir))


def page_text(spark, sf_dir):
    return pages.page_text(_pages(spark, sf_dir))


def page_links(spark, sf_dir):
    return pages.page_links(_pages(spark, sf_dir))


def api_search_titles(spark, sf_dir):
    """Stored search answers of 120 hits each."""
    titles = pages.page_titles(table(spark, sf_dir, "pages")).withColumn("response_id", F.floor(F.col("page_id") / 120))
    hits = F.sort_array(F.collect_list(F.struct("page_id", "title")))
    answers = titles.groupBy("response_id").agg(hits.alias("search"))
    response = F.to_json(F.struct(F.struct("search").alias("query")))
    return messages.search_titles(answers.select("response_id", response.alias("response")))


def api_page_extracts(spark, sf_dir):
    """Stored page answers; every fifth page has no extract."""
    stored = table(spark, sf_dir, "pages")
    extract = F.when(F.col("page_id") % 5 != 0, F.col("html"))
    page = F.struct(F.col("url").alias("title"), extract.alias("extract"))
    answer = F.struct(F.struct(F.create_map(F.col("page_id").cast("string"), page).alias("pages")).alias("query"))
    return messages.page_extracts(stored.select(F.to_json(answer).alias("response")))


def _page_messages(spark, sf_dir):
    stored = table(spark, sf_dir, "pages").select(F.col("url").alias("Title"), F.col("html").alias("Content"))
    return messages.to_messages(stored)


def pages_to_messages(spark, sf_dir):
    return messages.from_messages(_page_messages(spark, sf_dir))


def _message_stream(spark, sf_dir, batches_at_least=4):
    """The messages in files, and a stream over them that takes several micro-batches."""
    path = new_path(spark, "messages")
    count = max(batches_at_least, spark.sparkContext.defaultParallelism)
    messages.write_message_files(_page_messages(spark, sf_dir).repartition(count), path)
    return messages.file_stream(spark, path, max_files=max(1, count // batches_at_least))


def stream_words(spark, sf_dir):
    """The words from a query that also counts them."""
    stream = streams.message_words(_message_stream(spark, sf_dir))
    path, counts, checkpoint = (new_path(spark, n) for n in ("stream-words", "stream-counts", "stream-checkpoint"))
    streams.write_stream(stream, checkpoint, streams.word_sink(path), streams.count_sink(counts)).awaitTermination()
    return spark.read.schema("word string, run_id string").parquet(path).select("word")


def stream_word_freq(spark, sf_dir):
    """Counts of a query that also keeps the words; earlier micro-batches are folded on the way."""
    path, counts, checkpoint = (new_path(spark, n) for n in ("stream-words", "stream-counts", "stream-checkpoint"))
    return streams.stream_word_freq(spark, _message_stream(spark, sf_dir), counts, checkpoint, streams.word_sink(path),
                                    fold_every=2)


def stream_csv_words(spark, sf_dir):
    """The words from the checkpointed CSV sink."""
    path, checkpoint = new_path(spark, "stream-csv"), new_path(spark, "stream-checkpoint")
    streams.csv_stream(streams.message_words(_message_stream(spark, sf_dir)), path, checkpoint).awaitTermination()
    return files.read_csv(spark, path, "word string")


def numbered_words(spark, sf_dir):
    return number_rows(fixture.vocabulary(spark, sf_dir).select("word"), "word")


def label_batches(spark, sf_dir):
    return batches(fixture.vocabulary(spark, sf_dir))


def label_prompts(spark, sf_dir):
    return labelling.prompts(fixture.word_batches(spark, sf_dir), template="Words: ")


def label_rows(spark, sf_dir):
    parsed = labelling.parse_lines(fixture.label_lines(spark, sf_dir))
    return labelling.well_formed(parsed).select("batch_id", *labelling.LABEL_FIELDS)


def label_rows_strict(spark, sf_dir):
    parsed = labelling.parse_lines(fixture.label_lines(spark, sf_dir), strict=True)
    return labelling.well_formed(parsed).select("batch_id", *labelling.LABEL_FIELDS)


def label_rejects(spark, sf_dir):
    parsed = labelling.parse_lines(fixture.label_lines(spark, sf_dir))
    return labelling.rejected_labels(parsed).select("batch_id", "line", "reason")


def usable_words(spark, sf_dir):
    return labelling.usable_words(label_rows(spark, sf_dir))


def valid_labels(spark, sf_dir):
    return fixture.valid_labels(spark, sf_dir)


def lexicon_nodes(spark, sf_dir):
    return lexicon.lexicon_nodes(fixture.valid_labels(spark, sf_dir))


def lexicon_nodes_keep(spark, sf_dir):
    return lexicon.lexicon_nodes(fixture.valid_labels(spark, sf_dir), synonym_props="keep")


def lexicon_edges(spark, sf_dir):
    return lexicon.lexicon_edges(fixture.valid_labels(spark, sf_dir))


def lexicon_coverage(spark, sf_dir):
    return lexicon.lexicon_coverage(fixture.nodes(spark, sf_dir))


def pos_counts(spark, sf_dir):
    return lexicon.pos_counts(fixture.valid_labels(spark, sf_dir))


def sentiment_counts(spark, sf_dir):
    return lexicon.sentiment_counts(fixture.valid_labels(spark, sf_dir))


def word_sentiment(spark, sf_dir):
    return lexicon.word_sentiment(fixture.valid_labels(spark, sf_dir))


def _benchmark_words(spark, sf_dir):
    return words.text_words(table(spark, sf_dir, "benchmark"))


def lookup_words(spark, sf_dir):
    return lexicon.lookup_words(_benchmark_words(spark, sf_dir), fixture.nodes(spark, sf_dir))


def neighbours_out(spark, sf_dir):
    return lexicon.neighbours_out(_benchmark_words(spark, sf_dir), fixture.edges(spark, sf_dir), lexicon.SYNONYM)


def word_profile(spark, sf_dir):
    """Profiles of every counted or labelled word."""
    keys = fixture.vocabulary(spark, sf_dir).select("word").unionByName(fixture.nodes(spark, sf_dir).select("word"))
    return lexicon.word_profile(keys, fixture.vocabulary(spark, sf_dir),
                                lexicon.word_sentiment(fixture.valid_labels(spark, sf_dir)),
                                fixture.edges(spark, sf_dir))


def _listed(sets):
    return sets.withColumn("neighbours", F.array_join("neighbours", ", "))


def neighbour_sets(spark, sf_dir):
    return _listed(network.neighbour_sets(fixture.edges(spark, sf_dir), lexicon.SYNONYM))


def neighbour_parts(spark, sf_dir):
    """Lists of at most two words, so that many words need several."""
    return _listed(network.neighbour_sets(fixture.edges(spark, sf_dir), lexicon.ANTONYM, part_size=2))


def network_edges(spark, sf_dir):
    return network.network_edges(fixture.edges(spark, sf_dir), lexicon.SYNONYM)


def network_first_words(spark, sf_dir):
    return network.network_edges(fixture.edges(spark, sf_dir), lexicon.ANTONYM, limit=20)


def components(spark, sf_dir):
    return network.components(fixture.synonym_pairs(spark, sf_dir))


def _synonym_components(spark, sf_dir):
    return fixture.stored(spark, sf_dir, "components", lambda: components(spark, sf_dir))


def modularity(spark, sf_dir):
    found = network.modularity(fixture.synonym_pairs(spark, sf_dir), _synonym_components(spark, sf_dir), "component")
    return found.select(F.round("modularity", 9).alias("modularity"))


def themes(spark, sf_dir):
    return communities.themes(fixture.synonym_pairs(spark, sf_dir))


def antonym_components(spark, sf_dir):
    return network.components(fixture.antonym_pairs(spark, sf_dir))


def antonym_themes(spark, sf_dir):
    return communities.themes(fixture.antonym_pairs(spark, sf_dir))


def planted_components(spark, sf_dir):
    """Components of a network with a hub, chains, and cliques that are all linked."""
    return network.components(fixture.planted_pairs(spark, sf_dir))


def planted_themes(spark, sf_dir):
    """Each clique is a theme although all cliques are one component."""
    return communities.themes(fixture.planted_pairs(spark, sf_dir))


def words_missing_props(spark, sf_dir):
    return lexicon.words_missing_props(fixture.nodes(spark, sf_dir))


def _repaired(spark, sf_dir):
    """Where nodes, labels and counters are after the labels were counted and the nodes repaired; worked out once."""
    def fill(path):
        flows.count_labels(fixture.valid_labels(spark, sf_dir), path, "labels")
        nodes, labels = flows.repair(fixture.nodes(spark, sf_dir), stub_labeller, path, counter_path=path)
        written(nodes, f"{path}/repaired_nodes")
        written(labels, f"{path}/repair_labels")

    return fixture.folder(spark, sf_dir, "repair", fill)


def repair_lexicon(spark, sf_dir):
    return spark.read.schema(PROPS).parquet(f"{_repaired(spark, sf_dir)}/repaired_nodes")


def repair_counts(spark, sf_dir):
    """Parts of speech of the labels that the repair brought in."""
    return lexicon.pos_counts(spark.read.parquet(f"{_repaired(spark, sf_dir)}/repair_labels"))


def repair_pos_counts(spark, sf_dir):
    return flows.counters(spark, _repaired(spark, sf_dir))["pos_counts"]


def repair_sentiment_counts(spark, sf_dir):
    return flows.counters(spark, _repaired(spark, sf_dir))["sentiment_counts"]


def repair_word_sentiment(spark, sf_dir):
    return flows.counters(spark, _repaired(spark, sf_dir))["word_sentiment"]


def _two_runs(spark, sf_dir):
    """A stored lexicon into which two runs were written: labels whose seq is no multiple of three, then the others."""
    def fill(path):
        labels = fixture.labels(spark, sf_dir)
        flows.enrich(labelling.valid_labels(labels.where("seq % 3 <> 0")), path, "first")
        flows.enrich(labelling.valid_labels(labels.where("seq % 3 = 0")), path, "second")

    return fixture.folder(spark, sf_dir, "two-runs", fill)


def lexicon_nodes_two_runs(spark, sf_dir):
    return flows.stored_lexicon(spark, _two_runs(spark, sf_dir))["nodes"]


def lexicon_edges_two_runs(spark, sf_dir):
    return flows.stored_lexicon(spark, _two_runs(spark, sf_dir))["edges"]


def word_sentiment_two_runs(spark, sf_dir):
    return flows.stored_lexicon(spark, _two_runs(spark, sf_dir))["word_sentiment"]


def coverage_two_runs(spark, sf_dir):
    """Whether the sketches of the runs come within four standard errors of the exact number of nodes."""
    path = _two_runs(spark, sf_dir)
    exact = lexicon.lexicon_coverage(flows.node_table(path).read(spark)).select(F.col("unique_entries").alias("exact"))
    both = exact.unionByName(flows.coverage(spark, path).select(F.col("unique_entries").alias("about")), allowMissingColumns=True)
    error = F.abs(F.max("about") - F.max("exact")) / F.max("exact")
    return both.agg(F.max("exact").alias("exact"), (error < 4 * 1.04 / 2 ** (lexicon.SKETCH_BITS / 2)).alias("within"))


def lookup_words_stored(spark, sf_dir):
    """The lookup over the buckets of the keys alone."""
    keys = staged(_benchmark_words(spark, sf_dir), "lookup-keys")
    nodes = flows.node_table(_two_runs(spark, sf_dir)).rows_of(keys)
    return lexicon.lookup_words(keys, nodes)


def neighbours_out_stored(spark, sf_dir):
    keys = staged(_benchmark_words(spark, sf_dir), "lookup-keys")
    edges = flows.edge_table(_two_runs(spark, sf_dir)).rows_of(keys.withColumnRenamed("word", "src"))
    return lexicon.neighbours_out(keys, edges, lexicon.SYNONYM)


def components_two_runs(spark, sf_dir):
    """Components of the synonyms, of which the second run's came to the stored ones of the first."""
    def fill(path):
        usable = labelling.usable_words(fixture.valid_labels(spark, sf_dir))
        for part in ("seq % 3 <> 0", "seq % 3 = 0"):
            flows.grow_components(network.network_edges(lexicon.lexicon_edges(usable.where(part)), lexicon.SYNONYM), path)

    path = fixture.folder(spark, sf_dir, "grown-components", fill)
    return KeyedTable(f"{path}/components", COMPONENT, "word").read(spark)


def themes_modularity(spark, sf_dir):
    """Modularity of the planted network's themes after single words moved."""
    pairs = fixture.planted_pairs(spark, sf_dir)
    found = network.modularity(pairs, communities.themes(pairs, moving=True), "theme")
    return found.select(F.round("modularity", 9).alias("modularity"))


QUERIES = {
    query.__name__: query
    for query in (
        tokens, tokens_glued, article_words, clean_words, word_freq, word_freq_by_token, vocab_size, top_words,
        bottom_words, hapax_words, words_union, merge_counts, positive_views, csv_roundtrip, page_ids_range,
        page_fields, page_comments, forum_fields, forum_comments, page_rejects, page_titles, page_text, page_links, api_search_titles, api_page_extracts,
        pages_to_messages, stream_words, stream_word_freq, stream_csv_words, numbered_words, label_batches, label_prompts, label_rows,
        label_rows_strict, label_rejects, usable_words, valid_labels, lexicon_nodes, lexicon_nodes_keep,
        lexicon_edges, lexicon_coverage, pos_counts, sentiment_counts, word_sentiment, lookup_words, neighbours_out,
        word_profile, neighbour_sets, neighbour_parts, network_edges, network_first_words, components, modularity,
        themes, antonym_components, antonym_themes, planted_components, planted_themes, words_missing_props,
        repair_lexicon, repair_counts, repair_pos_counts, repair_sentiment_counts, repair_word_sentiment,
        lexicon_nodes_two_runs, lexicon_edges_two_runs, word_sentiment_two_runs, coverage_two_runs, lookup_words_stored,
        neighbours_out_stored, components_two_runs, themes_modularity,
    )
}
