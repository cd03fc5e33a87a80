from tests.conftest import rows_of
from tests.test_pages import FORUM, pages
from wordloom.operators import lexicon
from wordloom.plans import flows
from wordloom.plans.stub import stub_labeller
from wordloom.sources.files import rows
from wordloom.sources.workspace import new_path


def test_from_pages_to_a_repaired_lexicon(spark):
    path = new_path(spark, "flow")
    for _ in range(2):  # a rerun replaces every table
        articles, comments = flows.collect_articles(pages(spark, FORUM), path)
        streamed = rows(spark, [("Hari",), ("bulan",)], "word string")
        freq = flows.build_vocabulary(articles, comments, streamed, path)
    # The title keeps its words apart, the ampersand is no letter, and both comments are counted.
    assert rows_of(freq) == sorted([
        ("a", 1), ("b", 1), ("bulan", 1), ("comment", 1), ("hari", 1), ("hariinihujanlagi", 1), ("no", 1), ("text", 1),
        ("textmore", 1)])
    labels, rejects = flows.label_words(freq, stub_labeller, path, batch_size=4)
    assert labels.count() + rejects.count() == freq.count()
    tables = flows.enrich(labels, path)
    names = {row.word for row in tables["nodes"].collect()}
    assert {"a", "b", "hari"} <= names
    assert {row.src for row in tables["edges"].collect()} | {row.dst for row in tables["edges"].collect()} <= names
    missing = lexicon.words_missing_props(tables["nodes"]).count()
    assert missing > 0
    before = {name: rows_of(tables[name]) for name in ("pos_counts", "sentiment_counts", "word_sentiment")}
    for _ in range(2):  # a rerun adds nothing to the counters
        repaired, found = flows.repair(tables["nodes"], stub_labeller, new_path(spark, "repair"), counter_path=path)
        after = flows.counters(spark, path)
        assert sum(n for _, n in rows_of(after["pos_counts"])) == sum(n for _, n in before["pos_counts"]) + found.count()
        assert sum(n for _, n in rows_of(after["sentiment_counts"])) == sum(n for _, n in before["sentiment_counts"]) + found.count()
        sentiments = dict(before["word_sentiment"]) | {r.word: r.sentiment for r in found.collect()}
        assert dict(rows_of(after["word_sentiment"])) == sentiments
    assert lexicon.words_missing_props(repaired).count() == missing - found.count()
    assert repaired.count() == tables["nodes"].count()


def test_labels_overwrite_in_batch_order(spark):
    freq = rows(spark, [("a", 1), ("b", 1), ("c", 1)], "word string, frequency bigint")
    labels, _ = flows.label_words(freq, lambda batch: "\n".join(
        f'{w},"def {w}",tidak diketahui,{"c" if w != "c" else "a"},kata nama,0.5' for w in batch), new_path(spark, "labels"),
        batch_size=1)
    nodes = {row.word: row.definition for row in lexicon.lexicon_nodes(labels).collect()}
    assert nodes == {"a": "def c", "b": "def b", "c": "def c"}
