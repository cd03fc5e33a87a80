import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from wordloom.operators import lexicon as X
from wordloom.operators.labelling import UNKNOWN
from wordloom.sources.files import rows

LABEL = "seq bigint, word string, definition string, antonym string, synonym string, pos string, sentiment double"


def labels(spark, *values):
    return rows(spark, list(values), LABEL)


def label(seq, word, synonym=UNKNOWN, antonym=UNKNOWN, definition=None, pos="kata nama", sentiment=0.0):
    return seq, word, definition or word.upper(), antonym, synonym, pos, sentiment


def replay(table, keep=False):
    """The lexicon after applying the labels one after another."""
    nodes, edges, own = {}, set(), set()
    for _, word, definition, antonym, synonym, pos, _ in sorted(table):
        nodes[word] = (definition, pos)
        own.add(word)
        if synonym not in (UNKNOWN, word):
            if not keep or synonym not in own:
                nodes[synonym] = (definition, pos)
            edges.add((word, "SYNONYM", synonym))
        if antonym not in (UNKNOWN, word):
            nodes.setdefault(antonym, (None, None))
            edges.add((word, "ANTONYM", antonym))
    return sorted((w, *p) for w, p in nodes.items()), sorted(edges)


@pytest.mark.parametrize("first, second, definition", [
    (label(1, "a", synonym="b"), label(2, "b"), "B"),
    (label(2, "a", synonym="b"), label(1, "b"), "A"),
])
def test_last_write_wins(spark, first, second, definition):
    nodes = {row.word: row.definition for row in X.lexicon_nodes(labels(spark, first, second)).collect()}
    assert nodes == {"a": "A", "b": definition}


def test_own_label_can_be_kept(spark):
    nodes = X.lexicon_nodes(labels(spark, label(2, "a", synonym="b"), label(1, "b")), synonym_props="keep")
    assert {row.word: row.definition for row in nodes.collect()} == {"a": "A", "b": "B"}


def test_antonyms_are_bare_and_self_links_are_ignored(spark):
    table = labels(spark, label(1, "a", antonym="c", synonym="a"))
    assert rows_of(X.lexicon_nodes(table)) == [("a", "A", "kata nama"), ("c", None, None)]
    assert rows_of(X.lexicon_edges(table)) == [("a", "ANTONYM", "c")]


@pytest.mark.parametrize("seed", range(4))
def test_set_operations_equal_a_sequential_replay(spark, seed):
    pick = random.Random(seed)
    names = [f"w{i}" for i in range(12)] + [UNKNOWN]
    table = [label(seq, pick.choice(names[:-1]), pick.choice(names), pick.choice(names), f"d{seq}", f"p{seq}")
             for seq in pick.sample(range(1000), 60)]
    df = labels(spark, *table).repartition(5)
    nodes, edges = replay(table)
    assert sorted(map(tuple, X.lexicon_nodes(df).collect()), key=lambda r: r[0]) == nodes
    assert sorted(map(tuple, X.lexicon_edges(df).collect())) == edges
    assert {w for s, _, d in edges for w in (s, d)} <= {row[0] for row in nodes}
    assert X.lexicon_coverage(X.lexicon_nodes(df)).first()[0] == len(nodes)


def test_counters(spark):
    table = labels(spark, label(1, "a", pos="kata kerja", sentiment=0.9), label(2, "a", pos="Kata Kerja", sentiment=-0.1),
                   label(3, "b", pos="kata kerja", sentiment=0.0), label(4, "b", sentiment=float("nan")))
    assert rows_of(X.pos_counts(table)) == [("kata kerja", 2), ("kata nama", 1), (UNKNOWN, 1)]
    assert rows_of(X.sentiment_counts(table)) == [("negative", 1), ("neutral", 2), ("positive", 1)]
    latest = {row.word: row.sentiment for row in X.word_sentiment(table.where("seq < 4")).collect()}
    assert latest == {"a": -0.1, "b": 0.0}


def test_the_valid_pos_list_has_no_repeats():
    assert len(set(X.VALID_POS)) == len(X.VALID_POS) == 23


def test_lookups(spark):
    table = labels(spark, label(1, "a", synonym="b", antonym="c"), label(2, "b"))
    nodes, edges = X.lexicon_nodes(table), X.lexicon_edges(table)
    keys = rows(spark, [("a",), ("a",), ("zz",), ("c",)], "word string")
    assert rows_of(X.lookup_words(keys, nodes)) == [("a", "A", "kata nama")] * 2 + [("c", None, None)]
    assert rows_of(X.neighbours_out(keys, edges, X.SYNONYM)) == [("a", "b")]


def test_neighbours_do_not_multiply_with_repeated_keys(spark):
    keys = rows(spark, [("hub",)] * 300, "word string")
    edges = rows(spark, [("hub", X.SYNONYM, f"w{i}") for i in range(300)], "src string, rel string, dst string")
    assert X.neighbours_out(keys, edges, X.SYNONYM).count() == 300


def test_profile_of_known_and_unknown_words(spark):
    table = labels(spark, label(1, "a", "b", "c", sentiment=0.5), label(2, "a", "d"), label(3, "a", "e"))
    freq = rows(spark, [("a", 7)], "word string, frequency bigint")
    keys = rows(spark, [("a",), ("zz",)], "word string")
    profile = X.word_profile(keys, freq, X.word_sentiment(table), X.lexicon_edges(table))
    assert rows_of(profile) == [("a", 0, 7, 0.0, "b, d, e", "c"), ("zz", 0, 0, None, "", "")]
    parts = X.word_profile(keys, freq, X.word_sentiment(table), X.lexicon_edges(table), part_size=2)
    assert rows_of(parts) == [("a", 0, 7, 0.0, "b, d", "c"), ("a", 1, 7, 0.0, "e", ""), ("zz", 0, 0, None, "", "")]


def test_repair(spark):
    nodes = rows(spark, [("a", None, None), ("b", "B", "p"), ("c", None, None)], "word string, definition string, pos string")
    found = labels(spark, label(1, "a", definition="old"), label(2, "a", definition="new"), label(3, "nowhere"))
    assert rows_of(X.words_missing_props(nodes)) == [("a",), ("c",)]
    repaired = X.repair_lexicon(nodes, found)
    assert rows_of(repaired) == [("a", "new", "kata nama"), ("b", "B", "p"), ("c", None, None)]
    assert rows_of(X.words_missing_props(repaired)) == [("c",)]
    # The label of an unknown word changes no node but is still counted.
    assert X.pos_counts(found).select(F.sum("n")).first()[0] == 3
