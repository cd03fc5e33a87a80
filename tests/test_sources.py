import json

import pytest

from tests.conftest import rows_of
from wordloom import schemas
from wordloom.sources import files, messages
from wordloom.sources.workspace import new_path, shared_dir, spread, staged


def test_csv_keeps_quotes_line_breaks_and_outer_spaces(spark):
    df = files.rows(spark, [(1, 'say "hi", ok\nnext', " x "), (2, None, "back\\slash"), (3, "\r\n", 'a""b')],
                    "id int, text string, more string")
    path = new_path(spark, "csv")
    files.write_csv(df, path)
    assert rows_of(files.read_csv(spark, path, df.schema)) == rows_of(df)
    files.write_csv(df, path)
    assert files.read_csv(spark, path, df.schema).count() == 3


def test_plain_csv(spark):
    df = files.rows(spark, [("a,b", "c"), ("d", None)], "x string, y string")
    path = new_path(spark, "csv")
    files.write_plain_csv(df, path)
    assert rows_of(files.read_csv(spark, path, df.schema)) == rows_of(df)


def test_rows_may_be_empty(spark):
    assert files.rows(spark, [], schemas.ARTICLE).count() == 0


def test_id_range_is_half_open(spark):
    ids = sorted(row[0] for row in files.id_range(spark, 100, 300).collect())
    assert (ids[0], ids[-1], len(ids)) == (100, 299, 200)


def test_ids_asked_for_and_stored(spark):
    stored = files.rows(spark, [(0,), (7,), (7,), (5_000_000_000,), (-3,), (None,), (2**62,)], "page_id bigint")
    assert rows_of(files.id_coverage(stored, 6, 9)) == sorted([
        (6, True, False), (7, True, True), (7, True, True), (8, True, False), (0, False, True), (-3, False, True),
        (5_000_000_000, False, True), (2**62, False, True)], key=lambda r: [(v is not None, str(v)) for v in r])
    assert rows_of(files.in_id_range(stored, 0, 8)) == [(0,), (7,), (7,)]


def test_counts_of_a_repeated_run_are_stored_once(spark):
    path = new_path(spark, "counts")
    assert files.read_counts(spark, path).count() == 0
    first = files.rows(spark, [("a", 1), ("b", 2)], "word string, frequency bigint")
    second = files.rows(spark, [("b", 5), ("c", 1)], "word string, frequency bigint")
    files.write_counts(first, path, "2024-01-01")
    for _ in range(2):
        files.write_counts(second, path, "2024-01-02")
    assert rows_of(files.read_counts(spark, path)) == [("a", 1), ("b", 7), ("c", 1)]


def test_messages_round_trip_and_bad_messages(spark):
    pages = files.rows(spark, [("t", 'line\n"q" é'), ("u", None)], schemas.MESSAGE)
    encoded = messages.to_messages(pages)
    assert json.loads(encoded.first().value) == {"Title": "t", "Content": 'line\n"q" é'}
    assert rows_of(messages.from_messages(encoded)) == rows_of(pages)
    bad = files.rows(spark, [("junk",), (None,), ('{"Title":"x"}',)], "value string")
    assert rows_of(messages.from_messages(bad)) == [(None, None), (None, None), ("x", None)]


def test_search_titles_keep_order_and_limit(spark):
    answer = json.dumps({"query": {"search": [{"title": f"t{i}", "size": i} for i in range(130)]}})
    df = files.rows(spark, [(7, answer), (8, '{"query": {}}'), (9, "junk")], "response_id int, response string")
    found = messages.search_titles(df).orderBy("position").collect()
    assert [row.title for row in found] == [f"t{i}" for i in range(130)]
    first = messages.search_titles(df, limit=100).orderBy("position").collect()
    assert [row.title for row in first] == [f"t{i}" for i in range(100)]
    assert messages.search_titles(df, limit=2).count() == 2


def test_page_extracts(spark):
    answer = json.dumps({"query": {"pages": {"1": {"title": "a", "extract": "x"}, "2": {"title": "b"}}}})
    df = files.rows(spark, [(answer,), ('{"query": {}}',)], "response string")
    assert rows_of(messages.page_extracts(df)) == [("a", "x")]


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        messages.kafka_stream(spark, "localhost:9092", "topic")


def test_workspace(spark):
    assert new_path(spark, "x") != new_path(spark, "x")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured.rstrip("/")
    df = spark.range(10)
    assert sorted(r[0] for r in staged(df, "r").collect()) == list(range(10))
    assert spread(spark.range(0, 10, 1, 1)).rdd.getNumPartitions() == 8
    assert spread(spark.range(0, 100, 1, 20)).rdd.getNumPartitions() == 20
