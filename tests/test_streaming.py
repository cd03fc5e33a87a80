import json

import pytest

from tests.conftest import rows_of
from wordloom.operators.words import word_freq
from wordloom.sources.files import read_csv, rows
from wordloom.sources.messages import file_stream, write_message_files
from wordloom.sources.runs import RunLog
from wordloom.sources.workspace import new_path
from wordloom.streaming import words as S


def message(content):
    return json.dumps({"Title": "t", "Content": content})


def write_messages(spark, path, *contents):
    df = rows(spark, [(message(c),) for c in contents] + [("junk",), (None,), ('{"Title":"x"}',)], "value string")
    df.write.mode("append").text(path)


def test_stream_equals_batch_over_several_batches(spark):
    path, out, checkpoint = (new_path(spark, n) for n in ("messages", "words", "checkpoint"))
    for i in range(3):
        write_messages(spark, path, f"Saya suka nasi {'ya ' * i}", "Café")
    stream = S.message_words(file_stream(spark, path, max_files=1))
    counts = new_path(spark, "counts")
    S.write_stream(stream, checkpoint, S.word_sink(out), S.count_sink(counts)).awaitTermination()
    batch = S.message_words(spark.read.schema("value string").text(path))
    assert rows_of(spark.read.parquet(out).select("word")) == rows_of(batch)
    assert rows_of(S.read_counts(spark, counts)) == rows_of(word_freq(batch))


def test_restart_continues_and_replays_nothing(spark):
    path, out, checkpoint = (new_path(spark, n) for n in ("messages", "words", "checkpoint"))

    def run():
        stream = S.message_words(file_stream(spark, path))
        S.write_stream(stream, checkpoint, S.word_sink(out)).awaitTermination()
        return sorted(row[0] for row in spark.read.parquet(out).select("word").collect())

    write_messages(spark, path, "satu dua")
    assert run() == ["dua", "satu"]
    assert run() == ["dua", "satu"]
    write_messages(spark, path, "tiga")
    assert run() == ["dua", "satu", "tiga"]


def test_counts_of_a_replayed_batch_are_not_added_twice(spark):
    path = new_path(spark, "counts")
    sink = S.count_sink(path)
    batch = rows(spark, [("a",), ("a",), ("b",)], "word string")
    for batch_id in (0, 0, 1):
        sink(batch, batch_id)
    assert rows_of(S.read_counts(spark, path)) == [("a", 4), ("b", 2)]


def test_running_counts_continue_with_new_messages(spark):
    path, counts, checkpoint = (new_path(spark, n) for n in ("messages", "counts", "checkpoint"))
    write_messages(spark, path, "satu dua")
    assert rows_of(S.stream_word_freq(spark, file_stream(spark, path), counts, checkpoint)) == [("dua", 1), ("satu", 1)]
    write_messages(spark, path, "dua")
    assert rows_of(S.stream_word_freq(spark, file_stream(spark, path), counts, checkpoint)) == [("dua", 2), ("satu", 1)]


def test_csv_and_console_sinks(spark, capfd):
    path, out, checkpoint = (new_path(spark, n) for n in ("messages", "csv", "checkpoint"))
    write_message_files(rows(spark, [(message("satu dua"),)], "value string"), path)
    S.csv_stream(S.message_words(file_stream(spark, path)), out, checkpoint).awaitTermination()
    assert rows_of(read_csv(spark, out, "word string")) == [("dua",), ("satu",)]
    S.console_stream(S.message_words(file_stream(spark, path))).awaitTermination()
    S.console_sink()(rows(spark, [("tiga",)], "word string"), 0)
    assert "tiga" in capfd.readouterr().out


def test_folding_changes_no_count_and_may_be_repeated(spark):
    path = new_path(spark, "counts")
    sink = S.count_sink(path)
    batches = [["a", "a", "b"], ["b"], ["c"], ["a"]]
    for batch_id, words in enumerate(batches[:3]):
        sink(rows(spark, [(w,) for w in words], "word string"), batch_id)
    wanted = [("a", 2), ("b", 2), ("c", 1)]
    for _ in range(3):
        S.fold_counts(spark, path)
        assert rows_of(S.read_counts(spark, path)) == wanted
    sink(rows(spark, [("a",), ("a",)], "word string"), 1)  # a replay of a folded batch counts no more
    sink(rows(spark, [("a",)], "word string"), 3)
    assert rows_of(S.read_counts(spark, path)) == [("a", 3), ("b", 2), ("c", 1)]


def test_folds_along_a_stream(spark):
    path, counts, checkpoint = (new_path(spark, n) for n in ("messages", "counts", "checkpoint"))
    for i in range(5):
        write_messages(spark, path, f"satu {'dua ' * i}")
    stream = file_stream(spark, path, max_files=1)
    found = S.stream_word_freq(spark, stream, counts, checkpoint, fold_every=2)
    assert rows_of(found) == [("dua", 10), ("satu", 5)]
    assert len(RunLog(spark, counts, "word string, frequency bigint").segments()) <= 3


def test_rows_are_counted_on_the_way_to_the_sinks(spark):
    path, out, counts, checkpoint = (new_path(spark, n) for n in ("messages", "words", "counts", "checkpoint"))
    for i in range(3):
        write_messages(spark, path, "satu dua " * (i + 1))
    stream = S.message_words(file_stream(spark, path, max_files=1))
    query = S.write_stream(stream, checkpoint, S.word_sink(out), S.count_sink(counts))
    query.awaitTermination()
    seen = S.rows_seen(query)
    stored = spark.read.schema("word string, run_id bigint").parquet(out).groupBy("run_id").count()
    assert {k: n for k, n in seen.items() if n} == dict(rows_of(stored)) and sum(seen.values()) == 12


def test_a_sink_that_fails_leaves_nothing_in_memory(spark):
    path, checkpoint = new_path(spark, "messages"), new_path(spark, "checkpoint")
    write_messages(spark, path, "satu")

    def broken(batch, batch_id):
        batch.count()
        raise OSError("gone")

    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    query = S.write_stream(S.message_words(file_stream(spark, path)), checkpoint, broken, broken)
    with pytest.raises(Exception, match="gone"):
        query.awaitTermination()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
