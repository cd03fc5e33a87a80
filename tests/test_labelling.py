import tempfile
import time
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from wordloom.operators import labelling as L
from wordloom.operators.numbering import batches
from wordloom.plans import flows
from wordloom.plans.stub import stub_labeller
from wordloom.sources.files import rows
from wordloom.sources.workspace import new_path, staged

EXAMPLE = '"pohon","tumbuhan tinggi, berbatang keras","rumput","pokok","kata nama","0.0"'


def lines(spark, *values):
    return rows(spark, [(v,) for v in values], "line string")


def test_quoted_commas_are_part_of_the_value(spark):
    parsed = L.well_formed(L.parse_lines(lines(spark, EXAMPLE))).drop("line")
    assert rows_of(parsed) == [
        ("pohon", "tumbuhan tinggi, berbatang keras", "rumput", "pokok", "kata nama", "0.0")]
    strict = L.parse_lines(lines(spark, EXAMPLE, "a,b,c,d,e,0.1"), strict=True)
    assert [row.word for row in L.well_formed(strict).collect()] == ["a"]


@pytest.mark.parametrize("line", ["a,b,c,d,e", "a,b,c,d,e,f,g", "", "free text"])
@pytest.mark.parametrize("strict", [False, True])
def test_other_field_counts_are_malformed(spark, line, strict):
    assert L.parse_lines(lines(spark, line), strict).first().malformed


def test_quotes_go_and_empty_values_are_null(spark):
    parsed = L.parse_lines(lines(spark, '"a","","c","d","e","0.1"', '"a","say ""x""","c","d","e","0.1"'))
    assert [row.definition for row in parsed.collect()] == [None, 'say "x']


def test_rejects_have_reasons(spark):
    parsed = L.parse_lines(lines(spark, EXAMPLE, "a,b", "a,b,c,d,e,n/a", 'a,"",c,d,e,0.1', "a,b,c,d,e,NaN"))
    reasons = sorted(row.reason for row in L.rejected_labels(parsed).collect())
    assert reasons == ["field_count", "missing_field", "sentiment", "sentiment"]
    assert [(row.word, row.sentiment) for row in L.valid_labels(parsed).collect()] == [("pohon", 0.0)]


@pytest.mark.parametrize("definition, antonym, synonym, usable", [
    (None, None, None, False),
    ("kata nama khas", None, "Tidak Diketahui", False),
    ("dinamakan", None, None, False),
    ("rasa senang", "tidak diketahui", "tidak diketahui", True),
    (None, None, "gembira", True),
])
def test_usable(spark, definition, antonym, synonym, usable):
    df = rows(spark, [(definition, antonym, synonym)], "definition string, antonym string, synonym string")
    assert (L.usable_words(df).count() == 1) is usable


def test_response_lines_drop_fence_and_header(spark):
    header = L.RESPONSE_HEADER
    answers = rows(spark, [(0, f"```\n{header}\na,b\nc,d\n```"), (1, f"{header} \r\ne,f\n"), (2, "g,h")],
                   "batch_id int, response string")
    lines = L.response_lines(answers).orderBy("batch_id", "line_no").select("batch_id", "line")
    assert [tuple(r) for r in lines.collect()] == [(0, "a,b"), (0, "c,d"), (1, "e,f"), (2, "g,h")]


def test_prompts_list_the_words(spark):
    df = rows(spark, [(0, "b"), (0, "a"), (1, "c")], "batch_id bigint, word string")
    assert rows_of(L.prompts(df, "W: ")) == [(0, "W: a, b"), (1, "W: c")]
    assert "a, b" in L.prompts(df).orderBy("batch_id").first().prompt


def numbered(spark, count):
    return batches(spark.range(count).select(F.format_string("kata%04d", "id").alias("word")))


def test_calls_are_spread_and_made_once(spark):
    """Tasks follow the stated number, not the few bytes of the batches."""
    calls, tasks = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def labeller(batch):
        calls.add(1)
        assert len(batch) <= 80
        return stub_labeller(batch)

    lists = L.word_lists(numbered(spark, 3200))
    answers = staged(L.responses(lists, labeller, calls_at_once=16).withColumn("task", F.spark_partition_id()), "answers")
    assert calls.value == answers.count() == 40
    per_task = [r["count"] for r in answers.groupBy("task").count().collect()]
    assert len(per_task) > 4 and max(per_task) <= 15
    parsed = L.parsed_answers(answers)
    assert L.well_formed(parsed).select("word").distinct().count() == 3200
    assert L.rejected_labels(parsed).count() == 0


def test_a_failing_call_leaves_the_others_alone(spark):
    def labeller(batch):
        if "kata0100" in batch:
            raise TimeoutError("no answer")
        return stub_labeller(batch)

    answers = staged(L.responses(L.word_lists(numbered(spark, 400)), labeller, wait=0.01), "answers")
    assert [r.error for r in answers.collect() if r.error] == ["TimeoutError: no answer"]
    assert L.well_formed(L.parsed_answers(answers)).count() == 320


def test_a_rerun_asks_only_for_what_has_no_answer(spark):
    path, calls, broken = new_path(spark, "labels"), spark.sparkContext.accumulator(0), {"kata0100"}
    words = spark.range(400).select(F.format_string("kata%04d", "id").alias("word"))

    def labeller_that_fails_on(some):
        def labeller(batch):
            calls.add(1)
            if some & set(batch):
                raise TimeoutError("no answer")
            return stub_labeller(batch)

        return labeller

    labels, rejects = flows.label_words(words, labeller_that_fails_on(broken), path)
    assert calls.value == 4 + 3 and labels.count() == 320  # a failing call is made three times
    assert rows_of(rejects.select("reason", "line")) == [("call", "TimeoutError: no answer")]
    labels, rejects = flows.label_words(words, labeller_that_fails_on(set()), path)
    assert calls.value == 8 and labels.count() == 400 and rejects.count() == 0
    labels, _ = flows.label_words(words, labeller_that_fails_on(set()), path)
    assert calls.value == 8 and labels.count() == 400


def test_one_new_word_costs_one_call(spark):
    path, asked = new_path(spark, "labels"), spark.sparkContext.accumulator(0)

    def labeller(batch):
        asked.add(1)
        return stub_labeller(batch)

    words = spark.range(1, 801).select(F.format_string("kata%04d", "id").alias("word"))
    before = flows.label_words(words, labeller, path)[0].drop("seq")
    wanted = rows_of(before)
    assert asked.value == 10
    more = words.unionByName(rows(spark, [("aaa",)], "word string"))  # in front of all others
    labels, _ = flows.label_words(more, labeller, path)
    assert asked.value == 11
    assert rows_of(labels.drop("seq")) == sorted([*wanted, *rows_of(L.valid_labels(L.parsed_answers(
        rows(spark, [(10, stub_labeller(["aaa"]), None)], "batch_id bigint, response string, error string"))).select(*L.LABEL_FIELDS))],
        key=lambda row: [(v is not None, str(v)) for v in row])
    stored = spark.read.parquet(f"{path}/batches")
    assert sorted(r[0] for r in stored.select("batch_id").distinct().collect()) == list(range(11))
    assert stored.count() == stored.select("word").distinct().count() == 801
    # A part of the vocabulary gets the labels of its batches and asks for nothing.
    part, _ = flows.label_words(words.where("word < 'kata0081'"), labeller, path)
    assert asked.value == 11 and part.count() == 80


def test_calls_that_wait_share_a_task(spark):
    """64 calls of half a second in 8 tasks of 8 threads take the time of few, not of 64 on 8 cores."""
    def slow(batch):
        time.sleep(0.5)
        return stub_labeller(batch)

    lists = staged(L.word_lists(numbered(spark, 64 * 80)), "lists")
    staged(L.responses(lists, stub_labeller), "answers")  # starts the workers
    start = time.perf_counter()
    plain = len(staged(L.responses(lists, stub_labeller), "answers").collect())
    usual = time.perf_counter() - start
    start = time.perf_counter()
    waited = len(staged(L.responses(lists, slow), "answers").collect())
    assert plain == waited == 64 and time.perf_counter() - start - usual < 0.5 * 64 / 8


def test_a_call_is_made_again_before_it_counts_as_failed(spark):
    seen = spark.sparkContext.accumulator(0)

    def labeller(batch):
        seen.add(1)
        flag = Path(tempfile.gettempdir()) / marker
        if not flag.exists():
            flag.touch()
            raise TimeoutError("once")
        return stub_labeller(batch)

    marker = f"run-{uuid.uuid4().hex}"
    answers = staged(L.responses(L.word_lists(numbered(spark, 10)), labeller, wait=0.01), "answers")
    assert seen.value == 2 and [r.error for r in answers.collect()] == [None]


def test_a_task_holds_a_bounded_number_of_answers(spark):
    """The worker's memory while 2,400 answers of 200,000 characters pass through one task."""
    def labeller(words):
        rss = int(Path("/proc/self/statm").read_text().split()[1]) * 4096
        return f"{rss} " + "x" * 200_000

    found = L.responses(spark.range(2400).selectExpr("id AS batch_id", "array('a') AS words"), labeller, tasks=1)
    used = [int(r.rss) for r in found.select(F.split("response", " ")[0].alias("rss")).collect()]
    assert len(used) == 2400 and max(used) - min(used) < 300_000_000
