"""Batch labelling of words by a pluggable labeller, and parsing of its answers.

A labeller is any callable ``list[str] -> str`` that returns CSV text with the six label fields.
"""

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions import text as X
from wordloom.schemas import LABEL_FIELDS

Labeller = Callable[[list[str]], str]

_LISTS_AT_ONCE = 256

# The header the model is asked to repeat, its code fence and the "unknown" marker.
RESPONSE_HEADER = '"word","definition","antonym","synonym","tatabahasa","sentiment"'
FENCE = "```"
UNKNOWN = "tidak diketahui"
UNUSABLE_MARKERS = ("tidak diketahui", "nama")

PROMPT = (
    "For each word below write one CSV row in Malay with the columns\n"
    + RESPONSE_HEADER
    + "\nQuote every value; sentiment lies between -1.0 and 1.0; write "
    + f'"{UNKNOWN}" where there is no antonym or synonym.\nWords: '
)


def word_lists(batches: DataFrame) -> DataFrame:
    """``(batch_id, words)``; a batch is bounded by the batch size, so its list is too."""
    return batches.groupBy("batch_id").agg(F.sort_array(F.collect_list("word")).alias("words"))


def prompts(batches: DataFrame, template: str = PROMPT) -> DataFrame:
    text = F.concat(F.lit(template), F.array_join("words", ", "))
    return word_lists(batches).select("batch_id", text.alias("prompt"))


def unanswered(batches: DataFrame, answers: DataFrame | None) -> DataFrame:
    """``(batch_id, words)`` of the batches without an answer so far; those that failed are asked again."""
    lists = word_lists(batches)
    if answers is None:
        return lists
    return lists.join(answers.where("error IS NULL").select("batch_id"), "batch_id", "left_anti")


def responses(lists: DataFrame, labeller: Labeller, calls_at_once: int = 64, tasks: int = 8, retries: int = 2,
              wait: float = 1.0) -> DataFrame:
    """``(batch_id, response, error)``: one labeller call per batch of ``(batch_id, words)``, on executors.

    The batches are dealt evenly to ``tasks`` tasks, however few bytes they have; each has a pool of threads for its
    share of ``calls_at_once``, so waiting calls hold one core a task and not one each. A call that fails is made again up
    to ``retries`` times, after ``wait`` seconds, then twice that, and so on; the last error stands instead of a response
    and does not disturb the others. Calls are slow and may cost money, so callers write the result to a table before
    parsing it. A task holds the words and answers of at most ``_LISTS_AT_ONCE`` batches as Python objects.
    """
    def answer(batch) -> tuple[str | None, str | None]:
        for attempt in range(retries + 1):
            try:
                return labeller(list(batch)), None
            except Exception as problem:  # one call must not repeat the others
                error = f"{type(problem).__name__}: {problem}"
            if attempt < retries:
                time.sleep(wait * 2 ** attempt)
        return None, error

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(max(1, calls_at_once // tasks)) as pool:
            for part in (whole.slice(start, _LISTS_AT_ONCE) for whole in batches for start in range(0, whole.num_rows, _LISTS_AT_ONCE)):
                response, error = zip(*pool.map(answer, part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(response, pa.string()), pa.array(error, pa.string())],
                                                 ["batch_id", "response", "error"])

    # By a hash of its own: an exchange by the same column and number would be left out, and the one before it coalesced.
    dealt = lists.select("batch_id", "words").repartition(tasks, F.xxhash64("batch_id", F.lit(tasks)))
    return dealt.mapInArrow(call, "batch_id bigint, response string, error string")


def response_lines(answers: DataFrame) -> DataFrame:
    """``(batch_id, line_no, line)`` without code fences and header; line numbers ascend within an answer."""
    bare = F.replace("response", F.lit(FENCE), F.lit(""))
    bare = F.replace(bare, F.lit(RESPONSE_HEADER + "\n"), F.lit(""))
    lines = answers.select("batch_id", F.posexplode(F.split(X.strip_text(bare), "\n")).alias("line_no", "line"))
    # A header that was not followed by a plain newline is still the first line.
    return lines.where(~((F.col("line_no") == 0) & F.col("line").startswith('"word"')))


def parse_lines(lines: DataFrame, strict: bool = False) -> DataFrame:
    """The label fields of each line as text plus ``malformed``; other columns pass through.

    The default reads quoted CSV, so a comma inside quotes is part of the value. ``strict=True`` splits at every
    comma. Either way a line without exactly six fields is malformed. Quotes around values are removed and empty
    values become null.
    """
    if strict:
        parts = F.split("line", ",")
        raw = [F.get(parts, F.lit(i)) for i in range(len(LABEL_FIELDS))]
        parsed = lines.select("*", *[c.alias(n) for c, n in zip(raw, LABEL_FIELDS)],
                              (F.size(parts) != len(LABEL_FIELDS)).alias("malformed"))
    else:
        schema = ", ".join(f"{n} string" for n in (*LABEL_FIELDS, "bad"))
        options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"}
        # A generator, so that each line is parsed once and not once per field.
        parsed = lines.select("*", F.inline(F.array(F.from_csv("line", F.lit(schema), options))))
        parsed = parsed.withColumn("malformed", F.col("bad").isNotNull() | (F.col("line") == "")).drop("bad")
    clean = {n: F.nullif(X.strip_quotes(F.col(n)), F.lit("")) for n in LABEL_FIELDS}
    return parsed.withColumns(clean)


def checked_labels(parsed: DataFrame) -> DataFrame:
    """Adds ``reason``: why a line cannot enter the lexicon, or null. ``sentiment`` becomes a double."""
    malformed = F.col("malformed") if "malformed" in parsed.columns else F.lit(False)
    missing = F.lit(False)
    for name in LABEL_FIELDS:
        missing = missing | F.col(name).isNull()
    number = X.parsed_number(F.col("sentiment"))
    reason = (
        F.when(malformed, "field_count").when(missing, "missing_field").when(number.isNull(), "sentiment")
    )
    return parsed.withColumns({"reason": reason, "sentiment": number}).drop("malformed")


def well_formed(parsed: DataFrame) -> DataFrame:
    return parsed.where(~F.col("malformed")).drop("malformed")


def valid_labels(parsed: DataFrame) -> DataFrame:
    return checked_labels(parsed).where("reason IS NULL").drop("reason")


def label_counts(reason: str = "reason") -> list[Column]:
    """Rows, labels and rejects by reason, to be observed in the pass that writes checked labels."""
    rejects = [F.count_if(F.coalesce(F.col(reason) == name, F.lit(False))).alias(name) for name in ("field_count", "missing_field", "sentiment")]
    return [F.count(F.lit(1)).alias("lines"), F.count_if(F.col(reason).isNull()).alias("labels"), *rejects]


def rejected_labels(parsed: DataFrame) -> DataFrame:
    return checked_labels(parsed).where("reason IS NOT NULL")


def usable_words(labels: DataFrame, markers: tuple[str, ...] = UNUSABLE_MARKERS) -> DataFrame:
    """Rows where at least one of definition, antonym and synonym contains none of the markers."""
    keep = F.lit(False)
    for name in ("definition", "antonym", "synonym"):
        free = F.lit(True)
        for marker in markers:
            free = free & ~F.lower(name).contains(marker)
        keep = keep | F.coalesce(free, F.lit(False))
    return labels.where(keep)


def parsed_answers(answers: DataFrame, strict: bool = False) -> DataFrame:
    """Raw answers to parsed label lines."""
    return parse_lines(response_lines(answers.where("error IS NULL")), strict)
