"""Which sources of a language use its words differently: smoothed shares of every common term, compared pair by pair.

The vocabulary of a language is put in an order that brings terms of equal counts together: terms with the same counts in
all sources become one run, and runs are sorted by their counts. Each source is then a run-length column over that order;
a pair of sources intersects the borders of its two columns and takes each difference times the length of its run.
"""

from collections import Counter, defaultdict
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.common import byte_texts, texts as strings, word_blocks
from wordloom.operators.numbering import number_rows
from wordloom.sources.workspace import staged

SCALE_DIGITS, DIGIT = 3, 1000  # shares are whole numbers of a thousand millionth: three digits of base 1,000
PRIOR = 5

#: Letters A-Z are lower-cased, other ASCII characters become spaces, bytes of all other characters stay.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

_ENTRIES = 100_000
_CELLS = 1 << 17
_STRIPE = 256
_BROADCAST_ROWS = 100_000


def _named(documents: DataFrame) -> DataFrame:
    def name(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit("")).alias(column)

    return documents.select(name("lang"), name("source"), "text")


def term_counts(documents: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences, and documents with the term; a term may come in several rows.

    A task counts its documents together and passes the counts on whenever it holds ``_ENTRIES`` of them.
    """
    schema = "lang string, source string, term string, n bigint, docs bigint"

    def count(batches):
        seen: dict[tuple[str, str], Counter] = defaultdict(Counter)
        holders: dict[tuple[str, str], Counter] = defaultdict(Counter)

        def rows():
            for (lang, source), counted in seen.items():
                with_term = holders[lang, source]
                terms = list(counted)
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()),
                    pa.array(terms, pa.binary()).cast(pa.string()), pa.array(counted.values(), pa.int64()),
                    pa.array([with_term[t] for t in terms], pa.int64())], names=["lang", "source", "term", "n", "docs"])
            seen.clear()
            holders.clear()

        for batch in batches:
            for lang, source, text in zip(strings(batch.column(0)), strings(batch.column(1)), byte_texts(batch.column(2))):
                if not text:
                    continue
                own: set[bytes] = set()
                for block in word_blocks(text.translate(_TERM_BYTES)):
                    seen[lang, source].update(block)
                    own.update(block)
                holders[lang, source].update(own)
                if sum(map(len, seen.values())) >= _ENTRIES:
                    yield from rows()
        yield from rows()

    return _named(documents).mapInArrow(count, schema)


def vocabulary(counts: DataFrame, least_documents: int) -> DataFrame:
    """``(lang, term, total, counts)``: the terms in enough documents of their language, with their count in each source.

    Counts arrive added up by task, so they are dealt by term at once, and both sums use that one exchange. The list has at
    most one entry for each source of the language.
    """
    dealt = counts.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    listed = F.sort_array(F.collect_list(F.struct("source", "n"))).alias("counts")
    whole = dealt.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), listed)
    return whole.where(F.col("docs") >= least_documents).drop("docs")


def source_totals(documents: DataFrame, kept: DataFrame) -> DataFrame:
    """``(lang, source, place, size, terms, lang_size, sources)`` of every source that occurs.

    ``size`` adds up the counts of its kept terms and ``terms`` counts those of the language; ``place`` numbers the
    sources of a language from 0 by name, ``sources`` says how many there are.
    """
    named = _named(documents).select("lang", "source").distinct()
    sizes = kept.select("lang", F.explode("counts").alias("c")).groupBy("lang", "c.source").agg(F.sum("c.n").alias("size"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("lang_size"))
    by_lang = Window.partitionBy("lang")
    return named.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", (F.row_number().over(by_lang.orderBy("source")) - 1).alias("place"),
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("size", "terms", "lang_size")],
        F.count("*").over(by_lang).alias("sources"))


def share(count: str, size: str, terms: str) -> str:
    """SQL of ``1 + floor(10^9 * (count + 5) / (size + 5 * terms))``, exact: long division, three decimal digits at a time.

    No step exceeds a thousand times the denominator, so bigint holds for sizes up to 9 * 10^15.
    """
    below, rest, quotient = f"({size} + {PRIOR} * {terms})", f"({count} + {PRIOR})", "0"
    for _ in range(SCALE_DIGITS):
        quotient = f"({quotient} * {DIGIT} + {rest} * {DIGIT} div {below})"
        rest = f"({rest} * {DIGIT} % {below})"
    return f"1 + {quotient}"


def shares(counts: np.ndarray, size: int, terms: int) -> np.ndarray:
    """The same as :func:`share`, for an array of counts of one source."""
    below, rest, quotient = size + PRIOR * terms, counts + PRIOR, 0
    for _ in range(SCALE_DIGITS):
        quotient, rest = quotient * DIGIT + rest * DIGIT // below, rest * DIGIT % below
    return 1 + quotient


def _small(table: DataFrame) -> DataFrame:
    """A hint to broadcast a table that was counted to be small; larger ones are joined by a shuffle."""
    return F.broadcast(table) if table.count() <= _BROADCAST_ROWS else table


def leading_terms(kept: DataFrame, sources: DataFrame, most: int) -> DataFrame:
    """The terms that a source uses more than its language does, the ``most`` largest differences of each source."""
    entries = kept.select("lang", "term", "total", F.explode("counts").alias("c")).select("lang", "term", "total", "c.source", "c.n")
    both = entries.join(_small(sources), ["lang", "source"]).select(
        "lang", "source", "term", F.expr(share("n", "size", "terms")).alias("p"), F.expr(share("total", "lang_size", "terms")).alias("q"))
    ahead = both.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return ahead.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def run_blocks(kept: DataFrame, sources: DataFrame, cells: int = _CELLS) -> DataFrame:
    """``(lang, block, run, length, counts)``: the reordered vocabulary as runs of terms with equal counts in all sources.

    Runs are sorted by their counts, so neighbours mostly differ in few sources. A block has so many runs that it is at
    most ``cells`` counts with all sources of the language, and at least one run.
    """
    runs = kept.groupBy("lang", "counts").agg(F.count("*").alias("length"))
    numbered = staged(number_rows(runs, "lang", "counts", name="n"), "runs")
    first = numbered.groupBy("lang").agg(F.min("n").alias("first"))
    langs = sources.groupBy("lang").agg(F.count("*").alias("sources")).join(first, "lang")
    place = F.col("n") - F.col("first")
    per_block = F.greatest(F.lit(1), F.floor(F.lit(cells) / F.col("sources"))).cast("bigint")
    return numbered.join(_small(langs), "lang").select(
        "lang", F.floor(place / per_block).alias("block"), (place % per_block).alias("run"), "length", "counts")


def column_runs(runs: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A source's column as runs of equal counts: where each starts, and its count. ``runs`` are the places of its counts."""
    column = np.zeros(size, np.int64)
    column[runs] = counts
    starts = np.flatnonzero(np.diff(column, prepend=column[0] - 1)) if size else np.zeros(0, np.int64)
    return starts, column[starts]


def run_distance(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], terms_before: np.ndarray) -> int:
    """Sum of the differences of two columns of shares: over the pieces between the borders of either, times their terms."""
    borders = np.union1d(a[0], b[0])
    left, right = (column[1][np.searchsorted(column[0], borders, "right") - 1] for column in (a, b))
    lengths = np.diff(terms_before[np.append(borders, len(terms_before) - 1)])
    return int((np.abs(left - right) * lengths).sum())


def pair_distances(kept: DataFrame, sources: DataFrame, cells: int = _CELLS) -> DataFrame:
    """``(lang, a, b, value)`` for the places ``a < b`` of each pair of sources of a language, 0 if it has no terms.

    A task has one block of the vocabulary and, for languages of very many sources, the pairs of one stripe of them; the
    blocks' sums are added by Spark.
    """
    blocks = staged(run_blocks(kept, sources, cells), "run-blocks")
    stripes = F.sequence(F.lit(0), F.floor((F.col("sources") - 1) / _STRIPE))
    counts = blocks.groupBy("lang").agg((F.max("block") + 1).alias("blocks"))
    widths = sources.select("lang", "sources").distinct()
    columns = (
        sources.join(_small(counts), "lang", "left")
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.coalesce("blocks", F.lit(1)), F.lit(1)) - 1)))
        .withColumn("stripe", F.explode(stripes))
        .select("lang", "block", "stripe", "source", "place", "size", "terms")
    )
    entries = (
        blocks.join(_small(widths), "lang").withColumn("stripe", F.explode(stripes))
        .select("lang", "block", "stripe", "run", "length", F.explode("counts").alias("c"))
        .select("lang", "block", "stripe", "run", "length", "c.source", "c.n")
    )

    def compare(key: tuple[Any, ...], entries: pd.DataFrame, columns: pd.DataFrame) -> pd.DataFrame:
        lang, _, stripe = key
        run = entries["run"].to_numpy(np.int64)
        width = int(run.max()) + 1 if len(run) else 0
        lengths = np.zeros(width, np.int64)
        lengths[run] = entries["length"].to_numpy(np.int64)
        before = np.append(0, np.cumsum(lengths))
        columns = columns.sort_values("place")
        at = pd.Index(columns["source"]).get_indexer(entries["source"])
        order = np.argsort(at, kind="stable")
        ends = np.searchsorted(at[order], np.arange(len(columns) + 1))
        n = entries["n"].to_numpy(np.int64)
        coded = []
        for i, (size, terms) in enumerate(zip(columns["size"].tolist(), columns["terms"].tolist())):
            own = order[ends[i]:ends[i + 1]]
            starts, values = column_runs(run[own], n[own], width)
            coded.append((starts, shares(values, size, terms) if terms else values))
        places = columns["place"].to_numpy(np.int64)
        found = [
            (lang, int(places[a]), int(places[b]), run_distance(coded[a], coded[b], before) if width else 0)
            for a in range(len(places)) if places[a] // _STRIPE == stripe for b in range(a + 1, len(places))
        ]
        return pd.DataFrame(found, columns=["lang", "a", "b", "value"])

    keys = ("lang", "block", "stripe")
    partial = entries.groupBy(*keys).cogroup(columns.groupBy(*keys)).applyInPandas(compare, "lang string, a bigint, b bigint, value bigint")
    return partial.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(documents: DataFrame, least_documents: int = 30, most_terms: int = 50, cells: int = _CELLS) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: the distance of each source to the others of its language, and the terms
    in which it is ahead of its language.

    Part ``pair`` has every other source, part ``term`` the ``most_terms`` largest differences; ranks start at 1 in each
    group and part, by falling value, then by the item's UTF-8 bytes. Terms are runs of letters A-Z and of characters
    outside ASCII. Null texts, languages and sources are empty strings; texts are read whole; repeated rows count each time;
    an empty table gives no rows, a language with a single source no pairs. Further columns are not read.
    """
    kept = staged(vocabulary(term_counts(documents), least_documents), "kept-terms")
    sources = staged(source_totals(documents, kept), "sources")
    terms = leading_terms(kept, sources, most_terms).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    names = _small(sources.select("lang", "place", "source"))
    half = pair_distances(kept, sources, cells)
    both = half.select("lang", "value", F.inline(F.array(
        F.struct(F.col("a").alias("own"), F.col("b").alias("other")), F.struct(F.col("b").alias("own"), F.col("a").alias("other")))))
    named = both.join(names.withColumnsRenamed({"place": "own"}), ["lang", "own"]).join(
        names.withColumnsRenamed({"place": "other", "source": "item"}), ["lang", "other"])
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = named.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return pairs.unionByName(terms)
