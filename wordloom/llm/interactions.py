"""How filters applied in a row act on each other: what each removes, alone and in every order.

Every row becomes a mask of the filters it fails; rows of one part with the same mask are one cell, counted by Spark. A
Gray-code walk over all subsets of the filters then toggles one filter at a time: each cell counts its active failures,
and the running survivors change by the cells whose counter leaves or reaches zero. Every order of the filters is a path
through the stored states, and each step is the difference of two of them.
"""

from collections.abc import Iterator
from itertools import permutations
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.common import quoted

_SPACES = r"[\x20\x09-\x0D]+"

#: Failure conditions over ``words``, ``distinct_words``, ``capitals``, ``characters`` and ``whole``, by the filter's letter.
FILTERS: dict[str, str] = {
    "A": "words < 200",
    "B": "100 * distinct_words < 50 * words",
    "C": "100 * capitals > 3 * characters",
    "D": r"whole RLIKE '[#$%&*|]'",
}
DUPLICATE = "E"

MOST_FILTERS = 8  # 40,320 orders a part


def failures(documents: DataFrame, part: str = "lang", filters: dict[str, str] | None = None) -> DataFrame:
    """``(doc_id, part, digest, mask)``: bit i of ``mask`` is set if the i-th filter fails; ``digest`` names equal texts."""
    filters = FILTERS if filters is None else filters
    texts = documents.select(
        F.col("doc_id"), F.coalesce(quoted(part).cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("whole"))
    cut = texts.withColumn("list", F.array_remove(F.split("whole", _SPACES), ""))
    facts = cut.select(
        "doc_id", "part", "whole", F.sha2("whole", 256).alias("digest"),
        F.size("list").cast("bigint").alias("words"), F.size(F.array_distinct("list")).cast("bigint").alias("distinct_words"),
        F.regexp_count("whole", F.lit("[A-Z]")).cast("bigint").alias("capitals"), F.length("whole").cast("bigint").alias("characters"))
    mask = sum((F.when(F.expr(condition), 1 << i).otherwise(0) for i, condition in enumerate(filters.values())), F.lit(0))
    return facts.select("doc_id", "part", "digest", mask.cast("int").alias("mask"))


def cells(failed: DataFrame, labels: DataFrame, duplicate_bit: int) -> DataFrame:
    """``(part, mask, n, good, toxic)`` with the bit of the duplicate filter: the text is that of a smaller id, anywhere.

    Copies are counted per text and part before they meet, so a text that is a third of all rows is a few rows a task. Rows
    without an id are nobody's copy. A document labelled more than once is good, or toxic, if any of its labels says so.
    """
    labelled = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    n = F.count("*").alias("n")
    rows = failed.join(labelled, "doc_id", "left").groupBy("doc_id", "digest", "part", "mask").agg(
        n, F.sum(F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    counts = F.struct("n", "good", "toxic")
    with_id = F.col("doc_id").isNotNull()

    def total(where: Column) -> Column:
        return F.struct(*[F.sum(F.when(where, F.col(c)).otherwise(0)).alias(c) for c in ("n", "good", "toxic")])

    texts = rows.groupBy("digest", "part", "mask").agg(
        F.min(F.when(with_id, F.struct("doc_id", counts.alias("counts")))).alias("first"),
        total(with_id).alias("known"), total(~with_id).alias("unknown"))
    texts = texts.withColumn("smallest", F.min("first.doc_id").over(Window.partitionBy("digest")))
    first = F.coalesce(F.col("first.doc_id") == F.col("smallest"), F.lit(False))

    def share(name: str, copies: bool) -> Column:
        own = F.when(first, F.col(f"first.counts.{name}")).otherwise(0)
        return (F.col(f"known.{name}") - own if copies else F.col(f"unknown.{name}") + own).alias(name)

    both = [F.struct((F.col("mask") + (duplicate_bit if copies else 0)).alias("mask"),
                     *[share(name, copies) for name in ("n", "good", "toxic")]) for copies in (False, True)]
    split = texts.select("part", F.explode(F.array(*both)).alias("cell")).select("part", "cell.*").where("n > 0")
    return split.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def subset_states(mask: np.ndarray, weights: np.ndarray, filters: int) -> np.ndarray:
    """What survives each subset of the filters: a row of totals for each of the 2^filters states, by a Gray-code walk.

    ``weights`` has a row for each cell. From one subset to the next a single filter is toggled, and only cells whose
    count of active failures becomes or stops being zero change the survivors.
    """
    active = np.zeros(len(mask), np.int64)
    survivors = weights.sum(axis=0)
    states = np.empty((1 << filters, weights.shape[1]), weights.dtype)
    states[0], subset = survivors, 0
    for turn in range(1, 1 << filters):
        bit = turn & -turn
        subset ^= bit
        touched = np.flatnonzero(mask & bit)
        if subset & bit:
            survivors = survivors - weights[touched[active[touched] == 0]].sum(axis=0)
            active[touched] += 1
        else:
            active[touched] -= 1
            survivors = survivors + weights[touched[active[touched] == 0]].sum(axis=0)
        states[subset] = survivors
    return states


def order_rows(states: np.ndarray, names: str) -> Iterator[tuple]:
    """``(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)`` of every order and step."""
    size = len(names)
    everything = (1 << size) - 1
    fails = [int(states[0][0] - states[1 << f][0]) for f in range(size)]
    alone = [int(states[everything & ~(1 << f)][0] - states[everything][0]) for f in range(size)]
    shapley, steps = [0] * size, []
    for order in permutations(range(size)):
        subset = 0
        for step, f in enumerate(order, 1):
            removed, good, toxic = (states[subset] - states[subset | 1 << f]).tolist()
            subset |= 1 << f
            shapley[f] += removed
            steps.append((order, step, f, int(states[subset][0]), removed, good, toxic))
    text = {order: "".join(names[f] for f in order) for order in permutations(range(size))}
    for order, step, f, kept, removed, good, toxic in steps:
        yield text[order], step, kept, removed, fails[f] - removed, alone[f], good, toxic, shapley[f]


_COLUMNS = ("filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(documents: DataFrame, labels: DataFrame, part: str = "lang", filters: dict[str, str] | None = None,
          duplicate: str = DUPLICATE) -> DataFrame:
    """A row for each part, order of the filters and step, with what that step keeps, removes and would have removed.

    ``filters`` maps a letter to a failure condition in SQL over the facts that :data:`FILTERS` names; ``duplicate`` is the
    letter of the filter that fails every text which a smaller id has too. Null texts are empty, null parts are the empty
    part, null labels say nothing, texts of any length are judged whole; repeated rows count each time and are no copies of
    each other if their id is the same; an empty table has no part and gives no row. Further columns are not read.
    """
    filters = FILTERS if filters is None else filters
    names = "".join(filters) + duplicate
    if len(names) > MOST_FILTERS or len(set(names)) < len(names):
        raise ValueError(f"filters take different single letters, at most {MOST_FILTERS} of them")
    found = cells(failures(documents, part, filters), labels, 1 << len(filters))

    def walk(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        # At most 2^filters rows, however large the part is.
        states = subset_states(rows["mask"].to_numpy(np.int64), rows[["n", "good", "toxic"]].to_numpy(np.int64), len(names))
        table = pd.DataFrame(list(order_rows(states, names)), columns=list(_COLUMNS))
        table.insert(0, "part", key[0])
        return table

    counts = ", ".join(f"{c} bigint" for c in _COLUMNS[2:])
    return found.groupBy("part").applyInPandas(walk, f"part string, filter_order string, step int, {counts}")

