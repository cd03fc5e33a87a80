"""Quality rules under weak supervision.

Every rule votes good, votes bad or abstains. The votes of a document form a pattern; all documents together give a table
of patterns with counts, whose size depends on the rules alone. Expectation-maximisation on that table estimates how often
each rule votes which way on good and on bad documents, and the posterior probability that a document is good, given
its pattern, takes the place of "all rules must pass".
"""

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import byte_texts, map_batches, word_blocks
from wordloom.sources.workspace import staged

_SYMBOL = re.compile(rb"[#*$%&|<>]")
_UPPER = re.compile(rb"[A-Z]")
_LETTER_START = re.compile(rb"[A-Za-z\x80-\xff]")
_CONTINUED = bytes(range(0x80, 0xC0))

STATS = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
         "n_upper bigint, n_lines bigint, n_lettered bigint")


def _repeated_words(numbers: np.ndarray, width: int) -> int:
    """Words in a window of ``width`` words that occurs twice or more; its first occurrence counts too."""
    n = len(numbers) - width + 1
    if n < 2:
        return 0
    window = numbers[:n].copy()
    for k in range(1, width):
        _, ranks = np.unique(window, return_inverse=True)
        window = ranks * (int(numbers.max()) + 1) + numbers[k:n + k]
    _, ranks, counts = np.unique(window, return_inverse=True, return_counts=True)
    edge = np.zeros(n + width, np.int32)
    hit = np.flatnonzero(counts[ranks] > 1)
    edge[hit] += 1
    np.subtract.at(edge, hit + width, 1)
    return int((np.cumsum(edge)[:len(numbers)] > 0).sum())


def text_stats(text: bytes | None, width: int = 3) -> tuple[int, ...]:
    """The numbers of ``STATS`` for a whole text; all 0 for a null one."""
    if not text:
        return (0,) * 8
    numbers: dict[bytes, int] = {}
    seen, word_bytes, lettered, starts = [], 0, 0, _LETTER_START.match
    for words in word_blocks(text):
        seen.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words)))
        word_bytes += sum(map(len, words))
        lettered += sum(1 for w in words if starts(w))
    words = np.concatenate(seen) if seen else np.zeros(0, np.int64)
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    # bytes.isspace knows the same six characters that separate words; continuation bytes are no code points.
    continued = 0 if text.isascii() else len(text) - len(text.translate(None, _CONTINUED))
    return (len(words), word_bytes - continued, len(_SYMBOL.findall(text)), sum(n - 1 for n in Counter(lines).values()),
            _repeated_words(words, width), len(_UPPER.findall(text)), len(lines), lettered)


def with_stats(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its ``keep`` columns) with the columns of ``STATS``."""
    place = docs.columns.index(text)

    def work():
        def each(batch):
            rows = np.array([text_stats(t) for t in byte_texts(batch.column(place))], np.int64).reshape(-1, 8)
            return [pa.array(column) for column in rows.T]

        return each

    return map_batches(docs, work, STATS, keep)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Rule:
    """Votes good where ``good`` holds, bad where ``bad`` holds and abstains elsewhere and on null."""

    name: str
    good: str
    bad: str


#: Shares are of words or of characters in words. Between the two conditions a rule abstains.
RULES = [
    Rule("length", "n_words >= 60", "n_words < 30"),
    Rule("word_length", "word_chars BETWEEN 3 * n_words AND 11 * n_words", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    Rule("symbols", "50 * n_symbols <= n_words", "8 * n_symbols > n_words"),
    Rule("symbol_share", "200 * n_symbols <= word_chars", "25 * n_symbols > word_chars"),
    Rule("repeated_lines", "10 * n_dup_lines <= n_lines", "3 * n_dup_lines > n_lines"),
    Rule("repeated_words", "5 * n_repeat_words <= n_words", "3 * n_repeat_words > n_words"),
    Rule("capitals", "4 * n_upper <= word_chars", "2 * n_upper > word_chars"),
    Rule("letters", "10 * n_lettered >= 8 * n_words", "10 * n_lettered < 7 * n_words"),
]


def votes(rules: list[Rule]) -> Column:
    """array<int>: 1 good, -1 bad, 0 abstain, by rule."""
    return F.array(*[
        F.when(F.expr(r.bad), -1).when(F.expr(r.good), 1).otherwise(0) for r in rules])


@dataclass
class LabelModel:
    """``shares[y, j, v]``: how often rule j votes v (bad, abstain, good) on documents of class y (bad, good)."""

    prior: np.ndarray
    shares: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """The probability of good for each row of votes; abstaining counts as evidence like any vote."""
        logs = np.log(self.prior)[None, :] + sum(
            np.log(self.shares[:, j, patterns[:, j] + 1]).T for j in range(patterns.shape[1]))
        return 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -700, 700)))


#: Where the estimate starts: shares of the votes bad, abstain and good on bad and on good documents. A bad document
#: breaks few rules and a good one hardly any, so one bad vote tells more than several good ones.
START = ((0.25, 0.10, 0.65), (0.004, 0.05, 0.946))


def fit(patterns: np.ndarray, counts: np.ndarray, rules: int, prior_good: float = 0.85, strength: float = 0.1,
        rounds: int = 200, tolerance: float = 1e-9) -> LabelModel:
    """Expectation-maximisation over the table of vote patterns.

    The start, the same for all rules, tells good from bad. It also counts as much as ``strength`` times the documents,
    at every size: a rule that never votes keeps it, no share gets to 0, and a single tight group of documents cannot
    take the place of "bad".
    """
    start = np.repeat(np.array(START)[:, None, :], rules, axis=1)
    strength = strength * float(counts.sum()) if len(patterns) else 0.0
    first_prior = np.array([1 - prior_good, prior_good])
    model, last = LabelModel(first_prior, start.copy()), None
    for _ in range(rounds if len(patterns) else 0):
        good = model.posterior(patterns)
        weights = np.stack([(1 - good) * counts, good * counts])
        prior = weights.sum(axis=1) + strength * first_prior
        shares = strength * start
        for j in range(rules):
            for v in (-1, 0, 1):
                shares[:, j, v + 1] += weights[:, patterns[:, j] == v].sum(axis=1)
        model = LabelModel(prior / prior.sum(), shares / shares.sum(axis=2, keepdims=True))
        if last is not None and np.abs(good - last).max() < tolerance:
            break
        last = good
    return model


def pattern_counts(numbers: DataFrame, rules: list[Rule]) -> tuple[np.ndarray, np.ndarray]:
    """All vote patterns and how many documents have each: at most 3 ^ rules rows, whatever the number of documents."""
    rows = numbers.groupBy(votes(rules).alias("votes")).count().orderBy("votes").collect()
    return np.array([r[0] for r in rows], np.int64).reshape(-1, len(rules)), np.array([r[1] for r in rows], np.float64)


def judged(docs: DataFrame, rules: list[Rule] = RULES, threshold: float = 0.5, text: str = "text",
           keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` with the numbers of ``STATS``, ``base_failed``, ``p_good`` and ``kept``.

    One pass reads the texts and counts vote patterns, a second one gives each row the posterior of its pattern. The
    numbers are written in between if the text is not kept; else they are worked out again, which is cheaper than a
    copy of the texts.
    ``kept`` is false for ``base_failed`` documents (under 50 words, or over half of the words in repeated windows),
    else whether ``p_good`` reaches ``threshold``. Null, empty and blank texts have numbers of 0 and fail the base.
    Repeated rows count and come out repeated; an empty table gives an empty result. Columns named like the added
    ones have to be left out of ``keep``.
    """
    if len(rules) > 12:
        raise ValueError("the table of vote patterns is bounded by 3 ^ rules; join some rules")
    narrow = keep is not None and text not in keep
    numbers = with_stats(docs, text, keep if narrow else [])
    if narrow:
        numbers = staged(numbers, "rule-numbers")
    patterns, counts = pattern_counts(numbers, rules)
    model = fit(patterns, counts, len(rules))
    return verdicts(numbers if narrow else with_stats(docs, text, keep), model, rules, threshold)


def verdicts(numbers: DataFrame, model: LabelModel, rules: list[Rule], threshold: float) -> DataFrame:
    """Posteriors by adding up the log odds of each vote, and what follows from them."""
    odds = np.log(model.shares[1]) - np.log(model.shares[0])
    total = F.lit(float(np.log(model.prior[1]) - np.log(model.prior[0])))
    for j, rule in enumerate(rules):
        bad, none, good = (F.lit(float(x)) for x in odds[j])
        total = total + F.when(F.expr(rule.bad), bad).when(F.expr(rule.good), good).otherwise(none)
    scored = numbers.withColumn("p_good", 1 / (1 + F.exp(-total)))
    return (scored.withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold)))


def good_documents(docs: DataFrame, rules: list[Rule] = RULES, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`judged` keeps, with their own columns, whatever those are called."""
    own = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    kept = judged(own, rules, threshold, own.columns[docs.columns.index(text)]).where("kept")
    return kept.select(*own.columns).toDF(*docs.columns)
