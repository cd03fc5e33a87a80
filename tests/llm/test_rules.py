import random
import re
from collections import Counter

import numpy as np

from tests.llm.conftest import by_id, edge_rows
from wordloom.llm import queries, rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_numbers_equal_brute_force():
    rnd = random.Random(3)
    texts = ["".join(rnd.choice(["a ", "b ", "é", "\n", "c d ", "#", "你 ", "\t"]) for _ in range(rnd.randrange(120))) for _ in range(400)]
    for text in texts + ["", " ", "a a a", "a a a a", "x\nx\n x\nx", "a b c a b c a"]:
        assert rules.text_stats(text.encode())[:5] == brute(text), text


def test_edge_rows(edge_docs):
    found = rules.judged(edge_docs.select("doc_id", "text", "label"), keep=["doc_id"])
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert by_id(found, columns) == sorted(((r[0], *brute(r[1])) for r in edge_rows()), key=lambda r: [(v is not None, str(v)) for v in r])
    assert all(not r.kept for r in found.collect() if r.base_failed)


def test_empty_table_and_clashing_columns(no_docs, edge_docs):
    assert rules.judged(no_docs.select("doc_id", "text"), keep=["doc_id"]).collect() == []
    kept = rules.good_documents(edge_docs)
    assert kept.columns == edge_docs.columns
    assert {r.kept for r in kept.collect()} == {True}  # the table's own column


def sampled(n, seed):
    """Votes of known accuracy on documents of known class."""
    rng = np.random.default_rng(seed)
    good = rng.random(n) < 0.8
    votes = np.empty((n, 5), np.int64)
    for j, (on_good, on_bad) in enumerate([(.02, .5), (.01, .3), (.03, .6), (.0, .4), (.05, .35)]):
        votes[:, j] = np.where(rng.random(n) < 0.1, 0, np.where(rng.random(n) < np.where(good, on_good, on_bad), -1, 1))
    return good, votes


def test_expectation_maximisation_recovers_the_classes():
    good, votes = sampled(20_000, 5)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = rules.fit(patterns, counts.astype(float), 5, strength=0.01)
    posterior = model.posterior(votes)
    assert ((posterior >= 0.5) == good).mean() > 0.93
    assert abs(model.prior[1] - 0.8) < 0.06
    assert abs(model.shares[1, 0, 0] - 0.02 * 0.9) < 0.02 and abs(model.shares[0, 0, 0] - 0.5 * 0.9) < 0.1


def test_estimate_does_not_depend_on_the_size():
    _, votes = sampled(3000, 6)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    small, large = rules.fit(patterns, counts.astype(float), 5), rules.fit(patterns, counts * 1000.0, 5)
    assert np.allclose(small.shares, large.shares)


def test_no_documents_give_the_start():
    model = rules.fit(np.zeros((0, 0), np.int64), np.zeros(0), 5)
    assert np.allclose(model.shares[1, 0], rules.START[1])


def test_verdicts_equal_the_posteriors(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = rules.judged(docs, keep=["doc_id"]).withColumn("votes", rules.votes(rules.RULES)).collect()
    patterns, counts = np.unique(np.array([r.votes for r in found]), axis=0, return_counts=True)
    posterior = rules.fit(patterns, counts.astype(float), len(rules.RULES)).posterior(np.array([r.votes for r in found]))
    assert np.allclose([r.p_good for r in found], posterior)


def test_query(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = queries.op3_quality_rules(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, *rest = brute(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, *rest)
        assert r.base_failed == (n < 50 or 100 * rest[3] > 50 * n)
        assert not (r.base_failed and r.kept)
        if not r.base_failed and r.doc_id in labels:
            assert r.kept == (labels[r.doc_id] == 1)
