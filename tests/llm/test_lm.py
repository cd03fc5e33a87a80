import itertools
import math
import re
import zlib
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest
import xxhash

from tests.llm.conftest import edge_rows, prose
from wordloom.llm import lm, queries

SMALL = lm.Spec(head=40, single=10, signatures=8, classes=4, least=3)


def tokens(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower()) + [None]


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 == 0


def brute_base(rows):
    """``doc_id: (held_out, n_tokens, n_known, train_tokens, base_score)`` rows, with plain counters."""
    counts = Counter(t for i, text in rows if i is not None and not held_out(i) for t in tokens(text))
    total, kinds = sum(counts.values()), len(counts)
    out = []
    for i, text in rows:
        own = tokens(text)
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (kinds + 1))) for t in own)
        out.append((str(i), held_out(i), len(own), sum(counts[t] > 0 for t in own), total, round(base, 5)))
    return sorted(out)


def base_rows(df):
    return sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in df.collect())


@pytest.mark.parametrize("spec", [SMALL, lm.Spec()])
def test_edge_rows(edge_docs, spec):
    found = lm.score(edge_docs, spec)
    assert base_rows(found) == brute_base([(r[0], r[1]) for r in edge_rows()])
    assert all(math.isfinite(r.score) and r.score < 0 for r in found.collect())


def test_nothing_to_learn_from(spark, no_docs):
    assert lm.score(no_docs, SMALL).collect() == []
    rows = [(None, "a b")]
    found = lm.score(spark.createDataFrame(rows, "doc_id bigint, text string"), SMALL)
    assert base_rows(found) == brute_base(rows) and math.isfinite(found.first().score)


def test_query_equals_plain_counts(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert base_rows(queries.op7_class_lm(spark, sf_dir)) == brute_base(rows)


def test_head_is_the_most_frequent_words(spark):
    vocabulary = spark.createDataFrame([("a", 50), ("b", 20), ("x" * 100, 90), ("c", 3), ("d", 3), ("e", 3)], "word string, c bigint")
    words, counts = lm.head_words(vocabulary, lm.Spec(head=4))
    assert words == [b"a", b"b"] and counts.tolist() == [50, 20]  # all words of a count or none
    assert lm.head_words(vocabulary, lm.Spec(head=5))[0] == [b"a", b"b", b"c", b"d", b"e"]


def test_exchange_finds_alternating_classes():
    """Words 0-3 and 4-7 take turns; the likelihood rises until the two groups are the classes."""
    rng = np.random.default_rng(1)
    text = [int(rng.integers(4)) + 4 * (i % 2) for i in range(4000)]
    class_of = np.array([0, 1, 0, 1, 0, 1, 0, 1, 2], np.int32)
    row = np.array([8, *text, 8])

    def contexts(class_of):
        counts = np.zeros((9, 2, 3), np.int64)
        np.add.at(counts, (row[1:], 0, class_of[row[:-1]]), 1)
        np.add.at(counts, (row[:-1], 1, class_of[row[1:]]), 1)
        return counts

    class_of = np.array([0, 1, 0, 0, 0, 1, 1, 1, 2], np.int32)
    gains = []
    for _ in range(4):
        gains.append(lm.likelihood(lm.class_bigrams(contexts(class_of), class_of)))
        class_of = lm.exchange(contexts(class_of), class_of)
    assert gains[-1] > gains[0]
    assert len(set(class_of[:4])) == len(set(class_of[4:8])) == 1 and class_of[0] != class_of[4] and class_of[8] == 2


def test_context_counts_equal_plain_counts(spark):
    rows = [([0, 1, 2, 1],), ([],), ([3],), ([2, 2],)]
    training = spark.createDataFrame(rows, "ids array<int>")
    unit_of, class_of = np.array([0, 1, 1, 2, 3], np.int32), np.array([0, 1, 0, 2], np.int32)  # number 4 is the end
    found = lm.context_counts(training, unit_of, class_of, 3)
    wanted = np.zeros((4, 2, 3), np.int64)
    for (ids,) in rows:
        units = [3, *(int(unit_of[i]) for i in ids), 3]
        for a, b in zip(units, units[1:]):
            wanted[b, 0, class_of[a]] += 1
    # Across texts, an end is followed by the next text's first word; the order of texts does not change a sum.
        for a, b in zip(units, units[1:]):
            wanted[a, 1, class_of[b]] += 1
    assert (found == wanted).all()


def learnt_model(docs, spec):
    """``(model, number of a word, counts)`` from all rows of ``docs``."""
    vocabulary = lm.word_counts(docs).persist()
    words, counts = lm.head_words(vocabulary, spec)
    own, signatures = lm.own_words(vocabulary, counts, spec.least, spec)
    training = lm.numbered_texts(docs, words, own, spec, [])
    model = lm.train(training, vocabulary, words, counts, own, signatures, docs.count(), spec.least, spec)
    places = {w: i for i, w in enumerate(words)}

    def number(word):
        rare = spec.head + spec.signatures + own.tolist().index(h) if (h := xxhash.xxh64_intdigest(word, 42)) in own else None
        return places.get(word, spec.head + lm.signature(word, spec) if rare is None else rare)

    return model, number, {r.word.encode(): r.c for r in vocabulary.collect()}, [r.ids for r in training.select("ids").collect()]


def small_docs(spark):
    return spark.createDataFrame([(i, prose(i, 40) + f" rare{i} " + "long" * 20) for i in range(60)], "doc_id bigint, text string")


def test_probabilities_add_up_to_one(spark):
    model, number, counts, _ = learnt_model(small_docs(spark), SMALL)
    assert np.allclose(model.transitions.sum(axis=1), 1)
    emitted = np.zeros(SMALL.classes)
    for word, c in counts.items():
        k = model.class_of[number(word)]
        emitted[k] += (c + SMALL.delta) / (model.class_tokens[k] + SMALL.delta * (model.class_kinds[k] + 1))
    unseen = SMALL.delta / (model.class_tokens + SMALL.delta * (model.class_kinds + 1))
    assert np.allclose(emitted + unseen, 1)


@pytest.mark.parametrize("spec", [SMALL, lm.Spec(head=4, single=3, signatures=8, classes=4, least=3)])
def test_score_is_the_product_over_the_tokens(spark, spec):
    """The score of a text by a plain walk over its tokens."""
    docs = small_docs(spark)
    found = {r.doc_id: r.score for r in lm.score(docs, spec).collect()}
    model, number, counts, _ = learnt_model(docs.where("crc32(string(doc_id)) % 10 != 0"), spec)
    for r in docs.collect():
        before, total = spec.classes, 0.0
        for t in tokens(r.text):
            if t is None:
                k, emission = spec.classes, 1.0
            else:
                k = model.class_of[number(t)]
                emission = (counts.get(t, 0) + spec.delta) / (model.class_tokens[k] + spec.delta * (model.class_kinds[k] + 1))
            total += math.log10(model.transitions[before, k] * emission)
            before = k
        assert found[r.doc_id] == pytest.approx(total)


def test_every_word_with_enough_occurrences_has_a_number_of_its_own(spark):
    """Words beyond the head too: those that occur often enough, and one too long for the head."""
    spec = lm.Spec(head=4, single=3, signatures=8, classes=4, least=3)
    docs = small_docs(spark)
    model, number, counts, ids = learnt_model(docs, spec)
    often = [w for w, c in counts.items() if c >= 3]
    own = {number(w) for w in often}
    assert len(often) > 10 and b"long" * 20 in often and len(own) == len(often)
    assert all(n < 4 or n >= 12 for n in own) and all(4 <= number(w) < 12 for w, c in counts.items() if c < 3)
    assert sorted(ids) == sorted([number(t) for t in tokens(r.text)[:-1]] for r in docs.collect())


def test_words_move_by_their_own_occurrences_whatever_the_number_of_tokens(spark, monkeypatch):
    """With counts as of a very large table the words with ``least`` occurrences are the same."""
    asked, counts, own_words = [], lm.word_counts, lm.own_words
    monkeypatch.setattr(lm, "word_counts", lambda texts: counts(texts).selectExpr("word", "c * 100000000 AS c"))
    monkeypatch.setattr(lm, "own_words", lambda vocabulary, c, least, spec: asked.append(least) or own_words(vocabulary, c, least, spec))
    assert lm.score(small_docs(spark), SMALL).count() == 60 and asked == [SMALL.least]


def test_hashes_in_blocks_give_the_same_scores(spark):
    spec = lm.Spec(head=4, single=3, signatures=8, classes=4, least=3)
    whole, blocks = ({r.doc_id: r for r in lm.score(small_docs(spark), s).collect()} for s in (spec, replace(spec, block=7)))
    assert len(lm.hash_blocks(np.arange(20), replace(spec, block=7))) == 3 and whole.keys() == blocks.keys()
    for i, r in whole.items():
        assert blocks[i][:5] == r[:5] and blocks[i].score == pytest.approx(r.score) and blocks[i].base_score == pytest.approx(r.base_score)


def test_unit_contexts_and_bigrams_equal_plain_counts(spark, monkeypatch):
    monkeypatch.setattr(lm, "_DENSE_UNITS", 70)
    rng = np.random.default_rng(5)
    rows = [([int(i) for i in rng.integers(0, 300, rng.integers(0, 40))],) for _ in range(50)]
    merged, class_of = np.arange(20), rng.integers(0, 4, 301).astype(np.uint8)
    merged[3], class_of[300], class_of[3] = 25, 4, class_of[25]
    contexts = lm.unit_contexts(spark.createDataFrame(rows, "ids array<int>").repartition(5), merged, class_of, 5)
    wanted = Counter()
    bigrams = np.zeros((5, 5))
    for (ids,) in rows:
        units = [300, *(25 if i == 3 else i for i in ids), 300]
        for a, b in zip(units, units[1:]):
            wanted[b, 0, class_of[a]] += 1
            wanted[a, 1, class_of[b]] += 1
            bigrams[class_of[a], class_of[b]] += 1
    found = {(part * 64 + c // 10, c // 5 % 2, c % 5): n for part, cells, sums in contexts.collect()
             for c, n in zip(np.frombuffer(cells, "<u2").tolist(), np.frombuffer(sums, "<i8").tolist())}
    assert found == dict(wanted)
    assert (lm.summed_bigrams(contexts, class_of, 5) == bigrams).all()


def test_a_word_beyond_the_core_chooses_its_class(spark):
    """Two groups of words take turns, the first letters of each most often; rarer words, alike in signature, end in their
    group's class, in the head or not."""
    rng = np.random.default_rng(2)
    texts = [" ".join(f"{'ab'[i % 2]}{chr(97 + int(26 * rng.random() ** 3))}" for i in range(60)) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    spec = lm.Spec(head=30, single=12, signatures=1, classes=2, least=5, rounds=6)
    model, number, counts, _ = learnt_model(docs, spec)
    classes = {w: int(model.class_of[number(w)]) for w in counts}
    assert len(classes) == 52 and {w[:1]: k for w, k in classes.items()}.keys() == {b"a", b"b"}
    assert all(len({k for w, k in classes.items() if w[:1] == g}) == 1 for g in (b"a", b"b"))
    assert classes[b"aa"] != classes[b"ba"]


def test_best_class_is_the_one_with_the_highest_likelihood():
    """Gains of a unit equal the likelihoods that its moves give, where it never stands beside itself or its own class."""
    rng = np.random.default_rng(3)
    bigrams = rng.integers(50, 99, (6, 6)).astype(float)
    side, other, n = np.array([0, 0, 1, 1]), np.array([1, 3, 1, 4]), np.array([9.0, 4, 6, 7])
    bigrams[1, 2] += 9; bigrams[3, 2] += 4; bigrams[2, 1] += 6; bigrams[2, 4] += 7
    found = lm.best_classes(np.zeros(4, int), side, other, n, np.array([2]), bigrams)

    def after(k):
        table = bigrams.copy()
        for s, o, c in zip(side, other, n):
            for to, sign in ((2, -1), (k, 1)):
                table[(o, to) if s == 0 else (to, o)] += sign * c
        return lm.likelihood(table)

    assert found.tolist() == [max(range(5), key=after)]


def test_classes_predict_held_out_texts_better_than_words_alone(spark):
    rows = [r for r in queries.op7_class_lm(spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert sum(r.score for r in rows) > 0.95 * sum(r.base_score for r in rows)


def test_signatures_see_the_ending():
    spec = lm.Spec()
    assert lm.signature(b"bcation", spec) == lm.signature(b"dztion", spec) != lm.signature(b"bcat1on", spec)
    assert len({lm.signature(bytes(w), spec) for w in itertools.product(b"abcdefgh", repeat=3)}) > 300
