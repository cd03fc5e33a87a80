import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import SCHEMA, prose
from wordloom.llm import language, queries


def test_counts_equal_plain_n_grams():
    """Buckets are hashes; the totals by text and length of n-gram are not."""
    texts = ["Ab  c\n", None, "", "ééé", "x" * 300]
    sums = Counter()
    for rows, buckets, n in language.gram_counts(texts, language.Grams(longest=3, bits=20)):
        for r, _, k in zip(rows, buckets, n):
            sums[int(r)] += int(k)
    lengths = {0: 4, 3: 3, 4: 300}  # white space collapses
    assert sums == {r: sum(max(0, n - k) for k in range(3)) for r, n in lengths.items()}


def test_equal_texts_have_equal_counts_wherever_they_stand(monkeypatch):
    monkeypatch.setattr(language, "_CHARS_AT_ONCE", 64)
    grams = language.Grams(bits=12)

    def counted(texts, row):
        out = Counter()
        for rows, buckets, n in language.gram_counts(texts, grams):
            for r, b, k in zip(rows, buckets, n):
                if r == row:
                    out[int(b)] += int(k)
        return out

    text = "some words here"
    assert counted([text], 0) == counted(["x" * 100, None, text, "y"], 2)


def plain_bayes(train, texts, grams, smoothing=0.5):
    """The same model by plain loops over dense vectors."""
    def vector(text):
        out = np.zeros(1 << grams.bits)
        for _, buckets, n in language.gram_counts([text], grams):
            out[buckets] += n
        return out

    names = sorted({lang for _, lang in train})
    sums = {name: sum(vector(t) for t, lang in train if lang == name) + smoothing for name in names}
    prior = {name: sum(lang == name for _, lang in train) for name in names}
    out = []
    for text in texts:
        v = vector(text)
        scores = [math.log(prior[n]) - math.log(len(train)) + float(v @ np.log(sums[n] / sums[n].sum())) for n in names]
        best = int(np.argmax(scores))
        out.append((names[best], 1 / sum(math.exp(s - scores[best]) for s in scores)))
    return out


def test_predictions_equal_plain_bayes(spark):
    grams = language.Grams(bits=10)
    train = [(prose(i, 30) + " zz" * (i % 3), "abc"[i % 3]) for i in range(30)]
    texts = [prose(100 + i, 5) + " zz" * i for i in range(12)]
    model = language.fit(spark.createDataFrame(train + [(None, "a"), ("q", None)], "text string, lang string"), grams)
    found = language.predict(spark.createDataFrame([(t,) for t in texts], "text string"), model).collect()
    wanted = dict(zip(texts, plain_bayes(train, texts, grams)))
    for r in found:
        assert r.lang_pred == wanted[r.text][0] and r.score == pytest.approx(wanted[r.text][1])


@pytest.mark.parametrize("at_once", [1, 2, 3])
def test_blocks_of_languages_give_the_same_as_one(spark, at_once):
    grams = language.Grams(bits=10)
    train = [(prose(i, 30) + " zz" * (i % 3), "abcde"[i % 5]) for i in range(40)] + [("same", "f"), ("same", "g")]
    texts = [prose(100 + i, 5) + " zz" * i for i in range(12)] + [None, "", "12 !", "same"]
    known = spark.createDataFrame(train, "text string, lang string")
    docs = spark.createDataFrame([(t, 1, 2) for t in texts + texts[:3]], "text string, row int, name int")
    whole, parts = (sorted((str(r.text), r.row, r.name, r.lang_pred, round(r.score, 9)) for r in language.predict(docs, language.fit(known, grams, at_once=n)).collect())
                    for n in (256, at_once))
    assert parts == whole and len(parts) == len(texts) + 3


def test_more_languages_than_a_block(spark):
    """The 257th language and all others are told from each other by letters of their own."""
    texts = [(" ".join(chr(0x4E00 + 3 * i + k) * 3 for k in range(3)), f"l{i:03}") for i in range(300)]
    docs = spark.createDataFrame(texts, "text string, lang string")
    found = language.predict(docs, language.fit(docs, language.Grams(bits=12))).collect()
    assert len(found) == 300 and np.mean([r.lang == r.lang_pred for r in found]) > 0.99


def test_edge_rows(edge_docs):
    found = {(r.doc_id, r.held_out, r.lang_pred) for r in language.identify(edge_docs).collect()}
    assert {(i, p) for i, _, p in found if i in (2, 3, 4)} == {(2, "und"), (3, "und"), (4, "und")}
    assert all(held == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2) for i, held, _ in found)
    assert all(p in ("a", "b", "und") for *_, p in found)
    assert language.identify(edge_docs).count() == edge_docs.count()
    assert language.identify(edge_docs).columns == ["doc_id", "held_out", "lang_pred", "score"]


def test_nothing_to_learn_from(spark, no_docs):
    assert language.identify(no_docs).collect() == []
    rows = spark.createDataFrame([(2, "some text", None, "s", 9, True, "", 1, 1, "", 0.1, "", 1, 1, "")], SCHEMA)
    assert [(r.lang_pred, r.score) for r in language.identify(rows).collect()] == [("und", 0.0)]


def test_texts_without_letters(spark):
    model = language.fit(spark.createDataFrame([("abc", "a"), ("xyz", "b")], "text string, lang string"))
    found = language.predict(spark.createDataFrame([("123 !?",), ("é",)], "text string"), model)
    assert {r.text: r.lang_pred == "und" for r in found.collect()} == {"123 !?": True, "é": False}


def test_accuracy_on_the_held_out_fold(spark):
    sf_dir = "/root/testdata/sf0.01"
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op8_language_id(spark, sf_dir).collect()
    assert len(rows) == len(langs) and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in langs if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in held]) > 0.97


def test_a_text_longer_than_a_piece_has_all_its_n_grams(monkeypatch):
    grams = language.Grams()
    pick = np.random.default_rng(2)
    texts = ["".join(pick.choice(list("abcDÉ  \n"), 3001)), None, "x", " \n" * 700 + "ab" + "\t" * 900 + "c", "ab"]

    def counted():
        sums = Counter()
        for block in language.gram_counts(texts, grams):
            for row, bucket, n in zip(*(part.tolist() for part in block)):
                sums[row, bucket] += n
        return sums

    whole = counted()
    plain = [" ".join((t or "").lower().split()) for t in texts]
    assert sum(whole.values()) == sum(max(len(t) - k, 0) for t in plain for k in range(grams.longest))
    for size in (1, 2, 3, 1000):
        monkeypatch.setattr(language, "_CHARS_AT_ONCE", size)
        assert counted() == whole
