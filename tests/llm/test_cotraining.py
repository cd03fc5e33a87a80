import numpy as np
import pytest

from tests.llm.conftest import SCHEMA, prose
from wordloom.llm import cotraining, queries

SMALL = cotraining.Spec(text_buckets=1 << 9, meta_buckets=1 << 6, rounds=2)


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_edge_rows(spark, edge_docs):
    labels = labels_of(spark, [(0, 1, 0), (1, 0, 0), (5, 1, 0), (6, 1, 0), (7, 0, 0), (8, 0, 0), (None, 1, 0), (2, None, 0), (3, 1, 0), (3, 0, 0), (99, 1, 0)])
    found = cotraining.classify(edge_docs, labels, SMALL)
    assert found.columns == ["doc_id", "p_text", "p_meta", "score", "kept"]
    rows = found.collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in edge_docs.collect())
    assert all(0 <= p <= 1 for r in rows for p in (r.p_text, r.p_meta, r.score))
    kept = cotraining.good_documents(edge_docs, labels, SMALL)
    assert kept.columns == edge_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in rows if r.kept)


def test_empty_tables(spark, no_docs, edge_docs):
    labels, none = labels_of(spark, [(0, 1, 0)]), labels_of(spark, [])
    assert cotraining.classify(no_docs, labels, SMALL).collect() == []
    scores = {round(r.score, 9) for r in cotraining.classify(edge_docs, none, SMALL).collect()}
    assert scores == {0.5}
    assert len({round(r.score, 9) for r in cotraining.classify(edge_docs, labels, SMALL).collect()}) == 1


def test_missing_metadata_columns(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    assert cotraining.classify(docs, labels_of(spark, [(1, 1, 0)]), SMALL).count() == 2


def test_majority_of_labels(spark):
    docs = spark.createDataFrame([(i,) for i in range(8)], "_keep_id bigint")
    labels = labels_of(spark, [(0, 1, 0), (0, 1, 0), (0, 0, 0), (1, 0, 0), (2, 1, 0), (2, 0, 0)])
    spec = cotraining.Spec(calibration_folds=10 ** 9)
    found = {r._keep_id: r.label for r in cotraining._with_labels(docs, labels, spec).collect()}
    assert found == {0: 1, 1: 0, 2: None, **{i: None for i in range(3, 8)}}


def test_text_view_counts():
    view = cotraining.TextView(cotraining.Spec(text_buckets=64))
    buckets, n = view("Ab ab ab!\nx\nx".encode())
    assert n[-4:].tolist() == [1, 4, 1, 2]  # words like the one before, others, repeated lines, others
    assert n[:-4].sum() == 10 and list(buckets[-4:]) == [60, 61, 62, 63] and view("Ab ab ab!\nx\nx".encode())[1].tolist() == n.tolist()
    assert [len(a) for a in view(b" \n ")] == [len(a) for a in view(None)] == [0, 0]


def test_the_shape_of_a_long_word_is_that_of_all_its_bytes():
    assert cotraining._shape(b"a" * 40 + b"-9") == cotraining._shape(b"a" * 39 + b"-9") == b"a-0"
    assert cotraining._shape(b"aA" * 5000 + b"7") == b"aA" * 5000 + b"0"


def test_shapes():
    assert [cotraining._shape(w) for w in (b"Ab12#", "Éé".encode(), b"AAA!!")] == [b"Aa0#", b"a", b"A!"]


def test_calibration_recovers_the_odds():
    rng = np.random.default_rng(1)
    scores = rng.normal(size=20_000)
    good = rng.random(20_000) < 1 / (1 + np.exp(-(2 * scores - 0.5)))
    found = cotraining.calibrate(scores, good.astype(float), np.ones(20_000))
    assert found.slope == pytest.approx(2, abs=0.1) and found.offset == pytest.approx(-0.5, abs=0.1)


def two_views(spark, n=600):
    """Texts and sources that both tell the class; only few documents are labelled, and only with known words."""
    rows, labels = [], []
    for i in range(n):
        good = i % 2 == 0
        words = ("good fine nice " if good else "bad poor ugly ") if i < 60 else ("sound neat tidy " if good else "grim dull vile ")
        source = "press" if good else "spam"
        rows.append((i, words * 10 + prose(i, 5), "a", source, 200, *(None,) * 10))
        if i < 60:
            labels.append((i, int(good), 0))
    return spark.createDataFrame(rows, SCHEMA), labels_of(spark, labels)


def test_a_view_learns_from_the_other_ones_labels(spark):
    """The words of unlabelled texts are unknown until the metadata view labels them."""
    docs, labels = two_views(spark)
    probe = spark.createDataFrame([(1000, "sound neat tidy " * 10, *(None,) * 13), (1001, "grim dull vile " * 10, *(None,) * 13)], SCHEMA)
    spec = cotraining.Spec(text_buckets=1 << 10, meta_buckets=1 << 6, sure=0.9)
    alone, _ = cotraining.train(docs, labels, cotraining.Spec(**{**vars(spec), "rounds": 0}))
    together, features = cotraining.train(docs, labels, spec)

    def gap(model):
        p = {r._id: r.p_text for r in cotraining.scored(probe, model, {"_id": "doc_id"}).collect()}
        return p[1000] - p[1001]

    assert gap(together) > 0.9 > gap(alone)
    # Scores from written features are those from the texts.
    written = {r._keep_id: r.score for r in cotraining.scored_features(features, together, ["_keep_id"]).collect()}
    assert written == {r._id: r.score for r in cotraining.scored(docs, together, {"_id": "doc_id"}).collect()}


def test_accuracy_on_labels_held_back(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    known, held = labels.where("crc32(string(doc_id)) % 3 != 0"), labels.where("crc32(string(doc_id)) % 3 = 0")
    rows = cotraining.classify(docs, known).join(held, "doc_id").collect()
    assert np.mean([r.kept == (r.quality == 1) for r in rows]) > 0.97
    assert all(r.kept for r in rows if r.quality == 1)


def test_query(spark, sf_dir):
    rows = queries.op4_quality_classifier(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs)
