"""Ids and texts against the sentencepiece library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from tests.llm.conftest import edge_rows
from wordloom.llm import pieces, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = ["a", "b", "▁", " ", "  ", "\n", "é", "你", "\U0001F600", "the", "ing", "\t", "\x00", "�", "<0x0A>", "<s>", "x" * 9, "梦", "ጀ", "   "]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, "rb") as file:
        return pieces.Vocabulary(file.read())


def random_texts(seed, n, longest=60):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randrange(longest))) for _ in range(n)]


TEXTS = random_texts(1, 3000) + random_texts(2, 30, 900) + [" " * n for n in range(80)] + ["x" * n for n in range(150)] + [
    "", "▁", "▁▁ a", "x" * 5000, " " * 5000, "ab " * 3000]


def encoded(encoder, texts):
    ids, counts, unequal = encoder.encode(pa.array(texts, pa.string()))
    return [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])], unequal.tolist()


@pytest.mark.parametrize("at_once", [len(TEXTS), 100])
def test_ids_equal_the_library(library, vocabulary, at_once):
    encoder = pieces.Encoder(vocabulary, library)
    wanted = library.encode(TEXTS, add_bos=True, add_eos=True)
    for start in range(0, len(TEXTS), at_once):
        ids, unequal = encoded(encoder, TEXTS[start:start + at_once])
        assert ids == wanted[start:start + at_once] and not any(unequal)


def test_ids_are_the_same_after_chunks_were_forgotten(library, vocabulary, monkeypatch):
    monkeypatch.setattr(pieces, "_KEPT", 5)
    encoder = pieces.Encoder(vocabulary, None)
    for text in TEXTS[:200]:
        assert encoded(encoder, [text]) == ([library.encode(text, add_bos=True, add_eos=True)], [False])


def test_heaps_and_agendas_side_by_side_agree(vocabulary):
    chunks = [c for t in random_texts(3, 300) for c in t.replace(" ", "▁").split("x") if c]
    symbols, owner = pieces.merged_together("".join(chunks), np.array(list(map(len, chunks))), vocabulary)
    names = {i: piece for piece, i in vocabulary.ids.items()} | vocabulary.spelled
    together = [[names.get(s, chr(-s - 1) if s < 0 else None) for s in symbols[owner == i].tolist()] for i in range(len(chunks))]
    assert together == [pieces.merged(c, vocabulary.cost) for c in chunks]


def test_texts_of_ids_equal_the_library(library, vocabulary):
    decoder, rnd = pieces.Decoder(vocabulary), random.Random(4)
    lists = [[rnd.randrange(400) if rnd.random() < 0.7 else rnd.randrange(32_000) for _ in range(rnd.randrange(12))] for _ in range(5000)]
    assert [decoder.decode(np.array(ids, np.int32)) for ids in lists] == [library.decode(ids) for ids in lists]


def test_a_chunk_that_the_library_has_otherwise_is_reported(library, vocabulary, monkeypatch):
    monkeypatch.setattr(pieces.Encoder, "bytes_of", lambda self, character: [3])
    encoder = pieces.Encoder(vocabulary, library)
    texts = ["plain words", "an odd ጀ", "plain again", " ጀ", "ጀ " * 40 + "x" * 99 + "ጀ", " "]
    assert encoded(encoder, texts)[1] == [False, True, False, True, True, False]


def test_other_models_are_refused():
    with open(PATH, "rb") as file:
        spec = sentencepiece_model_pb2.ModelProto.FromString(file.read())
    for change in ("model_type", "byte_fallback", "remove_extra_whitespaces", "kind"):
        other = sentencepiece_model_pb2.ModelProto.FromString(spec.SerializeToString())
        if change == "model_type":
            other.trainer_spec.model_type = 1
        elif change == "byte_fallback":
            other.trainer_spec.byte_fallback = False
        elif change == "kind":
            other.pieces[500].type = 4
        else:
            other.normalizer_spec.remove_extra_whitespaces = True
        with pytest.raises(ValueError):
            pieces.Vocabulary(other.SerializeToString())


def test_columns_edge_rows_and_clashing_names(edge_docs, library):
    texts = [r[1] or "" for r in edge_rows()]
    both = pieces.round_trip(edge_docs, PATH, keep=["doc_id", "label", "component_id"])
    found = sorted((r["doc_id"] is not None, r["doc_id"], r["ids"], r["decoded"]) for r in both.collect() if r["doc_id"] is not None)
    wanted = sorted((True, r[0], library.encode(t, add_bos=True, add_eos=True), t) for r, t in zip(edge_rows(), texts) if r[0] is not None)
    assert found == wanted
    again = pieces.decode(pieces.encode(edge_docs, PATH, name="numbers", keep=["doc_id"], check=False), PATH, "numbers", "back")
    assert again.columns == ["doc_id", "numbers", "numbers_unequal", "back"]
    assert sorted(r["back"] for r in again.collect()) == sorted(texts)


def test_decoding_nulls_and_unknown_ids(spark, library):
    rows = [(1, None), (2, []), (3, [1, None, 99_999, -1, 415, 2])]
    found = pieces.decode(spark.createDataFrame(rows, "k int, ids array<int>"), PATH)
    assert {r["k"]: r["decoded"] for r in found.collect()} == {1: "", 2: "", 3: library.decode([415])}


def test_empty_table(no_docs):
    assert pieces.round_trip(no_docs, PATH, keep=["doc_id"]).collect() == []


def test_query_equals_the_library(spark, sf_dir, library):
    found = {r["doc_id"]: r for r in queries.QUERIES["op12_piece_codec"](spark, sf_dir).collect()}
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(found) == len(rows)
    for row in rows:
        ids = library.encode(row["text"] or "", add_bos=True, add_eos=True)
        own = found[row["doc_id"]]
        assert own["n_tokens"] == len(ids) and not own["ids_unequal"]
        assert own["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert own["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
