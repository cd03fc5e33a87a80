import hashlib
import json

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import edge_rows
from wordloom.llm import bpe, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def library_rows(library, rows):
    found = library.encode_batch([t or "" for t in rows], add_special_tokens=False)
    return [(e.ids, library.decode(e.ids, skip_special_tokens=False)) for e in found]


TEXTS = [
    "Hello  World\n", "<|endoftext|>a<|startoftext|><|endoftext|> b", "<|EndOfText|>", "it's don't I'LL we'Ve x'S", "123 4.5",
    "café CAFÉ é ß ẞ İ Σίσυφος ΣΑΣ", "你好 \U0001F600 ​﻿ a b c", "!!!???###", "aaaaaaaaaaaaaaaaaaaaa",
    "x" * 3000, "_a_b_", "\x1c\x85 a", "ab" * 500, "''s''t", "the theth ethe", "",
]


def test_texts_equal_the_library(library):
    encoder = bpe.Encoder(bpe.Vocabulary(open(PATH, encoding="utf-8").read()))
    wanted = [ids for ids, _ in library_rows(library, TEXTS)]
    for rows in ([TEXTS], [[t] for t in TEXTS]):  # together, and one by one with what was seen before
        encoded = [encoder.encode(r) for r in rows]
        assert [int(i) for ids, _ in encoded for i in ids] == [i for ids in wanted for i in ids]
        assert [int(n) for _, counts in encoded for n in counts] == [len(ids) for ids in wanted]


def merged_lists(words, vocabulary):
    ids, sizes = bpe.merge_words(words, vocabulary)
    ends = list(map(int, sizes.cumsum()))
    return [list(map(int, ids[a:b])) for a, b in zip([0, *ends], ends)]


def plain_merges(word, vocabulary):
    """One word alone: the lowest rank first, the leftmost place first."""
    ids = [int(vocabulary.inner[b]) for b in word[:-1]] + [int(vocabulary.final[word[-1]])]
    while True:
        pairs = dict(zip(zip(vocabulary.left, vocabulary.right), range(len(vocabulary.left))))
        ranked = [(pairs[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in pairs]
        if not ranked:
            return ids
        rank, i = min(ranked)
        ids[i:i + 2] = [vocabulary.merged[rank]]


def test_words_merged_together_equal_words_merged_alone():
    vocabulary = bpe.Vocabulary(open(PATH, encoding="utf-8").read())
    words = sorted({w.encode() for t in TEXTS for w in t.lower().split()} | {b"banana", b"anan", b"nanana", b"thethethe"})
    assert merged_lists(words, vocabulary) == [plain_merges(w, vocabulary) for w in words]


def test_a_lower_rank_that_a_merge_brings_up_goes_first(tmp_path):
    spec = json.load(open(PATH, encoding="utf-8"))
    letters = {**{s: i for i, s in enumerate(bpe.byte_symbols())}, **{s + "</w>": 256 + i for i, s in enumerate(bpe.byte_symbols())}}
    tokens = ["abc", "bc", "abcd", "ab", "abcdabc"]
    spec["model"]["vocab"] = letters | {t: 600 + i for i, t in enumerate(tokens)}
    # "abcd" ranks before the second way to make "abc".
    spec["model"]["merges"] = [["b", "c"], ["abc", "d"], ["abcd", "abc"], ["a", "bc"]]
    path = tmp_path / "small.json"
    path.write_text(json.dumps(spec))
    vocabulary = bpe.Vocabulary(path.read_text())
    assert vocabulary.early
    words = [b"abcdabcdx", b"abcabcd", b"xabcdabcq"]
    assert merged_lists(words, vocabulary) == [plain_merges(w, vocabulary) for w in words]


def test_other_kinds_of_vocabularies_are_refused():
    with pytest.raises((ValueError, KeyError, TypeError)):
        bpe.Vocabulary(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read())


def test_edge_rows(edge_docs, library):
    both = bpe.decode(bpe.encode(edge_docs.select("doc_id", "text", "label"), PATH, name="codes"), PATH, ids="codes")
    assert both.columns == ["doc_id", "text", "label", "codes", "decoded"]
    found = sorted((str(r.doc_id), list(r.codes), r.decoded) for r in both.collect())
    wanted = library_rows(library, [r[1] for r in edge_rows()])
    assert found == sorted((str(r[0]), ids, text) for r, (ids, text) in zip(edge_rows(), wanted))


def test_decoding_leaves_out_unknown_ids(spark):
    rows = spark.createDataFrame([(1, [3306, -1, 99999, 1002]), (2, None), (3, []), (4, [None, 1002])], "k int, ids array<int>")
    found = {r.k: r.decoded for r in bpe.decode(rows, PATH).collect()}
    assert found == {1: "hello</w> world</w>", 2: "", 3: "", 4: "world</w>"}


def test_empty_table(no_docs):
    assert bpe.decode(bpe.encode(no_docs.select("doc_id", "text"), PATH), PATH).collect() == []


def test_query_equals_the_library(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    wanted = {}
    for row, (ids, text) in zip(docs, library_rows(library, [r.text for r in docs])):
        wanted[row.doc_id] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    found = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op6_bpe_codec(spark, sf_dir).collect()}
    assert found == wanted
