import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows_of
from wordloom.functions import html as H
from wordloom.functions import text as X
from wordloom.operators import words as W


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "text string")


def column(df):
    return [row[0] for row in df.collect()]


def ascii_words(spark, *values):
    return column(W.text_words(texts(spark, *values), profile=X.ASCII))


@pytest.mark.parametrize("given_word, wanted", [
    ("Kanak-kanak,", "kanakkanak"), ("Covid19", "covid"), ("2024", ""), ("Café", "café"), ("d'Or", "dor"),
])
def test_clean_word(spark, given_word, wanted):
    assert column(texts(spark, given_word).select(X.clean_word("text"))) == [wanted]


def test_split_then_clean(spark):
    assert column(W.clean_tokens(texts(spark, "a,b;C", ",;", "12").withColumnRenamed("text", "word"))) == ["a", "b", "c"]


def test_combined_text_glues_in_strict_form(spark):
    df = spark.createDataFrame([("Berita Baru", "Hari ini, hujan"), (None, "apa")], "t string, c string")
    strict = df.select(X.combined_text("t", "c", None).alias("text"))
    assert column(W.tokens(strict)) == ["Berita", "BaruHari", "ini", "hujan"]
    assert column(W.tokens(df.select(X.combined_text("t", "c").alias("text")))) == [
        "Berita", "Baru", "Hari", "ini", "hujan", "apa"]


def test_raw_tokens_keep_empties_and_line_breaks(spark):
    assert column(W.tokens(texts(spark, "a  b\nc, d"))) == ["a", "", "b\nc", "d"]


def test_ascii_profile(spark):
    assert ascii_words(spark, "Saya suka\nnasi. Café") == ["Saya", "sukanasi", "Caf"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="aB éÉßşИ1,;.- \n\t'\"", max_size=40), min_size=1, max_size=20))
def test_fused_words_equal_two_steps_and_plain_python(spark, values):
    df = texts(spark, *values)
    fused = sorted(column(W.text_words(df)))
    assert fused == sorted(column(W.clean_tokens(W.tokens(df))))
    expected = []
    for value in values:
        for token in value.replace(", ", " ").split(" "):
            for piece in token.lower().replace(";", ",").split(","):
                word = "".join(ch for ch in piece if ch.isalpha())
                expected += [word] if word else []
    assert fused == sorted(expected)


@pytest.mark.parametrize("views, kept", [("12", True), ("0", False), ("-3", False), ("abc", False), (None, False)])
def test_positive(spark, views, kept):
    df = spark.createDataFrame([(views,)], "v string").where(X.positive(F.col("v")))
    assert (df.count() == 1) is kept


@pytest.mark.parametrize("text, number", [
    ("1,234", 1234), ("n/a", 0), ("-5", 0), ("", 0), ("3,000,000,000", 3_000_000_000), ("9" * 30, 0), (str(2**63 - 1), 2**63 - 1), ("٣", 0)])
def test_count_number(text, number):
    assert H.count_number(text) == number


def test_small_parsers(spark):
    assert [H.comment_number(i) for i in ("comment_12_li", "comment_x", "", "comment_3000000001_li")] == [12, 0, 0, 3_000_000_001]
    assert H.before_bar(" \t2024-1-1 | x") == "2024-1-1"
    assert column(texts(spark, '""a "b""').select(X.strip_quotes(F.col("text")))) == ['a "b']


@pytest.mark.parametrize("text, number", [
    ("0.9", 0.9), ("-0.1", -0.1), (" 1e2 ", 100.0), (".5", 0.5), ("NaN", None), ("n/a", None), ("1d", None),
    ("1_0", None), ("", None), (None, None),
])
def test_parsed_number(spark, text, number):
    df = spark.createDataFrame([(text,)], "t string")
    assert column(df.select(X.parsed_number(F.col("t")))) == [number]


def test_page_url_and_back(spark):
    df = spark.range(5, 6).select(X.page_url("https://f.example.com/view?mod=view&aid=", F.col("id")).alias("u"))
    assert df.select("u", X.page_id_of(F.col("u"))).first() == ("https://f.example.com/view?mod=view&aid=5", 5)
    large = spark.range(3_000_000_000, 3_000_000_001).select(X.page_id_of(X.page_url("https://f.example.com/view?aid=", F.col("id"))))
    assert large.first()[0] == 3_000_000_000


def test_frequency_reports(spark):
    freq = W.word_freq(texts(spark, *"a a a b b c d".split()).withColumnRenamed("text", "word"))
    assert [tuple(r) for r in W.top_words(freq, 2).collect()] == [("a", 3), ("b", 2)]
    assert [tuple(r) for r in W.bottom_words(freq, 3).collect()] == [("c", 1), ("d", 1), ("b", 2)]
    assert rows_of(W.hapax_words(freq)) == [("c",), ("d",)]
    assert tuple(W.vocab_size(freq).first()) == (4, 7)
    assert tuple(W.vocab_size(freq.where("false")).first()) == (0, 0)
    assert rows_of(W.merge_counts(freq, freq.where("word = 'a'"))) == [("a", 6), ("b", 2), ("c", 1), ("d", 1)]


def test_article_words_use_viewed_articles_and_comments(spark):
    articles = spark.createDataFrame([("T", "x, y", "3"), ("U", "z", "0"), ("V", "z", "many")],
                                     "Title string, Content string, Views string")
    comments = spark.createDataFrame([("p q",), (None,)], "Comment_Text string")
    assert column(W.article_words(articles)) == ["T", "x", "y"]
    assert column(W.article_words(articles, comments)) == ["T", "x", "y", "p", "q"]
