"""Schemas shared by sources and operators; nothing is inferred at run time."""

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


ARTICLE = T.StructType([
    T.StructField("AID", T.LongType()),
    T.StructField("Title", T.StringType()),
    T.StructField("Date", T.StringType()),
    T.StructField("Publisher", T.StringType()),
    T.StructField("Views", T.LongType()),
    T.StructField("Comments_Count", T.LongType()),
    T.StructField("Content", T.StringType()),
])

COMMENT = T.StructType([
    T.StructField("AID", T.LongType()),
    T.StructField("Comment_ID", T.LongType()),
    T.StructField("User", T.StringType()),
    T.StructField("Comment_Text", T.StringType()),
])

PAGE_RECORD = T.StructType([
    T.StructField("Article", ARTICLE),
    T.StructField("Comments", T.ArrayType(COMMENT)),
])

FLAT_PAGE = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("links", T.ArrayType(_strings("href", "label"))),
])

MESSAGE = _strings("Title", "Content")

SEARCH_RESPONSE = T.StructType([
    T.StructField("query", T.StructType([
        T.StructField("search", T.ArrayType(_strings("title"))),
    ])),
])

PAGES_RESPONSE = T.StructType([
    T.StructField("query", T.StructType([
        T.StructField("pages", T.MapType(T.StringType(), _strings("title", "extract"))),
    ])),
])

LABEL_FIELDS = ("word", "definition", "antonym", "synonym", "pos", "sentiment")
LABEL_TEXT = _strings(*LABEL_FIELDS)

ANSWER = T.StructType([
    T.StructField("batch_id", T.LongType()),
    *_strings("response", "error"),
])

WORD_BATCH = T.StructType([
    T.StructField("batch_id", T.LongType()),
    *_strings("word"),
])

PROPS = _strings("word", "definition", "pos")

EDGE = _strings("src", "rel", "dst")

COMPONENT = _strings("word", "component")
