"""Article and comment fields from stored HTML pages."""

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial
from xml.etree.ElementTree import Element

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from wordloom.functions import html as H
from wordloom.schemas import FLAT_PAGE, PAGE_RECORD


@dataclass(frozen=True)
class Selector:
    """A tag, optionally with an id or one of its classes; ``any_id`` asks for some id."""

    tag: str
    id: str | None = None
    cls: str | None = None
    any_id: bool = False

    def matches(self, node: Element) -> bool:
        return (
            node.tag == self.tag
            and (self.id is None or node.get("id") == self.id)
            and (self.cls is None or self.cls in node.get("class", "").split())
            and (not self.any_id or "id" in node.attrib)
        )


@dataclass(frozen=True)
class PageSpec:
    """Where the fields of an article page are. The defaults are fixed values: one forum's page layout."""

    title: Selector = Selector("title")
    byline: Selector = Selector("p", cls="xg1")
    publisher: Selector = Selector("a")
    views: Selector = Selector("em", id="_viewnum")
    comment_count: Selector = Selector("em", id="_commentnum")
    content: Selector = Selector("td", id="article_content")
    comments: Selector = Selector("div", id="comment_ul")
    comment: Selector = Selector("dl", any_id=True)
    user: Selector = Selector("a", cls="xi2")
    body: Selector = Selector("dd")
    quote: Selector = Selector("div", cls="quote")
    joiner: str = ""


# What stands in for an absent tag.
NO_VALUE, NO_USER, NO_TEXT = "Unknown", "Anonymous", "No comment text"
_PAGES_AT_ONCE = 256  # pages held as Python objects at a time


def _find(node: Element | None, selector: Selector) -> Element | None:
    if node is None:
        return None
    return next((n for n in node.iter() if n is not node and selector.matches(n)), None)


def _plain(node: Element | None, default: str) -> str:
    return default if node is None else "".join(H.texts(node)).strip()


def _joined(node: Element, joiner: str, without: Selector | None = None) -> str:
    stripped = (text.strip() for text in H.texts(node, without and without.matches))
    return joiner.join(t for t in stripped if t)


def _comment_record(node: Element, page_id: int, spec: PageSpec) -> dict:
    body = _find(node, spec.body)
    return {
        "AID": page_id,
        "Comment_ID": H.comment_number(node.get("id", "")),
        "User": _plain(_find(node, spec.user), NO_USER),
        "Comment_Text": NO_TEXT if body is None else _joined(body, spec.joiner, spec.quote),
    }


def page_record(page_id: int, html: str, spec: PageSpec = PageSpec()) -> dict:
    """The article and its comments as one record."""
    root = H.parse(html)
    byline = _find(root, spec.byline)
    content = _find(root, spec.content)
    comments = _find(root, spec.comments)
    return {
        "Article": {
            "AID": page_id,
            "Title": _plain(_find(root, spec.title), NO_VALUE),
            "Date": NO_VALUE if byline is None else H.before_bar("".join(H.texts(byline))),
            "Publisher": _plain(_find(byline, spec.publisher), NO_VALUE),
            "Views": H.count_number(_plain(_find(root, spec.views), "0")),
            "Comments_Count": H.count_number(_plain(_find(root, spec.comment_count), "0")),
            "Content": "" if content is None else _joined(content, spec.joiner),
        },
        "Comments": [] if comments is None else [
            _comment_record(n, page_id, spec) for n in comments.iter() if n is not comments and spec.comment.matches(n)
        ],
    }


Extractor = Callable[[int, str], dict | None]


def _read(pages: DataFrame, read: Callable[[int, str], dict], schema: T.StructType) -> DataFrame:
    """``read`` on every stored page; ``page_id`` always, and why a page could not be read in ``problem``."""
    full = T.StructType([pages.schema["page_id"], *schema, T.StructField("problem", T.StringType())])
    arrow = to_arrow_schema(full)

    def record(page_id, html):
        if html is None:
            return {"page_id": page_id, "problem": "no html"}
        try:
            found = read(page_id, html)
            return {"page_id": page_id, **found} if found else {"page_id": page_id, "problem": "no record"}
        except Exception as problem:  # one unreadable page must not stop the job
            return {"page_id": page_id, "problem": f"{type(problem).__name__}: {problem}"}

    def fitting(page_id, row):
        try:
            pa.RecordBatch.from_pylist([row], schema=arrow)
            return row
        except Exception as problem:
            return {"page_id": page_id, "problem": f"{type(problem).__name__}: {problem}"}

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for start in range(0, batch.num_rows, _PAGES_AT_ONCE):
                ids, htmls = (column.to_pylist() for column in batch.slice(start, _PAGES_AT_ONCE).columns)
                records = [record(*page) for page in zip(ids, htmls)]
                try:
                    read_rows = pa.RecordBatch.from_pylist(records, schema=arrow)
                except Exception:  # an extractor's record may not fit the schema; only then are they looked at one by one
                    read_rows = pa.RecordBatch.from_pylist(list(map(fitting, ids, records)), schema=arrow)
                yield read_rows

    return pages.select("page_id", "html").mapInArrow(run, full)


def extract_pages(pages: DataFrame, extractor: Extractor | None = None, spec: PageSpec = PageSpec()) -> DataFrame:
    """``(page_id, Article, Comments, problem)`` per stored page ``(page_id, html)``, page by page on executors.

    Any function from id and HTML to a record can be plugged in. A page it cannot read keeps its id, has a null article
    and null comments, and says why in ``problem``. Write the result once when several parts are needed.
    """
    return _read(pages, extractor or partial(page_record, spec=spec), PAGE_RECORD)


def articles(records: DataFrame) -> DataFrame:
    """One row per page; an unreadable page is a row of nulls, and stands in :func:`page_rejects` with its id."""
    return records.select("Article.*")


def comments(records: DataFrame) -> DataFrame:
    """One row per comment; pages without comments give none."""
    return records.select(F.explode("Comments").alias("Comment")).select("Comment.*")


def page_rejects(records: DataFrame) -> DataFrame:
    """``(page_id, problem)`` of the pages that could not be read."""
    return records.where("problem IS NOT NULL").select("page_id", "problem")


def _flat(page_id: int, html: str, joiner: str) -> dict:
    root = H.parse(html)
    return {"title": _plain(_find(root, PageSpec.title), NO_VALUE), "text": H.visible_text(root, joiner),
            "links": [{"href": href, "label": label} for href, label in H.links(root)]}


def read_pages(pages: DataFrame, joiner: str = " ") -> DataFrame:
    """``(page_id, title, text, links, problem)``: the parts that need no page layout, from one reading of the page."""
    return _read(pages, partial(_flat, joiner=joiner), FLAT_PAGE)


def page_titles(pages: DataFrame) -> DataFrame:
    return read_pages(pages).select("page_id", F.coalesce("title", F.lit(NO_VALUE)).alias("title"))


def page_text(pages: DataFrame, joiner: str = " ") -> DataFrame:
    return read_pages(pages, joiner).select("page_id", "text")


def page_links(pages: DataFrame) -> DataFrame:
    """One row per link, in page order."""
    found = read_pages(pages).select("page_id", F.posexplode("links").alias("position", "link"))
    return found.select("page_id", "position", "link.*")
