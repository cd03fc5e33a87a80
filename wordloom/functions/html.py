"""Reading HTML as a browser does: a tree with all character references decoded, and the texts and links in it."""

from collections.abc import Iterator
from html.parser import HTMLParser
from xml.etree.ElementTree import Element, SubElement

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_HIDDEN = frozenset(("script", "style", "template"))


class _TreeParser(HTMLParser):
    """Builds an element tree in which every run of text is a ``#text`` child."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("#root")
        self._open = [self.root]
        self._runs: list[list[str]] = [[]]
        self._counts: dict[str, int] = {}

    def _end_run(self) -> None:
        run = self._runs[-1]
        if run:
            SubElement(self._open[-1], "#text").text = "".join(run)
            run.clear()

    def handle_starttag(self, tag, attrs):
        self._end_run()
        node = SubElement(self._open[-1], tag, {k: v or "" for k, v in attrs})
        if tag not in _VOID:
            self._open.append(node)
            self._runs.append([])
            self._counts[tag] = self._counts.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self._end_run()
        SubElement(self._open[-1], tag, {k: v or "" for k, v in attrs})

    def handle_endtag(self, tag):
        # Counting open tags makes a stray end tag cheap however deep the tree is.
        while self._counts.get(tag):
            self._end_run()
            self._runs.pop()
            closed = self._open.pop().tag
            self._counts[closed] -= 1
            if closed == tag:
                return

    def handle_data(self, data):
        self._runs[-1].append(data)

    def handle_comment(self, data):
        self._end_run()
        SubElement(self._open[-1], "#comment")

    def close(self):
        super().close()
        while len(self._open) > 1:
            self._end_run()
            self._runs.pop()
            self._open.pop()
        self._end_run()


def parse(html: str) -> Element:
    parser = _TreeParser()
    parser.feed(html)
    parser.close()
    return parser.root


def texts(node: Element, without=None) -> Iterator[str]:
    """The runs of visible text below ``node`` in page order, but not those below children that ``without`` matches.

    The walk keeps its own stack, so a page may be nested to any depth.
    """
    stack = [iter(node)]
    while stack:
        child = next(stack[-1], None)
        if child is None:
            stack.pop()
        elif child.tag == "#text":
            yield child.text
        elif child.tag not in _HIDDEN and not (without and without(child)):
            stack.append(iter(child))


def visible_text(root: Element, joiner: str = " ") -> str:
    """All visible text, with ``joiner`` between runs and every stretch of white space as one space."""
    return " ".join(joiner.join(texts(root)).split())


def links(root: Element) -> list[tuple[str, str]]:
    """``(href, label)`` of all anchors with an address, in page order."""
    return [(a.get("href"), "".join(texts(a)).strip()) for a in root.iter("a") if "href" in a.attrib]


def count_number(text: str) -> int:
    """Digits with thousands commas as a number; anything else, nothing, or more than a bigint holds, is 0."""
    digits = text.replace(",", "")
    number = int(digits) if digits.isascii() and digits.isdigit() and len(digits.lstrip("0")) <= 19 else 0
    return number if number < 2**63 else 0


def comment_number(element_id: str) -> int:
    """``comment_12_li`` -> 12; anything without digits in that place -> 0."""
    return count_number(element_id.replace("comment_", "").split("_")[0])


def before_bar(text: str) -> str:
    """Text before the first vertical bar, stripped."""
    return text.split("|")[0].strip()
