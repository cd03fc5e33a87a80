"""Text expressions. All are built-ins, so they stay in JVM and need no Python worker."""

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Profile:
    """How running text becomes words.

    ``drop`` removes characters without splitting; ``separators`` are the single characters that split.
    """

    lower: bool
    drop: str
    separators: str


# What each of the two cleaning modes keeps and splits on.
UNICODE = Profile(lower=True, drop=r"[^\p{L} ,;]+", separators=" ,;")
ASCII = Profile(lower=False, drop=r"[^a-zA-Z ]+", separators=" ")
NOT_A_LETTER = r"[^\p{L}]+"
WHITESPACE_ENDS = r"^\s+|\s+$"
# Fixed value: decimal text that both Python's float() and Spark read alike.
NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def combined_text(title, content, separator: str | None = " ") -> Column:
    """Title and content as one text.

    ``separator=None`` is the strict form: the two are glued together and a null in either gives null.
    """
    if separator is None:
        return F.concat(title, content)
    return F.concat_ws(separator, title, content)


def raw_tokens(text) -> Column:
    """Array of space-separated tokens; comma+space counts as a space, empty tokens stay."""
    return F.split(F.replace(text, F.lit(", "), F.lit(" ")), " ")


def clean_word(word) -> Column:
    """Lower-case letters of any script; everything else vanishes without splitting."""
    return F.regexp_replace(F.lower(word), NOT_A_LETTER, "")


def text_words(text, profile: Profile = UNICODE) -> Column:
    """Array of cleaned words of a whole text, possibly with empty entries.

    Equals tokenizing and then cleaning each token, but runs one pattern per text instead of one per token:
    dropping characters never touches a separator, so the order of the two steps does not matter.
    """
    base = F.lower(text) if profile.lower else F.col(text) if isinstance(text, str) else text
    kept = F.regexp_replace(base, profile.drop, "")
    for separator in profile.separators.replace(" ", ""):
        kept = F.replace(kept, F.lit(separator), F.lit(" "))
    return F.split(kept, " ")


def strip_text(text) -> Column:
    """Remove all leading and trailing whitespace, not only spaces."""
    return F.regexp_replace(text, WHITESPACE_ENDS, "")


def strip_quotes(text) -> Column:
    """Remove all leading and trailing double quotes."""
    return F.btrim(text, F.lit('"'))


def parsed_number(text) -> Column:
    """Double, or null where the text is not a plain decimal number."""
    bare = strip_text(text)
    return F.when(bare.rlike(NUMBER), bare.try_cast("double"))


def positive(text) -> Column:
    """True where the text is an integer above 0; bad text is not an error."""
    return F.coalesce(text.try_cast("bigint") > 0, F.lit(False))


def page_url(base_url: str, page_id) -> Column:
    return F.concat(F.lit(base_url), page_id.cast("string"))


def page_id_of(url) -> Column:
    """Inverse of :func:`page_url` for urls that carry the id in the ``aid`` parameter."""
    return F.try_parse_url(url, F.lit("QUERY"), F.lit("aid")).try_cast("bigint")
