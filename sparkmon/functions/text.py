"""Text column expressions: tokens and guide sections."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkmon import constants as K

# Fixed value: a token is a run of at least two letters, digits or underscores.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
# Fixed value: the characters removed around a quoted paragraph.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def tokens(text: str | Column) -> Column:
    """Lower-case tokens of the whole text, in order, with repeats."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), 0)


def is_content(token: str, stop_words: list[str] | None = None) -> Column:
    """Whether an exploded token is not a stop word."""
    stop = K.STOP_WORDS if stop_words is None else stop_words
    if not stop:
        return F.lit(True)
    listed = ", ".join("'" + word.replace("'", "\\'") + "'" for word in stop)
    return F.expr(f"`{token}` NOT IN ({listed})")


def content(text: str | Column, stop_words: list[str] | None = None) -> Column:
    """The tokens of the whole text that are no stop words, in order, with repeats."""
    stop = K.STOP_WORDS if stop_words is None else stop_words
    return F.filter(tokens(text), lambda token: ~token.isin(list(stop))) if stop else tokens(text)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def guide_action(text: str | Column) -> Column:
    """The "Recommended action" paragraph on one line, else the first 300 characters."""
    text = F.col(text) if isinstance(text, str) else text
    sections = F.filter(
        F.split(text, "## "),
        lambda c: (F.lower(F.substring(c, 1, len(K.ACTION_HEADING))) == K.ACTION_HEADING)
        & c.contains("\n"),
    )
    section = F.get(sections, F.lit(0))
    body = F.substring(section, F.locate("\n", section) + 1, F.length(section))
    paragraph = F.replace(strip(body), F.lit("\n"), F.lit(" "))
    return F.coalesce(paragraph, F.substring(strip(text), 1, K.ACTION_FALLBACK_CHARS))


def preview(text: str | Column, chars: int = K.PREVIEW_CHARS) -> Column:
    return F.substring(text, 1, chars)
