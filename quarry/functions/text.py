"""String expressions shared by the text and tree operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns.  A word is a maximal run of Unicode letters; in social
# text a leading @ (user name) or # (tag) stays part of the token, and URLs
# are removed before tokenising.
WORD_PATTERN = r"\p{L}+"
SOCIAL_WORD_PATTERN = r"[@#]?\p{L}+"
URL_PATTERN = r"(https?://|www\.)\S+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(text, social: bool = False) -> Column:
    """Lower-cased letter runs of the whole text, in order (array<string>).

    ``social=True`` drops URLs first and keeps ``@name`` / ``#tag`` tokens.
    """
    t = F.lower(_col(text))
    if social:
        t = F.regexp_replace(t, URL_PATTERN, " ")
        return F.regexp_extract_all(t, F.lit(f"({SOCIAL_WORD_PATTERN})"), 1)
    return F.regexp_extract_all(t, F.lit(f"({WORD_PATTERN})"), 1)


def word_count(text) -> Column:
    return F.size(F.regexp_extract_all(_col(text), F.lit(f"({WORD_PATTERN})"), 1))


def letter_share(text) -> Column:
    """Share of characters that are letters; null for an empty text."""
    t = _col(text)
    letters = F.length(F.regexp_replace(t, r"\P{L}", ""))
    return F.try_divide(letters.cast("double"), F.length(t).cast("double"))
