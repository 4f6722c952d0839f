"""Text column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: markup tags are whatever stands between < and >.
TAG_PATTERN = "<[^>]+>"


def strip_tags(html: Column) -> Column:
    """Replace every markup tag by one blank."""
    return F.regexp_replace(html, TAG_PATTERN, " ")


def document_content(title: Column, html: Column, max_chars: int | None = None) -> Column:
    """Title, line break, tag-free body. ``max_chars`` caps the body on request."""
    body = strip_tags(html)
    if max_chars is not None:
        body = F.substring(body, 1, max_chars)
    return F.concat(title, F.lit("\n"), body)


def is_blank(value: Column) -> Column:
    """True for NULL and for text of blanks only."""
    return F.coalesce(F.trim(value) == "", F.lit(True))


def words(text: Column) -> Column:
    """Blank-separated words, empty pieces removed."""
    return F.filter(F.split(text, " "), lambda w: w != "")
