"""Text of raw pages and parts of their addresses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Removed with all they hold; one pattern each, as RE2 has no backreferences.
DROPPED = ("script", "style", "noscript", "template")
#: Ends of these are line breaks.
BLOCKS = r"(?i)<(?:br|/p|/div|/li|/h[1-6]|/tr|/title)[^>]*>"
#: Entities that are decoded; the ampersand comes last.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}


def page_text(html: Column) -> Column:
    """What a reader sees of a page, blank runs joined and lines trimmed."""
    out = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    for tag in DROPPED:
        out = F.regexp_replace(out, rf"(?is)<{tag}[^0-9a-z].*?</{tag}[^>]*>|<{tag}>.*?</{tag}[^>]*>", "")
    out = F.regexp_replace(F.regexp_replace(out, BLOCKS, "\n"), r"<[^>]*>", " ")
    out = reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), ENTITIES.items(), out)
    out = F.regexp_replace(out, r"[ \t\r]+", " ")
    return F.btrim(F.regexp_replace(out, r" ?\n[ \n]*", "\n"), F.lit(" \n"))


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+([^?#]*)", 1)
