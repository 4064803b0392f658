"""HTML block extraction with built-in regular expressions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, functions as F

# Basic character references; the ampersand comes last.
_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))
_SPACE = r"[\s\p{Z}]*"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _open_tag(tag: str, css_class: str | None) -> str:
    """Pattern of an opening tag. Several classes must match as written, one may stand among others."""
    if css_class is None:
        return rf"<{tag}(?:\s[^>]*)?>"
    wanted = re.escape(css_class)
    if " " not in css_class:
        wanted = rf'(?:[^"]*\s)?{wanted}(?:\s[^"]*)?'
    return rf'<{tag}\s[^>]*?class="{wanted}"[^>]*>'


def blocks(html: Column | str, tag: str, css_class: str | None = None) -> Column:
    """Inner HTML of every matching element, in document order."""
    pattern = rf"(?s){_open_tag(tag, css_class)}(.*?)</{tag}>"
    return F.regexp_extract_all(_col(html), F.lit(pattern), 1)


def attributes(html: Column | str, tag: str, attribute: str) -> Column:
    """Value of one attribute of every matching element."""
    return F.regexp_extract_all(_col(html), F.lit(rf'<{tag}\s[^>]*?{attribute}="([^"]*)"'), 1)


def sections(html: Column | str, tag: str, css_class: str) -> Column:
    """Cut a page before each matching element; text ahead of the first one is left out."""
    parts = F.split(_col(html), f"(?={_open_tag(tag, css_class)})")
    return F.filter(parts, lambda p: p.rlike(f"^{_open_tag(tag, css_class)}"))


def first_block(html: Column | str, tag: str, css_class: str | None = None) -> Column:
    return F.get(blocks(html, tag, css_class), F.lit(0))


def node_text(inner: Column | str) -> Column:
    """Text of a node: tags dropped, each piece stripped, entities decoded; empty is NULL."""
    spaced = F.replace(_col(inner), F.lit("&nbsp;"), F.lit("\u00a0"))
    bare = F.regexp_replace(spaced, f"{_SPACE}<[^>]+>{_SPACE}", "")
    stripped = F.regexp_replace(bare, f"^{_SPACE}|{_SPACE}$", "")
    decoded = reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), _ENTITIES, stripped)
    return F.nullif(decoded, F.lit(""))
