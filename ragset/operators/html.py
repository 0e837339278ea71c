"""HTML pages as markdown, by built-in functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What ends a block, in between the steps.
CUT = "\x01"
_ATTR = r"""\s*=\s*["']([^"']*)["']"""
#: Steps from a page to blocks, in order: what is never shown, images and links with their targets, headings, items, rows, blocks, other tags, entities.
STEPS = [
    (r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<head\b.*?</head\s*>|<noscript\b.*?</noscript\s*>", ""),
    (rf"(?is)<img\b[^>]*?\balt{_ATTR}[^>]*?\bsrc{_ATTR}[^>]*>", " ![$1]($2) "),
    (rf"(?is)<img\b[^>]*?\bsrc{_ATTR}[^>]*?\balt{_ATTR}[^>]*>", " ![$2]($1) "),
    (rf"(?is)<img\b[^>]*?\bsrc{_ATTR}[^>]*>", " ![]($1) "),
    (rf"(?is)<a\b[^>]*?\bhref{_ATTR}[^>]*>(.*?)</a\s*>", "[$2]($1)"),
    *((rf"(?i)<h{i}\b[^>]*>", f"{CUT}{'#' * i} ") for i in range(1, 7)),
    (r"(?i)</h[1-6]\s*>", CUT),
    (r"(?i)<li\b[^>]*>", f"{CUT}- "),
    (r"(?i)<t[dh]\b[^>]*>", " | "),
    (r"(?i)</tr\s*>", f" |{CUT}"),
    (r"(?i)</?(?:p|div|section|article|ul|ol|li|table|thead|tbody|tfoot|tr|br|blockquote|body|html)\b[^>]*>", CUT),
    (r"<[a-zA-Z/!?][^>]*>", ""),
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;|&apos;", "'"), ("&amp;", "&"),
]


def markdown(html: Column) -> Column:
    """Headings, paragraphs, list items, tables with a rule below their first row, images and links of a page, blank lines between; a null page is empty.

    Named entities but for the few of STEPS stay as they are. White space within a block is one space.
    """
    page = F.coalesce(html, F.lit(""))
    for pattern, put in STEPS:
        page = F.regexp_replace(page, pattern, put)
    blocks = F.transform(F.split(page, CUT), lambda b: F.trim(F.regexp_replace(b, r"[ \t\n\r\f\x0b]+", " ")))
    blocks = F.filter(blocks, lambda b: ~b.rlike(r"^(?:#{1,6}|-|[| ]*)$"))
    row = lambda b: F.coalesce(b.rlike(r"^\|.*\|$"), F.lit(False))

    def joined(b: Column) -> Column:
        first = lambda x, i: row(x) & ~row(F.get(b, i - 1))
        rule = lambda x: F.concat(F.lit("\n|"), F.repeat(F.lit("---|"), F.length(F.regexp_replace(x, r"[^|]", "")) - 1))
        gap = lambda x, i: F.when(i == 0, "").when(row(x) & row(F.get(b, i - 1)), "\n").otherwise("\n\n")
        return F.array_join(F.transform(b, lambda x, i: F.concat(gap(x, i), x, F.when(first(x, i), rule(x)).otherwise(""))), "")

    return F.transform(F.array(blocks), joined)[0]  # the blocks are made once


def html_to_markdown(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, markdown) of each page."""
    return pages.select(key, markdown(F.col(html)).alias("markdown"))
