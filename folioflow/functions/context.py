"""Source names, page choice and context headers; Column -> Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import U, clean_basic, collapse_whitespace, drop_numbered_page_markers, let, squeeze_blank_lines, strip, sub

HEADER = "Ngữ cảnh"
EXCERPT = "Trích đoạn từ "
LIMIT = 200


def source_name(name: Column) -> Column:
    """Without the extension and part numbers, with .pdf at the end."""
    return F.concat(sub(sub(sub(name, r"(?i)\.pdf\z"), r"(?i)[_-]part[_-]\d+"), r"[_\- ]+\z"), F.lit(".pdf"))


def document_id(name: Column) -> Column:
    """Without .pdf, every character but word characters and dashes replaced by an underscore."""
    return sub(sub(name, r"\.pdf\z"), rf"{U}[^\w\-]", "_")


def node_id(document: Column, index: Column) -> Column:
    """The index has at least four digits; longer ones stay whole."""
    return F.concat_ws("_node_", document, F.when(index.isNotNull(), F.format_string("%04d", index.cast("bigint"))))


def page_of(page_start: Column, page: Column, metadata_page: Column) -> Column:
    """The first of the three that is positive; null if none is."""
    return F.coalesce(*(F.when(p > 0, p) for p in (page_start, page, metadata_page)))


def optimal_part_pages(total: Column, target: int) -> Column:
    """Pages of a part such that the parts of a document are equally long and not above target."""
    return F.when(total <= target, total).otherwise(F.ceil(total / F.ceil(total / target))).cast("bigint")


def part_of(page: Column, pages: Column) -> Column:
    """Number of the part, from 1, in which a page lies."""
    return (F.floor((page - 1) / pages) + 1).cast("bigint")


def page_in_document(local: Column, part: Column, pages: Column, total: Column) -> Column:
    """The page of the whole document for a page of a part, at most the last one."""
    return F.least(local + (part - 1) * pages, total).cast("bigint")


def drop_context(text: Column) -> Column:
    """Without context header lines."""
    return strip(squeeze_blank_lines(sub(text, rf"(?md)^\[{HEADER}:[^\n]*\]\s*$\n?")))


def context(source: Column, text: Column) -> Column:
    """`Trích đoạn từ <source>: <first sentence or two>`, at most 200 characters on one line."""
    prefix, bare = F.concat(F.lit(EXCERPT), source, F.lit(": ")), F.concat(F.lit(EXCERPT), source)
    room = F.lit(LIMIT) - F.length(prefix)

    def idea(parts: Column) -> Column:
        first, second = strip(F.get(parts, 0)), strip(F.get(parts, 1))
        return F.when((F.length(first) < 10) & second.isNotNull(), F.concat(first, F.lit(". "), second)).otherwise(first)

    def at_word(short: Column) -> Column:
        blank = F.length(short) - F.locate(" ", F.reverse(short))
        return F.when((F.locate(" ", F.reverse(short)) > 0) & (blank > F.floor((room - 3) / 2)), F.substring(short, F.lit(1), blank)).otherwise(short)

    def fitted(own: Column) -> Column:
        cut = F.concat(sub(let(F.substring(own, F.lit(1), room - 3), at_word), r"[ ,;:\-]+\z"), F.lit("..."))
        return F.when(F.length(own) <= room, own).when(room <= 3, F.substring(own, F.lit(1), room)).otherwise(cut)

    def whole(flat: Column) -> Column:
        own = let(F.split(flat, rf"{U}[.;!?]\s", 3), lambda parts: let(idea(parts), fitted))
        return F.when(flat == "", bare).when(room <= 0, F.substring(bare, 1, LIMIT)).otherwise(F.concat(prefix, own))

    return let(strip(sub(collapse_whitespace(text), rf"{U}^(?:[#*\-•]+|\d+[.)\s])+\s*")), whole)


def with_context(source: Column, text: Column) -> Column:
    """The cleaned text under exactly one context header."""
    bare = F.concat(F.lit(f"[{HEADER}: {EXCERPT}"), source, F.lit("]"))
    headed = lambda own: F.when(own == "", bare).otherwise(F.concat(F.lit(f"[{HEADER}: "), context(source, own), F.lit("]\n\n"), own))
    return let(strip(drop_numbered_page_markers(clean_basic(drop_context(text)))), headed)
