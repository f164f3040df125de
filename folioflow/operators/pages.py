"""Source pages: markers, as-of lookup of character positions, estimates, and pages of split documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import U, collapse_whitespace

MARKER = rf"(?i){U}<!--\s*PAGE\s*:\s*\d+\s*-->\n?"
PREFIXES = (120, 80, 60, 40)


def page_ranges(text: Column) -> Column:
    """array<struct<page, start, end>>: half-open character ranges between page markers; the last ends with the text."""
    numbers = F.regexp_extract_all(text, F.lit(rf"(?i){U}<!--\s*PAGE\s*:\s*(\d+)\s*-->"), F.lit(1))
    whole = F.regexp_extract_all(text, F.lit(MARKER), F.lit(0))
    parts = F.split(text, MARKER, -1)
    sizes = F.zip_with(F.zip_with(F.slice(parts, F.lit(1), F.size(numbers)), whole, lambda p, m: F.length(p) + F.length(m)), numbers, lambda n, page: F.struct(n.alias("skip"), page.cast("int").alias("page")))
    rows = F.zip_with(sizes, F.slice(parts, F.lit(2), F.size(numbers)), lambda s, body: F.struct(s.skip.alias("skip"), s.page.alias("page"), F.length(body).alias("n")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<page:int,start:int,end:int>>").alias("out"))

    def step(s: Column, r: Column) -> Column:
        begin = s["at"] + r.skip
        row = F.struct(r.page.alias("page"), begin.alias("start"), (begin + r.n).alias("end"))
        return F.struct(begin.alias("at"), F.concat(s.out, F.array(row)).alias("out"))

    return F.when(F.size(numbers) == 0, start.out).otherwise(F.aggregate(rows, start, step, lambda s: s.out))


def page_at(ranges: Column, position: Column) -> Column:
    """The page of a character position: null before the first page and inside markers, the last page beyond the end."""
    before = F.filter(ranges, lambda r: r.start <= position)
    own = F.element_at(before, -1)
    last = F.size(before) == F.size(ranges)
    return F.when(F.size(before) > 0, F.when((position < own.end) | last, own.page))


def page_by_line(markers: DataFrame, positions: DataFrame) -> DataFrame:
    """positions (doc, id, pos) with the last page of markers (doc, pos, page) at or before pos, 1 if there is none.

    An as-of join by one sort: both sides are united and the last page is carried forward.
    """
    both = markers.where("page > 0").select("doc", "pos", "page", F.lit(None).cast("bigint").alias("id"), F.lit(0).alias("kind")).unionByName(
        positions.select("doc", "pos", F.lit(None).cast("int").alias("page"), F.col("id").cast("bigint"), F.lit(1).alias("kind"))
    )
    so_far = Window.partitionBy("doc").orderBy("pos", "kind").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("page", F.coalesce(F.last("page", ignorenulls=True).over(so_far), F.lit(1))).where("kind = 1").select("doc", "id", "pos", "page")


def find_prefix(node: Column, text: Column, prefixes: tuple[int, ...] = PREFIXES) -> Column:
    """Character position of the first of a node's beginnings that a text contains, -1 if it has none."""
    found = (F.when((F.length(F.substring(node, 1, n)) > 0), F.nullif(F.instr(text, F.substring(node, 1, n)), F.lit(0))) for n in prefixes)
    return F.coalesce(*found, F.lit(0)) - 1


def assign_pages(nodes: DataFrame, paged: DataFrame) -> DataFrame:
    """nodes (doc, id, text) with source_char_pos, page_start and page_end from paged (doc, text with page markers).

    Positions count in the text of the pages, white space collapsed and joined by blanks. Nodes that are not found have
    position -1 and no pages.
    """
    markers = F.regexp_extract_all("text", F.lit(rf"(?i){U}<!--\s*PAGE\s*:\s*(\d+)\s*-->"), F.lit(1))
    bodies = F.slice(F.split("text", MARKER, -1), F.lit(2), F.greatest(F.size(markers), F.lit(1)))
    flat = paged.select("doc", markers.alias("numbers"), F.transform(bodies, collapse_whitespace).alias("bodies"))
    starts = F.aggregate("bodies", F.array(F.lit(0)), lambda a, b: F.concat(a, F.array(F.element_at(a, -1) + F.length(b) + 1)))
    ranges = F.transform(F.slice(starts, F.lit(1), F.size("bodies")), lambda s, i: F.struct(F.get("numbers", i).cast("int").alias("page"), s.alias("start"), (s + F.length(F.get("bodies", i)) + 1).alias("end")))
    flat = flat.select("doc", F.array_join("bodies", " ").alias("flat"), ranges.alias("ranges"))
    found = nodes.join(flat, "doc", "left").withColumn("own", collapse_whitespace(F.col("text"))).withColumn("at", F.coalesce(find_prefix(F.col("own"), F.col("flat")), F.lit(-1)))
    first = F.when(F.col("at") >= 0, page_at(F.col("ranges"), F.col("at")))
    last = F.when(F.col("at") >= 0, page_at(F.col("ranges"), F.greatest(F.col("at"), F.col("at") + F.length("own") - 1)))
    return found.select(*nodes.columns, F.col("at").alias("source_char_pos"), first.alias("page_start"), F.coalesce(last, first).alias("page_end"))


def estimate_pages(nodes: DataFrame, pages: Column) -> DataFrame:
    """nodes (doc, idx, text) with the page in which the node's middle lies if text is spread evenly over `pages` pages."""
    before = Window.partitionBy("doc").orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("doc")
    center = F.coalesce(F.sum(F.length("text")).over(before), F.lit(0)) + F.length("text") / 2
    total = F.greatest(F.sum(F.length("text")).over(whole), F.lit(1))
    return nodes.withColumn("page", F.least(F.greatest(F.floor(center / total * pages) + 1, F.lit(1)), pages).cast("int"))


def reorder(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """nodes (doc, idx, text) with source_char_pos in docs (doc, text) and the order by it; nodes not found keep theirs at the end."""
    source = docs.select("doc", collapse_whitespace(F.col("text")).alias("source"))
    at = F.coalesce(find_prefix(collapse_whitespace(F.col("text")), F.col("source"), (120, 80, 60)), F.lit(-1))
    found = nodes.join(source, "doc", "left").withColumn("source_char_pos", at).drop("source")
    order = Window.partitionBy("doc").orderBy(F.when(F.col("source_char_pos") < 0, 1).otherwise(0), "source_char_pos", "idx")
    return found.withColumn("order", F.row_number().over(order) - 1)
