"""Entry points as DataFrame functions, each the composition of its steps in one lazy plan."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import context as X
from ..functions import nodes as N
from ..functions import text as T
from ..functions import vietnamese as V
from ..operators import audit, chunks, exports, pages, tables, tags
from ..operators.cleaning import clean_nodes

#: Nodes that main() rechunks are cut beyond so many characters.
TARGET = 8000


def clean_document(docs: DataFrame, extract: bool = True) -> DataFrame:
    """(doc, text, tables): both cleaning stages over docs (doc, text); paragraphs are kept apart for the chunker."""
    first = (T.drop_page_markers, T.drop_invisible, T.drop_footer_lines, T.drop_image_links, T.drop_long_separators, T.drop_gibberish_lines, T.drop_page_artifacts, T.drop_repeated_lines, partial(T.fix_ocr_punctuation, keep_paragraphs=True), T.normalise_markdown, T.normalise_whitespace)
    second = (partial(V.join_broken_lines, keep_empty=True), V.fix_ocr_letters, V.normalise_headings, V.normalise_bullets, V.replace_breaks, V.normalise_punctuation, partial(V.normalise_spacing, keep_numbers=True))
    found = T.apply(docs.select("doc", "text"), *first, *second)
    found = tables.extract_tables(found) if extract else found.withColumn("tables", F.array().cast(tables.TABLES))
    return T.apply(found, V.drop_residue)


def _numbered(nodes: DataFrame, *order: str) -> DataFrame:
    """nodes with idx anew: their place in a document by page_start, source_char_pos (unknown ones last) and what else is named."""
    place = [F.coalesce("page_start", F.lit(999_999)), F.when(F.col("source_char_pos") >= 0, F.col("source_char_pos")).otherwise(999_999)]
    return nodes.withColumn("idx", (F.row_number().over(Window.partitionBy("doc").orderBy(*place, *order)) - 1).cast("bigint"))


def main(docs: DataFrame, paged: DataFrame | None = None, dictionary: dict[str, list[str]] | None = None, least: int = 150, most: int = 400, threshold: float = 0.85, skip: tuple[bool, bool, bool] = (False, False, False)) -> DataFrame:
    """Nodes (doc, idx, id, section, text, source, page, page_start, page_end, merged, tags, domain) of docs (doc, text).

    Documents are cleaned and cut into nodes; nodes get pages from paged (doc, text with page markers), are cleaned and
    repaired (skip: administrative texts, name lists, contents), cut at TARGET characters with the path of their headings
    as section, given pages again, deduplicated, merged and tagged. Without paged, pages are unknown and page is 1;
    without a dictionary nodes have a domain but no tags.
    """
    nodes = chunks.chunk(clean_document(docs).select("doc", "text"), least, most).select("doc", "idx", "section", "text")
    unknown = {"source_char_pos": F.lit(-1), "page_start": F.lit(None).cast("int"), "page_end": F.lit(None).cast("int")}
    located = lambda n: pages.assign_pages(n, paged) if paged is not None else n.withColumns(unknown)
    nodes = _numbered(located(nodes), "idx")
    nodes = clean_nodes(nodes, *skip).where("reason_skip is null").select("doc", "idx", "text", F.coalesce("page_start", F.lit(0)).alias("page"))
    split = chunks.split_long(nodes, TARGET).select("doc", "idx", "part", F.col("section_path").alias("section"), "text")
    nodes = _numbered(located(split), "idx", "part")
    done = audit.audit(nodes, threshold, least).withColumn("source", F.col("doc").cast("string")).withColumn("page", F.coalesce("page_start", F.lit(1)))
    return tags.tag_nodes(done, dictionary or {})


def process_documents(docs: DataFrame, least: int = 150, most: int = 400, threshold: float = 0.85) -> DataFrame:
    """Nodes (doc, idx, id, section, text, page_start, page_end, merged) of docs (doc, text), cleaned, cut, deduplicated and merged."""
    nodes = chunks.chunk(clean_document(docs).select("doc", "text"), least, most)
    nodes = nodes.select("doc", "idx", "section", "text", F.lit(None).cast("int").alias("page_start"), F.lit(None).cast("int").alias("page_end"))
    return audit.audit(nodes, threshold, least)


def document_flags(docs: DataFrame) -> DataFrame:
    """(doc, is_administrative, is_toc) of whole documents (doc, text); they are marked, never left out."""
    return docs.select("doc", N.is_administrative(F.col("text"), N.ADMINISTRATIVE_DOCUMENT).alias("is_administrative"), N.is_contents_document(F.col("text")).alias("is_toc"))


def joined_sources(nodes: DataFrame) -> DataFrame:
    """(doc, text, n_nodes): the texts of a source's nodes (source, page, id, text) one below the other; empty ones are left out."""
    parts = F.array_sort(F.collect_list(F.when(F.coalesce("text", F.lit("")) != "", F.struct("page", "id", "text"))))
    return nodes.groupBy(F.col("source").alias("doc")).agg(F.array_join(F.transform(parts, lambda x: x.text), "\n\n").alias("text"), F.count("*").alias("n_nodes"))


def clean_and_rechunk(nodes: DataFrame, target: int = TARGET, most: int | None = None, paged: DataFrame | None = None) -> DataFrame:
    """Larger chunks (source, n, id, text, page_start, page_end, chars) of tool nodes (source, page, id, text).

    The nodes of a source are joined, cleaned in both stages with their tables taken out, cut into nodes, deduplicated and
    merged, and then cut by structure at about target characters. paged (doc, text with page markers) gives the chunks
    their pages; without it they have those of the nodes, 1 if unknown.
    """
    done = process_documents(joined_sources(nodes))
    rows = done.select(F.col("doc").alias("source"), F.coalesce("page_start", F.lit(0)).alias("page"), F.col("idx").alias("source_char_pos"), "id", "text")
    found = chunks.rechunk(rows, target, most=most)
    if paged is None:
        return found
    located = pages.assign_pages(found.drop("page_start", "page_end").withColumnRenamed("source", "doc"), paged)
    place = [F.coalesce("page_start", F.lit(999_999)), F.when(F.col("source_char_pos") >= 0, F.col("source_char_pos")).otherwise(999_999), F.col("id")]
    n = (F.row_number().over(Window.partitionBy("doc").orderBy(*place)) - 1).cast("bigint")
    return located.select(F.col("doc").alias("source"), n.alias("n"), "id", "text", "page_start", "page_end", "chars")


def chunk_statistics(nodes: DataFrame, found: DataFrame) -> DataFrame:
    """One row: input nodes, sources, output chunks and their mean characters."""
    before = nodes.agg(F.count("*").alias("input_nodes"), F.countDistinct("source").alias("sources"))
    after = found.agg(F.count("*").alias("output_chunks"), F.round(F.avg("chars"), 2).alias("avg_chars"))
    return before.crossJoin(after)  # one row each


def standard_chunks(found: DataFrame) -> DataFrame:
    """(source, page, content) of chunks (source, page_start, text), ready for export: one context header each."""
    return exports.standard_records(found.select(F.concat(F.regexp_replace("source", r"\.pdf\z", ""), F.lit(".pdf")).alias("source"), F.col("page_start").alias("page"), "text"))


def batch(parts: DataFrame, part_pages: int, totals: DataFrame, dictionary: dict[str, list[str]] | None = None, **options) -> DataFrame:
    """Nodes of documents that were cut into parts of part_pages pages: parts (doc, part, text with page markers of the
    part), totals (doc, pages). Every part goes through main() with its own pages; pages are then those of the whole
    document and nodes are numbered through all of its parts."""
    name = F.concat_ws("_part_", F.col("doc").cast("string"), F.format_string("%02d", F.col("part")))
    own = parts.select(name.alias("key"), F.col("doc").alias("document"), "part", "text")
    rows = own.select(F.col("key").alias("doc"), "text")
    nodes = main(rows, rows, dictionary, **options).withColumnRenamed("doc", "key")
    found = nodes.join(own.select("key", "document", "part"), "key").join(totals.select(F.col("doc").alias("document"), F.col("pages").alias("total")), "document")
    move = lambda c: F.when(F.col(c).isNotNull(), X.page_in_document(F.col(c), F.col("part"), F.lit(part_pages), F.col("total"))).cast("int")
    found = found.withColumns({c: move(c) for c in ("page_start", "page_end")}).withColumn("page", F.coalesce("page_start", F.lit(1)))
    idx = (F.row_number().over(Window.partitionBy("document").orderBy(F.coalesce("page_start", F.lit(999_999)), "part", "idx")) - 1).cast("bigint")
    found = found.withColumn("idx", idx).withColumn("source", X.source_name(F.col("document").cast("string")))
    return found.select(F.col("document").alias("doc"), "part", "idx", X.node_id(F.col("document").cast("string"), F.col("idx")).alias("id"), "section", "text", "source", "page", "page_start", "page_end", "merged", "tags", "domain")


def document_ids(docs: DataFrame, source: str) -> DataFrame:
    return docs.withColumn("doc", X.document_id(F.col(source)))
