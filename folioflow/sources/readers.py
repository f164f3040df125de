"""Readers for nodes, documents and PDF files, all by Spark's own sources."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import drop_invisible

NODE = "source string, page int, chunk_id string, tags array<string>, content string, section string, page_start int, page_end int"


#: A document with its nodes, as document_json() writes it.
DOCUMENT = (
    "doc_id string, nodes array<struct<id: string, content: string, section: string, source: string, page: int, page_start: int, page_end: int, tags: array<string>, domain: string, "
    "metadata: struct<page_start: int, page_end: int, tags: array<string>, domain: string>>>, processing_info struct<source_file: string, pipeline_version: string, total_nodes: bigint>"
)


def pdf_files(spark: SparkSession, path: str, named: str | None = None) -> DataFrame:
    """(path, length, content) of PDF files; named: only those whose name contains it, in any case."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{pdf,PDF}").load(path)
    return files.where(F.lower(_name()).contains(named.lower().removesuffix(".pdf"))) if named else files


def _name():
    return F.element_at(F.split("path", "/"), -1)


def find_pdf(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The PDF file of a name, with or without extension: the one that is written so, else the first that is but for case."""
    own = name if name.lower().endswith(".pdf") else f"{name}.pdf"
    return pdf_files(spark, path).where(F.lower(_name()) == own.lower()).orderBy(_name() != own, "path").limit(1)


def select_pdf(spark: SparkSession, path: str, part: str) -> DataFrame:
    """The first PDF file, by name, whose name contains a text in any case."""
    return pdf_files(spark, path, part).orderBy(_name(), "path").limit(1)


def page_counts(blocks: DataFrame) -> DataFrame:
    """(doc, pages) of page blocks (doc, page); without a page 0."""
    return blocks.groupBy("doc").agg(F.coalesce(F.max("page"), F.lit(0)).cast("bigint").alias("pages"))


def documents(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """(doc, idx, id, text, section, source, page, page_start, page_end, tags, domain): the nodes of document files, in order.

    What a node lacks is taken from its metadata, a missing source from the document. Broken files are left out.
    """
    rows = spark.read.schema(DOCUMENT).option("multiLine", True).option("pathGlobFilter", pattern).json(path)
    n = rows.where("nodes is not null").select("doc_id", "processing_info", F.posexplode("nodes").alias("idx", "n"))
    of = lambda c: F.coalesce(f"n.{c}", f"n.metadata.{c}").alias(c)
    start = F.coalesce("n.page_start", "n.metadata.page_start")
    page = F.coalesce(F.when(start > 0, start), F.when(F.col("n.page") > 0, F.col("n.page"))).alias("page")
    return n.select(F.col("doc_id").alias("doc"), F.col("idx").cast("bigint").alias("idx"), F.col("n.id").alias("id"), F.col("n.content").alias("text"), F.coalesce("n.section", F.lit("")).alias("section"), F.coalesce("n.source", "processing_info.source_file", F.concat("doc_id", F.lit(".pdf"))).alias("source"), page, of("page_start"), of("page_end"), of("tags"), of("domain"))


def tool_nodes(nodes: DataFrame) -> DataFrame:
    """(id, section, text, source, page_start, page_end) of tool nodes (chunk_id, source, section_path, content, page_start, page_end);
    a node without chunk_id has its source as id, else unknown."""
    return nodes.select(F.coalesce(F.nullif("chunk_id", F.lit("")), F.nullif("source", F.lit("")), F.lit("unknown")).alias("id"), F.coalesce("section_path", F.lit("")).alias("section"), F.coalesce("content", F.lit("")).alias("text"), "source", "page_start", "page_end")


def text_analysis(docs: DataFrame) -> DataFrame:
    """(doc, chars, lines, images, bytes) of extracted texts (doc, text); a null text counts as empty."""
    t = F.coalesce("text", F.lit(""))
    return docs.select("doc", F.length(t).cast("bigint").alias("chars"), F.size(F.split(t, "\n")).cast("bigint").alias("lines"), F.regexp_count(t, F.lit(r"!\[[^\]]*\]\([^)]*\)")).cast("bigint").alias("images"), F.octet_length(t).cast("bigint").alias("bytes"))


def text_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc, text) of text or Markdown files, one row a file."""
    rows = spark.read.text(path, wholetext=True)
    return rows.select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("doc"), F.col("value").alias("text"))


def nodes(spark: SparkSession, path: str, skip_temporary: bool = True) -> DataFrame:
    """Nodes of JSON files that hold an object or an array of them; a broken file gives a row of nulls, which is left out.

    skip_temporary: files named temp_* or beginning with a dot don't count.
    """
    rows = spark.read.schema(NODE).option("multiLine", True).json(path)
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    rows = rows.withColumn("_file", name)
    if skip_temporary:
        rows = rows.where(~F.col("_file").contains("temp_") & ~F.col("_file").startswith("."))
    return rows.where("coalesce(source, chunk_id, content) is not null").drop("_file")


def page_blocks(blocks: DataFrame) -> DataFrame:
    """(doc, text): text blocks (doc, page, x0, y0, text) of pages in reading order under page markers.

    Blocks whose tops lie within five points are on one line. A plug-in that reads PDF pages gives such rows.
    """
    order = F.struct((F.round(F.col("y0") / 5) * 5).alias("row"), F.col("x0"), drop_invisible(F.col("text")).alias("text"))
    pages = blocks.groupBy("doc", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(order)), lambda b: b.text), "\n").alias("text"))
    parts = F.array_sort(F.collect_list(F.struct("page", "text")))
    return pages.groupBy("doc").agg(F.array_join(F.transform(parts, lambda p: F.concat(F.lit("<!--PAGE:"), p.page.cast("string"), F.lit("-->\n"), p.text)), "\n\n").alias("text"))


def safe(name: str) -> str:
    return re.sub(r"[^\w\-.]", "_", name)
