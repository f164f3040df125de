"""Records and review texts from nodes; rows in, rows out. Nodes have (doc, idx, id, section, text, source, page, tags, domain)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.context import source_name, with_context


def standard_records(nodes: DataFrame) -> DataFrame:
    """(source, page, content): normalised source, page of at least 1, text under one context header."""
    source = source_name(F.col("source"))
    page = F.coalesce(F.when(F.col("page") > 0, F.col("page")), F.lit(1)).cast("int")
    return nodes.select(source.alias("source"), page.alias("page"), with_context(source, F.coalesce("text", F.lit(""))).alias("content"))


def training_samples(nodes: DataFrame) -> DataFrame:
    """(id, text, section, domain, tags, source, doc_id), a row for each node."""
    return nodes.select("id", "text", F.coalesce("section", F.lit("")).alias("section"), F.coalesce("domain", F.lit("")).alias("domain"), F.coalesce("tags", F.array().cast("array<string>")).alias("tags"), "source", F.col("doc").cast("string").alias("doc_id"))


def _document(nodes: DataFrame, node: Column, head: Column, *more: Column) -> DataFrame:
    parts = F.array_sort(F.collect_list(F.struct("idx", node.alias("part"))))
    found = nodes.groupBy("doc").agg(F.count("*").alias("n"), F.array_join(F.transform(parts, lambda x: x.part), "\n").alias("body"), F.first("source", ignorenulls=True).alias("source"), *more)
    return found.select("doc", F.concat_ws("\n", head, "body").alias("text"))


def plain_text(nodes: DataFrame) -> DataFrame:
    """(doc, text): nodes one below the other, each under its section."""
    section = F.when(F.coalesce("section", F.lit("")) != "", F.concat(F.lit("["), "section", F.lit("]\n\n"))).otherwise(F.lit(""))
    node = F.concat(section, F.coalesce("text", F.lit("")), F.lit("\n\n" + "-" * 40 + "\n"))
    return _document(nodes, node, F.concat(F.lit("# Document: "), F.col("doc").cast("string"), F.lit("\n# Nodes: "), F.col("n").cast("string"), F.lit("\n" + "=" * 80 + "\n")))


def detailed_text(nodes: DataFrame, width: int = 76) -> DataFrame:
    """(doc, text): nodes with their fields, every line cut to `width` characters."""
    lines = F.array_join(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.concat(F.lit("│ "), F.substring(x, 1, width))), "\n")
    fields = F.concat_ws("\n", F.concat(F.lit("┌ Node "), F.col("id")), F.concat(F.lit("│ Section: "), F.coalesce("section", F.lit(""))), F.concat(F.lit("│ Domain: "), F.coalesce("domain", F.lit(""))), F.concat(F.lit("│ Tags: "), F.coalesce(F.array_join("tags", ", "), F.lit(""))))
    return _document(nodes, F.concat_ws("\n", fields, lines, F.lit("└" + "─" * width)), F.concat(F.lit("Document: "), F.col("doc").cast("string")))


def training_text(nodes: DataFrame) -> DataFrame:
    """(doc, text): one <TEXT> block for each node, under its fields as comments."""
    line = lambda name, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"# {name}: "), c))
    node = F.concat_ws("\n", F.concat(F.lit("# --- Sample "), (F.col("idx") + 1).cast("string"), F.lit(" ---")), line("Domain", F.col("domain")), line("Tags", F.array_join("tags", ", ")), line("Section", F.col("section")), F.lit("<TEXT>"), F.trim(F.coalesce("text", F.lit(""))), F.lit("</TEXT>\n"))
    return _document(nodes, node, F.concat(F.lit("# Document: "), F.col("doc").cast("string"), F.lit("\n# Source: "), F.coalesce("source", F.lit("N/A")), F.lit("\n# Nodes: "), F.col("n").cast("string"), F.lit("\n")))


def markdown(nodes: DataFrame) -> DataFrame:
    """(doc, text): nodes as quotes, a heading wherever the section changes."""
    before = F.last(F.when(F.coalesce("section", F.lit("")) != "", F.col("section")), ignorenulls=True).over(Window.partitionBy("doc").orderBy("idx").rowsBetween(Window.unboundedPreceding, -1))
    changed = nodes.withColumn("_before", before)
    head = F.when((F.coalesce("section", F.lit("")) != "") & ~F.col("section").eqNullSafe(F.col("_before")), F.concat(F.lit("### "), "section", F.lit("\n")))
    domain = F.when(F.coalesce("domain", F.lit("")) != "", F.concat(F.lit("- Domain: `"), "domain", F.lit("`")))
    tags = F.when(F.size("tags") > 0, F.concat(F.lit("- Tags: "), F.array_join(F.transform("tags", lambda t: F.concat(F.lit("`"), t, F.lit("`"))), ", ")))
    quote = F.concat(F.lit("\n> "), F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit("\n> ")), F.lit("\n\n---\n"))
    node = F.concat_ws("\n", head, F.concat(F.lit("**Node "), (F.col("idx") + 1).cast("string"), F.lit("**")), domain, tags, quote)
    info = F.concat(F.lit("# "), F.col("doc").cast("string"), F.lit("\n\n| Property | Value |\n|---|---|\n| Source File | `"), F.coalesce("source", F.lit("N/A")), F.lit("` |\n| Total Nodes | "), F.col("n").cast("string"), F.lit(" |\n"))
    return _document(changed, node, info)


def document_json(nodes: DataFrame, version: str = "1.1.0") -> DataFrame:
    """(doc, json): one JSON object for each document, its nodes in order."""
    node = F.struct("idx", "id", F.col("text").alias("content"), "section", "page", "tags", "domain")
    found = nodes.groupBy("doc").agg(F.array_sort(F.collect_list(node)).alias("nodes"), F.first("source", ignorenulls=True).alias("source_file"), F.count("*").alias("total_nodes"))
    info = F.struct("source_file", F.lit(version).alias("pipeline_version"), "total_nodes")
    return found.select("doc", F.to_json(F.struct(F.col("doc").cast("string").alias("doc_id"), F.transform("nodes", lambda n: n.dropFields("idx")).alias("nodes"), info.alias("processing_info"))).alias("json"))


def combined_array(records: DataFrame, order: str) -> DataFrame:
    """(source, json): the records of a source as one JSON array, by the column named order."""
    fields = [c for c in records.columns if c != order]
    return records.groupBy("source").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), *fields))), lambda r: r.dropFields("_o"))).alias("json"))
