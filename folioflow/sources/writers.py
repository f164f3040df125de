"""Sinks: JSON lines, one file for each document, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import audit, chunks, cleaning, exports


def json_lines(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def document_texts(rows: DataFrame, path: str) -> None:
    """rows (doc, text or json) as text, in one folder for each document; a writer task holds one row at a time."""
    body = next(c for c in rows.columns if c != "doc")
    rows.select("doc", F.col(body).alias("value")).write.mode("overwrite").partitionBy("doc").text(path)


FORMATS = {"plain": exports.plain_text, "detailed": exports.detailed_text, "training": exports.training_text, "markdown": exports.markdown, "json": exports.document_json}


def export(nodes: DataFrame, kind: str, path: str) -> None:
    """Nodes in one of the FORMATS, as standard records or as JSON lines of training samples."""
    if kind == "jsonl":
        json_lines(exports.training_samples(nodes), path)
    elif kind == "standard":
        json_lines(exports.standard_records(nodes), path)
    else:
        document_texts(FORMATS[kind](nodes), path)


def audit_report(nodes: DataFrame, path: str) -> None:
    """JSON lines of every document's summary and flagged nodes, told apart by `type`, and its report in Markdown."""
    noted = nodes.persist()
    json_lines(audit.report_rows(noted), f"{path}/rows")
    document_texts(audit.report(noted), f"{path}/markdown")
    noted.unpersist()


def cleaning_report(cleaned: DataFrame, path: str) -> None:
    """JSON lines of what clean_nodes() did to every node, and its summary."""
    json_lines(cleaning.cleaning_report(cleaned), f"{path}/nodes")
    json_lines(cleaning.clean_summary(cleaned), f"{path}/summary")


def rechunk_report(chunks_: DataFrame, path: str) -> None:
    """JSON lines of rechunk_lines() without the texts, and their summary."""
    json_lines(chunks_.drop("text"), f"{path}/chunks")
    json_lines(chunks.rechunk_summary(chunks_), f"{path}/summary")
