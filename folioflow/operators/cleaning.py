"""Cleaning and repair of nodes, with what was done to each: flags, actions, warnings and a summary."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import nodes as N
from ..functions.text import U, let, strip, sub, words
from .tables import repaired

#: Footers that nodes still have.
NODE_FOOTERS = (
    r"<PARSED TEXT FOR PAGE:.*?>",
    r"\*\.kcb_[^\s]*_\d{1,2}/\d{1,2}/\d{4}\s+\d{1,2}:\d{2}:\d{2}",
    r"\[Page \d+\]",
    r"---Page Break---",
)
IMAGE = r"!\[([^\]]*)\]\([^)]*\)"
#: Reasons to skip a node, by flag, in order.
SKIPPED = {"is_administrative": "administrative_content", "is_name_list": "name_list_content", "is_toc": "table_of_contents"}


def _footer(pattern: str) -> str:
    return f"(?id){U}{pattern}"


def _noted(nodes: DataFrame, done: Column, text: Column) -> DataFrame:
    """nodes with a new text and further actions: one projection a step, since both look at the text before. The new ones
    get their names in a second one: in the first, functions in lambdas would take the new text for the old."""
    rest = [c for c in nodes.columns if c not in ("text", "actions")]
    return nodes.select(*rest, text.alias("_text"), F.concat("actions", done).alias("_actions")).select(*rest, F.col("_text").alias("text"), F.col("_actions").alias("actions"))


def _times(what: str, n: Column) -> Column:
    return F.array_repeat(F.lit(what), n.cast("int"))


def _without_lines(nodes: DataFrame, what: str, unwanted: Callable[[Column], Column]) -> DataFrame:
    lines = F.split("text", "\n")
    kept = F.filter(lines, lambda x: ~unwanted(x))
    marked = nodes.withColumn("_kept", kept).withColumn("_n", F.size(lines) - F.size("_kept"))
    return _noted(marked, _times(what, F.col("_n")), F.array_join("_kept", "\n")).drop("_kept", "_n")


def _images(nodes: DataFrame) -> DataFrame:
    found = F.transform(F.regexp_extract_all("text", F.lit(IMAGE), F.lit(1)), lambda alt: F.when(strip(alt) == "", "removed_image").otherwise("replaced_image_with_alt"))
    some = F.when(F.size(found) > 0, F.concat(found, F.array(F.lit("removed_local_images")))).otherwise(found)
    return _noted(nodes, some, N.replace_images(F.col("text")))


def _repetitive(line: Column) -> Column:
    w = words(line)
    return (F.length(strip(line)) > 10) & (F.size(w) > 20) & (F.size(F.array_distinct(w)) < 0.1 * F.size(w))


def _headings(nodes: DataFrame) -> DataFrame:
    close = let(F.split("text", "\n"), lambda f: F.filter(f, lambda x, i: x.rlike(rf"{U}^#{{1,6}}\s") & (i > 0) & (strip(F.get(f, i - 1)) != "")))
    return _noted(nodes, _times("added_blank_before_header", F.size(close)), N.space_headings(F.col("text")))


def _bullets(nodes: DataFrame) -> DataFrame:
    bullet, heading = rf"{U}^\s*- \+", rf"(?d){U}^#+\s+-\s*\S"
    each = F.transform(F.split("text", "\n"), lambda x: F.array_compact(F.array(F.when(x.rlike(bullet), "normalized_bullet_format"), F.when(x.rlike(heading), "separated_header_bullet"))))
    return _noted(nodes, F.flatten(each), N.split_bulleted_headings(F.col("text")))


def clean_nodes(nodes: DataFrame, skip_administrative: bool = False, skip_names: bool = False, skip_contents: bool = False) -> DataFrame:
    """nodes (text and any other columns) with flags, reason_skip, the cleaned and repaired text, actions and warnings.

    A node of a kind that is to be skipped keeps its text and has a reason_skip, no actions and no warnings. A null text
    stays null and counts as empty. What remains of images or footers after cleaning gives a warning, as do table rows
    with another number of pipes than their header.
    """
    text = F.coalesce("text", F.lit(""))
    flagged = nodes.withColumn("is_administrative", N.is_administrative(text)).withColumn("is_name_list", N.is_name_list(text)).withColumn("is_toc", N.is_contents(text))
    wanted = zip((skip_administrative, skip_names, skip_contents), SKIPPED.items(), strict=True)
    reason = F.coalesce(F.lit(None).cast("string"), *(F.when(F.col(flag), F.lit(why)) for on, (flag, why) in wanted if on))
    none = F.array().cast("array<string>")
    found = flagged.withColumn("reason_skip", reason).withColumn("original", F.col("text")).withColumn("text", text).withColumn("actions", none)
    found = _images(found)
    found = _without_lines(found, "removed_footer_line", lambda x: x.rlike("|".join(_footer(p) for p in NODE_FOOTERS)))
    found = _without_lines(found, "removed_long_separator_line", lambda x: strip(x).rlike(r"^[-—]{50,}\z"))
    found = _without_lines(found, "removed_repetitive_noise", _repetitive)
    found = _bullets(_headings(found))
    found = _noted(found, _times("replaced_html_br_with_newline", F.lower("text").contains("<br")), N.breaks_to_lines(F.col("text")))
    found = repaired(found, "text", "_table").withColumn("text", F.col("_table.text")).withColumn("actions", F.concat("actions", "_table.actions"))
    gates = [F.when(F.col("text").rlike(IMAGE), "Quality Gate FAIL: Local image links still present")]
    gates += [F.when(F.col("text").rlike(_footer(p)), f"Quality Gate FAIL: Footer pattern still present: {p}") for p in NODE_FOOTERS]
    found = found.withColumn("warnings", F.concat("_table.warnings", F.array_compact(F.array(*gates))))
    skipped = F.col("reason_skip").isNotNull()
    out = {"text": F.when(skipped | F.col("original").isNull(), F.col("original")).otherwise(F.col("text"))} | {c: F.when(skipped, none).otherwise(F.col(c)) for c in ("actions", "warnings")}
    return found.select(*(out.get(c, F.col(c)).alias(c) for c in (*nodes.columns, *SKIPPED, "reason_skip", "actions", "warnings")))


def cleaning_report(cleaned: DataFrame) -> DataFrame:
    """One row for each node of clean_nodes(), without its text: the record of a report."""
    flags = F.struct(*SKIPPED).alias("flags")
    rest = [c for c in cleaned.columns if c not in ("text", "reason_skip", "actions", "warnings", *SKIPPED)]
    return cleaned.select(*rest, "actions", "warnings", flags, F.col("reason_skip").isNotNull().alias("skip"), "reason_skip")


def clean_summary(cleaned: DataFrame) -> DataFrame:
    """One row for clean_nodes(): nodes, how many are skipped for each reason, have repaired tables, and all warnings."""
    count = lambda c, name: F.count_if(c).alias(name)
    return cleaned.agg(
        F.count("*").alias("total_nodes"), *(count(F.col("reason_skip") == why, f"skipped_{why}") for why in SKIPPED.values()),
        count(F.exists("actions", lambda a: a.contains("repaired_table")), "table_repairs"), F.coalesce(F.sum(F.size("warnings")), F.lit(0)).cast("bigint").alias("warnings"),
    )
