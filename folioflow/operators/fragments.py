"""Repair of texts whose tables recognition has torn: fragments of cells, lines that go on, rows, and lines that say again
what stands above. State runs along the lines of one text, so a text is folded in Python as one row."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import nodes as N
from ..functions import text as T
from ..functions import vietnamese as V
from . import tables

#: How lines begin that are no fragment of a cell.
STRUCTURE = ("|", "#", "- ", "* ", "> ")
_ITEM = re.compile(r"\d+\.\s")
_MARKUP = re.compile(r"<[^>]+>|\*\*|__")
_EDGES = re.compile(r"^\||\|$")
FRAGMENT, SHARED, LEAST, OVERLAP = 60, 41, 20, (11, 100)


def table_blocks(lines: list[str]) -> list[tuple[int, int]]:
    """Half-open line ranges of tables: like those that extraction takes out, but after empty lines a table goes on if a
    pipe follows within five lines."""
    out, i = [], 0
    while i < len(lines):
        if tables._opens(lines, i):
            end = tables._end(lines, i, 5)
            out.append((i, end))
            i = end
        else:
            i += 1
    return out


def table_ranges(text: str) -> list[tuple[int, int]]:
    """Character ranges of tables, ends included."""
    lines = text.split("\n")
    starts = [0]
    for line in lines:
        starts.append(starts[-1] + len(line) + 1)
    return [(starts[a], starts[b] - 1) for a, b in table_blocks(lines)]


def _into_row(row: str, more: str) -> str:
    """A table row with a text added to its last cell."""
    row = row.rstrip()
    if not row.endswith("|"):
        return f"{row} {more}"
    joined = f"{row[:-1].rstrip()} {more}".rstrip()
    return joined if joined.endswith("|") else f"{joined} |"


def join_fragments(text: str) -> str:
    """Short lines without markup right below a table row, or below it and one empty line, become part of its last cell."""
    out: list[str] = []
    for line in text.split("\n"):
        own = line.strip()
        loose = own and len(own) < FRAGMENT and not own.startswith(STRUCTURE) and not _ITEM.match(own)
        above = next((k for k in range(len(out) - 1, max(len(out) - 3, -1), -1) if out[k].strip()), None) if loose else None
        if above is not None and out[above].strip().startswith("|"):
            out[above] = _into_row(out[above], own)
        else:
            out.append(line)
    return "\n".join(out)


def join_continuations(block: list[str]) -> list[str]:
    """Lines of a table that do not begin with a pipe become part of the row above."""
    out: list[str] = []
    for line in block:
        own = line.strip()
        if out and own and not own.startswith("|"):
            out[-1] = _into_row(out[-1], own)
        else:
            out.append(line)
    return out


def separates(row: str) -> bool:
    """Whether a row has two cells or more of dashes, colons and blanks alone."""
    return row.strip().startswith("|") and sum(bool(c.strip()) and not c.strip("-: ") for c in row.strip().split("|")) >= 2


def repair_blocks(text: str) -> str:
    """Tables with their continuations joined and their separators as wide as the first row; rows are not merged."""
    lines, out, at = text.split("\n"), [], 0
    for a, b in table_blocks(lines):
        block = join_continuations(lines[a:b])
        whole = [x.strip() for x in block if x.strip().startswith("|") and x.strip().endswith("|") and not separates(x)]
        width = max(1, (whole[0] if whole else block[0]).count("|") - 1)
        out += [*lines[at:a], *("|" + "|".join(["---"] * width) + "|" if separates(x) else x for x in block)]
        at = b
    return "\n".join([*out, *lines[at:]])


def drop_echoes(text: str) -> str:
    """Without lines of over LEAST characters that equal the line before, and lines outside tables that share SHARED
    characters in a row with one of the two lines before, markup apart; a line that begins with the end of the line before
    (OVERLAP characters at least and at most) is joined to it."""
    out: list[str] = []
    for line in text.split("\n"):
        own, last = line.strip(), out[-1].strip() if out else None
        if last == own and len(own) > LEAST:
            continue
        if out and len(own) >= SHARED and not (own.startswith("|") and "|" in own[1:]):
            plain = _MARKUP.sub("", own)
            pieces = {plain[k : k + SHARED] for k in range(len(plain) - SHARED + 1)}
            above = (_EDGES.sub("", _MARKUP.sub("", x.strip())) for x in out[-2:])
            if any(x[k : k + SHARED] in pieces for x in above for k in range(len(x) - SHARED + 1)):
                continue
        least, most = OVERLAP
        shared = 0
        if last and len(own) > LEAST and len(last) > LEAST:
            shared = next((n for n in range(min(len(last), len(own), most), least - 1, -1) if last.endswith(own[:n])), 0)
        if shared:
            out[-1] = f"{last} {own[shared:]}"
        else:
            out.append(line)
    return "\n".join(out)


def fold(docs: DataFrame, *changes: Callable[[str], str]) -> DataFrame:
    """docs (text and any other columns) with text changed by functions of one text; null texts stay."""
    at = docs.columns.index("text")

    def one(t: str | None) -> str | None:
        for f in changes if t is not None else ():
            t = f(t)
        return t

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.set_column(at, "text", pa.array([one(t) for t in b.column(at).to_pylist()], pa.string()))

    return docs.mapInArrow(run, docs.schema)


def drop_junk_separators(text):
    """Column -> Column: without lines of 20 and more characters that are dashes, equals signs, underscores, tildes, stars and blanks."""
    return T.keep_lines(text, lambda x: ~((F.length(T.strip(x)) >= LEAST) & T.strip(x).rlike(r"(?U)^[-=_~*\s]+\z")))


def clean_torn(docs: DataFrame) -> DataFrame:
    """docs (text and any other columns) through all steps of this module and the line filters around them."""
    found = T.apply(docs, T.drop_image_links, T.drop_footer_lines, T.drop_long_separators, T.drop_gibberish_lines, V.replace_breaks)
    found = fold(found, join_fragments, repair_blocks)
    found = T.apply(found, tables.normalise_rows, N.unwrap_latex, V.normalise_headings, V.normalise_bullets, drop_junk_separators, tables.limit_newlines)
    return fold(found, drop_echoes)


def process_nodes(nodes: DataFrame) -> DataFrame:
    """nodes (text and any other columns) after clean_torn() with is_administrative, is_name_list, is_toc and skip_indexing (any of
    them), which are of the text before; nodes that are or become empty go."""
    text = F.col("text")
    flags = {"is_administrative": N.is_administrative(text), "is_name_list": N.is_name_list(text), "is_toc": N.is_contents_document(text)}
    found = nodes.where(T.strip(text) != "").withColumns(flags).withColumn("skip_indexing", F.col("is_administrative") | F.col("is_name_list") | F.col("is_toc"))
    return clean_torn(found).where(T.strip(F.col("text")) != "")
