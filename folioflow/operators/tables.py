"""Markdown tables: extraction with placeholders, and repair. State runs along the lines of one text, so a text is folded
in Python as one row; rows are independent and batches are bounded."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate, groupby
from operator import itemgetter

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions.text import U, let, map_lines, sub

#: Words of table captions.
CAPTION_WORDS = ("Bảng", "Table", "Liều", "Dự phòng", "Hình", "Figure", "Điều trị", "Phác đồ", "Công thức", "Thành phần")
_NUMBERED = re.compile("(?:" + "|".join(CAPTION_WORDS) + r")\s*[\d.:]+", re.IGNORECASE)
_SEPARATOR = re.compile(r"\s*\|?(?:\s*:?-{2,}:?\s*\|?)+\s*")


def _rowlike(line: str) -> bool:
    return line.count("|") >= 2


def _opens(lines: list[str], i: int) -> bool:
    window = lines[i : i + 3]
    return _rowlike(lines[i]) and sum(map(_rowlike, window)) >= 2 and sum(x.count("|") for x in window) >= 4


def _end(lines: list[str], start: int, ahead: int = 3) -> int:
    """Where the table that opens at start ends: after its last line with a pipe.

    One line without pipes may stand between two with, as may several empty ones if a row follows within `ahead` lines;
    a heading ends it.
    """
    end = i = start + 1
    while i < len(lines):
        line = lines[i].strip()
        if line.startswith("#") and not line.startswith("#|"):
            break
        if "|" in line:
            end = i + 1
        else:
            gap = lines[end : i + 1]
            if len(gap) >= 2 and (any(x.strip() for x in gap) or not any(map(_rowlike, lines[i + 1 : i + 1 + ahead]))):
                break
        i += 1
    return end


def caption_of(lines: list[str], start: int) -> str:
    """The nearest of the two lines above a table that names it, or the empty string."""
    for line in (x.strip() for x in reversed(lines[max(0, start - 2) : start])):
        if _NUMBERED.search(line) or len(line) < 100 and any(w.lower() in line.lower() for w in CAPTION_WORDS):
            return line
    return ""


def extract(text: str) -> tuple[str, list[dict]]:
    """The text with a placeholder for each table, and the tables (table_id, caption, raw_markdown, line_start, line_end)."""
    lines = text.split("\n")
    out: list[str] = []
    found: list[dict] = []
    i = 0
    while i < len(lines):
        if not _opens(lines, i):
            out.append(lines[i])
            i += 1
            continue
        end = _end(lines, i)
        number = len(found) + 1
        caption = caption_of(lines, i) or f"Table_{number}"
        found.append({"table_id": f"table_{number}", "caption": caption, "raw_markdown": "\n".join(lines[i:end]), "line_start": i, "line_end": end - 1})
        out.append(f"[TABLE_REMOVED: {caption[:60].strip()}]")
        i = end
    return "\n".join(out), found


TABLES = "array<struct<table_id:string,caption:string,raw_markdown:string,line_start:int,line_end:int>>"


def extract_tables(docs: DataFrame) -> DataFrame:
    """(doc, text, tables) of docs (doc, text); a null text has none."""
    kind = docs.schema["doc"].dataType.simpleString()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            rows = [(d, *(extract(t) if t is not None else (None, []))) for d, t in zip(p.doc, p.text, strict=True)]
            yield pd.DataFrame(rows, columns=["doc", "text", "tables"])

    return docs.select("doc", "text").mapInPandas(run, f"doc {kind}, text string, tables {TABLES}")


def cells(row: str) -> list[str]:
    return [c.strip() for c in row.split("|")[1:-1]]


def _written(own: list[str]) -> str:
    return f"|{'|'.join(own)}|"


def _one_row(lines: list[str], width: int) -> str:
    """A row and the lines that continue it: their cells go to its last one, and it gets `width` cells."""
    if len(lines) == 1:
        return lines[0]
    own = cells(lines[0])
    for more in map(cells, lines[1:]):
        if own and more:
            own[-1] = " ".join([own[-1], *more])
        own = (own + [""] * width)[:width]
    return _written(own)


def repair_block(block: list[str], latex: str = "drop") -> tuple[list[str], list[str], list[str]]:
    """A repaired table of three lines or more, what was done, and warnings.

    The second line becomes a separator of the header's width. Rows are numbered by a running count of lines with at
    least as many cells as the header, and lines of one number are one row. Formulas are dropped (latex="drop") or lose
    their marks.
    """
    width = len(cells(block[0]))
    number = accumulate(len(cells(line)) >= width for line in block[2:])
    rows = [_one_row([line for _, line in own], width) for _, own in groupby(zip(number, block[2:], strict=True), key=itemgetter(0))]
    whole = [block[0], _written(["---"] * width), *rows]
    formula = "" if latex == "drop" else r"\1"
    plain = [re.sub(r"\\math(?:rm|bf)\{([^}]*)\}", r"\1", re.sub(r"\$([^$]*)\$", formula, line)) for line in whole]
    done = {
        f"repaired_table_separator (cols={width})": True,
        f"merged_table_rows ({len(block)} -> {len(whole)} lines)": len(whole) < len(block),
        "cleaned_latex_in_table": plain != whole,
    }
    pipes = [(line, line.count("|")) for line in plain]
    warnings = [f"TABLE WARNING (HIGH): Line has {n} pipes, expected {width + 1}: {line[:60]}" for line, n in pipes if n != width + 1]
    return plain, [what for what, so in done.items() if so], warnings


def repair(text: str) -> tuple[str, list[str], list[str]]:
    """A text whose blocks of at least three lines that begin with a pipe are repaired; a block whose first line is
    indented has no header to go by, and only gets a warning."""
    out, actions, warnings = [], [], []
    for table, own in groupby(text.split("\n"), key=lambda line: line.strip().startswith("|")):
        block = list(own)
        if table and len(block) >= 3 and block[0].startswith("|"):
            block, done, said = repair_block(block)
            actions += done
            warnings += said
        elif table and len(block) >= 3:
            warnings.append(f"TABLE WARNING: Cannot determine column count in header: {block[0][:50]}")
        out += block
    return "\n".join(out), actions, warnings


REPAIRED = StructType().add("text", StringType()).add("actions", ArrayType(StringType())).add("warnings", ArrayType(StringType()))


def repaired(nodes: DataFrame, text: str = "text", to: str = "repaired") -> DataFrame:
    """nodes with a struct (text, actions, warnings) of repair() of a column more; a null text has neither."""
    parts = pa.list_(pa.string())
    arrow = pa.struct([("text", pa.string()), ("actions", parts), ("warnings", parts)])
    at, names = nodes.columns.index(text), [*nodes.columns, to]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = [dict(zip(("text", "actions", "warnings"), repair(t), strict=True)) if t is not None else {"text": None, "actions": [], "warnings": []} for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(done, arrow)], names)

    return nodes.mapInArrow(run, StructType([*nodes.schema.fields, StructField(to, REPAIRED)]))


def repair_tables(docs: DataFrame) -> DataFrame:
    """(doc, text, actions, warnings) of docs (doc, text)."""
    return repaired(docs.select("doc", "text")).select("doc", "repaired.*")


def is_separator(row: Column) -> Column:
    return row.rlike(r"^\s*\|?(?:\s*:?-{2,}:?\s*\|?)+\s*\z")


def close_rows(row: Column) -> Column:
    """A row between pipes, empty cells filled by a blank."""
    own = F.trim(row)
    filled = sub(own, r"\|(?=\|)", "| ")
    return F.when(own == "", row).otherwise(F.concat(F.when(filled.startswith("|"), F.lit("")).otherwise(F.lit("|")), filled, F.when(filled.endswith("|"), F.lit("")).otherwise(F.lit("|"))))


def join_numbers(row: Column) -> Column:
    """Decimals and thousands without a blank after the mark; single digits that fill a cell are one number."""
    t = sub(sub(row, r"(\d+)\.\s+(\d+)", "$1.$2"), r"(\d+),\s+(\d+)", "$1,$2")
    return sub(t, r"\|\s*(\d)\s+(\d)\s+(\d+)\s*\|", "| $1$2$3 |")


def is_junk_row(row: Column) -> Column:
    """A row whose first cell can't be a row number."""
    own = F.trim(row)
    junk = own.rlike(r"^\|\s*\.?\d{1,3}\s*,\s*\d+\s*\||^\|\s*\.0\d+\s*\||^\|\s*£\d+\s*/?\s*\|") | (own.rlike(r"^\|\s*\d{3,}\s*\|") & (F.length(own) < 30) & ~own.rlike(r"^\|\s*0"))
    return own.startswith("|") & ~is_separator(own) & junk


def normalise_rows(text: Column) -> Column:
    """Rows closed, numbers joined and junk rows dropped in the table lines of a text."""
    kept = F.array_join(F.filter(F.split(text, "\n"), lambda x: ~is_junk_row(x)), "\n")
    return map_lines(kept, lambda x: F.when(F.trim(x).startswith("|"), join_numbers(close_rows(x))).otherwise(x))


def drop_consecutive(text: Column, length: int = 20) -> Column:
    """Without lines of over `length` characters that equal the line before."""
    kept = lambda f: F.filter(f, lambda x, i: ~((i > 0) & (F.length(x) > length) & (x == F.coalesce(F.get(f, i - 1), F.lit("")))))
    return F.array_join(let(F.split(text, "\n"), kept), "\n")


def limit_newlines(text: Column) -> Column:
    return sub(text, rf"{U}\n{{4,}}", "\n\n\n")
