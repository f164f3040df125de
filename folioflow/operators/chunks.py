"""Chunkers. Each cut depends on the one before it, so a document (or section) is folded in Python: sections one row at a
time, without a shuffle, and the nodes of a source as a stream of sorted rows. Texts of any length are folded in linear time."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from functools import partial
from itertools import groupby, islice
from operator import itemgetter

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import drop_invisible, sub
from .batches import give_back, pieces
from .fragments import table_ranges
from .structure import sections

_PARAGRAPHS = re.compile(r"\n\s*\n")
_SENTENCES = re.compile(r'(?<=[.!?])\s+(?=[A-ZÀ-Ỹa-zà-ỹ0-9"])')
_PLACEHOLDER = re.compile(r"\s*\[TABLE_REMOVED:[^\]]*\]")


def tokens(text: str) -> int:
    return max(1, len(" ".join(text.split())) // 4)


def is_table(paragraph: str) -> bool:
    return bool(_PLACEHOLDER.match(paragraph)) or sum(x.count("|") >= 2 for x in paragraph.split("\n")) >= 2


def pack_section(text: str, least: int = 150, most: int = 400) -> list[str]:
    """Node texts of one section: paragraphs are gathered up to `most` tokens.

    A longer paragraph is cut at sentences, tables are nodes of their own, and a rest below `least` tokens joins the
    section's last node.
    """
    out: list[str] = []
    held: list[str] = []
    size = 0

    def flush() -> None:
        nonlocal held, size
        if held:
            out.append("\n\n".join(held))
        held, size = [], 0

    for p in (x.strip() for x in _PARAGRAPHS.split(text)):
        if not p:
            continue
        n = tokens(p)
        if is_table(p):
            flush()
            out.append(p)
        elif n > most:
            flush()
            part: list[str] = []
            total = 0
            for s in (x.strip() for x in _SENTENCES.split(p)):
                m = tokens(s)
                if part and total + m > most:
                    out.append(" ".join(part))
                    part, total = [], 0
                part.append(s)
                total += m
            rest = " ".join(part)
            if tokens(rest) >= least:
                out.append(rest)
            elif rest:
                held, size = [rest], tokens(rest)
        else:
            if held and size + n > most:
                flush()
            held.append(p)
            size += n
    rest = "\n\n".join(held)
    if rest and out and tokens(rest) < least:
        out[-1] = f"{out[-1]}\n\n{rest}"
    elif rest:
        out.append(rest)
    return out


_PACKED = pa.schema([("at", pa.int64()), ("section_no", pa.int64()), ("n", pa.int64()), ("section", pa.string()), ("text", pa.string()), ("tokens", pa.int64()), ("has_table", pa.bool_())])


def chunk(docs: DataFrame, least: int = 150, most: int = 400) -> DataFrame:
    """(doc, idx, section, text, tokens, has_table): nodes of docs (doc, text) in order; idx counts within a document."""
    found = sections(docs).select("doc", "section", "title", "text")
    kind = found.schema["doc"].dataType.simpleString()

    def rows(p: pa.RecordBatch) -> Iterator[dict]:
        doc = p.column("doc")
        for i, (s, title, text) in enumerate(zip(*(p.column(c).to_pylist() for c in ("section", "title", "text")), strict=True)):
            for n, x in enumerate(pack_section(text, least, most)):
                yield {"at": i, "section_no": s, "n": n, "section": title, "text": x, "tokens": tokens(x), "has_table": is_table(x)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p in pieces(b, "text"):
                out = pa.RecordBatch.from_pylist(list(rows(p)), _PACKED)
                yield pa.RecordBatch.from_arrays([p.column("doc").take(out.column("at")), *out.columns[1:]], ["doc", *_PACKED.names[1:]])
            give_back()

    nodes = found.mapInArrow(run, f"doc {kind}, section_no bigint, n bigint, section string, text string, tokens bigint, has_table boolean")
    idx = F.row_number().over(Window.partitionBy("doc").orderBy("section_no", "n")) - 1
    return nodes.select("doc", idx.cast("bigint").alias("idx"), "section", "text", "tokens", "has_table")


def chunk_stats(nodes: DataFrame) -> DataFrame:
    """(doc, total_nodes, min_tokens, max_tokens, avg_tokens) of nodes (doc, tokens); the average is floored."""
    return nodes.groupBy("doc").agg(F.count("*").alias("total_nodes"), F.min("tokens").alias("min_tokens"), F.max("tokens").alias("max_tokens"), F.floor(F.avg("tokens")).alias("avg_tokens"))


#: What counts as a heading and as a numbered line inside a chunk, and how page markers look.
_HEADED = re.compile(r"^#{1,6}\s", re.MULTILINE)
_NUMBERED = re.compile(r"^(?:\d+(?:\.\d+)*|[IVX]+|[A-Z])[.)]\s", re.MULTILINE)
_MARKER = re.compile(r"<!--\s*PAGE\s*:?\s*\d*\s*-->[\t ]*\n?", re.IGNORECASE)
_TITLE = re.compile(r"(#{1,6})\s+(.+)$")
_NUMBER = re.compile(r"(\d+(?:\.\d+)*|[IVX]+|[A-Z])[.)]\s+.+$")


def _in_tables(lines: list[str]) -> list[bool]:
    """Of every line whether it lies in a run of three or more lines with pipes whose first one begins with one."""
    out: list[bool] = []
    while len(out) < len(lines):
        i = j = len(out)
        if lines[i].strip().startswith("|"):
            while j < len(lines) and "|" in lines[j]:
                j += 1
        n = max(1, j - i)
        out += [n >= 3] * n
    return out


class Path:
    """Titles of the headings above a line: one of a level not deeper than the last cuts the path to the titles above its
    level; numbered lines add their number and are cut by headings alone."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.level = 0

    def pass_by(self, line: str) -> None:
        if m := _TITLE.match(line):
            level = len(m[1])
            if level <= self.level:
                del self.parts[level - 1 :]
            self.parts.append(m[2].strip()[:40])
            self.level = level
        elif m := _NUMBER.match(line):
            self.parts.append(m[1])

    def __str__(self) -> str:
        return " > ".join(self.parts) or "Document"


def chunks_by_lines(parts: Iterable[tuple[int, str]], target: int = 8000) -> Iterator[dict]:
    """Chunks of whole lines of parts (page, text): one ends at the first line from `target` characters on before which no
    table goes on, and beyond 1.5 times the target in any case. Only the lines of one part and one chunk are held."""
    path, held, size, page = Path(), [], 0, 1
    head: dict = {}

    def done() -> Iterator[dict]:
        whole = "\n".join(held)
        text = re.sub(r"\n{3,}", "\n\n", _MARKER.sub("", whole)).strip()
        if text:
            yield head | {"text": text, "page_end": page, "chars": len(text), "tokens": len(text.split()), "has_table": any(x.strip().startswith("|") for x in held), "headings": len(_HEADED.findall(whole)), "numbered": len(_NUMBERED.findall(whole))}

    for k, (number, text) in enumerate(parts):
        lines = [*([] if k else [""]), "", f"<!--PAGE:{number}-->", "", *text.split("\n")]
        table = [*_in_tables(lines), False]  # the line after is an empty one
        for i, line in enumerate(lines):
            if line == f"<!--PAGE:{number}-->":
                page = max(number, 1)
            if not held:
                head = {"page_start": max(number, 1) if i < len(lines) - 1 else page, "section_path": str(path)}
            held.append(line)
            size += len(line) + 1
            path.pass_by(line)
            if (size > target and not table[i + 1]) or size - 1 > 1.5 * target:
                yield from done()
                held, size = [], 0
    yield from done()


_BOUNDARY = re.compile(r"#{1,6}\s+\S|\d+(?:\.\d+)*\.?\s+\S|(?:CHƯƠNG|MỤC|PHẦN)\s+\S", re.IGNORECASE)


def _break(text: str, at: int, target: int, least: int, most: int, whole_tables: bool = False) -> int:
    """Where the chunk that begins at `at` ends: at the section boundary nearest to the target, else after an empty line,
    else after a line end, else after `most` characters. whole_tables: nowhere inside a table but for the last."""
    goal, end = at + target, min(at + most, len(text))
    best = None
    if whole_tables:
        last = text.find("\n", end)
        tables = [(at + a, at + b) for a, b in table_ranges(text[at : last if last >= 0 else len(text)])]
        places = [p + 1 for p in range(at, end) if text[p] == "\n" and not any(a < p + 1 <= b for a, b in tables)]
        near = [p for p in places if p >= at + least and _BOUNDARY.match(text[p : None if (e := text.find("\n", p)) < 0 else e].strip())]
        blank = [p for p in places if p - 2 >= max(goal - 200, at + least) and text[p - 2 : p] == "\n\n"]
        lines = [p for p in places if p > goal]
        return min(near, key=lambda p: abs(p - goal)) if near else blank[0] if blank else lines[0] if lines else end
    p = text.find("\n", max(at + least - 1, 0)) + 1
    while 0 < p <= end:
        if best is not None and p - goal >= abs(best - goal):
            break  # farther ones follow
        e = text.find("\n", p)
        if _BOUNDARY.match(text[p : e if e >= 0 else len(text)].strip()) and (best is None or abs(p - goal) < abs(best - goal)):
            best = p
        p = e + 1
    if best is not None:
        return best
    if (blank := text.find("\n\n", max(goal - 200, at + least), end + 1)) >= 0:
        return blank + 2
    line = text.find("\n", goal, end)
    return line + 1 if line >= 0 else end


def chunks_by_structure(parts: Iterable[tuple[int, str]], target: int = 8000, least: int = 2000, most: int | None = None, whole_tables: bool = False) -> Iterator[dict]:
    """Chunks of parts (page, text), joined by empty lines, with the pages at their first and last character. Cuts depend
    on what follows within `most` characters and a line; no more than that and a part is held."""
    most = most or int(1.8 * target)
    text, at, marks = "", 0, [(0, 1)]  # marks: where pages begin in text

    def page(position: int) -> int:
        return marks[bisect_right(marks, position, key=itemgetter(0)) - 1][1]

    def chunk(begin: int, end: int) -> Iterator[dict]:
        if own := text[begin:end].strip():
            yield {"text": own, "page_start": page(begin), "page_end": page(max(begin, end - 1)), "chars": len(own)}

    for number, part in parts:
        text = f"{text.rstrip('\n')}\n\n" if text else ""
        if number > 0:
            marks.append((len(text), number))
        text += part.lstrip("\n") if text else part
        while len(text) - at > most and text.find("\n", at + most) >= 0:
            end = _break(text, at, target, least, most, whole_tables)
            end = end if end > at else at + most
            yield from chunk(at, end)
            at = end
        if at > 4 * most:  # what is done goes
            last = page(at)
            marks = [(0, last), *((p - at, n) for p, n in marks if p > at)]
            text, at = text[at:], 0
    while len(text) - at > target:
        end = _break(text, at, target, least, most, whole_tables)
        end = end if end > at else at + most
        yield from chunk(at, end)
        at = end
    yield from chunk(at, len(text))


BY_LINES = "text string, page_start int, page_end int, section_path string, chars bigint, tokens bigint, has_table boolean, headings bigint, numbered bigint"
BY_STRUCTURE = "text string, page_start int, page_end int, chars bigint"


def _in_order(nodes: DataFrame, fold: Callable[[Iterable[tuple[int, str]]], Iterator[dict]], fields: str, word: str) -> DataFrame:
    """(source, n, id, and the fields of fold's chunks): a source's nodes stream through fold in the order of page, position and id."""
    page = F.coalesce(F.when(F.col("page") > 0, F.col("page")), F.lit(0)).cast("int").alias("page")
    pos = F.col("source_char_pos").cast("bigint") if "source_char_pos" in nodes.columns else F.lit(0).cast("bigint")
    rows = nodes.select(F.col("source").cast("string").alias("source"), page, pos.alias("pos"), "id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartition("source").sortWithinPartitions("source", "page", "pos", "id")
    names = [x.split()[0] for x in fields.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        every = (r for f in frames for r in zip(f["source"], f["page"], f["text"], strict=True))
        found = (
            {"source": source, "n": n, "id": f"{(source or '').removesuffix('.json').removesuffix('.pdf')}_{word}_{n:04d}"} | c
            for source, own in groupby(every, key=itemgetter(0))
            for n, c in enumerate(fold((p, t) for _, p, t in own))
        )
        while some := list(islice(found, 500)):
            yield pd.DataFrame(some, columns=["source", "n", "id", *names])

    return rows.mapInPandas(run, f"source string, n bigint, id string, {fields}")


def rechunk(nodes: DataFrame, target: int = 8000, least: int = 2000, most: int | None = None, whole_tables: bool = False) -> DataFrame:
    """(source, n, id, text, page_start, page_end, chars): larger chunks of nodes (source, page, id, text, and
    source_char_pos if there is one), cut by structure. whole_tables: tables are cut only if nothing else can be.

    Page markers and invisible characters go first. Null texts are empty, pages below 1 are unknown and count as the last
    known one, 1 at first. A source streams through one task, which holds little more than a chunk of it.
    """
    clean = sub(drop_invisible(sub(sub(F.col("text"), r"(?i)<!--\s*PAGE\s*:?\s*\d*\s*-->"), r"(?i)<!--\s*PAGE[_\s][^>]*?-->")), r"\n{3,}", "\n\n")
    return _in_order(nodes.withColumn("text", clean), partial(chunks_by_structure, target=target, least=least, most=most, whole_tables=whole_tables), BY_STRUCTURE, "chunk")


def rechunk_lines(nodes: DataFrame, target: int = 8000) -> DataFrame:
    """(source, n, id, text, page_start, page_end, section_path, chars, tokens, has_table, headings, numbered): larger
    chunks of whole lines of nodes as for rechunk(), which do not cut tables below 1.5 times the target.

    section_path is that of the first line; chars and tokens (words) count the chunk without page markers.
    """
    return _in_order(nodes, partial(chunks_by_lines, target=target), BY_LINES, "rechunk")


def split_long(nodes: DataFrame, target: int = 8000) -> DataFrame:
    """(doc, idx, part, and the fields of rechunk_lines()): nodes (doc, idx, page, text) cut one by one, without a shuffle;
    part counts from 0. Nodes without text make no row."""
    page, text = F.coalesce(F.when(F.col("page") > 0, F.col("page")), F.lit(0)).cast("int").alias("page"), F.coalesce("text", F.lit("")).alias("text")
    names = [x.split()[0] for x in BY_LINES.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [{"doc": d, "idx": i, "part": n} | c for d, i, p, t in zip(f["doc"], f["idx"], f["page"], f["text"], strict=True) for n, c in enumerate(chunks_by_lines([(p, t)], target))]
            yield pd.DataFrame(rows, columns=["doc", "idx", "part", *names])

    return nodes.select("doc", "idx", page, text).mapInPandas(run, f"doc {nodes.schema['doc'].dataType.simpleString()}, idx bigint, part bigint, {BY_LINES}")


def rechunk_summary(chunks: DataFrame) -> DataFrame:
    """One row for the chunks of rechunk_lines(): how many, mean characters and tokens, chunks with a table."""
    return chunks.agg(F.count("*").alias("chunks"), F.round(F.avg("chars"), 2).alias("avg_chars"), F.round(F.avg("tokens"), 2).alias("avg_tokens"), F.count_if("has_table").alias("with_table"))
