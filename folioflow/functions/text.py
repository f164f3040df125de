"""Cleaning of extracted text: Column -> Column functions of built-in expressions, composable in any order.

Patterns are Java's with Unicode classes, `$` and `.` see only line feeds as line ends. Null texts stay null, empty
ones stay empty.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

U = "(?U)"


def sub(text: Column, pattern: str, to: str = "") -> Column:
    return F.regexp_replace(text, F.lit(pattern), F.lit(to))


def apply(docs: DataFrame, *changes: Callable[[Column], Column]) -> DataFrame:
    """docs with its column text changed step by step: one projection a step, since a step may use its input several times."""
    return reduce(lambda d, f: d.withColumn("text", f(F.col("text"))), changes, docs)


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value) with value evaluated once; what a lambda of an array function refers to is otherwise evaluated for each element."""
    return F.element_at(F.transform(F.array(value), then), 1)


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return sub(text, rf"{U}^\s+|\s+\z")


def map_lines(text: Column, change: Callable[[Column], Column]) -> Column:
    return F.array_join(F.transform(F.split(text, "\n"), change), "\n")


def keep_lines(text: Column, wanted: Callable[[Column], Column]) -> Column:
    return F.array_join(F.filter(F.split(text, "\n"), wanted), "\n")


def words(text: Column) -> Column:
    """White-space separated words."""
    return F.filter(F.split(text, rf"{U}\s+"), lambda x: x != "")


def squeeze_blank_lines(text: Column) -> Column:
    """At most one empty line in a row."""
    return sub(text, r"\n{3,}", "\n\n")


def drop_page_markers(text: Column) -> Column:
    """Without HTML comments that begin with PAGE, the white space and line end after them, and parsed-page tags."""
    return sub(sub(text, rf"(?i){U}<!--\s*PAGE[^>]*?-->\s*\n?"), r"(?i)<PARSED TEXT FOR PAGE:[^>]*>")


def drop_numbered_page_markers(text: Column) -> Column:
    """Like drop_page_markers, but only comments of the form PAGE:number."""
    return sub(sub(text, rf"(?i){U}<!--\s*PAGE\s*:\s*\d+\s*-->\s*\n?"), rf"(?i){U}<PARSED\s+TEXT\s+FOR\s+PAGE\s*:[^>]*>")


def drop_invisible(text: Column) -> Column:
    """Without control, format, private and unassigned characters and U+FFFD; no-break spaces become blanks."""
    return sub(F.translate(text, "\u00a0", " "), r"[\p{C}\x{FFFD}&&[^\n\t\r]]")


#: Lines that page footers, system logs and extraction tools leave.
FOOTERS = (
    r"kcb[_.].*\d{1,2}\s*/\s*\d{1,2}\s*/\s*\d{4}",
    r"kcb[_.].*\d{1,2}\s*:\s*\d{2}\s*:\s*\d{2}",
    r"^[*\s]*kcb[_.][^\n]{10,}$",
    r"<PARSED TEXT",
    r"\[Page\s*\d+\]",
    r"---Page Break---",
)


def drop_footer_lines(text: Column) -> Column:
    pattern = f"(?i){U}" + "|".join(f"(?:{p})" for p in FOOTERS)
    return keep_lines(text, lambda x: ~x.rlike(pattern))


def drop_image_links(text: Column) -> Column:
    """Without Markdown images of the usual raster formats; a blank before the extension is allowed."""
    return squeeze_blank_lines(sub(text, rf"(?i){U}!\[[^\]]*\]\([^)]*\.\s*(?:jpe?g|png|gif|bmp)\s*\)"))


def drop_long_separators(text: Column) -> Column:
    """Without lines of 50 and more dashes, underscores, equals signs or tildes."""
    return keep_lines(text, lambda x: ~strip(x).rlike(r"^[-—_=~]{50,}\z"))


def most_frequent(items: Column) -> Column:
    """How often the most frequent element of an array of strings occurs; 0 if it is empty. Sorts once and counts runs."""
    start = F.struct(F.lit(None).cast("string").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("most"))

    def step(s: Column, x: Column) -> Column:
        run = F.when(x.eqNullSafe(s.last), s.run + 1).otherwise(F.lit(1))
        return F.struct(x.alias("last"), run.alias("run"), F.greatest(s.most, run).alias("most"))

    return F.aggregate(F.sort_array(items), start, step, lambda s: s.most)


def pairs(items: Column) -> Column:
    """Adjacent elements, joined by a blank."""
    return F.when(F.size(items) < 2, F.array().cast("array<string>")).otherwise(F.zip_with(F.slice(items, F.lit(1), F.size(items) - 1), F.slice(items, F.lit(2), F.size(items) - 1), lambda a, b: F.concat_ws(" ", a, b)))


#: Characters that ordinary text consists of.
ORDINARY = r"[a-zA-ZÀ-ỹ0-9\s.,;:!?\-()\[\]{}|+=*/#@%&\"'`~<>]"


def is_gibberish(line: Column) -> Column:
    """A word 30 times, a word pair 20 times, three different words among more than ten, or a long line of odd characters."""


    def judged(own: Column) -> Column:
        odd = F.length(sub(own, U + ORDINARY)) > 0.4 * F.length(own)
        long_line = (F.length(own) > 120) & (odd | own.rlike("(?i)deo da la la companya") | own.rlike(r"([^\s])\1{10,}"))
        return let(words(own), lambda w: (F.size(w) >= 4) & (repeats(w) | long_line))

    def repeats(w: Column) -> Column:
        n = F.size(w)
        few = (n > 10) & (F.size(F.array_distinct(w)) <= 3)
        return few | ((n >= 30) & (most_frequent(w) >= 30)) | ((n > 20) & (most_frequent(pairs(w)) >= 20))

    return let(strip(line), judged)


def drop_gibberish_lines(text: Column) -> Column:
    return keep_lines(text, lambda x: ~is_gibberish(x))


def drop_page_artifacts(text: Column) -> Column:
    """Without bare page numbers, lines that begin with a page reference, and dividers of 3 to 49 characters."""
    pattern = rf"(?i){U}^[\d\-–—]+\z|^(?:Page|Trang|p\.?|tr\.?)\s*\d+|^[\-_=~]{{3,49}}\z"
    return keep_lines(text, lambda x: ~strip(x).rlike(pattern))


def drop_repeated_lines(text: Column, times: int = 2, length: int = 50) -> Column:
    """Without lines of at least `length` characters that occur `times` times in the text, headings apart.

    operators.structure.drop_repeated_lines does the same by an aggregation, for texts that are too large for a row.
    """
    norms = lambda f: F.transform(f, lambda x, i: let(F.lower(strip(x)), lambda n: F.struct(F.when(F.length(n) >= length, n).alias("n"), i.alias("i"))))
    alike = lambda s, a, b: F.get(s, a).n == F.get(s, b).n
    often = lambda s, j: reduce(lambda a, b: a | b, (F.coalesce((j >= k) & alike(s, F.greatest(j - k, F.lit(0)), j - k + times - 1), F.lit(False)) for k in range(times)))

    def unmarked(f: Column) -> Column:
        marks = let(F.sort_array(norms(f)), lambda s: F.sort_array(F.transform(s, lambda x, j: F.struct(x.i.alias("i"), often(s, j).alias("often")))))
        return let(marks, lambda m: F.when(F.exists(m, lambda x: x.often), F.array_join(F.filter(f, lambda x, i: ~F.get(m, i).often | strip(x).startswith("#")), "\n")).otherwise(text))

    return let(F.split(text, "\n"), unmarked)


def fix_ocr_punctuation(text: Column, keep_paragraphs: bool = False) -> Column:
    """One blank after sentence ends, none before punctuation. keep_paragraphs: line ends are left alone."""
    space = r"[ \t]" if keep_paragraphs else r"\s"
    return sub(sub(text, rf"{U}([.!?]){space}{{2,}}", "$1 "), rf"{U}{space}+([.!?,;:])", "$1")


def normalise_markdown(text: Column) -> Column:
    """Headings without asterisks, `- ` for bullets, `n. ` for numbered items."""

    def change(x: Column) -> Column:
        heading = rf"{U}^(#{{1,6}})\s*\*{{0,2}}(.+?)\*{{0,2}}\s*\z"
        bullet, number = rf"{U}^(\s*)[-*•]\s+(.*)\z", rf"{U}^(\s*)(\d+)[.)]\s+(.*)\z"
        title = F.concat_ws(" ", F.regexp_extract(x, heading, 1), strip(sub(F.regexp_extract(x, heading, 2), r"\*{1,2}")))
        return F.when(x.rlike(heading), title).when(x.rlike(bullet), sub(x, bullet, "$1- $2")).when(x.rlike(number), sub(x, number, "$1$2. $3")).otherwise(x)

    return map_lines(text, change)


def normalise_whitespace(text: Column) -> Column:
    """No blanks at line ends, single blanks outside table rows, one kind of line end, at most one empty line."""

    def change(x: Column) -> Column:
        x = sub(x, rf"{U}\s+\z")
        return F.when(x.rlike(rf"{U}^\s*\|"), x).otherwise(sub(x, r"[ \t]{2,}", " "))

    return strip(squeeze_blank_lines(sub(map_lines(text, change), r"\r\n?", "\n")))


def clean_basic(text: Column) -> Column:
    """Invisible characters, blanks at line ends and runs of empty lines removed; page markers stay."""
    return strip(squeeze_blank_lines(map_lines(drop_invisible(text), lambda x: sub(x, rf"{U}\s+\z"))))


def clean(text: Column) -> Column:
    """clean_basic without page markers; applying it twice changes nothing."""
    return clean_basic(drop_page_markers(text))


def collapse_whitespace(text: Column) -> Column:
    return strip(sub(text, rf"{U}\s+", " "))


#: The first cleaning stage, in order.
STAGE_1 = (drop_page_markers, drop_invisible, drop_footer_lines, drop_image_links, drop_long_separators, drop_gibberish_lines, drop_page_artifacts, drop_repeated_lines, fix_ocr_punctuation, normalise_markdown, normalise_whitespace)


def clean_extracted(docs: DataFrame) -> DataFrame:
    """The whole first stage over docs with a column text."""
    return apply(docs, *STAGE_1)


def tokens_estimated(text: Column) -> Column:
    """A quarter of the characters after white space is collapsed, at least 1."""
    return F.greatest(F.lit(1), F.floor(F.length(collapse_whitespace(text)) / 4)).cast("bigint")


def tokens_by_length(text: Column, least: int = 0) -> Column:
    """A quarter of the characters."""
    return F.greatest(F.lit(least), F.floor(F.length(text) / 4)).cast("bigint")


def tokens_by_words(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def paragraphs(text: Column) -> Column:
    """Parts between empty lines, stripped, empty ones left out."""
    return F.filter(F.transform(F.split(text, rf"{U}\n\s*\n"), strip), lambda x: x != "")


def sentences(text: Column) -> Column:
    """Parts that end in . ! ? before white space and a letter, digit or quote."""
    return F.filter(F.transform(F.split(text, rf"{U}(?<=[.!?])\s+(?=[A-ZÀ-Ỹa-zà-ỹ0-9\"])"), strip), lambda x: x != "")


def is_table_line(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit("|"))) >= 2


def is_table_placeholder(text: Column) -> Column:
    return strip(text).rlike(r"^\[TABLE_REMOVED:[^\]]*\]")


def is_table_content(paragraph: Column) -> Column:
    """A placeholder, or at least two table lines."""
    return is_table_placeholder(paragraph) | (F.size(F.filter(F.split(paragraph, "\n"), is_table_line)) >= 2)
