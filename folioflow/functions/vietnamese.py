"""The second cleaning stage, for Vietnamese and Markdown structure; Column -> Column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import U, apply, drop_invisible, drop_page_markers, let, map_lines, squeeze_blank_lines, strip, sub

LOWER = r"a-zàáảãạăằắẳẵặâầấẩẫậèéẻẽẹêềếểễệìíỉĩịòóỏõọôồốổỗộơờớởỡợùúủũụưừứửữựỳýỷỹỵđ"
UPPER = r"A-ZÀÁẢÃẠĂẰẮẲẴẶÂẦẤẨẪẬÈÉẺẼẸÊỀẾỂỄỆÌÍỈĨỊÒÓỎÕỌÔỒỐỔỖỘƠỜỚỞỠỢÙÚỦŨỤƯỪỨỬỮỰỲÝỶỸỴĐ"


def join_broken_lines(text: Column, keep_empty: bool = False) -> Column:
    """Words cut by a hyphen at a line end are joined, as are lines that go on in lower case.

    A line takes in the next one only, and a line taken in takes in none. Headings and list items stay. Empty lines
    are dropped unless keep_empty.
    """
    structural = lambda x: strip(x).rlike(r"^(?:#|-|\d+\.)") | (strip(x) == "")
    hyphen = lambda last, x: sub(last, rf"{U}\s+\z").endswith("-") & strip(x).rlike(f"^[{LOWER}{UPPER}]")
    goes_on = lambda last, x: ~sub(last, rf"{U}\s+\z").rlike(r"[.!?:;,]\z") & strip(x).rlike(f"^[{LOWER}]")

    def taken(f: Column) -> Column:
        """1 for every line that the one before takes in, else 0: of lines in a row that could be, every second one is."""
        fits = F.transform(f, lambda x, i: F.when((i > 0) & strip(x).rlike(f"^[{LOWER}{UPPER}]"), let(F.get(f, i - 1), lambda last: F.when(~structural(last) & (hyphen(last, x) | goes_on(last, x)), "1").otherwise("0"))).otherwise("0"))
        return F.split(F.replace(F.array_join(fits, ""), F.lit("11"), F.lit("10")), "")

    def joined(last: Column, x: Column) -> Column:
        return F.when(hyphen(last, x), F.concat(sub(last, rf"{U}-\s*\z"), strip(x))).otherwise(F.concat(sub(last, rf"{U}\s+\z"), F.lit(" "), strip(x)))

    def lines(f: Column) -> Column:
        return let(taken(f), lambda t: F.array_compact(F.transform(f, lambda x, i: F.when(F.get(t, i) == "1", F.lit(None)).when(F.coalesce(F.get(t, i + 1), F.lit("")) == "1", joined(x, F.get(f, i + 1))).otherwise(x))))

    done = let(F.split(text, "\n"), lines)
    return F.array_join(done if keep_empty else F.filter(done, lambda x: strip(x) != ""), "\n")


def fix_ocr_letters(text: Column) -> Column:
    """0 for O in words, missing blanks after full stops and commas, and the country's name."""
    t = sub(sub(text, rf"{U}\b0(?=[a-zA-Z])", "O"), rf"{U}(?<=[a-zA-Z])0\b", "o")
    t = sub(sub(t, rf"\.(?=[{UPPER}])", ". "), r",(?=[A-Za-zÀ-ỹ])", ", ")
    t = sub(sub(t, rf"{U}\bVIỆT\s+NAM\b", "VIỆT NAM"), rf"{U}\bViệt\s+Nam\b", "Việt Nam")
    return sub(t, rf"(?i){U}\bviet\s+nam\b", "việt nam")


def normalise_headings(text: Column) -> Column:
    """`# - x` becomes `# x`; an empty line goes before a heading unless there is one."""
    line = rf"{U}^\s*(#{{1,6}})\s*-\s+(.*?)\s*\z"
    fixed = F.transform(F.split(text, "\n"), lambda x: F.when(x.rlike(line), F.concat_ws(" ", F.regexp_extract(x, line, 1), F.regexp_extract(x, line, 2))).otherwise(x))
    apart = lambda f: F.transform(f, lambda x, i: F.when(strip(x).rlike(rf"{U}^#{{1,6}}\s+") & (i > 0) & (strip(F.get(f, i - 1)) != ""), F.concat(F.lit("\n"), x)).otherwise(x))
    return F.array_join(let(fixed, apart), "\n")


def normalise_bullets(text: Column) -> Column:
    """`- +` begins a nested item, on a line of its own; a dash is followed by a blank."""
    t = sub(text, rf"{U}\.\s*- \+\s*", ".\n  - ")
    return sub(sub(t, rf"(?md){U}^(\s*)- \+\s*", "$1  - "), rf"(?md){U}^(\s*)-([^\s\-])", "$1- $2")


def replace_breaks(text: Column) -> Column:
    """HTML line breaks become blanks in table rows and line ends elsewhere."""
    tag = rf"(?i){U}<br\s*/?>"
    return map_lines(text, lambda x: F.when(x.contains("|"), sub(x, tag, " ")).otherwise(sub(x, tag, "\n")))


def normalise_punctuation(text: Column) -> Column:
    """ASCII dashes; repeated sentence marks, dots included, become one."""
    return sub(sub(sub(text, "[–—]", "-"), r"\.{3,}", "..."), r"([.!?])\1+", "$1")


def normalise_spacing(text: Column, keep_numbers: bool = False) -> Column:
    """Single blanks, none before punctuation, one after it. keep_numbers: none is put between digits (2.1, 10:30)."""
    after = r"([.,!?;:])(?=[A-Za-zÀ-ỹ])|(?<!\d)([.,!?;:])(?=\d)" if keep_numbers else r"([.,!?;:])(?=[A-Za-zÀ-ỹ0-9])"
    t = sub(sub(text, " {2,}", " "), rf"{U}\s+([.,!?;:])", "$1")
    return strip(squeeze_blank_lines(sub(t, after, "$1$2 " if keep_numbers else "$1 ")))


def drop_residue(text: Column) -> Column:
    """Page markers and invisible characters that came through."""
    return strip(squeeze_blank_lines(drop_invisible(drop_page_markers(text))))


#: The second stage, in order; table extraction, if wanted, comes before the last step.
STAGE_2 = (join_broken_lines, fix_ocr_letters, normalise_headings, normalise_bullets, replace_breaks, normalise_punctuation, normalise_spacing, drop_residue)


def clean_final(docs: DataFrame) -> DataFrame:
    """The whole second stage over docs with a column text."""
    return apply(docs, *STAGE_2)
