"""Flags, noise counts and repairs of single nodes (chunks of a document); Column -> Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import U, is_table_line, keep_lines, let, map_lines, most_frequent, strip, sub, words

#: Academic titles of name lists.
TITLES = ("GS.", "PGS.", "TS.", "ThS.", "BSCK", "BS.", "Giáo sư", "Phó Giáo sư", "Tiến sĩ", "Thạc sĩ")
#: Phrases of administrative documents, for nodes.
ADMINISTRATIVE = ("Căn cứ", "Nơi nhận", "KT. BỘ TRƯỞNG", "QUYẾT ĐỊNH", "Kính gửi", "Nơi gửi", "Số ký hiệu", "Ngày ký", "Chứng thực", "Xác nhận", "Ký duyệt")
#: Phrases of administrative documents, for whole documents.
ADMINISTRATIVE_DOCUMENT = ("Căn cứ", "QUYẾT ĐỊNH", "Nơi nhận", "KT. BỘ TRƯỞNG", "Kính gửi", "Số ký hiệu", "Ngày ký", "Chứng thực", "Xác nhận", "Ký duyệt", "THỨ TRƯỞNG", "CỘNG HÒA XÃ HỘI", "Độc lập - Tự do", "BỘ Y TẾ")
#: Words of tables whose loss is a risk.
HIGH_RISK = ("liều", "mg", "kg", "oseltamivir", "zanamivir", "baloxavir", "dự phòng", "điều trị", "phác đồ", "thuốc", "tiêm", "uống", "g/ngày", "mg/ngày", "viên", "ống", "ml", "đơn vị")


def phrases_found(text: Column, phrases: tuple[str, ...]) -> Column:
    """How many of the phrases a text contains, in any case."""
    low = F.lower(text)
    return sum((low.contains(p.lower()).cast("int") for p in phrases), F.lit(0))


def is_administrative(text: Column, phrases: tuple[str, ...] = ADMINISTRATIVE) -> Column:
    return phrases_found(text, phrases) >= 3


def written_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: strip(x) != "")


def is_name_list(text: Column) -> Column:
    """Of three lines or more, over half of the written ones contain an academic title."""
    titled = F.filter(written_lines(text), lambda x: x.rlike("|".join(t.replace(".", r"\.") for t in TITLES)))
    return (F.size(F.split(text, "\n")) >= 3) & (F.size(titled) > 0.5 * F.greatest(F.size(written_lines(text)), F.lit(1)))


def dotted(text: Column) -> Column:
    return F.size(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"\.{3,}")))


def is_contents(text: Column) -> Column:
    """Over two lines with dot leaders, and these and the pipes are over 0.3 a written line."""
    pipes = F.length(text) - F.length(F.replace(text, F.lit("|")))
    n = F.size(written_lines(text))
    return (n > 0) & (dotted(text) > 2) & (dotted(text) + pipes > 0.3 * n)


def is_contents_document(text: Column) -> Column:
    """Says so, or over three lines have dot leaders and over 0.3 of the written ones end in dots and a number."""
    lines = written_lines(text)
    refs = F.size(F.filter(lines, lambda x: strip(x).rlike(rf"{U}\.{{3,}}\s*\d+\s*\z")))
    return F.upper(text).contains("MỤC LỤC") | ((dotted(text) > 3) & (refs > 0.3 * F.greatest(F.size(lines), F.lit(1))))


def replace_images(text: Column) -> Column:
    """Images become their description, or nothing if they have none."""
    return sub(sub(text, rf"{U}!\[(\s*)\]\([^)]*\)"), r"!\[([^\]]*)\]\([^)]*\)", "[IMG: $1]")


def drop_dash_lines(text: Column) -> Column:
    return keep_lines(text, lambda x: ~strip(x).rlike(r"^[-—]{50,}\z"))


def drop_repetitive_lines(text: Column) -> Column:
    """Without lines of over 20 words of which less than a tenth differ."""
    return keep_lines(text, lambda x: ~let(words(x), lambda w: (F.size(w) > 20) & (F.size(F.array_distinct(w)) < 0.1 * F.size(w))))


def space_headings(text: Column) -> Column:
    """An empty line before every heading."""
    apart = lambda f: F.transform(f, lambda x, i: F.when(x.rlike(rf"{U}^#{{1,6}}\s") & (i > 0) & (strip(F.get(f, i - 1)) != ""), F.concat(F.lit("\n"), x)).otherwise(x))
    return F.array_join(let(F.split(text, "\n"), apart), "\n")


def split_bulleted_headings(text: Column) -> Column:
    """`- +` becomes `- `; a heading that is a bullet becomes an empty heading and a bullet."""
    bullet = lambda x: sub(x, rf"{U}^(\s*)- \+", "$1- ")
    return map_lines(text, lambda x: sub(bullet(x), rf"{U}^(#+)\s+-\s*(\S.*?)\s*\z", "$1 \n- $2"))


def breaks_to_lines(text: Column) -> Column:
    return sub(text, rf"(?i){U}<br\s*/?>", "\n")


def drop_latex(text: Column) -> Column:
    """Formulas in dollars go; \\mathrm{} and \\mathbf{} leave their content."""
    return sub(sub(text, r"\$[^$]*\$"), r"\\math(?:rm|bf)\{([^}]*)\}", "$1")


def unwrap_latex(text: Column) -> Column:
    """Like drop_latex, but formulas leave their content."""
    return sub(sub(text, r"\$([^$]*)\$", "$1"), r"\\math(?:rm|bf)\{([^}]*)\}", "$1")


def noise(text: Column) -> Column:
    """struct<image_links, footer_patterns, gibberish_lines>: counts of noise that cleaning left."""
    gibberish = F.size(F.filter(F.split(text, "\n"), lambda x: let(words(x), lambda w: (F.size(w) >= 15) & (most_frequent(w) >= 15))))
    images = F.regexp_count(text, F.lit(r"!\[[^\]]*\]\([^)]+\)"))
    footers = F.regexp_count(text, F.lit(rf"(?i){U}kcb[_.][^\n]+\d{{1,2}}\s*[:/]\s*\d{{1,2}}"))
    return F.struct(images.cast("bigint").alias("image_links"), footers.cast("bigint").alias("footer_patterns"), gibberish.cast("bigint").alias("gibberish_lines"))


def table_lines(text: Column) -> Column:
    return F.size(F.filter(F.split(text, "\n"), is_table_line)).cast("bigint")


def first_keyword(text: Column, keywords: tuple[str, ...] = HIGH_RISK) -> Column:
    """The first of the keywords, in their order, that a text contains; null if none."""
    low = F.lower(text)
    return F.coalesce(*(F.when(low.contains(k.lower()), F.lit(k)) for k in keywords))


def removed_tables(text: Column) -> Column:
    """Captions of table placeholders."""
    return F.regexp_extract_all(text, F.lit(rf"{U}\[TABLE_REMOVED:\s*([^\]]+)\]"), F.lit(1))


def risky_tables(text: Column) -> Column:
    """array<struct<caption, keyword>> of the placeholders with a high-risk keyword."""
    return F.filter(F.transform(removed_tables(text), lambda c: F.struct(c.alias("caption"), first_keyword(c).alias("keyword"))), lambda s: s.keyword.isNotNull())


def comparable(text: Column) -> Column:
    """Lower case, single blanks, no punctuation."""
    return sub(F.trim(sub(F.lower(text), rf"{U}\s+", " ")), rf"{U}[^\w\s]")


def word_set(text: Column) -> Column:
    """The sorted words of comparable(); what it does to blanks makes no other words."""
    return F.sort_array(F.array_distinct(words(sub(F.lower(text), rf"{U}[^a-z0-9\w\s]+"))))


def similarity(a: Column, b: Column) -> Column:
    """Jaccard similarity of two word sets: 1 for two empty ones, 0 for one."""
    either = F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / either)
