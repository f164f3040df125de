"""Lines, headings, sections and boundaries of documents as rows. DataFrames have (doc, text) unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import U, paragraphs, sentences, strip, tokens_estimated

HEADING = rf"{U}^(#{{1,6}})\s+(.+?)\s*\z"


def lines(docs: DataFrame) -> DataFrame:
    """(doc, pos, line, char_pos): char_pos counts characters before the line, line ends included."""
    rows = docs.select("doc", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    before = Window.partitionBy("doc").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("char_pos", F.coalesce(F.sum(F.length("line") + 1).over(before), F.lit(0)))


def repeated_lines(docs: DataFrame, times: int = 2, length: int = 50) -> DataFrame:
    """(doc, norm, n): lower-cased lines of at least `length` characters that a document has at least `times` times."""
    norm = F.lower(strip(F.col("line"))).alias("norm")
    rows = docs.select("doc", F.explode(F.split("text", "\n")).alias("line")).select("doc", norm).where(F.length("norm") >= length)
    return rows.groupBy("doc", "norm").agg(F.count("*").alias("n")).where(F.col("n") >= times)


def drop_repeated_lines(docs: DataFrame, times: int = 2, length: int = 50) -> DataFrame:
    """(doc, text) without every occurrence of repeated lines, headings apart; documents may be of any length."""
    rows = docs.select("doc", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    norm = F.lower(strip(F.col("line")))
    rows = rows.withColumn("norm", F.when(strip(F.col("line")).startswith("#"), F.lit(None)).otherwise(norm))
    kept = rows.join(repeated_lines(docs, times, length), ["doc", "norm"], "left_anti")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x.line), "\n").alias("text")
    return docs.select("doc").join(kept.groupBy("doc").agg(text), "doc", "left").withColumn("text", F.coalesce("text", F.lit("")))


def headings(docs: DataFrame) -> DataFrame:
    """(doc, pos, level, title) of Markdown headings."""
    rows = docs.select("doc", F.posexplode(F.split("text", "\n")).alias("pos", "line")).where(F.col("line").rlike(HEADING))
    return rows.select("doc", "pos", F.length(F.regexp_extract("line", HEADING, 1)).alias("level"), F.regexp_extract("line", HEADING, 2).alias("title"))


def numbered(docs: DataFrame) -> DataFrame:
    """(doc, pos, number, title) of lines numbered by digits (2.4.), Roman numerals or capitals."""
    pattern = rf"{U}^((?:\d+\.)*\d+|[IVX]+|[A-Z])[.)]\s+(.+?)\s*\z"
    rows = docs.select("doc", F.posexplode(F.split("text", "\n")).alias("pos", "line")).where(F.col("line").rlike(pattern))
    return rows.select("doc", "pos", F.regexp_extract("line", pattern, 1).alias("number"), F.regexp_extract("line", pattern, 2).alias("title"))


def boundaries(docs: DataFrame) -> DataFrame:
    """(doc, char_pos, title, level) of headings, numbered lines and Vietnamese section marks."""
    own = strip(F.col("line"))
    number, mark = rf"{U}^(\d+(?:\.\d+)*\.?)\s+(.+)\z", rf"(?i){U}^(CHƯƠNG|MỤC|PHẦN)\s+(.+)\z"
    found = lines(docs).withColumn("own", own)
    of = lambda p: F.concat_ws(" ", F.regexp_extract("own", p, 1), F.regexp_extract("own", p, 2))
    level = F.when(F.col("own").rlike(HEADING), F.length(F.regexp_extract("own", HEADING, 1))).when(F.col("own").rlike(number), F.regexp_count(F.regexp_extract("own", number, 1), F.lit(r"\.")) + 1).when(F.col("own").rlike(mark), F.lit(1))
    title = F.when(F.col("own").rlike(HEADING), F.regexp_extract("own", HEADING, 2)).when(F.col("own").rlike(number), of(number)).otherwise(of(mark))
    return found.withColumn("level", level).where("level is not null").select("doc", "char_pos", title.alias("title"), F.col("level").cast("int").alias("level"))


def sections(docs: DataFrame) -> DataFrame:
    """(doc, section, level, title, text): what stands under each heading; text before the first has level 0 and no title.

    Headings without text below them make no section; the heading's line is no part of the text.
    """
    rows = docs.select("doc", F.posexplode(F.split("text", "\n")).alias("pos", "line")).withColumn("head", F.col("line").rlike(HEADING))
    so_far = Window.partitionBy("doc").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("section", F.sum(F.col("head").cast("int")).over(so_far))
    body = F.transform(F.array_sort(F.collect_list(F.when(~F.col("head"), F.struct("pos", "line")))), lambda x: x.line)
    head = F.max(F.when(F.col("head"), F.col("line")))
    found = rows.groupBy("doc", "section").agg(strip(F.array_join(body, "\n")).alias("text"), head.alias("head")).where("text <> ''")
    level = F.coalesce(F.length(F.regexp_extract("head", HEADING, 1)), F.lit(0))
    return found.select("doc", "section", level.alias("level"), F.coalesce(F.regexp_extract("head", HEADING, 2), F.lit("")).alias("title"), "text")


def section_paths(docs: DataFrame, width: int = 40) -> DataFrame:
    """(doc, pos, path): above every line the titles of headings and the numbers of numbered lines before it.

    A heading whose level is at most that of the heading before cuts the path to the titles above its level; deeper ones
    are appended, whatever levels are left out. Numbered lines add their number, which only a heading cuts. Titles are cut
    to `width` characters and joined by ` > `; without any the path is Document. The path after every heading is folded
    once for a document, and lines take the last one before them by one sort.
    """
    number = rf"{U}^((?:\d+\.)*\d+|[IVX]+|[A-Z])[.)]\s+.+\z"

    def mark(x: Column, i: Column) -> Column:
        head = F.struct(i.alias("pos"), F.length(F.regexp_extract(x, HEADING, 1)).alias("level"), F.substring(F.regexp_extract(x, HEADING, 2), 1, width).alias("name"))
        item = F.struct(i.alias("pos"), F.lit(0).alias("level"), F.regexp_extract(x, number, 1).alias("name"))
        return F.when(x.rlike(HEADING), head).when(x.rlike(number), item)

    start = F.struct(F.array().cast("array<string>").alias("path"), F.lit(0).alias("level"), F.array().cast("array<struct<pos:int,path:string>>").alias("out"))

    def step(s: Column, m: Column) -> Column:
        kept = F.when((m.level > 0) & (m.level <= s.level), F.slice(s.path, F.lit(1), F.least(m.level - 1, F.size(s.path)))).otherwise(s.path)
        path = F.concat(kept, F.array(m["name"]))
        return F.struct(path.alias("path"), F.when(m.level > 0, m.level).otherwise(s.level).alias("level"), F.concat(s.out, F.array(F.struct(m.pos.alias("pos"), F.array_join(path, " > ").alias("path")))).alias("out"))

    lines = F.split("text", "\n")
    marks = docs.select("doc", F.explode(F.aggregate(F.array_compact(F.transform(lines, mark)), start, step, lambda s: s.out)).alias("m")).select("doc", "m.pos", "m.path", F.lit(1).alias("kind"))
    rows = docs.select("doc", F.posexplode(lines).alias("pos", "line")).select("doc", "pos", F.lit(None).cast("string").alias("path"), F.lit(0).alias("kind"))
    before = Window.partitionBy("doc").orderBy("pos", "kind").rowsBetween(Window.unboundedPreceding, -1)
    found = rows.unionByName(marks).withColumn("path", F.coalesce(F.last("path", ignorenulls=True).over(before), F.lit("Document")))
    return found.where("kind = 0").select("doc", "pos", "path")


def paragraph_rows(docs: DataFrame, *keys: str) -> DataFrame:
    """(keys, n, paragraph, tokens): a row for every paragraph of text."""
    return docs.select(*(keys or ("doc",)), F.posexplode(paragraphs(F.col("text"))).alias("n", "paragraph")).withColumn("tokens", tokens_estimated(F.col("paragraph")))


def sentence_rows(docs: DataFrame) -> DataFrame:
    """(doc, n, sentence)."""
    return docs.select("doc", F.posexplode(sentences(F.col("text"))).alias("n", "sentence"))
