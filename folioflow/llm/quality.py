"""Quality rules with cross-document line frequency; DataFrame functions only.

Per document, words, symbols, repeated lines and repeated 5-word windows are counted inside its row. Across documents,
normalised lines are hashed and the distinct documents of a host that contain a line are counted. Lines in at least
MIN_DOCS documents and in the share LIMIT of the host's documents are boilerplate; they are removed, and a document that
loses more than DEPLETED of its words with them is rejected.

Lines are hashed once and kept as rows of a few bytes. Counting shuffles (host, line, document), first by all three, then
with partial counts by host and line, so neither a hot host nor a hot line meets in one task. Since a host has at most
1/LIMIT times its mean number of lines per document as boilerplate lines, their table is small; it and the table of
removed places are broadcast only if their measured size allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, broadcast_if_small, materialize, pick

MIN_DOCS = 10
LIMIT = 0.01
DEPLETED = 0.7
BLANK = r"[\x20\x09-\x0D]+"
WORDED = r"[^\x20\x09-\x0D]"


def let(value: Column, then) -> Column:
    """then(value) with value evaluated once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def words(text: Column) -> Column:
    return F.filter(F.split(text, BLANK), lambda x: x != "")


def lines(text: Column) -> Column:
    """Lines with a word."""
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(WORDED))


def normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), BLANK, " "))


def repeat_words(w: Column, size: int = 5) -> Column:
    """Words in windows of `size` words that occur twice or more in the array."""

    def covered(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            let(F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), places)
        )

    def places(s: Column) -> Column:
        twice = F.filter(s, lambda e, j: (e.h == F.get(s, j - 1).h).eqNullSafe(True) | (e.h == F.get(s, j + 1).h).eqNullSafe(True))
        return let(F.array_sort(F.transform(twice, lambda e: e.i)), total)

    def total(p: Column) -> Column:
        gaps = F.transform(p, lambda x, k: F.least(F.lit(size), F.coalesce(F.get(p, k + 1) - x, F.lit(size))))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    def windows(own: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(own) - size), lambda i: F.xxhash64(*(F.get(own, i + k) for k in range(size))))
        return let(hashes, covered)

    return F.when(F.size(w) < size + 1, F.lit(0)).otherwise(let(w, windows))


def line_rows(docs: DataFrame) -> DataFrame:
    """(host, doc, content, at, line): hashes of the lines with a word of docs (host, doc, content, text), by their place in the text."""
    rows = docs.select("host", "doc", "content", F.posexplode(F.split("text", "\n")).alias("at", "own")).where(F.col("own").rlike(WORDED))
    return rows.select("host", "doc", "content", "at", F.xxhash64(normalised(F.col("own"))).alias("line"))


def boilerplate(every: DataFrame, docs: DataFrame, min_docs: int = MIN_DOCS, limit: float = LIMIT) -> DataFrame:
    """(host, line): of line_rows() those above the host's limit; docs: (host, doc)."""
    seen = every.select("host", "line", "doc").distinct().groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs)
    sizes = docs.select("host", "doc").distinct().groupBy("host").agg(F.count("*").alias("docs"))
    return seen.join(sizes, "host").where(F.col("n") >= limit * F.col("docs")).select("host", "line")


def judge(docs: DataFrame, host: str = "source", min_docs: int = MIN_DOCS, limit: float = LIMIT, depleted: float = DEPLETED) -> DataFrame:
    """Counts, verdict and cleaned text of every row of docs (doc_id, text, and the column named by host).

    doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_line_words (words on boilerplate
    lines), kept and text (without boilerplate lines). A null text has no words, and so fails, and stays null; a null host
    is a host of its own; rows that share a doc_id are one document of a host but are judged each, rows without one are as
    many documents as they have texts; other columns are ignored.
    """
    d = pick(docs, doc_id="doc_id bigint", text="text string", host=f"{host} string")
    d = d.select("doc_id", F.col("text").isNull().alias("none"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("host", F.lit("")).alias("host"))
    d = d.withColumn("content", F.xxhash64("text")).withColumn("doc", F.struct("doc_id", F.when(F.col("doc_id").isNull(), F.col("content")).alias("text")))
    every = materialize(line_rows(d), "lines")
    bad = broadcast_if_small(materialize(boilerplate(every, d, min_docs, limit), "boilerplate"), 40)
    hits = every.join(bad, ["host", "line"]).select("host", "content", "at").distinct()  # copies of a text in a host agree
    lost = materialize(hits.groupBy("host", "content").agg(F.sort_array(F.collect_list("at")).alias("removed")), "removed")
    size = lost.agg(F.sum(48 + F.length("host") + 4 * F.size("removed"))).first()[0] or 0
    found = d.join(F.broadcast(lost) if size <= BROADCAST_BYTES else lost, ["host", "content"], "left").withColumn("w", words(F.col("text")))

    def on_lines(own: Column) -> Column:
        return F.aggregate(F.transform("removed", lambda i: F.size(words(F.get(own, i)))), F.lit(0), lambda a, n: a + n)

    split = F.split("text", "\n")
    left = F.array_join(F.filter(split, lambda x, i: ~F.array_contains("removed", i)), "\n")
    counted = found.select(
        "doc_id", F.size("w").cast("long").alias("n_words"), F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        let(lines(F.col("text")), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("w")).cast("long").alias("n_repeat_words"),
        F.coalesce(F.when(F.col("removed").isNotNull(), let(split, on_lines)), F.lit(0)).cast("long").alias("n_line_words"),
        F.when(F.col("none"), None).when(F.col("removed").isNull(), F.col("text")).otherwise(left).alias("text"),
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    kept = ~F.col("base_failed") & (F.col("n_line_words") <= depleted * F.col("n_words"))
    judged = counted.withColumn("base_failed", failed)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_line_words", kept.alias("kept"), "text")


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    from .common import table

    found = judge(table(spark, sf_dir, "documents"))
    return found.withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256)).drop("text")


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, coalesce(source, '') AS host FROM documents),
w AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
l AS (SELECT r, unnest(string_split(text, chr(10))) AS x, unnest(range(len(string_split(text, chr(10))))) AS pos FROM d),
own AS (SELECT r, pos, x, trim(regexp_replace(lower(x), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n FROM l WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
dup AS (SELECT r, count(*) - count(DISTINCT x) AS n_dup_lines FROM own GROUP BY r),
win AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
twice AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, s) > 1),
rep AS (SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY r),
docs AS (SELECT host, count(DISTINCT doc_id) AS docs FROM d GROUP BY host),
seen AS (SELECT host, norm, count(DISTINCT doc_id) AS n FROM own JOIN d USING (r) GROUP BY host, norm),
bad AS (SELECT host, norm FROM seen JOIN docs USING (host) WHERE n >= 10 AND n >= 0.01 * docs),
gone AS (SELECT r, pos, n FROM own JOIN d USING (r) JOIN bad USING (host, norm)),
lost AS (SELECT r, sum(n) AS n_line_words FROM gone GROUP BY r),
clean AS (SELECT l.r, sha256(coalesce(string_agg(x, chr(10) ORDER BY l.pos) FILTER (gone.r IS NULL), '')) AS text_sha256 FROM l LEFT JOIN gone ON gone.r = l.r AND gone.pos = l.pos GROUP BY l.r),
b AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(n_line_words, 0) AS BIGINT) AS n_line_words, text_sha256
    FROM d JOIN w USING (r) LEFT JOIN dup USING (r) LEFT JOIN rep USING (r) LEFT JOIN lost USING (r) LEFT JOIN clean USING (r)
),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM b)
SELECT *, NOT base_failed AND n_line_words <= 0.7 * n_words AS kept FROM f
"""
