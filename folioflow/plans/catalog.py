"""Named queries over the driver's tables, each with the DuckDB SQL that gives the same rows.

Every query runs over whole tables. Inputs that the tables lack (markers, headings, Markdown tables, noise) are added
to the texts by the query itself, in the same way in both languages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import context as X
from ..functions import nodes as N
from ..functions import text as T
from ..functions import vietnamese as V
from ..operators import audit, chunks, cleaning, exports, fragments, pages, structure, tables, tags
from ..sources import readers
from . import pipelines

QUERIES: dict = {}
SQL: dict[str, str] = {}

#: A dictionary of words that the tables have, for the tagging queries.
WORDS = {"german": ["der", "die", "und"], "french": ["de", "la", "les"], "spanish": ["los", "el", "que"], "english": ["the", "and", "of"], "short": ["ti", "ou", "is"]}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes (doc, idx, section, text, page_start, page_end, source, page): a turn each, on the page turn + 1."""
    c = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    page = (F.col("turn") + 1).cast("int")
    return c.select(F.col("conv_id").alias("doc"), F.col("turn").cast("bigint").alias("idx"), F.col("role").alias("section"), F.coalesce("text", F.lit("")).alias("text"), page.alias("page_start"), page.alias("page_end"), F.concat(F.lit("conv-"), F.col("conv_id").cast("string")).alias("source"), page.alias("page"))


def headed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents (doc, text): the turns of a conversation under `## role turn` headings."""
    part = F.concat(F.lit("## "), "section", F.lit(" "), F.col("idx").cast("string"), F.lit("\n\n"), "text")
    return conversations(spark, sf_dir).groupBy("doc").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", part.alias("p")))), lambda x: x.p), "\n\n").alias("text"))


def digest(docs: DataFrame, key: str, text: Column) -> DataFrame:
    return docs.select(key, text.alias("t")).select(key, F.length("t").cast("bigint").alias("n_chars"), F.md5("t").alias("digest"))


#: DuckDB forms of the text functions.
STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
INVISIBLE = r"regexp_replace(replace({0}, chr(160), ' '), '[^\P{{C}}\n\t\r]|\x{{FFFD}}', '', 'g')"
SQUEEZE = r"regexp_replace({0}, '\n{{3,}}', chr(10) || chr(10), 'g')"
LINES = "array_to_string(list_transform(string_split({0}, chr(10)), lambda l: {1}), chr(10))"
KEEP = "array_to_string(list_filter(string_split({0}, chr(10)), lambda l: {1}), chr(10))"
FLAT = STRIP.format(r"regexp_replace({0}, '\s+', ' ', 'g')")
TOKENS = "greatest(1, length(" + FLAT + ") // 4)"
WORDS_OF = r"list_filter(regexp_split_to_array({0}, '\s+'), lambda w: w <> '')"
DIGEST = "SELECT doc_id, CAST(length(t) AS BIGINT) AS n_chars, md5(t) AS digest FROM ({0})"


def basic(x: str) -> str:
    inner = LINES.format(INVISIBLE.format(x), r"regexp_replace(l, '\s+$', '')")
    return STRIP.format(SQUEEZE.format(inner))


PARAGRAPHS = "list_filter(list_transform(regexp_split_to_array({0}, '\\n\\s*\\n'), lambda p: " + STRIP.format("p") + "), lambda p: p <> '')"


@query(rf"""
WITH p AS (SELECT source, unnest({PARAGRAPHS.format(basic("replace(text, chr(10), chr(10) || chr(10))"))}) AS p FROM documents)
SELECT source, CAST(count(*) AS BIGINT) AS n_paragraphs, CAST(sum({TOKENS.format("p")}) AS BIGINT) AS n_tokens, CAST(max({TOKENS.format("p")}) AS BIGINT) AS max_tokens,
    CAST(sum(length(p)) AS BIGINT) AS n_chars FROM p GROUP BY source
""")
def source_summary(spark, sf_dir):
    docs = documents(spark, sf_dir).select("source", T.clean(F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n"))).alias("text"))
    rows = structure.paragraph_rows(docs, "source")
    return rows.groupBy("source").agg(F.count("*").alias("n_paragraphs"), F.sum("tokens").alias("n_tokens"), F.max("tokens").alias("max_tokens"), F.sum(F.length("paragraph")).alias("n_chars"))


@query(DIGEST.format(f"SELECT doc_id, {basic('text')} AS t FROM documents"))
def clean_basic(spark, sf_dir):
    return digest(documents(spark, sf_dir), "doc_id", T.clean_basic(F.col("text")))


@query(DIGEST.format(r"""SELECT doc_id, regexp_replace(regexp_replace('<!-- PAGE : ' || doc_id || ' -->' || chr(10) || text || '<PARSED TEXT FOR PAGE: 3>' || chr(10) || '<!--page_start--> x<!-- kept -->',
    '(?i)<!--\s*PAGE[^>]*?-->\s*\n?', '', 'g'), '(?i)<PARSED TEXT FOR PAGE:[^>]*>', '', 'g') AS t FROM documents"""))
def strip_page_markers(spark, sf_dir):
    marked = F.concat(F.lit("<!-- PAGE : "), F.col("doc_id").cast("string"), F.lit(" -->\n"), "text", F.lit("<PARSED TEXT FOR PAGE: 3>\n<!--page_start--> x<!-- kept -->"))
    return digest(documents(spark, sf_dir), "doc_id", T.drop_page_markers(marked))


@query(DIGEST.format(r"""SELECT doc_id, regexp_replace(regexp_replace(text || chr(10) || '![a](p/' || doc_id || ' . jpeg) ![b](x.png)' || chr(10) || chr(10) || chr(10) || '![c](x.svg)',
    '(?i)!\[[^\]]*\]\([^)]*\.\s*(?:jpe?g|png|gif|bmp)\s*\)', '', 'g'), '\n{3,}', chr(10) || chr(10), 'g') AS t FROM documents"""))
def strip_image_links(spark, sf_dir):
    text = F.concat("text", F.lit("\n![a](p/"), F.col("doc_id").cast("string"), F.lit(" . jpeg) ![b](x.png)\n\n\n![c](x.svg)"))
    return digest(documents(spark, sf_dir), "doc_id", T.drop_image_links(text))


NOISY = ("kcb_a 3 / 12 / 2020", "x kcb.b 12 : 30 : 01", "[Page 12]", "- 12 -", "Trang 4: x", "====", "_" * 60, "kept")


@query(DIGEST.format(rf"""SELECT doc_id, {KEEP.format("text || chr(10) || '" + "' || chr(10) || '".join(NOISY) + "'", r"NOT regexp_matches(l, '(?i)kcb[_.].*\d{1,2}\s*/\s*\d{1,2}\s*/\s*\d{4}|kcb[_.].*\d{1,2}\s*:\s*\d{2}\s*:\s*\d{2}|^[*\s]*kcb[_.][^\n]{10,}$|<PARSED TEXT|\[Page\s*\d+\]|---Page Break---') AND NOT regexp_matches(trim(l), '^[-—_=~]{50,}$') AND NOT regexp_matches(trim(l), '(?i)^[\d\-–—]+$|^(?:Page|Trang|p\.?|tr\.?)\s*\d+|^[\-_=~]{3,49}$')")} AS t FROM documents"""))
def drop_line_artifacts(spark, sf_dir):
    text = F.concat_ws("\n", "text", *map(F.lit, NOISY))
    return digest(documents(spark, sf_dir), "doc_id", T.drop_page_artifacts(T.drop_long_separators(T.drop_footer_lines(text))))


_TOKENS_OF_LINE = WORDS_OF.format("l")
_MAX = "list_max(list_transform(list_distinct({0}), lambda t: len(list_filter({0}, lambda x: x = t))))"


@query(rf"""
WITH l AS (SELECT doc_id, pos, l, {_TOKENS_OF_LINE} AS w FROM (
    SELECT doc_id, unnest(string_split(t, chr(10))) AS l, unnest(range(len(string_split(t, chr(10))))) AS pos FROM (SELECT doc_id, text || chr(10) || repeat('200 A ', 25) || chr(10) || repeat('ab ', 31) || chr(10) || repeat('x y z ', 5) || chr(10) || repeat('§', 200) || ' a b c d' AS t FROM documents))),
p AS (SELECT *, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) AS b FROM l),
g AS (SELECT *, length(trim(l)) AS n, {_MAX.format("w")} AS most, {_MAX.format("b")} AS most_pairs,
    length(regexp_replace(trim(l), '[a-zA-ZÀ-ỹ0-9\s.,;:!?\-()\[\]{{}}|+=*/#@%&"''`~<>]', '', 'g')) AS odd FROM p)
SELECT doc_id, CAST(count(*) FILTER (len(w) >= 4 AND (coalesce(most, 0) >= 30 OR (len(w) >= 6 AND most_pairs >= 20) OR (len(list_distinct(w)) <= 3 AND len(w) > 10) OR (n > 120 AND odd > 0.4 * n))) AS BIGINT) AS n_gibberish,
    CAST(count(*) AS BIGINT) AS n_lines FROM g GROUP BY doc_id
""")
def gibberish_lines(spark, sf_dir):
    bad = [F.repeat(F.lit("200 A "), 25), F.repeat(F.lit("ab "), 31), F.repeat(F.lit("x y z "), 5), F.concat(F.repeat(F.lit("§"), 200), F.lit(" a b c d"))]
    lines = F.split(F.concat_ws("\n", "text", *bad), "\n")
    return documents(spark, sf_dir).select("doc_id", F.size(F.filter(lines, T.is_gibberish)).cast("bigint").alias("n_gibberish"), F.size(lines).cast("bigint").alias("n_lines"))


@query(r"""
WITH l AS (SELECT doc_id, lower(trim(unnest(string_split(text, chr(10))))) AS norm FROM documents)
SELECT doc_id, md5(norm) AS digest, CAST(count(*) AS BIGINT) AS n FROM l WHERE length(norm) >= 50 GROUP BY doc_id, norm HAVING count(*) >= 2
""")
def repeated_lines(spark, sf_dir):
    found = structure.repeated_lines(documents(spark, sf_dir).select(F.col("doc_id").alias("doc"), "text"))
    return found.select(F.col("doc").alias("doc_id"), F.md5("norm").alias("digest"), "n")


@query(r"""
WITH l AS (SELECT doc_id, x, pos, lower(trim(x)) AS norm FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents)),
r AS (SELECT doc_id, norm FROM l WHERE length(norm) >= 50 GROUP BY ALL HAVING count(*) >= 2)
SELECT l.doc_id, CAST(length(coalesce(string_agg(x, chr(10) ORDER BY pos) FILTER (r.norm IS NULL OR starts_with(trim(x), '#')), '')) AS BIGINT) AS n_chars,
    md5(coalesce(string_agg(x, chr(10) ORDER BY pos) FILTER (r.norm IS NULL OR starts_with(trim(x), '#')), '')) AS digest
FROM l LEFT JOIN r ON l.doc_id = r.doc_id AND l.norm = r.norm GROUP BY l.doc_id
""")
def drop_repeated_lines(spark, sf_dir):
    found = structure.drop_repeated_lines(documents(spark, sf_dir).select(F.col("doc_id").alias("doc"), "text"))
    return digest(found.withColumnRenamed("doc", "doc_id"), "doc_id", F.col("text"))


@query(DIGEST.format(r"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text || ' a ,b . c', '([.!?])\s{2,}', '\1 ', 'g'), '\s+([.!?,;:])', '\1', 'g'),
    '[–—]', '-', 'g'), '\.{3,}', '...', 'g'), '\.+', '.', 'g'), '!+', '!', 'g'), '\?+', '?', 'g') AS t FROM documents"""))
def ocr_punctuation(spark, sf_dir):
    return digest(documents(spark, sf_dir), "doc_id", V.normalise_punctuation(T.fix_ocr_punctuation(F.concat("text", F.lit(" a ,b . c")))))


@query(DIGEST.format(rf"""SELECT doc_id, {STRIP.format(SQUEEZE.format(r"regexp_replace(regexp_replace(regexp_replace(text || ' 2.1  10:30', ' {2,}', ' ', 'g'), '\s+([.,!?;:])', '\1', 'g'), '([.,!?;:])([A-Za-zÀ-ỹ0-9])', '\1 \2', 'g')"))} AS t FROM documents"""))
def spacing(spark, sf_dir):
    return digest(documents(spark, sf_dir), "doc_id", V.normalise_spacing(F.concat("text", F.lit(" 2.1  10:30"))))


MARKDOWN = "\n".join(["# **Title** ", "* one", "2) two", "##  - three", "- + four", "-five", "a<br/>b", "| a<br>b |"])


@query(DIGEST.format(rf"""SELECT doc_id, {LINES.format(rf"'{MARKDOWN}' || chr(10) || text", r"CASE WHEN regexp_matches(l, '^#{1,6}\s*\*{0,2}.+?\*{0,2}\s*$') THEN regexp_extract(l, '^(#{1,6})', 1) || ' ' || trim(regexp_replace(regexp_extract(l, '^#{1,6}\s*\*{0,2}(.+?)\*{0,2}\s*$', 1), '\*{1,2}', '', 'g')) WHEN regexp_matches(l, '^\s*[-*•]\s+') THEN regexp_replace(l, '^(\s*)[-*•]\s+', '\1- ') WHEN regexp_matches(l, '^\s*\d+[.)]\s+') THEN regexp_replace(l, '^(\s*)(\d+)[.)]\s+', '\1\2. ') ELSE l END")} AS t FROM documents"""))
def markdown_structure(spark, sf_dir):
    return digest(documents(spark, sf_dir), "doc_id", T.normalise_markdown(F.concat_ws("\n", F.lit(MARKDOWN), "text")))


@query(DIGEST.format(rf"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(x, '\.\s*- \+\s*', '.' || chr(10) || '  - ', 'g'), '(?m)^(\s*)- \+\s*', '\1  - ', 'g'), '(?m)^(\s*)-([^\s\-])', '\1- \2', 'g') AS t
    FROM (SELECT doc_id, {LINES.format(f"'{MARKDOWN}' || chr(10) || text", "CASE WHEN contains(l, '|') THEN regexp_replace(l, '(?i)<br ?/?>', ' ', 'g') ELSE regexp_replace(l, '(?i)<br ?/?>', chr(10), 'g') END")} AS x FROM documents)"""))
def bullets_and_breaks(spark, sf_dir):
    return digest(documents(spark, sf_dir), "doc_id", V.normalise_bullets(V.replace_breaks(F.concat_ws("\n", F.lit(MARKDOWN), "text"))))


@query(rf"""SELECT doc_id, CAST({TOKENS.format("text")} AS BIGINT) AS estimated, CAST(length(text) // 4 AS BIGINT) AS by_length, CAST(greatest(1, length(text) // 4) AS BIGINT) AS at_least_one, CAST(len({WORDS_OF.format("text")}) AS BIGINT) AS by_words FROM documents""")
def token_estimates(spark, sf_dir):
    t = F.col("text")
    return documents(spark, sf_dir).select("doc_id", T.tokens_estimated(t).alias("estimated"), T.tokens_by_length(t).alias("by_length"), T.tokens_by_length(t, 1).alias("at_least_one"), T.tokens_by_words(t).alias("by_words"))


@query(rf"""
WITH p AS (SELECT doc_id, {PARAGRAPHS.format("replace(text, chr(10), chr(10) || ' ' || chr(10))")} AS ps FROM documents)
SELECT doc_id, CAST(n AS BIGINT) AS n, md5(p) AS digest, CAST({TOKENS.format("p")} AS BIGINT) AS tokens FROM (SELECT doc_id, unnest(ps) AS p, unnest(range(len(ps))) AS n FROM p)
""")
def paragraphs(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", F.replace(F.col("text"), F.lit("\n"), F.lit("\n \n")).alias("text"))
    return structure.paragraph_rows(docs, "doc_id").select("doc_id", F.col("n").cast("bigint").alias("n"), F.md5("paragraph").alias("digest"), "tokens")


@query(rf"""
WITH s AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\s+([A-ZÀ-Ỹa-zà-ỹ0-9"])', '\1' || chr(1) || '\2', 'g'), chr(1)), lambda x: {STRIP.format("x")}), lambda x: x <> '') AS s FROM documents)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_sentences, md5(array_to_string(s, '|')) AS digest FROM s
""")
def sentences(spark, sf_dir):
    found = documents(spark, sf_dir).select("doc_id", T.sentences(F.col("text")).alias("s"))
    return found.select("doc_id", F.size("s").cast("bigint").alias("n_sentences"), F.md5(F.array_join("s", "|")).alias("digest"))


_HEADED = "SELECT conv_id AS doc, string_agg('## ' || role || ' ' || turn || chr(10) || chr(10) || coalesce(text, ''), chr(10) || chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id"


@query(rf"""
WITH l AS (SELECT doc, l, pos, regexp_matches(l, '^#{{1,6}}\s+.+') AS head FROM (SELECT doc, unnest(string_split(text, chr(10))) AS l, unnest(range(len(string_split(text, chr(10))))) AS pos FROM ({_HEADED}))),
s AS (SELECT *, sum(CASE WHEN head THEN 1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY pos) AS section FROM l),
g AS (SELECT doc, section, max(CASE WHEN head THEN l END) AS head, {STRIP.format("coalesce(string_agg(CASE WHEN NOT head THEN l END, chr(10) ORDER BY pos), '')")} AS text FROM s GROUP BY doc, section)
SELECT doc, CAST(section AS BIGINT) AS section, CAST(coalesce(length(regexp_extract(head, '^(#+)', 1)), 0) AS INTEGER) AS level, coalesce(regexp_extract(head, '^#{{1,6}}\s+(.+?)\s*$', 1), '') AS title, md5(text) AS digest
FROM g WHERE text <> ''
""")
def sections(spark, sf_dir):
    return structure.sections(headed(spark, sf_dir)).select("doc", "section", "level", "title", F.md5("text").alias("digest"))


@query(rf"""
WITH l AS (SELECT doc, l, trim(l) AS own, coalesce(sum(length(l) + 1) OVER (PARTITION BY doc ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS char_pos
    FROM (SELECT doc, unnest(string_split(text, chr(10))) AS l, unnest(range(len(string_split(text, chr(10))))) AS pos FROM ({_HEADED})))
SELECT doc, CAST(char_pos AS BIGINT) AS char_pos, CASE WHEN regexp_matches(own, '^#{{1,6}}\s+.+$') THEN regexp_extract(own, '^#{{1,6}}\s+(.+?)\s*$', 1) ELSE regexp_extract(own, '^(\d+(?:\.\d+)*\.?)\s+(.+)$', 1) || ' ' || regexp_extract(own, '^(\d+(?:\.\d+)*\.?)\s+(.+)$', 2) END AS title,
    CAST(CASE WHEN regexp_matches(own, '^#{{1,6}}\s+.+$') THEN length(regexp_extract(own, '^(#+)', 1)) ELSE len(string_split(regexp_extract(own, '^(\d+(?:\.\d+)*\.?)\s', 1), '.')) END AS INTEGER) AS level
FROM l WHERE regexp_matches(own, '^#{{1,6}}\s+.+$') OR regexp_matches(own, '^\d+(?:\.\d+)*\.?\s+.+$')
""")
def boundaries(spark, sf_dir):
    return structure.boundaries(headed(spark, sf_dir))


def nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents (doc, text): the turns of a conversation under headings of three levels and numbered lines."""
    k = F.col("idx")
    head = F.concat(F.repeat(F.lit("#"), (k % 3 + F.when(k % 5 == 4, 2).otherwise(1)).cast("int")), F.lit(" "), "section", F.lit(" of a rather long title, number "), k.cast("string"))
    part = F.concat(head, F.lit("\n"), (k + 1).cast("string"), F.lit(".2) item\nIV. item\nB item\n"), "text")
    return conversations(spark, sf_dir).groupBy("doc").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", part.alias("p")))), lambda x: x.p), "\n").alias("text"))


@query(r"""
WITH RECURSIVE d AS (SELECT conv_id AS doc, string_agg(repeat('#', CAST(turn % 3 + CASE WHEN turn % 5 = 4 THEN 2 ELSE 1 END AS INTEGER)) || ' ' || role || ' of a rather long title, number ' || turn || chr(10) || (turn + 1) || '.2) item' || chr(10) || 'IV. item' || chr(10) || 'B item' || chr(10) || coalesce(text, ''), chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id),
l AS (SELECT doc, unnest(string_split(text, chr(10))) AS l, unnest(range(len(string_split(text, chr(10))))) AS pos FROM d),
m AS (SELECT doc, pos, row_number() OVER (PARTITION BY doc ORDER BY pos) AS k, length(regexp_extract(l, '^(#{1,6})\s+.+', 1)) AS level,
        CASE WHEN regexp_matches(l, '^#{1,6}\s+.+') THEN left(regexp_extract(l, '^#{1,6}\s+(.+?)\s*$', 1), 40) ELSE regexp_extract(l, '^((?:\d+\.)*\d+|[IVX]+|[A-Z])[.)]\s+.+', 1) END AS name
    FROM l WHERE regexp_matches(l, '^#{1,6}\s+.+') OR regexp_matches(l, '^((?:\d+\.)*\d+|[IVX]+|[A-Z])[.)]\s+.+')),
p AS (
    SELECT doc, k, pos, [name] AS path, level AS last FROM m WHERE k = 1
    UNION ALL
    SELECT m.doc, m.k, m.pos, list_append(CASE WHEN m.level > 0 AND m.level <= p.last THEN p.path[1:m.level - 1] ELSE p.path END, m.name), CASE WHEN m.level > 0 THEN m.level ELSE p.last END
    FROM p JOIN m ON m.doc = p.doc AND m.k = p.k + 1
)
SELECT l.doc, CAST(l.pos AS INTEGER) AS pos, coalesce(array_to_string(p.path, ' > '), 'Document') AS path FROM l ASOF LEFT JOIN p ON l.doc = p.doc AND l.pos > p.pos
""")
def section_paths(spark, sf_dir):
    return structure.section_paths(nested(spark, sf_dir))


def _spaced(spark, sf_dir) -> DataFrame:
    return documents(spark, sf_dir).select(F.col("doc_id").alias("doc"), F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n")).alias("text"))


@query()
def chunk_nodes(spark, sf_dir):
    return chunks.chunk(_spaced(spark, sf_dir)).select("doc", "idx", "tokens", "has_table", F.md5("text").alias("digest"))


@query()
def chunk_stats(spark, sf_dir):
    return chunks.chunk_stats(chunks.chunk(_spaced(spark, sf_dir)))


def _grouped(spark, sf_dir) -> DataFrame:
    """Tool nodes (source, page, id, text): the turns of a tenth of the conversations make a source."""
    c = conversations(spark, sf_dir)
    return c.select(F.concat(F.lit("group-"), (F.col("doc") % 10).cast("string")).alias("source"), "page", F.concat_ws("-", F.col("doc").cast("string"), F.col("idx").cast("string")).alias("id"), "text")


@query()
def rechunk_structure(spark, sf_dir):
    return chunks.rechunk(_grouped(spark, sf_dir), 2000, 500).select("source", "n", "id", "page_start", "page_end", "chars", F.md5("text").alias("digest"))


@query()
def rechunk_lines(spark, sf_dir):
    found = chunks.rechunk_lines(_grouped(spark, sf_dir), 2000)
    return found.withColumn("digest", F.md5("text")).drop("text")


@query()
def rechunk_summary(spark, sf_dir):
    return chunks.rechunk_summary(chunks.rechunk_lines(_grouped(spark, sf_dir), 2000))


@query(r"""
WITH p AS (SELECT conv_id AS doc, turn, length('<!--PAGE:' || (turn + 1) || '-->') + 1 AS head, length(coalesce(text, '')) AS n,
    coalesce(sum(length('<!--PAGE:' || (turn + 1) || '-->') + 1 + length(coalesce(text, '')) + 1) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) IS NULL AS last FROM conversations)
SELECT doc, CAST(turn AS BIGINT) AS idx, CAST(before + head AS BIGINT) AS start, CAST(before + head + n + CASE WHEN last THEN 0 ELSE 1 END AS BIGINT) AS stop, CAST(turn + 1 AS INTEGER) AS page FROM p
""")
def page_ranges(spark, sf_dir):
    return _paged(spark, sf_dir).select("doc", F.posexplode(pages.page_ranges(F.col("text"))).alias("idx", "r")).select("doc", F.col("idx").cast("bigint").alias("idx"), F.col("r.start").cast("bigint").alias("start"), F.col("r.end").cast("bigint").alias("stop"), "r.page")


@query(r"""
WITH m AS (SELECT conv_id AS doc, turn * 100 AS pos, CAST(turn + 1 AS INTEGER) AS page FROM conversations WHERE turn % 2 = 0),
q AS (SELECT conv_id AS doc, turn AS id, turn * 100 + 50 AS pos FROM conversations)
SELECT q.doc, CAST(id AS BIGINT) AS id, CAST(q.pos AS BIGINT) AS pos, coalesce(page, 1) AS page FROM q ASOF LEFT JOIN m ON q.doc = m.doc AND q.pos >= m.pos
""")
def page_lookup(spark, sf_dir):
    c = conversations(spark, sf_dir)
    markers = c.where("idx % 2 = 0").select("doc", (F.col("idx") * 100).alias("pos"), "page")
    return pages.page_by_line(markers, c.select("doc", F.col("idx").alias("id"), (F.col("idx") * 100 + 50).alias("pos")))


_FLAT_TURN = FLAT.format("coalesce(text, '')")


@query(rf"""
WITH t AS (SELECT conv_id AS doc, turn, {_FLAT_TURN} AS own FROM conversations),
s AS (SELECT *, coalesce(sum(length(own) + 1) OVER (PARTITION BY doc ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM t),
f AS (SELECT doc, string_agg(own, ' ' ORDER BY turn) AS flat FROM t GROUP BY doc),
a AS (SELECT t.doc, turn, own, CASE WHEN own = '' THEN -1 ELSE coalesce({", ".join(f"nullif(instr(flat, left(own, {n})), 0)" for n in pages.PREFIXES)}, 0) - 1 END AS found FROM t JOIN f USING (doc)),
b AS (SELECT a.*, s.turn + 1 AS page_start FROM a ASOF LEFT JOIN s ON s.doc = a.doc AND s.start <= a.found),
e AS (SELECT b.*, greatest(found, found + length(own) - 1) AS stop FROM b)
SELECT e.doc, CAST(e.turn AS BIGINT) AS id, CAST(found AS INTEGER) AS source_char_pos, CAST(CASE WHEN found >= 0 THEN page_start END AS INTEGER) AS page_start, CAST(CASE WHEN found >= 0 THEN s.turn + 1 END AS INTEGER) AS page_end
FROM e ASOF LEFT JOIN s ON s.doc = e.doc AND s.start <= e.stop
""")
def assign_pages(spark, sf_dir):
    return pages.assign_pages(conversations(spark, sf_dir).select("doc", F.col("idx").alias("id"), "text"), _paged(spark, sf_dir)).drop("text")


def _paged(spark, sf_dir) -> DataFrame:
    """(doc, text): the turns of a conversation, each on a page of its own."""
    part = F.concat(F.lit("<!--PAGE:"), F.col("page").cast("string"), F.lit("-->\n"), "text")
    return conversations(spark, sf_dir).groupBy("doc").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", part.alias("p")))), lambda x: x.p), "\n").alias("text"))


@query(r"""
WITH c AS (SELECT source AS doc, doc_id AS idx, length(text) AS n FROM documents),
s AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY doc ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + n / 2 AS center, greatest(sum(n) OVER (PARTITION BY doc), 1) AS total FROM c)
SELECT doc, idx, CAST(least(greatest(floor(center / total * 10) + 1, 1), 10) AS INTEGER) AS page FROM s
""")
def page_estimate(spark, sf_dir):
    docs = documents(spark, sf_dir).select(F.col("source").alias("doc"), F.col("doc_id").alias("idx"), "text")
    return pages.estimate_pages(docs, F.lit(10)).drop("text")


@query(r"""
WITH t AS (SELECT max(page_id) + 1 AS total FROM pages), p AS (SELECT page_id, total, CASE WHEN total <= 40 THEN total ELSE ceil(total / ceil(total / 40)) END AS size FROM pages, t)
SELECT page_id, CAST(size AS BIGINT) AS pages, CAST(floor(page_id / size) + 1 AS BIGINT) AS part, CAST(least(page_id % CAST(size AS BIGINT) + 1 + floor(page_id / size) * size, total) AS BIGINT) AS page FROM p
""")
def split_parts(spark, sf_dir):
    p = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id")
    total = p.agg((F.max("page_id") + 1).alias("total"))
    q = p.join(F.broadcast(total)).withColumn("pages", X.optimal_part_pages(F.col("total"), 40))  # one row
    q = q.withColumn("part", X.part_of(F.col("page_id") + 1, F.col("pages")))
    return q.select("page_id", "pages", "part", X.page_in_document(F.col("page_id") % F.col("pages") + 1, F.col("part"), F.col("pages"), F.col("total")).alias("page"))


_SET = r"list_sort(list_distinct(list_filter(regexp_split_to_array(regexp_replace(trim(regexp_replace(lower(text), '\s+', ' ', 'g')), '[^\p{L}\p{M}\p{N}_\s]', '', 'g'), '\s+'), lambda w: w <> '')))"


@query(rf"""
WITH s AS (SELECT lang AS doc, min(doc_id) AS idx, w, len(w) AS n FROM (SELECT lang, doc_id, {_SET} AS w FROM documents) WHERE len(w) > 0 GROUP BY lang, w),
t AS (SELECT doc, idx, n, unnest(w) AS t FROM s), c AS (SELECT t, count(*) AS c FROM t GROUP BY t),
p AS (SELECT doc, idx, n, t FROM (SELECT *, row_number() OVER (PARTITION BY doc, idx ORDER BY c, t) AS k FROM t JOIN c USING (t)) WHERE k <= n - ceil(0.8 * n - 1e-9) + 1),
ab AS (SELECT DISTINCT a.doc, a.idx AS a, b.idx AS b FROM p a JOIN p b ON a.doc = b.doc AND a.t = b.t AND a.idx < b.idx AND a.n >= 0.8 * b.n - 1e-9 AND b.n >= 0.8 * a.n - 1e-9),
v AS (SELECT ab.*, len(list_intersect(x.w, y.w)) / len(list_distinct(list_concat(x.w, y.w))) AS similarity FROM ab JOIN s x ON x.doc = ab.doc AND x.idx = a JOIN s y ON y.doc = ab.doc AND y.idx = b)
SELECT doc, a, b, round(similarity, 3) AS similarity FROM v WHERE similarity >= 0.8
""")
def dup_pairs(spark, sf_dir):
    return audit.duplicate_pairs(documents(spark, sf_dir).select(F.col("lang").alias("doc"), F.col("doc_id").alias("idx"), "text"))


@query(rf"""SELECT lang AS doc, doc_id AS idx, min(doc_id) OVER (PARTITION BY lang, {_SET}) AS class FROM documents""")
def dup_classes(spark, sf_dir):
    return audit.duplicate_classes(documents(spark, sf_dir).select(F.col("lang").alias("doc"), F.col("doc_id").alias("idx"), "text"))


_SETS = rf"""
s AS (SELECT source AS doc, doc_id AS idx, length(text) AS size, {_SET} AS w FROM documents),
cls AS (SELECT doc, w, min(idx) AS class, len(w) AS n FROM s GROUP BY doc, w),
tok AS (SELECT doc, class, n, unnest(w) AS t FROM cls), df AS (SELECT t, count(*) AS c FROM tok GROUP BY t),
pre AS (SELECT doc, class, n, t FROM (SELECT *, row_number() OVER (PARTITION BY doc, class ORDER BY c, t) AS k FROM tok JOIN df USING (t)) WHERE k <= n - ceil(0.85 * n - 1e-9) + 1),
ab AS (SELECT DISTINCT a.doc, a.class AS a, b.class AS b FROM pre a JOIN pre b ON a.doc = b.doc AND a.t = b.t AND a.class < b.class AND a.n >= 0.85 * b.n - 1e-9 AND b.n >= 0.85 * a.n - 1e-9),
cc AS (SELECT ab.* FROM ab JOIN cls x ON x.doc = ab.doc AND x.class = a JOIN cls y ON y.doc = ab.doc AND y.class = b WHERE len(list_intersect(x.w, y.w)) / len(list_distinct(list_concat(x.w, y.w))) >= 0.85),
own AS (SELECT s.doc, s.idx, size, class FROM s JOIN cls ON cls.doc = s.doc AND cls.w = s.w),
like_ AS (SELECT a AS one, b AS two, doc FROM cc UNION ALL SELECT b, a, doc FROM cc UNION ALL SELECT class, class, doc FROM cls)
"""


@query(rf"""
WITH RECURSIVE {_SETS},
near AS (SELECT x.doc, x.idx, list(y.idx) AS nb FROM own x JOIN like_ l ON l.doc = x.doc AND l.one = x.class JOIN own y ON y.doc = x.doc AND y.class = l.two AND y.idx < x.idx GROUP BY x.doc, x.idx),
r AS (SELECT own.doc, own.idx, size, coalesce(nb, CAST([] AS BIGINT[])) AS nb, row_number() OVER (PARTITION BY own.doc ORDER BY own.idx) AS k FROM own LEFT JOIN near ON near.doc = own.doc AND near.idx = own.idx),
g AS (
    SELECT doc, k, [{{'idx': idx, 'size': size}}] AS kept FROM r WHERE k = 1
    UNION ALL
    SELECT r.doc, r.k, CASE WHEN h IS NULL THEN list_append(g.kept, {{'idx': r.idx, 'size': r.size}})
        WHEN r.size <= list_filter(g.kept, lambda x: x.idx = h)[1].size THEN g.kept
        ELSE list_append(list_filter(g.kept, lambda x: x.idx <> h), {{'idx': r.idx, 'size': r.size}}) END
    FROM g JOIN (SELECT *, k - 1 AS before FROM r) r ON r.doc = g.doc AND r.before = g.k, LATERAL (SELECT list_min(list_filter(list_transform(g.kept, lambda x: x.idx), lambda x: list_contains(r.nb, x))) AS h) t
),
last AS (SELECT doc, arg_max(kept, k) AS kept FROM g GROUP BY doc)
SELECT doc, unnest(list_transform(kept, lambda x: x.idx)) AS idx FROM last
""")
def dedup_greedy(spark, sf_dir):
    docs = documents(spark, sf_dir).select(F.col("source").alias("doc"), F.col("doc_id").alias("idx"), "text")
    return audit.drop_duplicates(docs).select("doc", "idx")


@query(rf"""
WITH {_SETS.replace("RECURSIVE", "")},
n AS (SELECT doc, class, count(*) AS n FROM own GROUP BY doc, class),
p AS (SELECT doc, n * (n - 1) / 2 AS c FROM n UNION ALL SELECT cc.doc, x.n * y.n FROM cc JOIN n x ON x.doc = cc.doc AND x.class = a JOIN n y ON y.doc = cc.doc AND y.class = b)
SELECT doc, CAST(sum(c) AS BIGINT) AS duplicate_pairs FROM p GROUP BY doc
""")
def audit_stats(spark, sf_dir):
    docs = documents(spark, sf_dir).select(F.col("source").alias("doc"), F.col("doc_id").alias("idx"), F.lit("").alias("section"), "text", F.lit(None).cast("int").alias("page_start"), F.lit(None).cast("int").alias("page_end"))
    return audit.audit_stats(docs).select("doc", "duplicate_pairs")


@query(r"""
WITH RECURSIVE c AS (SELECT conv_id AS doc, turn AS idx, role AS section, coalesce(text, '') AS text, turn + 1 AS page, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations),
m AS (SELECT doc, greatest(10, least(150, floor(avg(greatest(1, length(text) // 4)) * 0.5))) AS least FROM c GROUP BY doc),
a AS (
    SELECT doc, k, 1 AS g, section, length(text) AS n FROM c WHERE k = 1
    UNION ALL
    SELECT c.doc, c.k, CASE WHEN same THEN a.g ELSE a.g + 1 END, c.section, CASE WHEN same THEN a.n + 2 + length(c.text) ELSE length(c.text) END
    FROM a JOIN c ON c.doc = a.doc AND c.k = a.k + 1 JOIN m ON m.doc = c.doc, LATERAL (SELECT c.section = a.section AND greatest(1, a.n // 4) < least AS same) t
),
b AS (SELECT c.doc, g, min(c.section) AS section, string_agg(text, chr(10) || chr(10) ORDER BY c.k) AS text, list(idx ORDER BY c.k) AS merged, min(page) AS p, max(page) AS q FROM c JOIN a USING (doc, k) GROUP BY c.doc, g),
v AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY g) AS k FROM b WHERE trim(text, ' ' || chr(9) || chr(10) || chr(13)) <> ''),
w AS (
    SELECT v.doc, k, 1 AS h, greatest(1, length(text) // 4) < least AS open FROM v JOIN m USING (doc) WHERE k = 1
    UNION ALL
    SELECT v.doc, v.k, CASE WHEN w.open THEN w.h ELSE w.h + 1 END, NOT w.open AND greatest(1, length(v.text) // 4) < least FROM w JOIN v ON v.doc = w.doc AND v.k = w.k + 1 JOIN m ON m.doc = v.doc
)
SELECT v.doc, CAST(h - 1 AS BIGINT) AS idx, v.doc || '_node_' || printf('%04d', h - 1) AS id, arg_min(section, v.k) AS section, CAST(min(p) AS INTEGER) AS page_start, CAST(max(q) AS INTEGER) AS page_end,
    array_to_string(flatten(list(merged ORDER BY v.k)), ',') AS merged, md5(string_agg(text, chr(10) || chr(10) ORDER BY v.k)) AS digest
FROM v JOIN w USING (doc, k) GROUP BY v.doc, h
""")
def merge_short(spark, sf_dir):
    return audit.merge_short(conversations(spark, sf_dir)).select("doc", "idx", "id", "section", "page_start", "page_end", F.array_join("merged", ",").alias("merged"), F.md5("text").alias("digest"))


@query(rf"""SELECT conv_id AS doc, CAST(greatest(10, least(150, floor(avg(greatest(1, length(coalesce(text, '')) // 4)) * 0.5))) AS BIGINT) AS least FROM conversations GROUP BY conv_id""")
def adaptive_minimum(spark, sf_dir):
    return audit.document_minimum(conversations(spark, sf_dir))


NOISE = "![x](a.png) ![y](b)\nkcb_1 x 3 / 12 z\n" + "q " * 16 + "\n| a | b |\n| c | d |\n|e|\n[TABLE_REMOVED: Liều dùng]\n[TABLE_REMOVED: x]"


@query(rf"""
WITH n AS (SELECT doc_id, text || chr(10) || '{NOISE}' AS t FROM documents),
l AS (SELECT doc_id, t, list_transform(string_split(t, chr(10)), lambda l: {WORDS_OF.format("l")}) AS w FROM n)
SELECT doc_id, CAST(len(regexp_extract_all(t, '!\[[^\]]*\]\([^)]+\)')) AS BIGINT) AS image_links, CAST(len(regexp_extract_all(t, '(?i)kcb[_.][^\n]+\d{{1,2}}\s*[:/]\s*\d{{1,2}}')) AS BIGINT) AS footer_patterns,
    CAST(len(list_filter(w, lambda x: len(x) >= 4 AND list_max(list_transform(list_distinct(x), lambda y: len(list_filter(x, lambda z: z = y)))) >= 15)) AS BIGINT) AS gibberish_lines,
    CAST(len(list_filter(string_split(t, chr(10)), lambda l: length(l) - length(replace(l, '|', '')) >= 2)) AS BIGINT) AS table_lines,
    len(list_filter(string_split(t, chr(10)), lambda l: length(l) - length(replace(l, '|', '')) >= 2)) >= 3 AS table_not_removed, CAST(1 AS BIGINT) AS risky_tables
FROM l
""")
def noise_flags(spark, sf_dir):
    docs = documents(spark, sf_dir).select(F.col("doc_id").alias("doc"), F.lit(0).alias("idx"), F.concat_ws("\n", "text", F.lit(NOISE)).alias("text"))
    return audit.flags(docs).drop("idx", "risky").withColumnRenamed("doc", "doc_id")


PHRASES = "Căn cứ Nơi nhận Kính gửi"
TOC = "\n".join(f"Mục {i} ........ {i}" for i in range(1, 6))


@query(rf"""
WITH t AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN text || chr(10) || '{PHRASES}' WHEN 1 THEN '{TOC}' || chr(10) || left(text, 5) WHEN 2 THEN 'GS. A' || chr(10) || 'TS. B' || chr(10) || 'ThS. C' || chr(10) || left(text, 5) ELSE text END AS t FROM documents),
l AS (SELECT *, list_filter(string_split(t, chr(10)), lambda l: trim(l) <> '') AS ls FROM t),
n AS (SELECT *, len(list_filter(ls, lambda l: regexp_matches(l, '\.{{3,}}'))) AS dots, length(t) - length(replace(t, '|', '')) AS pipes, len(list_filter(ls, lambda l: regexp_matches(l, '\.{{3,}}\s*\d+\s*$'))) AS refs,
    len(list_filter(ls, lambda l: {" OR ".join(f"contains(l, '{x}')" for x in N.TITLES)})) AS titled FROM l)
SELECT doc_id, {" + ".join(f"CAST(contains(lower(t), '{x.lower()}') AS INTEGER)" for x in N.ADMINISTRATIVE)} >= 3 AS is_administrative, len(string_split(t, chr(10))) >= 3 AND titled > 0.5 * greatest(len(ls), 1) AS is_name_list,
    len(ls) > 0 AND dots > 2 AND dots + pipes > 0.3 * len(ls) AS is_toc, contains(upper(t), 'MỤC LỤC') OR (dots > 3 AND refs > 0.3 * greatest(len(ls), 1)) AS is_toc_document
FROM n
""")
def node_flags(spark, sf_dir):
    k, t = F.col("doc_id") % 4, F.col("text")
    # as often as the shares of dotted and of titled lines ask for, so that whole texts can follow
    often = lambda head, lines: F.repeat(F.lit(head + "\n"), (F.size(F.split(F.coalesce(t, F.lit("")), "\n")) / lines).cast("int") + 1)
    names = "GS. A\nTS. B\nThS. C"
    text = F.when(k == 0, F.concat_ws("\n", t, F.lit(PHRASES))).when(k == 1, F.concat(often(TOC, 10), F.coalesce(t, F.lit("")))).when(k == 2, F.concat(often(names, 2), F.coalesce(t, F.lit("")))).otherwise(t)
    found = documents(spark, sf_dir).select("doc_id", text.alias("text"))
    t = F.col("text")
    return found.select("doc_id", N.is_administrative(t).alias("is_administrative"), N.is_name_list(t).alias("is_name_list"), N.is_contents(t).alias("is_toc"), N.is_contents_document(t).alias("is_toc_document"))


_COUNTS = ", ".join(f"{{'score': {' + '.join(f'''len(list_filter(w, lambda x: x = '{k}'))''' for k in keys)}, 'ord': {i}, 'label': '{label}'}}" for i, (label, keys) in enumerate(WORDS.items()))
_SCORES = rf"""
WITH w AS (SELECT doc_id, regexp_split_to_array(lower(text), '[^\p{{L}}\p{{M}}\p{{N}}_]+') AS w FROM documents),
s AS (SELECT doc_id, unnest([{_COUNTS}]) AS s FROM w),
r AS (SELECT doc_id, s.label AS label, s.score AS score, s.ord AS ord, row_number() OVER (PARTITION BY doc_id ORDER BY s.score DESC, s.ord) - 1 AS rank FROM s)
"""


@query(_SCORES + "SELECT doc_id, label, CAST(score AS BIGINT) AS score, CAST(rank AS INTEGER) AS rank FROM r WHERE score >= 1")
def tag_scores(spark, sf_dir):
    found = documents(spark, sf_dir).select("doc_id", F.explode(tags.scores(F.col("text"), WORDS)).alias("s"))
    return found.select("doc_id", "s.label", "s.score", "s.rank")


@query(_SCORES + "SELECT doc_id, coalesce(max(CASE WHEN rank = 0 AND score >= 1 THEN label END), 'Khác') AS domain FROM r GROUP BY doc_id")
def primary_domain(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", tags.primary_domain(F.col("text"), WORDS).alias("domain"))


@query(_SCORES + """, p AS (SELECT doc_id, label, 10 - least(rank, 9) AS p, rank AS o FROM r WHERE score >= 2 UNION ALL SELECT doc_id, 'english', 5, 1000 FROM documents WHERE lang = 'en' UNION ALL SELECT doc_id, 'short', 3, 2000 FROM documents WHERE source = 'src1'),
t AS (SELECT doc_id, label, sum(p) AS p, min(o) AS o FROM p GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY p DESC, o) AS k FROM t)
SELECT d.doc_id, coalesce(string_agg(label, ',' ORDER BY k) FILTER (k <= 3), '') AS tags FROM documents d LEFT JOIN k ON k.doc_id = d.doc_id GROUP BY d.doc_id""")
def top_tags(spark, sf_dir):
    section, source = F.when(F.col("lang") == "en", F.lit("of the")).otherwise(F.lit("")), F.when(F.col("source") == "src1", F.lit("ti")).otherwise(F.lit(""))
    return documents(spark, sf_dir).select("doc_id", F.array_join(tags.top_tags(F.col("text"), section, source, WORDS, 3), ",").alias("tags"))


@query(r"""SELECT DISTINCT source || '_part_0' || (doc_id % 3) || CASE WHEN doc_id % 2 = 0 THEN '.pdf' ELSE '' END AS name, source || '.pdf' AS source, regexp_replace(source || '_part_0' || (doc_id % 3), '[^\w\-]', '_', 'g') AS doc FROM documents""")
def source_names(spark, sf_dir):
    name = F.concat("source", F.lit("_part_0"), (F.col("doc_id") % 3).cast("string"), F.when(F.col("doc_id") % 2 == 0, F.lit(".pdf")).otherwise(F.lit("")))
    return documents(spark, sf_dir).select(name.alias("name")).distinct().select("name", X.source_name(F.col("name")).alias("source"), X.document_id(F.col("name")).alias("doc"))


_BODY = basic("text")
@query(rf"""
WITH b AS (SELECT doc_id, source || '.pdf' AS source, CAST(doc_id % 7 AS INTEGER) AS page, {_BODY} AS body FROM documents),
f AS (SELECT *, {STRIP.format(r"regexp_replace(" + FLAT.format("body") + r", '^(?:[#*\-•]+|\d+[.)\s])+\s*', '')")} AS flat, 'Trích đoạn từ ' || source || ': ' AS prefix FROM b),
s AS (SELECT *, string_split(regexp_replace(flat, '[.;!?]\s', chr(1), 'g'), chr(1)) AS parts, 200 - length(prefix) AS room FROM f),
i AS (SELECT *, CASE WHEN length(trim(parts[1])) < 10 AND len(parts) > 1 THEN trim(parts[1]) || '. ' || trim(parts[2]) ELSE trim(parts[1]) END AS idea FROM s),
c AS (SELECT *, left(idea, room - 3) AS short, length(left(idea, room - 3)) - instr(reverse(left(idea, room - 3)), ' ') AS blank FROM i),
h AS (SELECT *, CASE WHEN flat = '' THEN 'Trích đoạn từ ' || source WHEN length(idea) <= room THEN prefix || idea
    ELSE prefix || regexp_replace(CASE WHEN contains(short, ' ') AND blank > (room - 3) // 2 THEN left(short, blank) ELSE short END, '[ ,;:\-]+$', '') || '...' END AS head FROM c)
SELECT doc_id, source, greatest(page, 1) AS page, head, md5('[Ngữ cảnh: ' || head || ']' || CASE WHEN body = '' THEN '' ELSE chr(10) || chr(10) || body END) AS digest FROM h
""")
def standard_export(spark, sf_dir):
    d = documents(spark, sf_dir).select("doc_id", F.concat("source", F.lit("-part-"), (F.col("doc_id") % 3).cast("string"), F.lit(".pdf")).alias("source"), (F.col("doc_id") % 7).cast("int").alias("page"), F.concat(F.lit("[Ngữ cảnh: old]\n"), "text").alias("text"))
    source = X.source_name(F.col("source"))
    page = F.coalesce(X.page_of(F.col("page"), F.lit(None).cast("int"), F.lit(None).cast("int")), F.lit(1))
    found = d.select("doc_id", source.alias("source"), page.alias("page"), X.with_context(source, F.col("text")).alias("t"))
    return found.select("doc_id", "source", "page", F.regexp_extract("t", r"^\[Ngữ cảnh: ([^\n]*)\]", 1).alias("head"), F.md5("t").alias("digest"))


def _table_text(spark, sf_dir) -> DataFrame:
    """(doc, text): an order's items as a Markdown table with a wrong separator and rows that go on in the next line."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    row = F.concat_ws("", F.lit("|"), F.col("l_linenumber").cast("string"), F.lit("|"), "l_returnflag", F.lit("|$x$"), F.col("l_quantity").cast("bigint").cast("string"), F.lit("|"), F.when(F.col("l_linenumber") % 2 == 0, F.lit("\n|more|")))
    body = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", F.col("l_partkey").alias("k"), row.alias("r")))), lambda x: x.r)
    return li.groupBy(F.col("l_orderkey").alias("doc")).agg(F.concat(F.lit("Table 1\n|no|flag|quantity|\n|-|\n"), F.array_join(body, "\n"), F.lit("\n\nend\n")).alias("text"))


@query(r"""
WITH r AS (SELECT l_orderkey AS doc, '|' || l_linenumber || '|' || l_returnflag || '|' || CAST(l_quantity AS BIGINT) || CASE WHEN l_linenumber % 2 = 0 THEN ' more' ELSE '' END || '|' AS r, l_linenumber AS k, l_partkey AS p, l_linenumber % 2 = 0 AS two FROM lineitem),
t AS (SELECT doc, string_agg(CASE WHEN two THEN '|' || k || '|' || split_part(r, '|', 3) || '|' || split_part(r, '|', 4) || '|' ELSE replace(r, '|$x$', '|') END, chr(10) ORDER BY k, p, r) AS body FROM r GROUP BY doc)
SELECT doc, md5('Table 1' || chr(10) || '|no|flag|quantity|' || chr(10) || '|---|---|---|' || chr(10) || body || chr(10) || chr(10) || 'end' || chr(10)) AS digest FROM t
""")
def table_repair(spark, sf_dir):
    return tables.repair_tables(_table_text(spark, sf_dir)).select("doc", F.md5("text").alias("digest"))


@query(r"""
WITH t AS (SELECT l_orderkey AS doc, count(*) + 2 + count(*) FILTER (l_linenumber % 2 = 0) AS n FROM lineitem GROUP BY l_orderkey)
SELECT doc, md5('Table 1' || chr(10) || '[TABLE_REMOVED: Table 1]' || chr(10) || chr(10) || 'end' || chr(10)) AS digest, CAST(1 AS INTEGER) AS n_tables, 'Table 1' AS caption, CAST(1 AS INTEGER) AS line_start, CAST(n AS INTEGER) AS line_end FROM t
""")
def table_extraction(spark, sf_dir):
    t = tables.extract_tables(_table_text(spark, sf_dir))
    first = F.get("tables", 0)
    return t.select("doc", F.md5("text").alias("digest"), F.size("tables").alias("n_tables"), first.caption.alias("caption"), first.line_start.alias("line_start"), first.line_end.alias("line_end"))


#: Noise of nodes: two images, a footer of every kind, a long line, a repetitive one, headings, bullets, breaks and a table.
NODE_NOISE = (
    "![x](a.png) ![ ](b)", "# H", "##  - three", "- + four", "a<br/>b", "x [Page 12] y", "---Page Break---", "q " * 30, "-" * 60, "*.kcb_x_1/2/2020 10:11:12",
    "| a | b |", "|-|", "| $x$ 1 | 2 |", "| more |", "|3|4|5|", "end",
)
_NODE_TEXT = "'" + "' || chr(10) || '".join(NODE_NOISE) + "'"
_FOOT = "|".join(f"(?:{p})" for p in cleaning.NODE_FOOTERS)
_SOME = rf"regexp_matches(l, '(?i){_FOOT}')"
_LONG = r"regexp_matches(trim(l), '^[-—]{{50,}}$')".replace("{{", "{").replace("}}", "}")
_REPEATS = f"(length(trim(l)) > 10 AND len({WORDS_OF.format('l')}) > 20 AND len(list_distinct({WORDS_OF.format('l')})) < 0.1 * len({WORDS_OF.format('l')}))"
_IMAGES = r"regexp_replace(regexp_replace({0}, '!\[\s*\]\([^)]*\)', '', 'g'), '!\[([^\]]*)\]\([^)]*\)', '[IMG: \1]', 'g')"
_BULLETS = r"regexp_replace(regexp_replace(l, '^(\s*)- \+', '\1- '), '^(#+)\s+-\s*(\S.*?)\s*$', '\1 ' || chr(10) || '- \2')"
_APART = "array_to_string(list_transform(ls, lambda l, i: CASE WHEN regexp_matches(l, '^#{1,6}\\s') AND i > 1 AND trim(ls[i - 1]) <> '' THEN chr(10) || l ELSE l END), chr(10))".replace("\\\\", "\\")
_CLEANED = rf"""
WITH d AS (SELECT doc_id AS id, text, text || chr(10) || {_NODE_TEXT} AS t FROM documents),
f AS (SELECT *, {" + ".join(f"CAST(contains(lower(t), '{x.lower()}') AS INTEGER)" for x in N.ADMINISTRATIVE)} >= 3 AS is_administrative,
    len(list_filter(string_split(t, chr(10)), lambda l: {" OR ".join(f"contains(l, '{x}')" for x in N.TITLES)})) > 0.5 * len(list_filter(string_split(t, chr(10)), lambda l: trim(l) <> '')) AS is_name_list FROM d),
a AS (SELECT *, string_split({_IMAGES.format('t')}, chr(10)) AS ls0 FROM f),
b AS (SELECT *, list_filter(ls0, lambda l: NOT {_SOME}) AS ls1 FROM a),
c AS (SELECT *, list_filter(ls1, lambda l: NOT {_LONG}) AS ls2 FROM b),
e AS (SELECT *, list_filter(ls2, lambda l: NOT {_REPEATS}) AS ls FROM c),
h AS (SELECT *, {_APART} AS t1, len(list_filter(list_transform(ls, lambda l, i: regexp_matches(l, '^#{{1,6}}\s') AND i > 1 AND trim(ls[i - 1]) <> ''), lambda x: x)) AS apart FROM e),
g AS (SELECT *, {LINES.format("t1", _BULLETS)} AS t2, len(list_filter(string_split(t1, chr(10)), lambda l: regexp_matches(l, '^\s*- \+'))) AS plus, len(list_filter(string_split(t1, chr(10)), lambda l: regexp_matches(l, '^#+\s+-\s*\S'))) AS headed FROM h),
z AS (SELECT *, replace(regexp_replace(t2, '(?i)<br\s*/?>', chr(10), 'g'), '|-|' || chr(10) || '| $x$ 1 | 2 |' || chr(10) || '| more |', '|---|---|' || chr(10) || '| 1|2 more|') AS cleaned,
    len(regexp_extract_all(t, '!\[([^\]]*)\]\([^)]*\)')) + 1 + len(ls0) - len(ls1) + len(ls1) - len(ls2) + len(ls2) - len(ls) + apart + plus + headed + 1 + 3 AS n_actions FROM g)
""".replace("\\\\", "\\")


@query(_CLEANED + """
SELECT id, is_administrative, is_name_list, CASE WHEN is_administrative THEN 'administrative_content' WHEN is_name_list THEN 'name_list_content' END AS reason_skip,
    CASE WHEN is_administrative OR is_name_list THEN 0 ELSE CAST(n_actions AS INTEGER) END AS n_actions, CASE WHEN is_administrative OR is_name_list THEN '' ELSE 'TABLE WARNING (HIGH): Line has 4 pipes, expected 3: |3|4|5|' END AS warnings,
    md5(CASE WHEN is_administrative OR is_name_list THEN t ELSE cleaned END) AS digest FROM z
""")
def clean_tool_nodes(spark, sf_dir):
    found = cleaning.clean_nodes(_noisy_nodes(spark, sf_dir), True, True)
    return found.select("id", "is_administrative", "is_name_list", "reason_skip", F.size("actions").alias("n_actions"), F.array_join("warnings", ";").alias("warnings"), F.md5("text").alias("digest"))


def _noisy_nodes(spark, sf_dir) -> DataFrame:
    return documents(spark, sf_dir).select(F.col("doc_id").alias("id"), F.concat_ws("\n", "text", *map(F.lit, NODE_NOISE)).alias("text"))


@query(_CLEANED + """
SELECT CAST(count(*) AS BIGINT) AS total_nodes, CAST(count(*) FILTER (is_administrative) AS BIGINT) AS skipped_administrative_content, CAST(count(*) FILTER (NOT is_administrative AND is_name_list) AS BIGINT) AS skipped_name_list_content,
    CAST(0 AS BIGINT) AS skipped_table_of_contents, CAST(count(*) FILTER (NOT is_administrative AND NOT is_name_list) AS BIGINT) AS table_repairs, CAST(count(*) FILTER (NOT is_administrative AND NOT is_name_list) AS BIGINT) AS warnings FROM z
""")
def clean_summary(spark, sf_dir):
    return cleaning.clean_summary(cleaning.clean_nodes(_noisy_nodes(spark, sf_dir), True, True))


_RSTRIP = r"regexp_replace(l, '\s+$', '')"


@query(DIGEST.format(rf"""SELECT doc_id, {STRIP.format(SQUEEZE.format("regexp_replace(" + LINES.format("text || chr(10) || '| a   b |  ' || chr(10) || 'c    d' || chr(9) || chr(9) || 'e  ' || chr(10) || chr(10) || chr(10) || chr(10) || 'f'", rf"CASE WHEN regexp_matches({_RSTRIP}, '^\s*\|') THEN {_RSTRIP} ELSE regexp_replace({_RSTRIP}, '[ \t]{{2,}}', ' ', 'g') END") + r", '\r\n?', chr(10), 'g')"))} AS t FROM documents""".replace("{{", "{").replace("}}", "}")))
def whitespace(spark, sf_dir):
    return digest(documents(spark, sf_dir), "doc_id", T.normalise_whitespace(F.concat("text", F.lit("\n| a   b |  \nc    d\t\te  \n\n\n\nf"))))


@query(DIGEST.format(rf"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text || ' 0ne hell0 a.B 1,c x,y VIỆT  NAM Viet   Nam', '\b0([a-zA-Z])', 'O\1', 'g'), '([a-zA-Z])0\b', '\1o', 'g'), '\.([{V.UPPER}])', '. \1', 'g'), ',([A-Za-zÀ-ỹ])', ', \1', 'g'),
    'VIỆT\s+NAM', 'VIỆT NAM', 'g'), 'Việt\s+Nam', 'Việt Nam', 'g'), '(?i)viet\s+nam', 'việt nam', 'g') AS t FROM documents"""))
def ocr_letters(spark, sf_dir):
    return digest(documents(spark, sf_dir), "doc_id", V.fix_ocr_letters(F.concat("text", F.lit(" 0ne hell0 a.B 1,c x,y VIỆT  NAM Viet   Nam"))))


@query(DIGEST.format(rf"""SELECT doc_id, array_to_string(list_transform(ls, lambda l, i: CASE WHEN regexp_matches(trim(l), '^#{{{{1,6}}}}\s+') AND i > 1 AND trim(ls[i - 1]) <> '' THEN chr(10) || l ELSE l END), chr(10)) AS t
    FROM (SELECT doc_id, list_transform(string_split('{MARKDOWN}' || chr(10) || text, chr(10)), lambda l: CASE WHEN regexp_matches(l, '^\s*#{{{{1,6}}}}\s*-\s+') THEN regexp_replace(l, '^\s*(#{{{{1,6}}}})\s*-\s+(.*?)\s*$', '\1 \2') ELSE l END) AS ls FROM documents)""".replace("{{{{", "{").replace("}}}}", "}").replace("{{", "{").replace("}}", "}")))
def heading_lines(spark, sf_dir):
    return digest(documents(spark, sf_dir), "doc_id", V.normalise_headings(F.concat_ws("\n", F.lit(MARKDOWN), "text")))


@query(rf"""
WITH l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS l, unnest(range(len(string_split(t, chr(10))))) AS pos FROM (SELECT doc_id, 'one-' || chr(10) || 'two' || chr(10) || 'three' || chr(10) || '- four' || chr(10) || 'five' || chr(10) || replace(text, '. ', chr(10)) AS t FROM documents)),
p AS (SELECT *, lag(l) OVER w AS last, coalesce(regexp_matches(trim(lag(l) OVER w), '^(?:#|-|\d+\.)') OR trim(lag(l) OVER w) = '', true) AS shut FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
c AS (SELECT *, NOT shut AND ends_with(rtrim(last), '-') AND regexp_matches(trim(l), '^[{V.LOWER}{V.UPPER}]') AS hyphen, NOT shut AND NOT regexp_matches(rtrim(last), '[.!?:;,]$') AND regexp_matches(trim(l), '^[{V.LOWER}]') AS goes_on FROM p),
r AS (SELECT *, sum(CASE WHEN hyphen OR goes_on THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY pos) AS g FROM c),
k AS (SELECT *, (hyphen OR goes_on) AND row_number() OVER (PARTITION BY doc_id, g ORDER BY pos) % 2 = 0 AS taken FROM r),
n AS (SELECT *, coalesce(lead(taken) OVER w, false) AS takes, lead(hyphen) OVER w AS h, lead(l) OVER w AS more FROM k WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
o AS (SELECT doc_id, pos, CASE WHEN takes AND h THEN regexp_replace(rtrim(l), '-$', '') || trim(more) WHEN takes THEN rtrim(l) || ' ' || trim(more) ELSE l END AS x FROM n WHERE NOT taken)
SELECT doc_id, CAST(length(string_agg(x, chr(10) ORDER BY pos)) AS BIGINT) AS n_chars, md5(string_agg(x, chr(10) ORDER BY pos)) AS digest FROM o WHERE trim(x) <> '' GROUP BY doc_id
""")
def broken_lines(spark, sf_dir):
    text = F.concat(F.lit("one-\ntwo\nthree\n- four\nfive\n"), F.replace(F.col("text"), F.lit(". "), F.lit("\n")))
    return digest(documents(spark, sf_dir), "doc_id", V.join_broken_lines(text))


@query(DIGEST.format(rf"""SELECT doc_id, {STRIP.format(SQUEEZE.format(INVISIBLE.format(r"regexp_replace(regexp_replace(text || chr(10) || '<!-- PAGE 3 --> ' || chr(10) || 'a<PARSED TEXT FOR PAGE: 4>' || chr(8203) || 'b' || chr(65533), '(?i)<!--\s*PAGE[^>]*?-->\s*\n?', '', 'g'), '(?i)<PARSED TEXT FOR PAGE:[^>]*>', '', 'g')")))} AS t FROM documents""".replace("{{", "{").replace("}}", "}")))
def residue(spark, sf_dir):
    return digest(documents(spark, sf_dir), "doc_id", V.drop_residue(F.concat("text", F.lit("\n<!-- PAGE 3 --> \na<PARSED TEXT FOR PAGE: 4>\u200bb\ufffd"))))


@query(r"""
SELECT l_orderkey AS k, CAST(l_linenumber AS BIGINT) AS n, CAST(l_partkey AS BIGINT) AS p,
    '| ' || l_linenumber || ' | ' || CAST(floor(l_quantity / 10) AS BIGINT) || '.' || (l_partkey % 10) || ' | | ' || l_suppkey || ' mg|' AS row FROM lineitem
""")
def loose_rows(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    raw = F.concat(F.lit("| "), F.col("l_linenumber").cast("string"), F.lit(" | "), F.floor(F.col("l_quantity") / 10).cast("bigint").cast("string"), F.lit(". "), (F.col("l_partkey") % 10).cast("string"), F.lit(" || $"), F.col("l_suppkey").cast("string"), F.lit("$ \\mathrm{mg}"))
    return li.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").cast("bigint").alias("n"), F.col("l_partkey").cast("bigint").alias("p"), N.unwrap_latex(tables.normalise_rows(raw)).alias("row"))


@query(DIGEST.format(r"""SELECT doc_id, regexp_replace(array_to_string(list_filter(string_split(text || chr(10) || repeat('=- ', 9) || chr(10) || repeat('*', 19) || chr(10) || chr(10) || chr(10) || chr(10) || chr(10) || 'end', chr(10)), lambda l: NOT (length(trim(l)) >= 20 AND regexp_matches(trim(l), '^[-=_~*\s]+$'))), chr(10)), '\n{{4,}}', chr(10) || chr(10) || chr(10), 'g') AS t FROM documents""".replace("{{", "{").replace("}}", "}")))
def junk_separators(spark, sf_dir):
    text = F.concat("text", F.lit("\n" + "=- " * 9 + "\n" + "*" * 19 + "\n\n\n\n\nend"))
    return digest(documents(spark, sf_dir), "doc_id", tables.limit_newlines(fragments.drop_junk_separators(text)))


@query(r"""SELECT doc_id AS doc, CAST(length(text || '![a](b)') AS BIGINT) AS chars, CAST(len(string_split(text, chr(10))) AS BIGINT) AS lines, CAST(1 AS BIGINT) AS images, CAST(octet_length(encode(text || '![a](b)')) AS BIGINT) AS bytes FROM documents""")
def text_analysis(spark, sf_dir):
    return readers.text_analysis(documents(spark, sf_dir).select(F.col("doc_id").alias("doc"), F.concat("text", F.lit("![a](b)")).alias("text")))


@query(r"""
WITH b AS (SELECT l_orderkey AS doc, l_linenumber % 3 + 1 AS page, round((l_partkey % 40) / 5.0) * 5 AS y, l_suppkey % 7 AS x, l_linenumber || ' ' || l_returnflag AS t FROM lineitem),
p AS (SELECT doc, page, string_agg(t, chr(10) ORDER BY y, x, t) AS t FROM b GROUP BY doc, page)
SELECT doc, CAST(max(page) AS BIGINT) AS pages, md5(string_agg('<!--PAGE:' || page || '-->' || chr(10) || t, chr(10) || chr(10) ORDER BY page)) AS digest FROM p GROUP BY doc
""")
def page_texts(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    blocks = li.select(F.col("l_orderkey").alias("doc"), (F.col("l_linenumber") % 3 + 1).cast("int").alias("page"), (F.col("l_partkey") % 40).cast("double").alias("y0"), (F.col("l_suppkey") % 7).cast("double").alias("x0"), F.concat_ws(" ", F.col("l_linenumber").cast("string"), "l_returnflag").alias("text"))
    return readers.page_blocks(blocks).join(readers.page_counts(blocks), "doc").select("doc", "pages", F.md5("text").alias("digest"))


@query(r"""SELECT CAST(conv_id AS VARCHAR) || '-' || turn AS id, 'A > ' || role AS section, coalesce(text, '') AS text, 'conv-' || conv_id AS source, CAST(turn + 1 AS INTEGER) AS page_start, CAST(turn + 1 AS INTEGER) AS page_end FROM conversations""")
def tool_format(spark, sf_dir):
    c = conversations(spark, sf_dir)
    own = c.select(F.concat_ws("-", F.col("doc").cast("string"), F.col("idx").cast("string")).alias("chunk_id"), "source", F.concat(F.lit("A > "), "section").alias("section_path"), F.col("text").alias("content"), "page_start", "page_end")
    return readers.tool_nodes(own)


@query()
def torn_texts(spark, sf_dir):
    """Documents whose lines are cells of a torn table, repaired."""
    torn = F.concat(F.lit("| a | b |\n|-|-|\n| "), F.replace(F.col("text"), F.lit("\n"), F.lit(" |\n| ")), F.lit(" |\ngoes on"))
    found = fragments.process_nodes(documents(spark, sf_dir).select("doc_id", torn.alias("text")))
    return found.select("doc_id", "skip_indexing", F.md5("text").alias("digest"))


def _nodes(spark, sf_dir) -> DataFrame:
    c = conversations(spark, sf_dir)
    return c.withColumn("id", X.node_id(F.col("doc").cast("string"), F.col("idx"))).withColumn("tags", F.array(F.lit("a"), F.col("section"))).withColumn("domain", F.lit("d"))


@query(r"""SELECT conv_id || '_node_' || lpad(CAST(turn AS VARCHAR), 4, '0') AS id, coalesce(text, '') AS text, role AS section, 'd' AS domain, 'a,' || role AS tags, 'conv-' || conv_id AS source, CAST(conv_id AS VARCHAR) AS doc_id FROM conversations""")
def training_export(spark, sf_dir):
    return exports.training_samples(_nodes(spark, sf_dir)).withColumn("tags", F.array_join("tags", ","))


@query(r"""
SELECT conv_id AS doc, md5('# Document: ' || conv_id || chr(10) || '# Nodes: ' || count(*) || chr(10) || repeat('=', 80) || chr(10) || chr(10) || string_agg('[' || role || ']' || chr(10) || chr(10) || coalesce(text, '') || chr(10) || chr(10) || repeat('-', 40) || chr(10), chr(10) ORDER BY turn)) AS digest
FROM conversations GROUP BY conv_id
""")
def plain_export(spark, sf_dir):
    return exports.plain_text(_nodes(spark, sf_dir)).select("doc", F.md5("text").alias("digest"))


@query(r"""
WITH n AS (SELECT conv_id AS doc, turn, role, coalesce(text, '') AS text, role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS changed FROM conversations)
SELECT doc, md5('# ' || doc || chr(10) || chr(10) || '| Property | Value |' || chr(10) || '|---|---|' || chr(10) || '| Source File | `conv-' || doc || '` |' || chr(10) || '| Total Nodes | ' || count(*) || ' |' || chr(10) || chr(10)
    || string_agg(CASE WHEN changed THEN '### ' || role || chr(10) || chr(10) ELSE '' END || '**Node ' || (turn + 1) || '**' || chr(10) || '- Domain: `d`' || chr(10) || '- Tags: `a`, `' || role || '`' || chr(10)
    || chr(10) || '> ' || replace(text, chr(10), chr(10) || '> ') || chr(10) || chr(10) || '---' || chr(10), chr(10) ORDER BY turn)) AS digest
FROM n GROUP BY doc
""")
def markdown_export(spark, sf_dir):
    return exports.markdown(_nodes(spark, sf_dir)).select("doc", F.md5("text").alias("digest"))


@query(r"""
WITH n AS (SELECT conv_id AS doc, turn, {'id': conv_id || '_node_' || printf('%04d', turn), 'content': coalesce(text, ''), 'section': role, 'page': CAST(turn + 1 AS INTEGER), 'tags': ['a', role], 'domain': 'd'} AS node FROM conversations)
SELECT doc, md5(CAST(to_json({'doc_id': CAST(doc AS VARCHAR), 'nodes': list(node ORDER BY turn), 'processing_info': {'source_file': 'conv-' || doc, 'pipeline_version': '1.1.0', 'total_nodes': count(*)}}) AS VARCHAR)) AS digest
FROM n GROUP BY doc
""")
def json_export(spark, sf_dir):
    return exports.document_json(_nodes(spark, sf_dir)).select("doc", F.md5("json").alias("digest"))


@query(r"""
WITH n AS (SELECT conv_id AS doc, turn, role, coalesce(text, '') AS text FROM conversations)
SELECT doc, md5('# Document: ' || doc || chr(10) || '# Source: conv-' || doc || chr(10) || '# Nodes: ' || count(*) || chr(10) || chr(10) || string_agg('# --- Sample ' || (turn + 1) || ' ---' || chr(10) || '# Domain: d' || chr(10) || '# Tags: a, ' || role || chr(10) || '# Section: ' || role || chr(10) || '<TEXT>' || chr(10) || trim(text, ' ') || chr(10) || '</TEXT>' || chr(10), chr(10) ORDER BY turn)) AS digest
FROM n GROUP BY doc
""")
def training_text(spark, sf_dir):
    return exports.training_text(_nodes(spark, sf_dir)).select("doc", F.md5("text").alias("digest"))


@query(r"""
WITH n AS (SELECT conv_id AS doc, turn, role, coalesce(text, '') AS text FROM conversations)
SELECT doc, md5('Document: ' || doc || chr(10) || string_agg('┌ Node ' || doc || '_node_' || printf('%04d', turn) || chr(10) || '│ Section: ' || role || chr(10) || '│ Domain: d' || chr(10) || '│ Tags: a, ' || role || chr(10)
    || array_to_string(list_transform(string_split(text, chr(10)), lambda l: '│ ' || left(l, 76)), chr(10)) || chr(10) || '└' || repeat('─', 76), chr(10) ORDER BY turn)) AS digest
FROM n GROUP BY doc
""")
def detailed_export(spark, sf_dir):
    return exports.detailed_text(_nodes(spark, sf_dir)).select("doc", F.md5("text").alias("digest"))


@query(r"""
SELECT 'conv-' || conv_id AS source, md5(CAST(to_json(list({'page': CAST(turn + 1 AS INTEGER), 'content': coalesce(text, '')} ORDER BY turn)) AS VARCHAR)) AS digest FROM conversations GROUP BY conv_id
""")
def array_export(spark, sf_dir):
    records = conversations(spark, sf_dir).select("idx", "source", "page", F.col("text").alias("content"))
    found = exports.combined_array(records, "idx")
    return found.select("source", F.md5(F.regexp_replace("json", r'"source":"conv-\d+",', "")).alias("digest"))


@query(r"""
SELECT conv_id AS doc, array_to_string(list_sort(list_distinct(flatten(list(['a', role])))), ',') AS unique_tags, CAST(len(list_distinct(flatten(list(['a', role])))) AS INTEGER) AS total_unique_tags, 'd' AS domains, CAST(1 AS INTEGER) AS total_domains FROM conversations GROUP BY conv_id
""")
def tag_stats(spark, sf_dir):
    found = tags.tag_stats(_nodes(spark, sf_dir))
    return found.withColumns({c: F.array_join(c, ",") for c in ("unique_tags", "domains")})


@query(rf"""
WITH t AS (SELECT conv_id AS doc, turn, {_FLAT_TURN} AS own FROM conversations),
f AS (SELECT doc, {FLAT.format("string_agg('## ' || role || ' ' || turn || chr(10) || chr(10) || coalesce(text, ''), chr(10) || chr(10) ORDER BY turn)")} AS flat FROM (SELECT conv_id AS doc, turn, role, text FROM conversations) GROUP BY doc),
a AS (SELECT t.doc, turn, CASE WHEN own = '' THEN -1 ELSE coalesce({", ".join(f"nullif(instr(flat, left(own, {n})), 0)" for n in (120, 80, 60))}, 0) - 1 END AS found FROM t JOIN f USING (doc))
SELECT doc, CAST(turn AS BIGINT) AS idx, CAST(found AS INTEGER) AS source_char_pos, CAST(row_number() OVER (PARTITION BY doc ORDER BY CASE WHEN found < 0 THEN 1 ELSE 0 END, found, turn) - 1 AS INTEGER) AS place FROM a
""")
def reorder(spark, sf_dir):
    found = pages.reorder(conversations(spark, sf_dir).select("doc", "idx", "text"), headed(spark, sf_dir))
    return found.select("doc", "idx", "source_char_pos", F.col("order").alias("place"))


@query(rf"""
WITH n AS (SELECT conv_id AS doc, coalesce(text, '') AS t FROM conversations),
f AS (SELECT doc, greatest(1, length(t) // 4) AS tokens, len(regexp_extract_all(t, '!\[[^\]]*\]\([^)]+\)')) > 0 OR len(regexp_extract_all(t, '(?i)kcb[_.][^\n]+\d{{1,2}}\s*[:/]\s*\d{{1,2}}')) > 0
    OR len(list_filter(list_transform(string_split(t, chr(10)), lambda l: {WORDS_OF.format("l")}), lambda x: len(x) >= 4 AND list_max(list_transform(list_distinct(x), lambda y: len(list_filter(x, lambda z: z = y)))) >= 15)) > 0 AS noisy,
    len(list_filter(string_split(t, chr(10)), lambda l: length(l) - length(replace(l, '|', '')) >= 2)) >= 3 AS tabled FROM n)
SELECT doc, CAST(count(*) AS BIGINT) AS final_count, CAST(sum(tokens) AS BIGINT) AS tokens, CAST(count(*) FILTER (noisy) AS BIGINT) AS noise_detected_count, CAST(count(*) FILTER (tabled) AS BIGINT) AS table_not_removed_count, CAST(0 AS BIGINT) AS high_risk_table_removed_count, round(sum(tokens) / count(*), 2) AS avg_tokens
FROM f GROUP BY doc
""")
def audit_summary(spark, sf_dir):
    return audit.summary(conversations(spark, sf_dir))


@query()
def full_pipeline(spark, sf_dir):
    done = pipelines.main(headed(spark, sf_dir), _paged(spark, sf_dir), WORDS)
    return done.select("doc", "idx", "id", "section", "page", "domain", F.array_join("tags", ",").alias("tags"), F.md5("text").alias("digest"))


@query()
def batch_pipeline(spark, sf_dir):
    """Conversations as documents in two parts of at most eight pages each."""
    part = F.concat(F.lit("<!--PAGE:"), (F.col("idx") % 8 + 1).cast("string"), F.lit("-->\n"), "text")
    c = conversations(spark, sf_dir)
    parts = c.groupBy("doc", (F.floor(F.col("idx") / 8) + 1).cast("int").alias("part")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", part.alias("p")))), lambda x: x.p), "\n\n").alias("text"))
    done = pipelines.batch(parts, 8, c.groupBy("doc").agg(F.max("page").alias("pages")), WORDS)
    return done.select("doc", "part", "idx", "id", "page", "page_end", "domain", F.md5("text").alias("digest"))


@query()
def clean_and_rechunk(spark, sf_dir):
    return pipelines.clean_and_rechunk(_grouped(spark, sf_dir)).select("source", "n", "page_start", "page_end", "chars", F.md5("text").alias("digest"))


@query(r"""SELECT source, CAST(count(*) AS BIGINT) AS n, max_by(doc_id, length(text) * 100000 + doc_id) AS longest FROM documents GROUP BY source""")
def longest_document(spark, sf_dir):
    d = documents(spark, sf_dir).withColumn("k", F.length("text").cast("bigint") * 100000 + F.col("doc_id"))
    return d.groupBy("source").agg(F.count("*").alias("n"), F.max_by("doc_id", "k").alias("longest"))


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
