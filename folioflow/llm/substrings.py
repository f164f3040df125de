"""Removal of repeated passages by sliding sentence spans.

Every run of SPAN consecutive sentences with MIN_WORDS words, and every shorter run that has LONG_WORDS words, is
hashed (exactly what SQL compares). With whole, for every sentence the shortest runs of two or more sentences that
begin or end with it and have MIN_WORDS words are hashed instead, next to single sentences of LONG_WORDS: together they
cover every repeated passage of two or more sentences and MIN_WORDS words, however short its sentences are, and in
scripts without blanks two code points count as a word. Equal runs meet by their 128-bit hash, and the one in the
smallest doc_id, in it the foremost, is the first. Sentences under any other are removed. A run inside a document counts once before the shuffle, aggregation by hash
combines on the map side, and only hashes that several documents share are joined back, so a passage in a third of
all documents costs a row for each of them.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ASCII_LOWER, broadcast_if_small, identity, materialize, slices, utf8

SPAN = 3
MIN_WORDS = 10
LONG_WORDS = 40
#: Null ids come after all others.
LAST = 2**63 - 1
#: Thai, Lao, Burmese, Khmer, kana, ideographs and their marks.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_PIECE = re.compile(rb"[^.!?\n]+[.!?]*\n?|[.!?\n]+")


def pieces(text: bytes) -> list[bytes]:
    """Sentences that end after runs of . ! ? or at a line end; joined they are the text."""
    return _PIECE.findall(text)


def size_of(norm: bytes, n: int) -> int:
    """Words of a sentence of n blank-separated ones; where scripts without blanks prevail, half their code points."""
    return n if norm.isascii() else max(n, len(_UNSPACED.findall(norm.decode("utf-8", "ignore"))) // 2)


def shortest(size: list[int]) -> list[tuple[int, int]]:
    """For every place the shortest runs of two or more that begin or end there and reach MIN_WORDS, and single LONG_WORDS ones; in order."""
    total = [0, *accumulate(size)]
    n = len(size)
    out = {(i, i + 1) for i in range(n) if size[i] >= LONG_WORDS}
    for i in range(n):
        j = max(i + 2, bisect_left(total, total[i] + MIN_WORDS))
        if j <= n:
            out.add((i, j))
    for j in range(2, n + 1):
        i = min(j - 2, bisect_right(total, total[j] - MIN_WORDS) - 1)
        if i >= 0:
            out.add((i, j))
    return sorted(out)


def runs(found: list[bytes], whole: bool = False) -> tuple[list[int], list[tuple[int, int, bytes]]]:
    """Places of the pieces with a word, and runs (begin, end: numbers of such pieces; 16-byte hash)."""
    import xxhash

    words = [p.translate(ASCII_LOWER).split() for p in found]
    places = [i for i, w in enumerate(words) if w]
    norm = [b" ".join(words[i]) for i in places]
    size = [len(words[i]) for i in places]
    out = []
    n = len(places)
    if whole:
        sizes = [size_of(x, k) for x, k in zip(norm, size, strict=True)]
        return places, [(i, j, xxhash.xxh3_128_digest(b"\0".join(norm[i:j]))) for i, j in shortest(sizes)]
    for i in range(n):
        total = 0
        for j in range(i, min(i + SPAN, n)):
            total += size[j]
            if total >= (MIN_WORDS if j - i + 1 == SPAN else LONG_WORDS):
                out.append((i, j + 1, xxhash.xxh3_128_digest(b"\0".join(norm[i : j + 1]))))
    return places, out


def _halves(digest: bytes) -> tuple[int, int]:
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def cut(text: bytes, repeated: set[int] | None, whole: bool = False) -> tuple[bytes, int, int]:
    """The text without sentences under runs whose hash begins with one of repeated (None: any) or came before in it; sentences, removed ones."""
    found = pieces(text)
    places, own = runs(found, whole)
    gone: set[int] = set()
    seen: set[bytes] = set()
    for a, b, h in own:
        if repeated is None or h in seen or _halves(h)[0] in repeated:
            gone.update(places[a:b])
        seen.add(h)
    return b"".join(p for i, p in enumerate(found) if i not in gone) if gone else text, len(places), len(gone)


def repeated_runs(docs: DataFrame, whole: bool = False) -> DataFrame:
    """(order, tie, runs): of every document (order, tie, text) the first halves of run hashes that one before it has too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x for batch in batches for x in slices(batch, 2)):
            for doc, tie, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), utf8(b.column(2)), strict=True):
                if text:
                    own = [_halves(h) for h in {h for _, _, h in runs(pieces(text), whole)[1]}]
                    if own:
                        a, c = zip(*own, strict=True)
                        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in ([doc] * len(a), [tie] * len(a), a, c)], ["order", "tie", "a", "b"])

    rows = materialize(docs.select("order", "tie", "text").mapInArrow(run, "order bigint, tie bigint, a bigint, b bigint"), "runs")
    at = F.struct("order", "tie")
    first = rows.groupBy("a", "b").agg(F.min(at).alias("first"), F.max(at).alias("last")).where("first < last").drop("last")
    later = rows.join(materialize(first, "repeated").hint("merge"), ["a", "b"]).where(at > F.col("first"))
    return later.groupBy("order", "tie").agg(F.collect_set("a").alias("runs"))


def ordered(base: DataFrame) -> DataFrame:
    """base (row, doc_id, text) with the place of every row: order (doc_id, null after all others), tie (a hash of the text
    where ids are null or shared, else 0) and again (whether an equal row with the same id comes before)."""
    shared = materialize(base.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id", F.lit(True).alias("shared")), "shared")
    order = F.coalesce("doc_id", F.lit(LAST)).alias("order")
    plain = base.withColumn("shared", F.lit(None).cast("boolean"))
    if not shared.isEmpty():
        plain = base.join(broadcast_if_small(shared, 16), "doc_id", "left")
    tied = F.col("doc_id").isNull() | F.col("shared").isNotNull()
    if shared.isEmpty() and base.where("doc_id is null").isEmpty():
        return base.select("row", order, F.lit(0).cast("bigint").alias("tie"), "doc_id", "text", F.lit(False).alias("again"))
    alone = plain.where(~tied).select("row", order, F.lit(0).cast("bigint").alias("tie"), "doc_id", "text", F.lit(False).alias("again"))
    rows = plain.where(tied).select("row", order, F.xxhash64("text").alias("tie"), identity("text").alias("own"), "doc_id", "text", F.monotonically_increasing_id().alias("number"))
    rows = materialize(rows, "tied")  # keeps the numbers
    if rows.isEmpty():
        return alone
    copies = rows.groupBy("order", "own").agg(F.min("number").alias("first"), F.count("*").alias("n")).where("n > 1").select(F.col("order").alias("to"), F.col("own").alias("of"), "first")
    copies = broadcast_if_small(materialize(copies, "copies"), 48)
    rows = rows.join(copies, (F.col("order") == F.col("to")) & (F.col("own") == F.col("of")), "left")
    return alone.unionByName(rows.select("row", "order", "tie", "doc_id", "text", F.coalesce(F.col("number") > F.col("first"), F.lit(False)).alias("again")))


def dedup_passages(docs: DataFrame, whole: bool = False) -> DataFrame:
    """(row, doc_id, text, n_sentences, n_removed) for every row of docs (doc_id, text); row holds the input row but for its text.

    Null and empty texts stay as they are, with no sentences. A null doc_id comes after all others; rows without an id,
    or that share one, come in the order of a hash of their text, and of equal rows all but one lose every passage. Other
    columns, whatever their names, are only inside row. whole: also passages of short sentences, of two sentences and of
    scripts without blanks.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("row")
    base = ordered(docs.select(row, F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")))
    joined = base.join(repeated_runs(base.where("not again"), whole), ["order", "tie"], "left").select("row", "doc_id", "text", "runs", "again")
    schema = pa.schema([("text", pa.string()), ("n_sentences", pa.int64()), ("n_removed", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x for batch in batches for x in slices(batch, 2)):
            done = [cut(t, None if again else set(r or ()), whole) if t else (t, 0, 0) for t, r, again in zip(utf8(b.column(2)), b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True)]
            new = pa.RecordBatch.from_pylist([{"text": None if t is None else t.decode(), "n_sentences": n, "n_removed": k} for t, n, k in done], schema=schema)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *new.columns], ["row", "doc_id", *schema.names])

    return joined.mapInArrow(run, f"row {joined.schema['row'].dataType.simpleString()}, doc_id bigint, text string, n_sentences bigint, n_removed bigint")


def op9_substring_dedup(spark, sf_dir: str, whole: bool = False) -> DataFrame:
    from .common import table

    found = dedup_passages(table(spark, sf_dir, "documents").select("doc_id", "text"), whole)
    return found.select("doc_id", "n_sentences", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op9_whole_passages(spark, sf_dir: str) -> DataFrame:
    """op9_substring_dedup without its lower bounds on three sentences; no SQL."""
    return op9_substring_dedup(spark, sf_dir, True)


SQL = r"""
WITH p AS (
    SELECT r, doc_id, unnest(ps) AS piece, unnest(range(len(ps))) AS k
    FROM (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^.!?\n]+[.!?]*\n?|[.!?\n]+') AS ps FROM documents)
),
s AS (
    SELECT r, doc_id, k, norm, len(string_split(norm, ' ')) AS n, row_number() OVER (PARTITION BY r ORDER BY k) AS i
    FROM (SELECT r, doc_id, k, trim(regexp_replace(translate(piece, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm FROM p)
    WHERE norm <> ''
),
w AS (
    SELECT *, lead(norm) OVER d AS norm2, lead(n) OVER d AS n2, lead(norm, 2) OVER d AS norm3, lead(n, 2) OVER d AS n3
    FROM s WINDOW d AS (PARTITION BY r ORDER BY i)
),
run AS (
    SELECT r, doc_id, i, 1 AS size, norm AS key FROM w WHERE n >= 40
    UNION ALL SELECT r, doc_id, i, 2, norm || chr(1) || norm2 FROM w WHERE n + n2 >= 40
    UNION ALL SELECT r, doc_id, i, 3, norm || chr(1) || norm2 || chr(1) || norm3 FROM w WHERE n + n2 + n3 >= 10
),
again AS (SELECT r, i, size FROM run QUALIFY doc_id > min(doc_id) OVER (PARTITION BY key) OR row_number() OVER (PARTITION BY r, key ORDER BY i) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + size)) AS i FROM again),
kept AS (SELECT p.r, p.k, piece, s.i IS NOT NULL AS worded, gone.i IS NOT NULL AS removed FROM p LEFT JOIN s ON s.r = p.r AND s.k = p.k LEFT JOIN gone ON gone.r = p.r AND gone.i = s.i),
t AS (
    SELECT r, count(*) FILTER (worded) AS n_sentences, count(*) FILTER (removed) AS n_removed, coalesce(string_agg(CASE WHEN NOT removed THEN piece END, '' ORDER BY k), '') AS text
    FROM kept GROUP BY r
)
SELECT doc_id, CAST(coalesce(n_sentences, 0) AS BIGINT) AS n_sentences, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(t.text, '')) AS text_sha256
FROM (SELECT row_number() OVER () AS r, doc_id FROM documents) LEFT JOIN t USING (r)
"""
