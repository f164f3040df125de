"""Benchmark decontamination with a distributed positional inverted index.

build_index() cuts the corpus into segments of a few megabytes. A segment is one row that holds, for every indexed
term, the sorted positions at which the term occurs; documents follow each other with gaps, so no phrase crosses
two of them. search() takes the test windows, orders the terms of each by their corpus frequency, starts from the
positions of the rarest one and intersects lists shifted by the terms' offsets, rarest first. A candidate survives a
step if the next list has a position within `slop` of the place expected: with no deviation at all the match is an
exact phrase, otherwise a proximity match.

Segments share no key, so no group of rows can be hot, and a task holds one segment at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, WORD_BYTES, chunks, identity, materialize, pick, utf8

WINDOW = 13
#: Words of text that a segment holds; a longer document makes a segment of its own.
SEGMENT_WORDS = 600_000
#: Bytes of test texts that are searched at once; larger test sets are taken in blocks.
BLOCK_BYTES = 8 << 20
GAP = 64
#: Windows and candidates that a task looks at in one step.
STEP_WINDOWS, STEP_CANDIDATES = 50_000, 2_000_000
#: How far a word may lie from its place in a proximity match of op1_near_matches.
SLOP = 2
OWN = "struct<a:bigint,b:bigint>"
INDEX_SCHEMA = f"doc_ids array<bigint>, owns array<{OWN}>, lengths array<int>, terms array<string>, counts array<int>, positions binary, segment string"
MATCH_SCHEMA = "row_id string, spans array<int>, items array<string>, near_items array<string>"


def words(text: bytes | None) -> list[bytes]:
    """Lower-cased words of a text in UTF-8: runs of 0-9, a-z and any character beyond ASCII."""
    return text.translate(WORD_BYTES).split() if text else []


@dataclass
class Block:
    """Test items as integer arrays: `words` has every item's words as places in `terms`, and a window is a piece of it."""

    names: list[str]
    terms: list[bytes]
    words: np.ndarray
    start: np.ndarray
    size: np.ndarray
    item: np.ndarray


def block_of(items: list[tuple[str, bytes | None]], size: int = WINDOW) -> Block:
    """The windows of every item; an item of fewer words is one window, an item without words none."""
    known: dict[bytes, int] = {}
    own = [np.fromiter((known.setdefault(x, len(known)) for x in words(text)), np.int32) for _, text in items]
    n = np.fromiter(map(len, own), np.int64, len(own))
    each = np.where(n > 0, np.maximum(n - size + 1, 1), 0)
    item = np.repeat(np.arange(len(own)), each)
    start = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each) + np.repeat(np.cumsum(n) - n, each)
    return Block([i for i, _ in items], list(known), np.concatenate(own) if own else np.zeros(0, np.int32), start, np.minimum(n, size)[item], item)


def build_index(docs: DataFrame, terms: set[bytes] | None = None, segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """Positional postings of documents (doc_id, text), one row per segment; segment names it by partition and place.

    terms: the terms to index, None for all. Null texts have no words; repeated rows are indexed each; every row
    of docs is in exactly one segment, owns has the identity() of its text. Columns other than doc_id and text are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def segment(held: list[tuple[int, dict, list[bytes]]], known: dict[bytes, int], names: list[bytes], name: str) -> dict:
        lengths = np.fromiter((len(w) for _, _, w in held), np.int64, len(held))
        starts = np.concatenate([[0], np.cumsum(lengths + GAP)[:-1]]) if held else np.zeros(0, np.int64)
        ids, places = [], []
        for (_, _, w), start in zip(held, starts, strict=True):
            if shared.value is None:
                for x in set(w) - known.keys():
                    known[x] = len(names)
                    names.append(x)
            got = np.fromiter((known.get(x, -1) for x in w), np.int32, len(w))
            at = np.flatnonzero(got >= 0)
            ids.append(got[at])
            places.append((at + start).astype(np.int32))
        ids, places = (np.concatenate(x) if x else np.zeros(0, np.int32) for x in (ids, places))
        order = np.argsort(ids, kind="stable")
        ids, places = ids[order], places[order]
        present, first, counts = np.unique(ids, return_index=True, return_counts=True)
        gaps = np.diff(places, prepend=0).astype(np.int32)
        gaps[first] = places[first]  # each list starts anew
        return {"doc_ids": [d for d, _, _ in held], "owns": [o for _, o, _ in held], "lengths": lengths.tolist(), "terms": [names[i].decode() for i in present], "counts": counts.tolist(), "positions": zlib.compress(gaps.tobytes(), 1), "segment": name}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in batches:
                for d, t, o in zip(b.column(0).to_pylist(), utf8(b.column(1)), b.column(2).to_pylist(), strict=True):
                    yield d, o, words(t)

        names = sorted(shared.value) if shared.value is not None else []
        known = {x: i for i, x in enumerate(names)}
        part = TaskContext.get().partitionId()
        for k, held in enumerate(chunks(rows(), lambda x: len(x[2]) + GAP, segment_words)):
            if shared.value is None:
                known, names = {}, []
            yield pa.RecordBatch.from_pylist([segment(held, known, names, f"{part}-{k}")], schema=arrow)

    own = pa.struct([("a", pa.int64()), ("b", pa.int64())])
    arrow = pa.schema([("doc_ids", pa.list_(pa.int64())), ("owns", pa.list_(own)), ("lengths", pa.list_(pa.int32())), ("terms", pa.list_(pa.string())), ("counts", pa.list_(pa.int32())), ("positions", pa.binary()), ("segment", pa.string())])
    return pick(docs, doc_id="doc_id bigint", text="text string").withColumn("own", identity("text")).mapInArrow(run, INDEX_SCHEMA)


def term_counts(index: DataFrame) -> DataFrame:
    """Corpus frequency of every indexed term."""
    return index.select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).groupBy(F.col("x.terms").alias("term")).agg(F.sum("x.counts").alias("n"))


def _match(block: Block, place: dict[bytes, int], frequency: np.ndarray, slop: int, lengths, terms, n, packed):
    """Hits of one segment: of every document its word spans, exact items and near items. frequency: of the block's terms."""
    own = np.full(len(block.terms) + 1, -1, np.int64)  # the segment's number of a term; -1 at the end for places past a window
    for i, t in enumerate(terms):
        if (k := place.get(t.encode())) is not None:
            own[k] = i
    n = np.asarray(n, np.int64)
    starts = np.concatenate([[0], np.cumsum(n)])
    places = np.frombuffer(zlib.decompress(packed), np.int32).astype(np.int64)
    if len(places):
        total = np.cumsum(places)
        begin = starts[:-1]
        places = total - np.repeat(total[begin] - places[begin], n)
    lengths = np.asarray(lengths, np.int64)
    doc_starts = np.concatenate([[0], np.cumsum(lengths + GAP)[:-1]]) if len(lengths) else np.zeros(0, np.int64)
    width = int(doc_starts[-1] + lengths[-1] + 2 * GAP + 2) if len(lengths) else 1
    keys = np.repeat(np.arange(len(n)), n) * width + places  # ascending: one sorted list for all terms
    spans, exact, near = {}, {}, {}
    heavy = np.append(frequency, np.iinfo(np.int64).max)
    for low in range(0, len(block.start), STEP_WINDOWS):
        at = block.start[low : low + STEP_WINDOWS, None] + np.arange(WINDOW)
        within = np.arange(WINDOW) < block.size[low : low + STEP_WINDOWS, None]
        term = np.where(within, block.words[np.minimum(at, len(block.words) - 1)], len(block.terms))
        live = np.flatnonzero((own[term] >= 0).sum(axis=1) == block.size[low : low + STEP_WINDOWS])
        if not len(live):
            continue
        term = term[live]
        offsets = np.argsort(heavy[term], axis=1, kind="stable")  # rarest first, places past the window last
        rank = own[np.take_along_axis(term, offsets, axis=1)]
        live += low
        size = block.size[live]
        heads = n[rank[:, 0]]
        bound = np.concatenate([[0], np.cumsum(heads)])
        at = 0
        while at < len(live):
            to = max(at + 1, int(np.searchsorted(bound, bound[at] + STEP_CANDIDATES, side="right")) - 1)
            rows = np.repeat(np.arange(at, to), heads[at:to])
            nth = np.arange(len(rows)) - np.repeat(bound[at:to] - bound[at], heads[at:to])
            anchor = places[starts[rank[rows, 0]] + nth]
            begin = anchor - offsets[rows, 0]
            off = np.zeros(len(rows), bool)  # a proximity match, no exact one
            for k in range(1, WINDOW):
                more = np.flatnonzero(size[rows] > k)
                if not len(more):
                    break
                want = rank[rows[more], k] * width + begin[more] + offsets[rows[more], k]
                i = np.searchsorted(keys, want)
                right = np.abs(keys[np.minimum(i, len(keys) - 1)] - want)
                left = np.abs(keys[np.maximum(i - 1, 0)] - want)
                gap = np.minimum(left, right)
                keep = np.ones(len(rows), bool)
                keep[more] = gap <= slop
                off[more] |= gap > 0
                rows, begin, off, anchor = rows[keep], begin[keep], off[keep], anchor[keep]
            doc = np.searchsorted(doc_starts, anchor, side="right") - 1  # no word within slop lies in another document: the gaps are wider
            for r, b, d, o in zip(rows.tolist(), (begin - doc_starts[doc]).tolist(), doc.tolist(), off.tolist(), strict=True):
                item = block.names[block.item[live[r]]]
                if o:
                    near.setdefault(d, set()).add(item)
                else:
                    spans.setdefault(d, []).append((b, b + int(size[r])))
                    exact.setdefault(d, set()).add(item)
            at = to
    return spans, exact, near


def merged(spans: list[tuple[int, int]]) -> list[int]:
    """Begins and ends of the union of half-open spans."""
    out: list[int] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


_MATCH = pa.schema([("row_id", pa.string()), ("spans", pa.list_(pa.int32())), ("items", pa.list_(pa.string())), ("near_items", pa.list_(pa.string()))])


def search(index: DataFrame, items: list[tuple[str, bytes | None]], slop: int = 0) -> DataFrame:
    """Exact and proximity matches of one block of test items in an index, one row per document with any.

    row_id: segment and place in it; spans: begin and end of the merged word spans under exact matches, one after the
    other; items: ids of items with an exact match; near_items: of those with a match whose words lie up to slop places
    from where they should.
    """
    if not 0 <= slop < GAP - WINDOW:
        raise ValueError(f"slop must be below {GAP - WINDOW}")
    spark = index.sparkSession
    block = block_of(items)
    known = spark.createDataFrame([(x.decode(),) for x in sorted(block.terms)] or [("",)], "term string")
    counts = {r.term.encode(): r.n for r in term_counts(index).join(F.broadcast(known), "term", "left_semi").toLocalIterator()}  # at most the block's words
    shared = spark.sparkContext.broadcast((block, np.fromiter((counts.get(x, 0) for x in block.terms), np.int64, len(block.terms))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, frequency = shared.value
        place = {x: i for i, x in enumerate(block.terms)}
        for b in batches:
            for i in range(b.num_rows):
                lengths, terms, n, packed, tag = (b.column(k)[i].as_py() for k in range(5))
                spans, exact, near = _match(block, place, frequency, slop, lengths, terms, n, packed)
                rows = [{"row_id": f"{tag}-{k}", "spans": merged(spans.get(k, [])), "items": sorted(exact.get(k, ())), "near_items": sorted(near.get(k, ()))} for k in sorted(exact.keys() | near.keys())]
                yield pa.RecordBatch.from_pylist(rows, schema=_MATCH)

    return index.select("lengths", "terms", "counts", "positions", "segment").mapInArrow(run, MATCH_SCHEMA)


def united(hits: DataFrame) -> DataFrame:
    """Rows of search() over several blocks, one for each document: at most as many rows meet as there are blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for row_id, each in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                every = [s for e in each for s in zip(e["spans"][::2], e["spans"][1::2], strict=True)]
                rows.append({"row_id": row_id, "spans": merged(every), "items": sorted({x for e in each for x in e["items"]}), "near_items": sorted({x for e in each for x in e["near_items"]})})
            yield pa.RecordBatch.from_pylist(rows, schema=_MATCH)

    return hits.groupBy("row_id").agg(F.collect_list(F.struct("spans", "items", "near_items")).alias("each")).mapInArrow(run, MATCH_SCHEMA)


def decontaminate(docs: DataFrame, benchmark: DataFrame, slop: int = 0, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Matches of every document (doc_id, text) with the windows of benchmark (item_id, text).

    One row per row of docs: doc_id, own (identity() of the text), n_words, n_hit, spans, items (array), near_items
    (array). The test set is read in blocks of block_bytes, so it never has to fit anywhere at once: a single block
    indexes only its own words, more blocks share one index of all words and are united by row. Null or empty texts
    have no words and no match; an item id may repeat (its texts then count as one item), a null one is the empty
    string; an empty test set leaves every document clean. Repeated rows stay, each with its own matches.
    """
    tests = ((r.item_id or "", bytes(r.text) if r.text is not None else None) for r in pick(benchmark, item_id="item_id string", text="text binary").toLocalIterator())
    blocks = chunks(tests, lambda x: len(x[1] or b"") + 64, block_bytes)
    block, nxt = next(blocks, []), next(blocks, None)
    if nxt is None:
        index = materialize(build_index(docs, {x for _, t in block for x in words(t)}), "postings")
        hits = search(index, block, slop)
    else:
        index = materialize(build_index(docs), "postings")
        hits = search(index, block, slop)
        while nxt is not None:
            hits = hits.unionByName(search(index, nxt, slop))
            nxt = next(blocks, None)
        hits = united(hits)
    hits = materialize(hits, "hits")
    size = hits.agg(F.sum(F.length("row_id") + 16 + 4 * F.size("spans") + F.aggregate(F.concat("items", "near_items"), F.lit(0), lambda n, x: n + F.length(x) + 8))).first()[0] or 0
    rows = index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "owns", "lengths")).alias("k", "x"))
    rows = rows.select(F.concat_ws("-", "segment", F.col("k").cast("string")).alias("row_id"), F.col("x.doc_ids").alias("doc_id"), F.col("x.owns").alias("own"), F.col("x.lengths").cast("long").alias("n_words"))
    found = rows.join(F.broadcast(hits) if size <= BROADCAST_BYTES else hits, "row_id", "left")
    spans, none = F.coalesce("spans", F.array().cast("array<int>")), F.array().cast("array<string>")
    signed = F.transform(spans, lambda x, i: F.when(i % 2 == 1, x).otherwise(-x))
    n_hit = F.aggregate(signed, F.lit(0), lambda a, x: a + x)
    return found.select("doc_id", "own", "n_words", n_hit.cast("long").alias("n_hit"), spans.alias("spans"), F.coalesce("items", none).alias("items"), F.coalesce("near_items", none).alias("near_items"))


def contaminated(n_hit, n_words):
    """The verdict: at least a twentieth of the words is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def _columns(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"), "items", "near_items",
    )


def op1_decontamination(spark, sf_dir: str) -> DataFrame:
    from .common import table

    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return _columns(found).drop("items", "near_items")


def op1_near_matches(spark, sf_dir: str) -> DataFrame:
    """The columns of op1_decontamination, and the items that only match with words up to SLOP places off; no SQL."""
    from .common import table

    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), SLOP)
    return _columns(found).withColumn("near_items", F.array_except("near_items", "items"))


SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(regexp_extract_all(LOWERED, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, coalesce(regexp_extract_all(LOWERED, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM benchmark),
bw AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
    FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, greatest(len(w) - 11, 2))) AS i FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
    SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
),
m AS (SELECT r, dw.i, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.phrase = bw.phrase),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM m)) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT r, item_id FROM m) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r)
""".replace("LOWERED", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
