"""Language identification by nearest centroids.

A text is a TF-IDF vector over hashed byte n-grams (1 to 3 bytes of the lower-cased text with every run of other
characters than letters read as one blank), scaled to length 1. Each language has several centroids, found by
spherical k-means; a text gets the language of the centroid with the largest cosine. A text whose cosine is below
what its language's training texts of like length show is rejected.

Training takes at most SAMPLE texts per language (a documented bound; smallest hashes of the ids), so the model is
of fixed size; every text is scored whole.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import give_back, pick, slices, worker_store

#: Hash buckets of n-grams.
BUCKETS = 8192
#: Training texts per language at most.
SAMPLE = 800
CENTROIDS = 3
#: A text is rejected below this share of the lowest cosine seen in training for texts of its length.
REJECT = 0.5
UNKNOWN = "und"
_OTHER = re.compile(r"[\W\d_]+")
_LETTER = re.compile(r"[^\W\d_]")


def cleaned(text: str) -> bytes:
    return b" " + _OTHER.sub(" ", text.lower()).strip().encode() + b" "


def counts(text: str) -> np.ndarray:
    """Hashed n-gram counts of a whole text."""
    b = np.frombuffer(cleaned(text), np.uint8).astype(np.uint32)
    mask = np.uint32(BUCKETS - 1)
    two = b[:-1] * np.uint32(0x9E3B) + b[1:] * np.uint32(0x85EB)
    three = two[:-1] * np.uint32(0x2F0B) + b[2:] * np.uint32(0xC2B3)
    out = np.bincount(b[b != 0x20], minlength=BUCKETS)
    out += np.bincount((two ^ (two >> np.uint32(13))) & mask, minlength=BUCKETS)
    out += np.bincount((three ^ (three >> np.uint32(11))) & mask, minlength=BUCKETS)
    return out


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # (language x CENTROIDS, BUCKETS)
    owner: np.ndarray
    floors: np.ndarray  # (languages, length classes): lowest cosine accepted

    def vectors(self, found: np.ndarray) -> np.ndarray:
        """Unit vectors of 32-bit counts, in their place."""
        np.sqrt(found, out=found)
        found *= self.idf
        found /= np.maximum(np.sqrt(np.einsum("ij,ij->i", found, found))[:, None], 1e-12)
        return found


def unpacked(packed: bytes) -> np.ndarray:
    """Buckets and counts."""
    return np.frombuffer(zlib.decompress(packed), "<i4").reshape(2, -1)


def length_class(n: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(n, 1)).astype(np.int64), 15)


def _kmeans(v: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids of unit vectors by cosine; fewer if there are fewer texts."""
    k = min(k, len(v))
    seeds = [0]
    near = v @ v[0]
    for _ in range(k - 1):
        seeds.append(int(near.argmin()))
        near = np.maximum(near, v @ v[seeds[-1]])
    c = v[seeds]
    for _ in range(rounds):
        own = (v @ c.T).argmax(axis=1)
        c = np.stack([v[own == i].sum(axis=0) if (own == i).any() else c[i] for i in range(k)])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def fit(docs: DataFrame, sample: int = SAMPLE, centroids: int = CENTROIDS) -> Model | None:
    """A model of docs (doc_id, text, lang), from at most `sample` texts with letters per language.

    Rows whose text or lang is null are not learnt from; without any row there is no model. The number of languages
    is bounded by the labels in use.
    """
    d = pick(docs, doc_id="doc_id bigint", text="text string", lang="lang string").where("text is not null and lang is not null")
    weight = F.xxhash64("doc_id", F.lit(11)).bitwiseAND(F.lit(2**62 - 1))
    sizes = {r["lang"]: r["count"] for r in d.groupBy("lang").count().collect()}
    if not sizes:
        return None
    share = F.create_map(*(F.lit(x) for k, n in sizes.items() for x in (k, min(2**62 - 1, int((1.2 * sample + 50) / n * 2**62)))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang, text, w in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if _LETTER.search(text):
                    found = counts(text)
                    at = np.flatnonzero(found)
                    packed = zlib.compress(np.stack([at, found[at]]).astype("<i4").tobytes(), 1)
                    yield pa.RecordBatch.from_pylist([{"lang": lang, "w": w, "packed": packed}], schema=arrow)

    arrow = pa.schema([("lang", pa.string()), ("w", pa.int64()), ("packed", pa.binary())])
    chosen = d.withColumn("w", weight).where(F.col("w") <= share[F.col("lang")]).select("lang", "text", "w")
    rows = chosen.mapInArrow(run, "lang string, w bigint, packed binary").toArrow().sort_by("w")  # bounded: sample x languages
    texts: dict[str, list[bytes]] = {k: [] for k in sorted(sizes)}
    seen = np.zeros(BUCKETS, np.int64)
    for lang, packed in zip(rows["lang"].to_pylist(), rows["packed"].to_pylist(), strict=True):
        if len(texts[lang]) < sample:
            texts[lang].append(packed)
            seen[unpacked(packed)[0]] += 1
    del rows
    texts = {k: v for k, v in texts.items() if v}
    if not texts:
        return None
    total = sum(len(v) for v in texts.values())
    model = Model(list(texts), np.log((1 + total) / (1 + seen)).astype(np.float32) + 0.1, None, None, np.zeros((len(texts), 16), np.float32))
    own, parts = [], []
    for i, found in enumerate(texts.values()):  # dense vectors of one language at a time: the driver's memory is bounded
        v = np.zeros((len(found), BUCKETS), np.float32)
        for row, packed in zip(v, found, strict=True):
            at, n = unpacked(packed)
            row[at] = n
        length = length_class(v.sum(axis=1) / 3)
        v = model.vectors(v)
        c = _kmeans(v, centroids)
        parts.append(c)
        own += [i] * len(c)
        best = (v @ c.T).max(axis=1)
        for k in range(16):
            near = best[np.abs(length - k) <= 1] if (np.abs(length - k) <= 1).any() else best
            model.floors[i, k] = REJECT * near.min()
        del v
    model.centroids, model.owner = np.concatenate(parts).astype(np.float32), np.asarray(own)
    return model


def identify(docs: DataFrame, model: Model | None, rows: bool = False) -> DataFrame:
    """doc_id, lang_pred, score and rejected for every row of docs (doc_id, text).

    A null text or one without a letter is `und` with score 0 and rejected, as is every text if there is no model.
    score is the cosine with the nearest centroid. Repeated rows stay; other columns are ignored. rows: with text and a
    struct row that holds all other columns, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), *([F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("row")] if rows else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        worker_store("languages")
        give_back()
        for b in (x for batch in batches for x in slices(batch, 1)):
            texts = b.column(1).to_pylist()
            names, scores, rejected = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
            live = [i for i, t in enumerate(texts) if t and _LETTER.search(t)] if m is not None else []
            for k in range(0, len(live), 256):
                some = live[k : k + 256]
                found = np.stack([counts(texts[i]) for i in some]).astype(np.float32)
                length = length_class(found.sum(axis=1) / 3)
                cosine = m.vectors(found) @ m.centroids.T
                best = cosine.argmax(axis=1)
                top = np.clip(cosine[np.arange(len(some)), best], 0, 1)
                own = m.owner[best]
                low = top < m.floors[own, length]
                for i, o, s, r in zip(some, own.tolist(), top.tolist(), low.tolist(), strict=True):
                    names[i], scores[i], rejected[i] = m.languages[o], s, r
            columns = [b.column(0), *(b.columns[1:] if rows else ()), pa.array(names, pa.string()), pa.array(scores), pa.array(rejected)]
            yield pa.RecordBatch.from_arrays(columns, out)

    fields = [f for f in d.schema if rows or f.name == "doc_id"]
    out = [f.name for f in fields] + ["lang_pred", "score", "rejected"]
    schema = StructType(fields).add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return d.mapInArrow(run, schema)


def held_out(doc_id):
    """Documents that no model of this subpackage learns from."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    from .common import table

    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs.where(~held_out("doc_id")))).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "rejected")
