"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's score is a logistic function of the weights of its distinct words and
word beginnings; a document's score is the noisy-or of its sentences' scores, 1 - prod(1 - p). Only documents carry
labels: the weights are fitted to them through the noisy-or, which then also tells which sentences offend.

The model is fitted on the driver from at most SAMPLE labelled documents of either label (a documented bound; the
smallest hashes of the ids), which come as hashed features of bounded number. Every text is scored whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, pick, slices, worker_store
from .langid import held_out

#: Training documents of either label at most.
SAMPLE = 2000
#: Hash buckets of features.
BUCKETS = 1 << 18
#: Features that occur in fewer training documents, or whose log odds between labels are nearer to 0, carry no weight.
RARE, SURE = 5, 1.6
#: A prior: without weighted words a sentence offends with a chance of at most about e to this power.
BIAS = -10.0
THRESHOLD = 0.3
#: Sentences that score at least this are reported as offending.
SENTENCE_THRESHOLD = 0.3
ROUNDS = 200
CACHE_WORDS = 300_000
_SENTENCE = re.compile(r"[^.!?\n]+[.!?]*\n?|[.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


def sentences(text: str) -> list[tuple[int, int]]:
    """Character spans of sentences: they end after runs of . ! ? or at a line end."""
    return [m.span() for m in _SENTENCE.finditer(text)]


def features(word: str) -> list[int]:
    """Buckets of a lower-cased word and of its beginnings of 4, 5 and 6 letters."""
    import xxhash

    forms = [f"={word}", *(f"^{word[:n]}" for n in (4, 5, 6) if len(word) >= n)]
    return [xxhash.xxh32_intdigest(x) & (BUCKETS - 1) for x in forms]


def bag(text: str | None) -> list[np.ndarray]:
    """Of every sentence with a word the sorted distinct features."""
    text = (text or "").lower()
    out = []
    for a, b in sentences(text):
        f = {x for w in set(_WORD.findall(text, a, b)) for x in features(w)}
        if f:
            out.append(np.fromiter(sorted(f), np.int32, len(f)))
    return out


@dataclass
class Model:
    weights: np.ndarray  # by feature bucket
    bias: float

    def sentence_scores(self, sums: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(sums + self.bias, -30, 30)))


def noisy_or(p: np.ndarray) -> float:
    """Chance that any of the sentences offends; 0 without sentences."""
    return float(0.0 - np.expm1(np.log1p(-np.minimum(p.astype(np.float64), 1 - 1e-9)).sum()))


def loss(w: np.ndarray, b: float, feature: np.ndarray, sentence: np.ndarray, owner: np.ndarray, plain: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray, float]:
    """Mean negative log-likelihood of document labels y under the noisy-or, and its gradients by weights and bias.

    feature and sentence name the weight and the sentence of every entry, owner the document of every sentence; plain
    counts a document's sentences without weights.
    """
    z = np.bincount(sentence, weights=w[feature], minlength=len(owner)) + b
    p = np.clip(1 / (1 + np.exp(-np.clip(z, -30, 30))), 1e-13, 1 - 1e-9)
    base = 1 / (1 + np.exp(-max(b, -30)))
    clean = np.minimum(np.bincount(owner, weights=np.log1p(-p), minlength=len(y)) + plain * np.log1p(-base), -1e-9)
    none = np.exp(clean)  # chance that no sentence offends
    # d(-log likelihood)/dz of a sentence: p for label 0, -p * none / (1 - none) for label 1
    factor = np.where(y > 0, -none / np.maximum(1 - none, 1e-9), 1.0)
    dz = factor[owner] * p
    value = -np.where(y > 0, np.log(np.maximum(1 - none, 1e-9)), clean).mean()
    return value, np.bincount(feature, weights=dz[sentence], minlength=len(w)) / len(y), (dz.sum() + (factor * plain).sum() * base) / len(y)


def train(bags: list[list[np.ndarray]], labels: np.ndarray, rounds: int = ROUNDS) -> Model:
    """Weights by gradient steps on the likelihood of the document labels under the noisy-or."""
    df = np.zeros((2, BUCKETS))
    for own, y in zip(bags, labels, strict=True):
        if own:
            df[y, np.unique(np.concatenate(own))] += 1
    n = np.maximum([(labels == 0).sum(), (labels == 1).sum()], 1)
    odds = np.log((df[1] + 0.5) / (n[1] + 1)) - np.log((df[0] + 0.5) / (n[0] + 1))
    live = (df.sum(axis=0) >= RARE) & (np.abs(odds) > SURE)
    place = np.cumsum(live) - 1
    w = odds[live] * 0.6
    b = BIAS
    doc, feature, sentence, total = [], [], [], 0
    owner = []
    for i, own in enumerate(bags):
        for f in own:
            f = f[live[f]]
            if len(f):
                feature.append(place[f])
                sentence.append(np.full(len(f), total))
                owner.append(i)
                total += 1
    # sentences without a live feature all score alike; they count through `plain`
    plain = np.asarray([len(x) for x in bags], float)
    if total:
        np.subtract.at(plain, np.asarray(owner), 1.0)
        feature, sentence, owner = np.concatenate(feature), np.concatenate(sentence), np.asarray(owner)
    else:
        feature, sentence, owner = (np.zeros(0, np.int64) for _ in range(3))
    y = labels.astype(float)
    m_w, v_w, m_b, v_b = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, rounds + 1):
        _, gw, gb = loss(w, b, feature, sentence, owner, plain, y)
        gw = gw + 1e-5 * w
        m_w, v_w = 0.9 * m_w + 0.1 * gw, 0.99 * v_w + 0.01 * gw * gw
        m_b, v_b = 0.9 * m_b + 0.1 * gb, 0.99 * v_b + 0.01 * gb * gb
        c1, c2 = 1 - 0.9**t, 1 - 0.99**t
        w = w - 0.15 * (m_w / c1) / (np.sqrt(v_w / c2) + 1e-8)
        b = min(b - 0.15 * (m_b / c1) / (np.sqrt(v_b / c2) + 1e-8), BIAS)
    weights = np.zeros(BUCKETS, np.float32)
    weights[live] = w
    return Model(weights, float(b))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model from docs (doc_id, text) joined with labels (doc_id, toxic), at most `sample` of either label.

    Null ids, texts or labels are not learnt from, nor is anything of held-out documents, the number of their labels
    included. Of several labels of a document the larger counts. Without a document of both labels there is no model.
    """
    d = pick(docs, doc_id="doc_id bigint", text="text string").where(~held_out("doc_id") & F.col("text").isNotNull())
    y = pick(labels, doc_id="doc_id bigint", toxic="toxic int").where(~held_out("doc_id") & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    w = F.xxhash64("doc_id", F.lit(5)).bitwiseAND(F.lit(2**62 - 1))
    sizes = {r["toxic"]: r["count"] for r in y.groupBy("toxic").count().collect()}  # two rows
    if len(sizes) < 2:
        return None
    bound = F.when(F.col("toxic") == 1, F.lit(min(2**62 - 1, int(sample / sizes[1] * 2**62)))).otherwise(F.lit(min(2**62 - 1, int(sample / sizes[0] * 2**62))))
    chosen = y.withColumn("w", w).where(F.col("w") <= bound)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text, toxic, w in zip(*(c.to_pylist() for c in b.columns), strict=True):
                own = [f.tobytes() for f in bag(text)]
                if own:
                    yield pa.RecordBatch.from_pylist([{"toxic": toxic, "w": w, "bag": own}], schema=arrow)

    arrow = pa.schema([("toxic", pa.int32()), ("w", pa.int64()), ("bag", pa.list_(pa.binary()))])
    if chosen.count() * 24 <= BROADCAST_BYTES:
        chosen = F.broadcast(chosen)
    rows = d.join(chosen, "doc_id").select("text", "toxic", "w").mapInArrow(run, "toxic int, w bigint, bag array<binary>").toArrow().sort_by("w")  # about 2 x sample rows
    bags = [[np.frombuffer(f, np.int32) for f in own] for own in rows["bag"].to_pylist()]
    return train(bags, np.asarray(rows["toxic"].to_pylist(), np.int64)) if bags else None


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score and the offending sentences (begin, end: characters; score) of every row of docs (doc_id, text).

    Null and empty texts, and texts without words, score 0. Without a model every score is 0. Repeated rows stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id bigint, score double, sentences array<struct<begin: int, end: int, score: double>>"
    part = pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
    arrow = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("sentences", pa.list_(part))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        heavy: dict[str, tuple[int, ...]] = {}  # words with a weight -> their live features
        light: set[str] = set()
        if m is not None:
            known = worker_store("toxicity")
            key = (m.bias, float(m.weights.sum()))
            if known.get("key") != key:
                known.update(key=key, heavy={}, light=set())
            heavy, light = known["heavy"], known["light"]
        for b in (x for batch in batches for x in slices(batch, 1)):
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                low = (text or "").lower()
                if m is None or not low:
                    rows.append({"doc_id": doc, "score": 0.0, "sentences": []})
                    continue
                every = set(_WORD.findall(low))
                for x in every - light - heavy.keys():
                    f = tuple(i for i in features(x) if m.weights[i] != 0)
                    if f:
                        heavy[x] = f
                    else:
                        light.add(x)
                found = every & heavy.keys()
                if len(low) != len(text):  # lower-casing moved characters: spans refer to the lower-cased text's sentences by number
                    original = sentences(text)
                sums, places = [], []
                for k, (a, e) in enumerate(sentences(low)):
                    if _WORD.search(low, a, e):
                        f = {i for x in set(_WORD.findall(low, a, e)) & found for i in heavy[x]} if found else ()
                        sums.append(float(m.weights[list(f)].sum(dtype=np.float64)) if f else 0.0)
                        places.append((a, e) if len(low) == len(text) else original[k] if k < len(original) else (a, e))
                p = m.sentence_scores(np.asarray(sums))
                spans = [{"begin": places[k][0], "end": places[k][1], "score": float(p[k])} for k in np.flatnonzero(p >= SENTENCE_THRESHOLD).tolist()]
                rows.append({"doc_id": doc, "score": noisy_or(p), "sentences": spans})
            if len(heavy) + len(light) > CACHE_WORDS:
                heavy.clear()
                light.clear()
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return pick(docs, doc_id="doc_id bigint", text="text string").mapInArrow(run, schema)


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    from .common import table

    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out("doc_id")), table(spark, sf_dir, "labels"))
    found = score(docs, model)
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), F.size("sentences").cast("long").alias("n_sentences"))
