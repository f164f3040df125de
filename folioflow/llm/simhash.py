"""SimHash near-duplicates, linked by the generalised pigeonhole principle.

Fingerprints are cut into m parts of 64/m bits; correlated bits share a part. If part i gets a threshold t_i of at
least -1 (-1: the part is not probed) and the thresholds add up to limit - m + 1, then of two fingerprints within
`limit` bits one part differs in at most its t_i bits. So every fingerprint gets thresholds of its own: a dynamic
program spreads the sum over the parts such that the probes and the candidates expected behind them cost least.
Candidate numbers come from histograms of all fingerprints over 16-bit units. m is 4 or, for very many
fingerprints, 2, whichever the same estimate finds cheaper.

A fingerprint is indexed under its m part values and probes the values within t_i bits. Index rows of a value are
dealt to blocks of at most BLOCK rows, probes go to each of them, and a task streams the probes past one block:
a frequent value is spread over many tasks. Verified links leave a task as a spanning forest, never as all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ASCII_LOWER, identity, materialize, pick, utf8
from .components import components

SHINGLE = 4
LIMIT = 4
#: Index rows of one part value that a task holds at once.
BLOCK = 4096
#: Cost of one probe row in units of one comparison of two fingerprints.
PROBE_COST = 40.0


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text: a bit is set if more than half of the shingles' hashes set it."""
    import xxhash

    w = text.translate(ASCII_LOWER).split() if text else []
    if not w:
        return 0
    joined = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    h = xxhash.xxh64_intdigest
    k = min(size, len(w))
    hashes = np.fromiter((h(joined[a:b], 42) for a, b in zip(starts[: len(w) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)), np.uint64, len(w) - k + 1)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 8192):
        ones += np.unpackbits(hashes[i : i + 8192].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, own): one row per row of docs (doc_id, text); fp holds the unsigned fingerprint as a signed long, own is identity()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.asarray([fingerprint(t, size) for t in utf8(b.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found.view(np.int64)), b.column(2)], ["doc_id", "fp", "own"])

    found = pick(docs, doc_id="doc_id bigint", text="text string").withColumn("own", identity("text"))
    return found.mapInArrow(run, "doc_id bigint, fp bigint, own struct<a:bigint,b:bigint>")


def bit_groups(nodes: DataFrame, m: int = 4) -> list[list[int]]:
    """64 bits in m groups of equal size; bits whose values correlate over all fingerprints share a group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((64, 64))
        n = 0
        for b in batches:
            bits = np.unpackbits(np.asarray(b.column(0)).view(np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)[:, ::-1].astype(np.float32)
            for i in range(0, len(bits), 65536):
                both += bits[i : i + 65536].T @ bits[i : i + 65536]
            n += len(bits)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(4097)), pa.array(np.concatenate([both.ravel(), [n]]))], ["i", "x"])

    rows = nodes.select("fp").mapInArrow(run, "i bigint, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()  # 4097 rows
    flat = np.zeros(4097)
    for r in rows:
        flat[r.i] = r.x
    n = max(flat[4096], 1)
    both = flat[:4096].reshape(64, 64) / n
    p = np.diag(both)
    deviation = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    tied = np.abs(both - np.outer(p, p)) / np.outer(deviation, deviation)
    left, groups = list(range(64)), []
    for _ in range(m):
        group = [left.pop(0)]
        while len(group) < 64 // m:
            best = max(left, key=lambda x: (tied[group, x].sum(), -x))
            left.remove(best)
            group.append(best)
        groups.append(sorted(group))
    return groups


def part(fp: np.ndarray, bits: list[int]) -> np.ndarray:
    """The bits of unsigned fingerprints, packed."""
    out = np.zeros(len(fp), np.uint64)
    for to, bit in enumerate(bits):
        out |= ((fp >> np.uint64(bit)) & np.uint64(1)) << np.uint64(to)
    return out


def by_distance(histogram: np.ndarray, limit: int) -> np.ndarray:
    """How many fingerprints differ from each value of a unit in exactly 0, 1, ... limit bits."""
    out = np.zeros((limit + 1, len(histogram)))
    out[0] = histogram
    index = np.arange(len(histogram))
    for bit in range(int(len(histogram)).bit_length() - 1):
        flipped = out[:, index ^ (1 << bit)]
        out[1:] += flipped[:-1]
    return out


class Plan:
    """Parts, candidate estimates and per-fingerprint thresholds."""

    def __init__(self, groups: list[list[int]], tables: list[np.ndarray], n: int, m: int, limit: int):
        per = 4 // m
        self.units, self.tables, self.n, self.m, self.limit = groups, [t.astype(np.float32) for t in tables], max(n, 1), m, limit
        self.members = [list(range(i * per, (i + 1) * per)) for i in range(m)]
        self.width = 16 * per
        self.masks = [np.asarray([sum(1 << b for b in c) for c in combinations(range(self.width), r)] or [0], np.uint64) for r in range(limit + 1)]
        self.ball = [1, *np.cumsum([len(x) for x in self.masks])[1:].tolist()]

    def values(self, fp: np.ndarray) -> list[np.ndarray]:
        """The fingerprints' values in every part."""
        units = [part(fp, g) for g in self.units]
        return [sum(units[u] << np.uint64(16 * k) for k, u in enumerate(own)) for own in self.members]

    def candidates(self, values: np.ndarray, i: int) -> np.ndarray:
        """Estimated index rows within 0, 1, ... limit bits of the values of part i."""
        own = [self.tables[u][:, ((values >> np.uint64(16 * k)) & np.uint64(0xFFFF)).astype(np.int64)] for k, u in enumerate(self.members[i])]
        exact = own[0]
        for other in own[1:]:
            exact = np.stack([sum(exact[a] * other[d - a] for a in range(d + 1)) / self.n for d in range(self.limit + 1)])
        return np.cumsum(exact, axis=0)

    def thresholds(self, values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Thresholds (parts x fingerprints) of least estimated cost, and that cost."""
        size, low, total = len(values[0]), -self.m, self.limit - self.m + 1
        high = self.limit
        cost = np.full((high - low + 1, size), np.inf)
        cost[-low] = 0
        back = []
        for i, v in enumerate(values):
            cn = self.candidates(v, i)
            own = [np.zeros(size), *(PROBE_COST * self.ball[t] + cn[t] for t in range(self.limit + 1))]
            new, choice = np.full_like(cost, np.inf), np.zeros(cost.shape, np.int8)
            for s in range(low, high + 1):
                for t in range(-1, self.limit + 1):
                    if low <= s - t <= high:
                        c = cost[s - t - low] + own[t + 1]
                        better = c < new[s - low]
                        new[s - low] = np.where(better, c, new[s - low])
                        choice[s - low] = np.where(better, t, choice[s - low])
            back.append(choice)
            cost = new
        s = np.full(size, total)
        found = np.zeros((self.m, size), np.int8)
        for i in reversed(range(self.m)):
            found[i] = back[i][s - low, np.arange(size)]
            s = s - found[i]
        return found, cost[total - low]

    def blocks(self, values: np.ndarray, i: int) -> np.ndarray:
        """Into how many blocks the index rows of a part's values are dealt."""
        own = [self.tables[u][0, ((values >> np.uint64(16 * k)) & np.uint64(0xFFFF)).astype(np.int64)] for k, u in enumerate(self.members[i])]
        return (np.min(own, axis=0) // BLOCK).astype(np.int64) + 1


def plan_for(nodes: DataFrame, n: int, limit: int) -> Plan:
    """Bit groups and unit histograms over all fingerprints; the number of parts of least estimated cost."""
    groups = bit_groups(nodes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.asarray(b.column(0)).view(np.uint64)
            for u, g in enumerate(groups):
                v, c = np.unique(part(fp, g), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(v.astype(np.int64) | (u << 16)), pa.array(c)], ["k", "c"])

    rows = nodes.select("fp").mapInArrow(run, "k bigint, c bigint").groupBy("k").agg(F.sum("c").alias("c"))  # 4 x 65536 rows at most
    tables = np.zeros((4, 65536))
    for r in rows.toLocalIterator():
        tables[r.k >> 16, r.k & 0xFFFF] = r.c
    tables = [by_distance(x, limit) for x in tables]
    plans = [Plan(groups, tables, n, m, limit) for m in (4, 2)]
    rng = np.random.default_rng(7)
    chance = [t[0] / max(t[0].sum(), 1) for t in tables]
    units = [rng.choice(65536, 2000, p=c) if c.sum() else np.zeros(2000, np.int64) for c in chance]
    price = []
    for p in plans:
        values = [sum(units[u].astype(np.uint64) << np.uint64(16 * k) for k, u in enumerate(own)) for own in p.members]
        price.append(p.thresholds(values)[1].mean())
    return plans[int(np.argmin(price))]


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join the same components, at most one per node."""
    if not len(a):
        return a, b
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    if len(a) <= len(nodes):
        return a, b
    u, v = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        while (jumped := new[new] != new).any():
            new = np.where(jumped, new[new], new)
        new = new[label]
        if (new == label).all():
            break
        label = new
    keep = label != np.arange(len(nodes))
    return nodes[keep], nodes[label[keep]]


def links(nodes: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Edges (a, b) that connect fingerprints just as all pairs of distinct ones within limit bits would."""
    spark = nodes.sparkSession
    n = nodes.count()
    shared = spark.sparkContext.broadcast(plan_for(nodes, n, limit))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for b in batches:
            every = np.asarray(b.column(0)).view(np.uint64)
            for at in range(0, len(every), 4096):
                fp = every[at : at + 4096]
                values = p.values(fp)
                deal = (fp * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
                chosen, _ = p.thresholds(values)
                for i, v in enumerate(values):
                    block = (deal % p.blocks(v, i).astype(np.uint64)).astype(np.int64)
                    yield batch(i, v, block, 0, fp)
                    for r in range(limit + 1):
                        who = np.flatnonzero(chosen[i] >= r)
                        for masks in np.array_split(p.masks[r], max(1, len(who) * len(p.masks[r]) // 500_000)) if len(who) else ():
                            value = (v[who][:, None] ^ masks).ravel()
                            own = np.repeat(fp[who], len(masks))
                            times = p.blocks(value, i)
                            block = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                            yield batch(i, np.repeat(value, times), block, 1, np.repeat(own, times))

    def batch(i: int, value: np.ndarray, block: np.ndarray, role: int, fp: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array((value.astype(np.int64) << 2) | i), pa.array((block << 1) | role), pa.array(fp.view(np.int64))], ["k", "block", "fp"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows arrive by value, block and role, index rows first: those of the last block stay for the next batch."""
        held = np.zeros((2, 0), np.int64), np.zeros(0, np.uint64)
        for b in batches:
            k, block, fp = np.asarray(b.column(0)), np.asarray(b.column(1)), np.asarray(b.column(2)).view(np.uint64)
            keys = np.concatenate([held[0], np.stack([k, block >> 1])], axis=1)
            role = np.concatenate([np.zeros(len(held[1]), np.int64), block & 1])
            fp = np.concatenate([held[1], fp])
            new = np.ones(len(fp), bool)
            new[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
            group = np.cumsum(new) - 1
            first = np.flatnonzero(new)
            size = np.bincount(group[role == 0], minlength=len(first))
            probes = np.flatnonzero(role == 1)
            probes = probes[size[group[probes]] > 0]
            each = size[group[probes]]
            total = np.concatenate([[0], np.cumsum(each)])
            at = 0
            while at < len(probes):
                to = max(at + 1, int(np.searchsorted(total, total[at] + 3_000_000, side="right")) - 1)
                own = probes[at:to]
                p = np.repeat(fp[own], each[at:to])
                index = np.arange(total[to] - total[at]) - np.repeat(total[at:to] - total[at], each[at:to]) + np.repeat(first[group[own]], each[at:to])
                q = fp[index]
                distance = np.bitwise_count(p ^ q)
                close = (distance <= limit) & (distance > 0)
                a, c = forest(p[close], q[close])
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(c.view(np.int64))], ["a", "b"])
                at = to
            last = (group == group[-1]) & (role == 0) if len(group) else np.zeros(0, bool)
            held = keys[:, last], fp[last]

    dealt = nodes.select("fp").mapInArrow(rows, "k bigint, block bigint, fp bigint").withColumn("to", F.shiftright("block", 1)).repartition("k", "to").sortWithinPartitions("k", "block").drop("to")
    return dealt.mapInArrow(verify, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, limit: int = LIMIT, size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, own, component_id, component) for every row of docs (doc_id, text).

    Documents within limit bits are linked; a component is named by the smallest doc_id in it. Texts without words,
    null ones included, have fingerprint 0 and are linked like any other. Repeated rows stay; a null doc_id never
    names a component unless all its members' are null. Since rows may share a doc_id, components may share a name:
    component, a fingerprint in it, is theirs alone. own is identity() of the text. Other columns are ignored.
    """
    found = materialize(fingerprints(docs, size), "fingerprints")
    nodes = materialize(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    label = components(links(nodes, limit))
    tied = nodes.join(label, nodes.fp == label.node).select("fp", "least", "component")
    names = tied.groupBy("component").agg(F.min("least").alias("name"))
    named = tied.join(names, "component").select("fp", "name", "component")
    whole = nodes.join(named, "fp", "left").select("fp", F.coalesce("name", "least").alias("component_id"), F.coalesce("component", "fp").alias("component"))
    return found.join(whole, "fp").select("doc_id", "fp", "own", "component_id", "component")


def op2_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    from .common import table

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
