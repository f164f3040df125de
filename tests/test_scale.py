"""What keeps large inputs within bounds: work that must not grow faster than the input."""

import random
import time

import pyarrow as pa
from pyspark.sql import functions as F

from folioflow.functions import text as T
from folioflow.functions import vietnamese as V
from folioflow.operators import audit, batches, cleaning


def _near_nodes(seed: int = 1, n: int = 60) -> list[tuple]:
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for i in range(n):
        texts.append(" ".join(r.sample(words, r.choice((1, 3, 8, 30, 60)))) if i % 3 == 0 else " ".join(x for x in texts[-1].split() if r.random() > 0.08) + r.choice(("", " new", f" n{i}")))
    return [("d", i, t) for i, t in enumerate(texts)]


def _brute(rows: list[tuple], threshold: float) -> list[tuple]:
    first: dict = {}
    for doc, i, t in rows:
        first.setdefault(frozenset(t.lower().split()), (doc, i))
    found = sorted((i, w) for w, (_, i) in first.items() if w)
    return [(a, b, round(len(x & y) / len(x | y), 3)) for k, (a, x) in enumerate(found) for b, y in found[k + 1 :] if len(x & y) / len(x | y) >= threshold - 1e-12]


def test_pairs_are_all_pairs(spark):
    for threshold in (0.8, 0.85, 0.5):
        rows = _near_nodes()
        got = audit.duplicate_pairs(spark.createDataFrame(rows, "doc string, idx bigint, text string"), threshold)
        assert sorted((r.a, r.b, r.similarity) for r in got.collect()) == _brute(rows, threshold)


def test_cells_of_many_pairs_are_cut(spark, monkeypatch):
    monkeypatch.setattr(audit, "COMPARED", 5)
    rows = [("d", i, " ".join(f"w{k}" for k in range(50) if k != i)) for i in range(30)]
    got = audit.duplicate_pairs(spark.createDataFrame(rows, "doc string, idx bigint, text string"))
    assert sorted((r.a, r.b, r.similarity) for r in got.collect()) == _brute(rows, 0.8)


def test_one_shared_rare_word_makes_no_comparison(spark):
    rows = [("d", i, "rare " + " ".join(f"w{i}x{k}" for k in range(30))) for i in range(40)]
    assert audit._candidates(spark.createDataFrame(rows, "doc string, idx bigint, text string"), 0.8).count() == 0


def test_counts_of_merged_nodes_are_those_of_merging(spark):
    r = random.Random(3)
    rows = [(d, i, r.choice("ab"), r.choice(("", " \n", "\x1c", "short", "x" * 90, "y" * 700, None)), 1, 1) for d in ("d", "e", "f") for i in range(40)] + [("g", 0, "a", " ", 1, 1)]
    nodes = spark.createDataFrame(rows, "doc string, idx bigint, section string, text string, page_start int, page_end int")
    want = {x.doc: x["count"] for x in audit.merge_short(nodes).groupBy("doc").count().collect()}
    assert {x.doc: x.final_count for x in audit.merged_counts(nodes, audit.document_minimum(nodes)).collect()} == want


def _seconds(spark, change, lines: list[str]) -> float:
    docs = spark.createDataFrame([("\n".join(lines),)], "text string").select(F.length(change(F.col("text"))).alias("n"))
    docs.collect()
    began = time.time()
    docs.collect()
    return time.time() - began


def test_long_texts_are_cleaned_in_linear_time(spark):
    """Eight times the lines take about eight times as long, not 64 times."""
    for change in (lambda t: V.join_broken_lines(t, True), T.drop_repeated_lines):
        lines = [f"Line {i // 2} that stands here twice and has a number of its own, " + "x" * (i % 7) for i in range(80_000)]
        assert _seconds(spark, change, lines) < 30 * max(0.1, _seconds(spark, change, lines[:10_000]))


def test_headings_of_long_nodes_are_counted_in_linear_time(spark):
    one = lambda n: spark.createDataFrame([("\n".join(["a", "# b"] * n), [])], "text string, actions array<string>")
    took = {}
    for n in (1000, 8000):
        found = cleaning._headings(one(n)).select(F.size("actions").alias("n"))
        found.collect()
        began = time.time()
        assert found.first().n == n
        took[n] = time.time() - began
    assert took[8000] < 30 * max(0.1, took[1000])


def test_workers_hold_few_texts_at_once():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * 1000] * 50 + ["y" * 9000, None, ""]})
    found = list(batches.pieces(batch, "text", 4000))
    assert [p.num_rows for p in found] == [4] * 12 + [2, 1, 2]
    assert pa.Table.from_batches(found).column("text").to_pylist() == batch.column("text").to_pylist()
