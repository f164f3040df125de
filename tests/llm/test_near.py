from folioflow.llm import decontam

DOCS = "doc_id bigint, text string"


def test_near_matches_query(spark, tmp_path):
    p = [f"p{i}" for i in range(13)]
    changed = {1: p, 2: [*p[:6], "extra", *p[6:]], 3: [p[1], p[0], *p[2:]], 4: [*p[:11], p[12], p[11]], 5: [*p[:6], "one", "two", "three", *p[6:]]}
    spark.createDataFrame([(d, " ".join(w)) for d, w in changed.items()] + [(6, "p0 " * 40)], DOCS).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([("a", " ".join(p))], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    found = {r.doc_id: (r.n_hit, r["items"], r.near_items) for r in decontam.op1_near_matches(spark, str(tmp_path)).collect()}
    assert found == {1: (13, ["a"], []), 2: (0, [], ["a"]), 3: (0, [], ["a"]), 4: (0, [], ["a"]), 5: (0, [], []), 6: (0, [], [])}


def test_equal_segments_stay_apart(spark):
    docs = spark.createDataFrame([(1, "p0 p1 x")], DOCS).coalesce(1)
    docs = docs.unionByName(docs)
    items = spark.createDataFrame([("a", "p0 p1"), ("b", "x")], "item_id string, text string")
    for block in (1 << 20, 1):
        assert [(r.n_hit, r["items"]) for r in decontam.decontaminate(docs, items, block_bytes=block).collect()] == [(3, ["a", "b"])] * 2
