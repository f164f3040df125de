"""Functions and queries do the whole job: cases that a first version left out."""

from folioflow.functions import context
from folioflow.plans import catalog
from pyspark.sql import functions as F


def test_node_ids_keep_all_digits(spark):
    rows = spark.createDataFrame([(0,), (1000,), (10000,), (10009,), (None,)], "i bigint").select(context.node_id(F.lit("d"), F.col("i")).alias("x"))
    assert [r.x for r in rows.collect()] == ["d_node_0000", "d_node_1000", "d_node_10000", "d_node_10009", "d"]


def test_node_flags_read_whole_texts(spark, tmp_path):
    late = "real line\n" * 50 + catalog.PHRASES
    spark.createDataFrame([(i, late if i < 4 else "real line\n" * 50) for i in range(8)], "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = {r.doc_id: r for r in catalog.node_flags(spark, str(tmp_path)).collect()}
    assert [found[i].is_administrative for i in range(8)] == [True] * 5 + [False] * 3
    assert [found[i].is_toc and found[i].is_toc_document for i in range(8)] == [False, True, False, False] * 2
    assert [found[i].is_name_list for i in range(8)] == [False, False, True, False] * 2
