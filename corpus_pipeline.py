"""The corpus pipeline: language ID, line dedup, near-duplicate removal, decontamination and packing.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last return the columns of documents. Texts
that are only null or empty, null ids and empty tables have the results that the operators' docstrings state.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm import decontam, langid, linededup, packing, simhash
from folioflow.llm.common import broadcast_if_small, discard, identity, kept_alone, materialize, table


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language identification does not reject; null labels are filled with its prediction."""
    model = langid.fit(docs.where(~langid.held_out("doc_id")))
    found = langid.identify(docs, model, rows=True).where(~F.col("rejected"))
    new = {"text": F.col("text"), "lang": F.coalesce("row.lang", "lang_pred")}
    return found.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat or nearly repeat earlier ones; all documents stay."""
    found = linededup.dedup_lines(docs)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("bigint")}
    return found.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component: with the smallest doc_id, null last; rows may share a doc_id and stay if their components differ."""
    found = simhash.near_duplicates(docs)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "own")).alias("x")
    kept = materialize(found.groupBy("component").agg(least).select("x.doc_id", "x.own"), "kept")
    rows = _matching(_rows(docs), kept, ["doc_id", "own"], "left_semi")
    again = found.groupBy("doc_id", "own").agg(F.count("*").alias("n")).where("n > 1").select("doc_id", "own")
    again = materialize(again, "again")
    if not again.isEmpty():  # of rows that share both id and text one stays; only they are shuffled
        once = _matching(rows, again, ["doc_id", "own"], "left_semi").groupBy("doc_id", "own").agg(F.first("row").alias("row"))
        rows = _matching(rows, again, ["doc_id", "own"], "left_anti").unionByName(once)
    return rows.select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark: a single window of it in the text makes a document go."""
    found = decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    leaks = materialize(found.where("n_hit > 0").select("own").distinct(), "leaks")
    return _matching(_rows(docs), leaks, ["own"], "left_anti").select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents with their places in sequences of at most 4096 tokens."""
    return packing.pack_documents(docs)


def _rows(docs: DataFrame) -> DataFrame:
    """(row, doc_id, own): a row's columns, whatever their names, are only inside row; own is identity() of the text."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), identity(F.col("text").cast("string")).alias("own"))


def _matching(rows: DataFrame, wanted: DataFrame, keys: list[str], how: str) -> DataFrame:
    """rows joined with a table of keys (null ids are equal), which is broadcast only if its measured size allows."""
    wanted = broadcast_if_small(wanted.select(*(F.col(k).alias(f"wanted_{k}") for k in keys)), 40)
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"wanted_{k}")) for k in keys))
    return rows.join(wanted, same, how)


STAGES = [
    ("language_id", keep_known_languages),
    ("line_dedup", drop_repeated_lines),
    ("simhash_dedup", keep_one_of_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]
#: Nearest-centroid classification, fingerprint components and tokenisation are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents, each result written as Parquet and read again; what a stage wrote besides goes with it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        last, docs = docs, kept_alone(spark, partial(stage, spark, docs, sf_dir), name)
        if hasattr(last, "scratch"):
            discard(last)
    return STAGES[-1][1](spark, docs, sf_dir)
