"""The stages that look at one document at a time, over a stream; an extension, since the batch plans need no state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean, tokens_estimated


def clean_stream(docs: DataFrame) -> DataFrame:
    """A stream of documents (doc, text) cleaned, with their estimated tokens; stateless."""
    return docs.select("doc", clean(F.col("text")).alias("text")).withColumn("tokens", tokens_estimated(F.col("text")))


def first_copies(docs: DataFrame, time: str, within: str = "1 hour") -> DataFrame:
    """A stream of (doc, text, time) without texts that came before; state is dropped `within` after their time."""
    return docs.withColumn("_content", F.xxhash64("text")).withWatermark(time, within).dropDuplicatesWithinWatermark(["_content"]).drop("_content")
