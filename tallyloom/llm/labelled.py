"""Bounded samples of labelled texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import sampled_by, written


def remainder(doc_id: str, of: int) -> Column:
    """crc32 of the key as text, modulo of; a null key gives -1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % of, F.lit(-1)).cast("int")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows: int) -> DataFrame:
    """text and label of at most about rows documents whose label is known and whose key passes learn.

    The sample is drawn from the labels by a hash of the key, so that it can be broadcast and is the same under any
    partitioning; texts are never shuffled. It is written, so that models read it, not all documents, as often as
    they like. A key with both labels is left out, and so are null labels.
    """
    known = labels.where(F.col(label).isNotNull() & learn).groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("other"))
    picked = written(sampled_by(known.where("label = other").select("doc_id", "label"), rows, "doc_id"))
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    return written(texts.select("doc_id", "text", F.col("label").cast("int").alias("label")))
