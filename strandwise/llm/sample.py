"""Bounded samples of labelled rows, for fitting classifiers only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from strandwise.operators.skew import small

#: Length of the texts that a classifier is fitted on, whole: shorter ones teach nothing, longer ones are left to those who can hold them.
LEAST_CHARS, MOST_CHARS = 41, 20_000


def labelled_sample(docs: DataFrame, doc_id: str, text: str, label, per_label: int) -> list[tuple]:
    """(label, text) of the `per_label` documents of each label with the lowest id hash, in a fixed order; texts are whole.

    Drawn from the documents with LEAST_CHARS to MOST_CHARS characters; so at most labels x per_label x MOST_CHARS characters
    reach the driver. The ids are chosen first: each task keeps its lowest `per_label` of a label, and only those meet.
    Then one scan fetches their texts. Null labels are left out.
    """
    docs = docs.where(F.length(text).between(LEAST_CHARS, MOST_CHARS))
    key = F.struct(F.xxhash64(doc_id).alias("h"), F.col(doc_id).cast("string").alias("i"))
    named = docs.select(F.col(doc_id).alias("id"), label.alias("label"), key.alias("key")).where("label is not null")
    first = named.withColumn("r", F.row_number().over(W.partitionBy("label").orderBy("key"))).where(F.col("r") <= per_label).select("id", "label", "key").distinct()
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(small(first), "id").select("label", "key", "text").distinct().collect()
    return [(r["label"], r["text"]) for r in sorted(rows, key=lambda r: (r["label"], r["key"], r["text"]))]
