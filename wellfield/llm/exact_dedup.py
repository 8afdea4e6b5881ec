"""Exact dedup with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii


def exact_dedup(docs: DataFrame, *, keep: str = "largest", content_hash=F.md5) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are, once A-Z is lower-cased. Rows group by a 128-bit content hash together with
    the normalised bytes themselves, so a collision of `content_hash` never joins different texts. Equal texts of one
    map task shrink to one row before the shuffle; only (hash, digest) keys go into the join back, which adaptive
    execution splits where a group is hot.

    A null text counts as empty; texts are hashed and compared whole, however long. Of equal texts the row with the largest (or smallest) doc_id stays; a null doc_id
    loses to any other, and stays if its group has no other. Rows that repeat the id that stays are all marked kept.
    An empty table gives no rows; other columns of docs are ignored.
    """
    text = lower_ascii(F.coalesce(F.col("text"), F.lit("")))
    rows = docs.select("doc_id", text.alias("norm")).select("doc_id", "norm", content_hash(F.col("norm")).alias("h"))
    best: Column = F.max("doc_id") if keep == "largest" else F.min("doc_id")
    groups = rows.groupBy("h", "norm").agg(best.alias("keep_id"), F.count("*").alias("group_size"))
    groups = groups.select("h", F.sha2("norm", 256).alias("text_sha256"), "keep_id", "group_size")
    keyed = rows.select("doc_id", "h", F.sha2("norm", 256).alias("text_sha256"))
    joined = keyed.join(groups, ["h", "text_sha256"])
    return joined.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
