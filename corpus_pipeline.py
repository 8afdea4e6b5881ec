"""A training corpus from raw documents: language, exact copies, near copies, source mix, tokens.

Every stage works on whole texts and on all rows that the one before kept. The first four return the columns of their
docs, whatever these are; columns of their own take names that docs has not. An empty table passes through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellfield.llm.byte_bpe import digests
from wellfield.llm.common import Scratch, first_words, fresh, lower_ascii
from wellfield.llm.exact_dedup import exact_dedup
from wellfield.llm.language_id import UNKNOWN, held_out, identify, profiles
from wellfield.llm.mixing import mix_sources
from wellfield.llm.ngram_jaccard import near_duplicates

#: SQL does not express the language profiles, nor the drawn order of the mix.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told (a null text, or one without a letter) go; a null `lang` of the others
    becomes the predicted language, a given one stays. Languages are learned from rows that have both a text and a lang
    and are not held out; without such rows nothing can be told, and all go. Repeated rows are rows of their own, ties
    between languages go to the first by name, and long texts are read whole."""
    pred, score = fresh(docs, "lang_pred", "score")
    known = profiles(docs.where(~held_out(F.col("doc_id"))))
    found = identify(docs, known, names=(pred, score)).where(F.col(pred) != UNKNOWN)
    return found.withColumn("lang", F.coalesce("lang", pred)).select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts (A-Z lower-cased; null is empty) stays: that with the largest id, a null id
    before all others; of rows that repeat it, the first by the other plain columns. Repeats shrink to one on the map
    side, so a group of any size never meets in one task. Texts are compared whole, however long."""
    kept = exact_dedup(docs).where("kept").select(_id_and_text("doc_id", F.col("text_sha256")).alias("pick")).distinct()
    text = F.sha2(lower_ascii(F.coalesce(F.col("text"), F.lit(""))), 256)
    plain = [f.name for f in docs.schema if isinstance(f.dataType, T.AtomicType)]
    first = F.min(F.struct(*plain)) if plain == docs.columns else F.min_by(F.struct(*docs.columns), F.struct(*plain))
    rows = docs.groupBy(_id_and_text("doc_id", text).alias("pick")).agg(first.alias("row"))
    return rows.join(kept, "pick", "left_semi").select("row.*").select(*docs.columns)


def _id_and_text(doc_id: str, digest: Column) -> Column:
    return F.concat_ws(" ", F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), digest)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near duplicates stays: that with the smallest id, a null id after all others; of
    several, the first in docs. Texts without words are alone; long ones are read whole. Rows are numbered for that, as ids may repeat or be null."""
    (row,) = fresh(docs, "row")
    rows = Scratch(spark, "near").put("numbered", docs.withColumn(row, F.monotonically_increasing_id()))
    found = near_duplicates(rows.select(F.col(row).alias("doc_id"), "text")).select(F.col("doc_id").alias(row), "component_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", row)
    first = found.join(rows.select(row, "doc_id"), row).groupBy("component_id").agg(F.min(order).alias("first"))
    return rows.join(first.select(F.col("first")[row].alias(row)), row, "left_semi").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes: a document as often as it is taken whole, and its first words where the last pass
    over its source ends inside it. Rows whose text has no word go, as nothing is taken of them. A null source is a
    source of its own; rows with one id are drawn together, in the order of their sizes; n_chars follows the text."""
    row, size, passes, part, copy = fresh(docs, "row", "size", "passes", "part_words", "copy")
    scratch = Scratch(spark, "mixed")
    rows = scratch.put("numbered", docs.withColumn(row, F.monotonically_increasing_id()))
    taken = mix_sources(rows, carry=(row,)).select(row, F.col("size").alias(size), F.col("passes").alias(passes), F.col("part_words").alias(part)).where(F.col(size) > 0)
    rows = rows.join(scratch.put("taken", taken), row)
    times = F.col(passes) + (F.col(part) >= F.col(size)).cast("long")
    whole = rows.withColumn(copy, F.explode(F.sequence(F.lit(0).cast("long"), times))).where(F.col(copy) < times)
    cut = rows.where((F.col(part) > 0) & (F.col(part) < F.col(size))).withColumn("text", first_words(F.col("text"), F.col(part)))
    mixed = whole.select(*docs.columns).union(cut.select(*docs.columns))
    return mixed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's tokens by number and digest, and the digest of what they decode to. A null text has no tokens; equal
    rows give equal results."""
    return digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


STAGES = [("language_id", language), ("exact_dedup", exact), ("ngram_jaccard", near), ("mix_sources", mix), ("byte_bpe", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each on what the one before wrote; the last one's rows."""
    scratch, docs = Scratch(spark, "pipeline"), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.put(name, stage(spark, docs, sf_dir))
        if k:
            scratch.drop(STAGES[k - 1][0])
    return docs
