"""Exact deduplication by 128-bit content hash, with a comparison of bytes inside each hash group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserine.llm.common import ascii_lower, join_hot, materialize, unused


def content_hash(text: Column) -> Column:
    """The 128-bit hash that groups texts."""
    return F.unhex(F.md5(text))


def exact_dedup(docs: DataFrame, *, keep: str = "min", hash_of=content_hash) -> DataFrame:
    """One row a document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; a null text counts as empty. Of equal texts the smallest
    (keep="min") or largest (keep="max") doc_id stays; rows with the same doc_id and text all carry its decision.
    Columns other than doc_id and text are ignored; an empty table gives an empty result. A null doc_id is smaller
    than any other.

    Rows are grouped by (hash, text): the hash deals them out, equality of the text bytes decides, so texts whose
    hashes collide form two groups. Copies are merged before the shuffle, so a group of any size sends one row a task.
    Decisions go back by (hash, sha256), dealt by join_hot.
    """
    base, classes = _classes(docs, keep, hash_of)
    total = classes.agg(F.coalesce(F.sum("group_size"), F.lit(0))).first()[0]
    rows = base.select("doc_id", "_hash", F.sha2("_text", 256).alias("text_sha256"))
    out = join_hot(rows, classes, ["_hash", "text_sha256"], "group_size", total)
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def _classes(docs: DataFrame, keep: str, hash_of=content_hash) -> tuple[DataFrame, DataFrame]:
    """(doc_id, _text, _hash) of all rows; (_hash, text_sha256, keep_id, group_size) of all distinct texts."""
    base = docs.select("doc_id", ascii_lower(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_text")).select(
        "doc_id", "_text", hash_of(F.col("_text")).alias("_hash")
    )
    first = {"min": F.min, "max": F.max}[keep]
    order = F.struct(F.col("doc_id").isNotNull().alias("given"), F.col("doc_id").alias("id"))
    texts = base.groupBy("_hash", "_text").agg(first(order).alias("_first"), F.count("*").alias("group_size"))
    classes = texts.select("_hash", F.sha2("_text", 256).alias("text_sha256"), F.col("_first.id").alias("keep_id"), "group_size")
    classes = classes.groupBy("_hash", "text_sha256").agg(
        F.first("keep_id").alias("keep_id"), F.first("group_size").alias("group_size"), F.count("*").alias("_texts")
    )
    alone = F.when(F.col("_texts") > 1, F.raise_error(F.lit("two texts share both hashes"))).otherwise(F.col("group_size"))
    return base, materialize(classes.select("_hash", "text_sha256", "keep_id", alone.cast("long").alias("group_size")), "exact")


def drop_copies(docs: DataFrame, *, keep: str = "max") -> DataFrame:
    """The rows of docs that stay, with their columns: of equal texts the one with the smallest (largest) doc_id.

    Rows alike in doc_id and normalised text are one document: the row with the smallest text as it stands stays (a
    null is smaller than any other; of rows with one text, any). A null doc_id counts as the smallest. An empty table
    gives an empty result.
    """
    _, classes = _classes(docs, keep)
    text = ascii_lower(F.coalesce(F.col("text").cast("string"), F.lit("")))
    names = [unused(docs, c) for c in ("hash", "sha", "keep", "size")]
    h, sha, id_, size = map(F.col, names)
    stays = classes.select("_hash", "text_sha256", "keep_id", "group_size").toDF(*names)
    kept = docs.join(stays, (content_hash(text) == h) & (F.sha2(text, 256) == sha) & F.col("doc_id").eqNullSafe(id_))
    alone = kept.where(size == 1).select(*docs.columns)
    full = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    several = kept.where(size > 1).groupBy(h, sha).agg(F.min_by(full, F.struct(F.col("text").cast("string"))).alias("_row"))
    return alone.unionByName(several.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns]))
