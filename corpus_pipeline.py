"""A corpus pipeline over `documents`: language ID, exact dedup, near dedup, secret scan, packing.

Each stage works on all documents that the stage before kept. The first four return the columns of documents; the last
returns the pieces of the packed sequences (doc_id, piece, start, length, ids_crc32, sequence_id, offset).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserine.llm.common import discard, materialize, prepare, unused
from tesserine.llm.exact_dedup import drop_copies
from tesserine.llm.jaccard_join import Threshold, one_of_each
from tesserine.llm.language_id import evidence, fit_profiles, least_scores, weigh
from tesserine.llm.packing import pack
from tesserine.llm.secrets import redact


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in a learned language go on, under the language that they are in.

    The cosine with the nearest prototype decides: it must reach the bound that `least_scores` takes from all labelled
    rows with as many distinct n-grams. A lang whose own cosine stays below the bound gives way to the predicted one,
    which a null lang takes too. Texts without a letter are rejected, null and empty ones with them. Where no row has a
    lang, nothing is learned: every text with a letter goes on, under "und". Repeated rows are judged each; a null doc_id
    makes no difference.
    """
    prepare(spark)
    name = unused(docs, "seen")
    seen = weigh(docs, fit_profiles(docs), name)  # judged twice, for the bounds and for the rows: texts are not written for it
    s = F.col(name)
    least = F.element_at(F.array(*[F.lit(b).cast("double") for b in least_scores(seen, name)]), evidence(s["grams"]) + 1)
    found = seen.where((s["grams"] > 0) & (least.isNull() | (s["score"] >= least)))
    stays = least.isNull() | s["own"].isNull() | (s["own"] >= least)
    return found.withColumn("lang", F.coalesce(F.when(stays, F.col("lang")), s["lang_pred"])).select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased, null as empty) the document with the largest id goes on.

    A null id is the smallest. Of rows alike in id and text one goes on, as `drop_copies` says.
    """
    prepare(spark)
    return drop_copies(docs, keep="max")


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a likeness of 0.8 in five-word shingles the smallest id goes on.

    Texts without words are linked with nothing and go on, as do rows without an id. Rows that share an id are one
    document: all of them go on or none.
    """
    prepare(spark)
    return one_of_each(docs, words=5, threshold=Threshold(80, 100))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents go on, with secrets masked; a null text stays null, repeated rows are masked each."""
    prepare(spark)
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences of at most 1024 tokens.

    A null or empty text is one piece of the end id; repeated rows are packed each, under their own doc_id or null.
    """
    prepare(spark)
    return pack(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("jaccard_join", jaccard_join),
    ("secret_scan", secret_scan),
    ("packing", packing),
]
ORACLE_SQL = None  # learned profiles, near-duplicate groups and token ids are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        kept = materialize(stage(spark, docs, sf_dir), name)
        discard(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
