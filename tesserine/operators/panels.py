"""Gene panels: by variance, from gene sets, and against a matrix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesserine.operators.profile import gene_state


def hvg_panel(long: DataFrame, n: int) -> DataFrame:
    """(pos, gene_id): the n genes of largest log1p variance."""
    top = gene_state(long).orderBy(F.col("variance").desc(), "gene_id").limit(n)
    return top.select((F.row_number().over(Window.orderBy(F.col("variance").desc(), "gene_id")) - 1).alias("pos"), "gene_id", "variance")  # n rows


def resolve_panel(panel: DataFrame, genes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(panel genes of the matrix in panel order, panel genes that it lacks), compared as text."""
    known = genes.select(F.col("gene_id").cast("string").alias("gene_id")).distinct()
    want = panel.withColumn("gene_id", F.col("gene_id").cast("string"))
    return want.join(known, "gene_id", "left_semi").orderBy("pos"), want.join(known, "gene_id", "left_anti")


def symbols(genes: DataFrame, names: DataFrame) -> DataFrame:
    """Genes with their symbol, null if unknown."""
    return genes.join(names.groupBy("gene_id").agg(F.min_by("symbol", "pos").alias("symbol")), "gene_id", "left")


def ids_of_symbols(wanted: DataFrame, names: DataFrame) -> DataFrame:
    """Symbols with their gene id; the first row of a symbol counts."""
    return wanted.join(names.groupBy("symbol").agg(F.min_by("gene_id", "pos").alias("gene_id")), "symbol")


def union_of_sets(sets: DataFrame, names: Sequence[str]) -> DataFrame:
    """(symbol, pos) of the named sets' genes in first-seen order; unknown names are refused.

    sets: set_name, set_pos, pos, symbol.
    """
    have = {r[0] for r in sets.where(F.col("set_name").isin(*names)).select("set_name").distinct().collect()}
    if lost := sorted(set(names) - have):
        raise ValueError(f"unknown gene sets: {', '.join(lost)}")
    first = sets.where(F.col("set_name").isin(*names)).groupBy("symbol").agg(F.min(F.struct("set_pos", "pos")).alias("first"))
    return first.select("symbol", F.col("first.set_pos").alias("set_pos"), F.col("first.pos").alias("pos"))


def panel_from_sets(sets: DataFrame, names: Sequence[str], symbol_table: DataFrame, genes: DataFrame) -> DataFrame:
    """The panel of the named sets' genes that the matrix holds; an empty one is an error."""
    mapped = ids_of_symbols(union_of_sets(sets, names), symbol_table)
    kept = mapped.join(genes.select("gene_id").distinct(), "gene_id", "left_semi")
    if not kept.take(1):
        raise ValueError("no gene of the sets is in the matrix")
    return kept
