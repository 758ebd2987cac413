"""Leakage-safe splits of patients: nested folds, single draws, digests and samples."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesserine.functions import labels as L

_PREFIX = 3  # hex digits of the order text that cut a stratum into pieces


def dealt(patients: DataFrame, seed: int, by: Sequence[str] = ("field",), name: str = "place") -> DataFrame:
    """patients with their place from 0 in the order (stratum, md5(seed|patient), patient) of each field.

    Places come from counts of (stratum, first digits of the text) and a window inside these pieces, so a field may
    have any number of patients.
    """
    rows = patients.withColumn("_o", L.fold_order(seed, F.col("patient_id"))).withColumn("_p", F.substring("_o", 1, _PREFIX))
    pieces = rows.groupBy(*by, "stratum", "_p").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy("stratum", "_p").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(*by, "stratum", "_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_c"))
    inside = Window.partitionBy(*by, "stratum", "_p").orderBy("_o", "patient_id")
    return rows.join(pieces, [*by, "stratum", "_p"]).select(*patients.columns, (F.col("_c") + F.row_number().over(inside) - 1).alias(name))


def nested_cv(patients: DataFrame, n_outer: int, n_inner: int, seed: int) -> DataFrame:
    """(field, outer_fold, inner_fold, split_version, patient_id, category): test fixed by outer fold.

    Patients are dealt in turn along the stratum-sorted order, so each stratum is even within one. The inner folds deal
    the rest of each outer fold again with seed + 1 + outer.
    """
    if n_outer < 2 or n_inner < 1:
        raise ValueError("nested CV needs n_outer >= 2 and n_inner >= 1")
    outer = dealt(patients, seed).withColumn("_test", F.pmod("place", F.lit(n_outer)).cast("int")).drop("place")
    out = None
    for k in range(n_outer):
        rest = dealt(outer.where(F.col("_test") != k), seed + 1 + k).withColumn("_val", F.pmod("place", F.lit(max(n_inner, 2))).cast("int"))
        axis = F.explode(F.sequence(F.lit(0), F.lit(n_inner - 1))).alias("inner_fold")
        inner = rest.select("field", F.lit(k).alias("outer_fold"), axis, "patient_id", "_val").withColumn("category", F.when(F.col("_val") == F.col("inner_fold"), "validate").otherwise("fit")).drop("_val")
        test = outer.where(F.col("_test") == k).select("field", F.lit(k).alias("outer_fold"), axis, "patient_id", F.lit("test").alias("category"))
        part = inner.unionByName(test)
        out = part if out is None else out.unionByName(part)
    name = L.split_name("field", F.col("outer_fold"), F.col("inner_fold"))
    return out.select("field", "outer_fold", "inner_fold", name.alias("split_version"), "patient_id", "category")


def all_test(patients: DataFrame) -> DataFrame:
    """Every valid patient of each field in test (L2)."""
    return patients.select(F.concat(F.lit("all_test_"), "field").alias("split_version"), "patient_id", F.lit("test").alias("category"))


def all_predict(patients: DataFrame) -> DataFrame:
    """Every patient once in predict (L2)."""
    return patients.select("patient_id").distinct().select(F.lit("all_predict").alias("split_version"), "patient_id", F.lit("predict").alias("category"))


def draw(patients: DataFrame, seed: int, test: float, validate: float = 0.0, by: Sequence[str] = ("field",)) -> DataFrame:
    """A stratified draw: in each stratum the first share goes to test, the next to validate, the rest to fit (L3)."""
    rows = patients.withColumn("_o", L.fold_order(seed, F.col("patient_id")))
    sized = rows.groupBy(*by, "stratum").agg(F.count("*").alias("_n"))
    place = dealt(patients, seed, [*by, "stratum"])
    n_test, n_val = F.round(F.col("_n") * test), F.round(F.col("_n") * validate)
    category = F.when(F.col("place") < n_test, "test").when(F.col("place") < n_test + n_val, "validate").otherwise("fit")
    return place.join(F.broadcast(sized), [*by, "stratum"]).select(*by, "patient_id", category.alias("category"))


def _chunks(by: Sequence[str], most: int):
    """Sorted rows to runs of codes of one group and stage, joined by commas; a run has at most `most` codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, at, last, held = TaskContext.get().partitionId(), 0, None, []

        def send(row: dict) -> pa.RecordBatch:
            keys = {c: pa.array([row[c]], batch.schema.field(c).type) for c in (*by, "category")}
            return pa.record_batch(keys | {"_pid": pa.array([pid], pa.int32()), "_at": pa.array([at], pa.int32()), "_codes": pa.array([",".join(held)], pa.string())})

        for batch in batches:
            for row in batch.to_pylist():
                key = tuple(row[c] for c in (*by, "category"))
                if held and (key != last[0] or len(held) >= most):
                    yield send(last[1])
                    at, held = at + 1, []
                last = (key, row)
                held.append(row["_code"])
        if held:
            yield send(last[1])

    return run


def _streamed(by: Sequence[str]):
    """Runs in order to the digest of each group: a run at a time is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        group = stage = state = schema = None
        for batch in batches:
            schema = batch.schema
            for row in batch.to_pylist():
                key = tuple(row[c] for c in by)
                if state is None or key != group:
                    if state is not None:
                        done.append((*group, state.hexdigest()[:16]))
                    group, stage, state = key, None, hashlib.sha256()
                if row["category"] != stage:
                    state.update(f"{'' if stage is None else ';'}{row['category']}:".encode())
                else:
                    state.update(b",")
                stage = row["category"]
                state.update(row["_codes"].encode())
        if state is not None:
            done.append((*group, state.hexdigest()[:16]))
            yield pa.record_batch({c: pa.array([d[k] for d in done], schema.field(c).type) for k, c in enumerate(by)} | {"split_hash": pa.array([d[-1] for d in done], pa.string())})

    return run


def split_digest(split: DataFrame, by: Sequence[str] = ("field",), *, most: int = 10_000) -> DataFrame:
    """First 16 hex digits of sha256 over stage:codes;... with stages and codes sorted (L4).

    Rows are range-partitioned and sorted; each partition joins runs of at most `most` codes, and one stream a split hashes
    these in order, so no task holds a split's codes. Rows without a code or category are left out."""
    rows = split.select(*by, "category", F.col("patient_id").cast("string").alias("_code")).where(F.col("_code").isNotNull() & F.col("category").isNotNull())
    order = [*by, "category", "_code"]
    keys = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in by)
    parts = int(split.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_chunks(by, most), f"{keys}{', ' if by else ''}category string, _pid int, _at int, _codes string")
    dealt = runs.repartition(*by) if by else runs.repartition(1)
    return dealt.sortWithinPartitions(*by, "category", "_pid", "_at").mapInArrow(_streamed(by), f"{keys}{', ' if by else ''}split_hash string")


def population(split: DataFrame, version: str) -> DataFrame:
    """The patients of one stored version in fit, validate or test."""
    return split.where((F.col("split_version") == version) & F.col("category").isin("fit", "validate", "test")).select("patient_id").distinct()


def fit_set(split: DataFrame | None = None, version: str | None = None, codes: DataFrame | None = None) -> DataFrame:
    """The patients to fit on: a stored split's, or explicit codes, exactly one of them."""
    if (split is None) == (codes is None):
        raise ValueError("give a stored split or explicit codes")
    if codes is not None:
        return codes.select("patient_id").distinct()
    return split.where((F.col("split_version") == version) & (F.col("category") == "fit")).select("patient_id")


def first_slides(slides: DataFrame, n: int, position: str) -> DataFrame:
    """The first n slides in manifest order."""
    return slides.orderBy(position).limit(n)


def head_per_class(df: DataFrame, n: int, by: str, order: str) -> DataFrame:
    """The first n rows of each class by id."""
    w = Window.partitionBy(by).orderBy(order)
    return df.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= n).drop("_k")


def bags(tiles: DataFrame, size: int, seed: int, key: str = "slide_id", tile: str = "tile_idx") -> DataFrame:
    """`size` tiles a slide: a hash-ordered sample, and small slides repeat theirs in turn."""
    w = Window.partitionBy(key).orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string"), F.col(tile).cast("string"))), tile)
    kept = tiles.withColumn("_k", F.row_number().over(w) - 1).withColumn("_n", F.count("*").over(Window.partitionBy(key))).where(F.col("_k") < size)
    turns = F.sequence(F.col("_k"), F.lit(size - 1), F.least("_n", F.lit(size)).cast("int"))
    return kept.withColumn("bag_pos", F.explode(turns)).drop("_k", "_n")


def restrict_import(imported: DataFrame, shared: DataFrame) -> DataFrame:
    """A foreign split on the shared patients."""
    return imported.join(shared.select("patient_id").distinct(), "patient_id", "left_semi")


def tile_grid(slides: DataFrame, tile: int, mask: DataFrame | None = None, least: float = 0.5) -> DataFrame:
    """Whole tiles of each slide; with a mask of cells (slide_id, cx, cy, cover) only those covered enough."""
    axis = lambda c: F.explode(F.when(F.col(c) >= tile, F.sequence(F.lit(0), (F.col(c) / tile).cast("int") - 1)).otherwise(F.array().cast("array<int>")))
    grid = slides.withColumn("tx", axis("width")).withColumn("ty", axis("height")).select("slide_id", "tx", "ty")
    if mask is None:
        return grid
    cover = mask.groupBy("slide_id", F.col("cx").alias("tx"), F.col("cy").alias("ty")).agg(F.avg("cover").alias("cover"))
    return grid.join(cover, ["slide_id", "tx", "ty"]).where(F.col("cover") >= least)
