"""Streaming jobs: running tile pooling, running gene correlation, and trial rows as they land."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tesserine.operators import compare
from tesserine.operators.rollup import tiles_to_slides


def tile_stream(spark: SparkSession, path: str, schema, *, files_per_trigger: int = 100) -> DataFrame:
    """Tiles as files land in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def running_slides(tiles: DataFrame) -> DataFrame:
    """Slides pooled from the tiles so far, in update mode."""
    return tiles_to_slides(tiles)


def gene_sums(pairs: DataFrame) -> DataFrame:
    """The six sums a gene from which Pearson follows; they add up over batches (R2)."""
    x, y = F.col("pred"), F.col("label")
    rows = pairs.where(x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y))
    return rows.groupBy("gene_id").agg(
        F.count("*").alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"), F.sum(x * y).alias("sxy"), F.sum(x * x).alias("sxx"), F.sum(y * y).alias("syy")
    )


def pearson_of_sums(sums: DataFrame) -> DataFrame:
    """Pearson by gene; genes of fewer than two patients or without variance are dropped (R2)."""
    n, sx, sy = F.col("n").cast("double"), F.col("sx"), F.col("sy")
    vx, vy = n * F.col("sxx") - sx * sx, n * F.col("syy") - sy * sy
    rows = sums.where((F.col("n") >= 2) & (vx > 1e-9) & (vy > 1e-9))
    return rows.select("gene_id", "n", ((n * F.col("sxy") - sx * sy) / F.sqrt(vx * vy)).alias("pearson"))


def unique_trials(trials: DataFrame, *, late: str = "7 days") -> DataFrame:
    """One row a trial identity; a trial that lands again within the watermark is dropped.

    A trial without `landed` lands when it is read. State is kept for `late` and no longer; the table that takes the trials
    drops what lands again after that."""
    key = ["arm", "field", "seed", "rep"]
    if "landed" in trials.columns:
        return trials.withWatermark("landed", late).dropDuplicatesWithinWatermark(key)
    timed = trials.withColumn("landed", F.current_timestamp())
    return timed.withWatermark("landed", late).dropDuplicatesWithinWatermark(key).drop("landed")


def margin_on_arrival(trials: DataFrame, store: str, reference: str, publish: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Appends arriving trials to a table and publishes the arm summary of all so far."""

    def step(batch: DataFrame, number: int) -> None:
        # a batch that is tried again replaces its own part, so each trial is stored once
        batch.write.mode("overwrite").parquet(f"{store}/batch={number}")
        every = batch.sparkSession.read.parquet(store).drop("batch").dropDuplicates(["arm", "field", "seed", "rep"])
        publish(compare.summarize_arms(every, reference), number)

    return unique_trials(trials).writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_to_memory(stream: DataFrame, name: str, mode: str, checkpoint: str) -> DataFrame:
    """Drains what is there into an in-memory table: for small results such as summaries."""
    q = stream.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.table(name)
