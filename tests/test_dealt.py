"""Shuffles dealt by the number of rows, groups cut only where they are large, and inputs that are evaluated once."""

import random

from pyspark.sql import functions as F

from tesserine.operators import checks, inspect, ordered


def counted(spark, rows, schema):
    seen = spark.sparkContext.accumulator(0)

    def one(row):
        seen.add(1)
        return row

    return spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(one), schema), seen


def test_as_of_cuts_only_large_groups(spark, monkeypatch):
    r = random.Random(2)
    right = spark.createDataFrame([(r.choice(["a", "b", None]), r.uniform(-5, 5), k) for k in range(80)], "g string, t double, v int")
    left = spark.createDataFrame([(k, r.choice(["a", "b", None]), r.uniform(-6, 6)) for k in range(80)], "id int, g string, t double")
    out = []
    for most in (0, 60, 1 << 20):
        monkeypatch.setattr(ordered, "GROUP_ROWS", most)
        out.append(sorted(map(repr, ordered.as_of(left, right, ["g"], "t", ["v"]).collect())))
    assert out[0] == out[1] == out[2] and len(out[0]) == 80


def test_partitions_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(ordered, "TASK_ROWS", 100)
    df = spark.range(2000).select((F.col("id") % 500).alias("g"), F.col("id"), F.rand(1).alias("x"))
    assert ordered.dealt(df, 2000, ["g"]).rdd.getNumPartitions() == 20
    assert ordered.row_numbers(df, ["g"], "x", "id").rdd.getNumPartitions() == 20  # groups too small to cut
    one = ordered.row_numbers(df.withColumn("g", F.lit(0)), ["g"], "x", "id")
    assert one.rdd.getNumPartitions() >= 20 and one.agg(F.max("rank"), F.count_distinct("rank")).first()[:] == (2000, 2000)


def test_clashes_and_weights_read_their_input_once(spark):
    rows = [(k % 2, m, k % 7, k, (k + (m if k == 3 else 0)) if k % 5 else None, k, k / 10) for k in range(40) for m in range(2)]
    rows += [(1 - (k % 2), 0, 100, k, 1, 1, 0.0) for k in range(2)]
    att, seen = counted(spark, rows, "outer_fold int, inner_fold int, slide_id long, tile_idx int, x int, y int, logit double")
    got = {(r.slide_id, r.kind) for r in checks.coordinate_clashes(att).collect()}
    assert got == {(3, "coordinates"), *[(s, "outer folds") for s in (*range(7), 100)]} and seen.value == len(rows)
    before = seen.value
    assert inspect.attention_weights(att).agg(F.count("weight")).first()[0] == len(rows) and seen.value == before + len(rows)
