"""Running sums and ranks over groups of any size, without a window that spans a group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tesserine.sources import sinks

STEPS = 1024  # buckets of an octave


def bucket(x: Column) -> Column:
    """A non-decreasing whole number of any double: its octave and the place in it. Nulls come first, NaN last.

    Values from 1e3 to 1e9 fall in twenty thousand buckets, and a group's bucket totals stay a small table: a group has at
    most 2048 octaves on either side of 0.
    """
    a = F.abs(x)
    octave = F.greatest(F.least(F.floor(F.log2(F.when(a > 0, a))), F.lit(1023).cast("long")), F.lit(-1000).cast("long"))
    place = F.greatest(F.least(F.floor((F.when(a < float("inf"), a) * F.pow(F.lit(2.0), -octave) - 1) * STEPS), F.lit(STEPS - 1).cast("long")), F.lit(0).cast("long"))
    size = F.when(a == float("inf"), F.lit(1025 * STEPS * 2).cast("long")).when(a > 0, (octave + 1001) * STEPS + place + 1).otherwise(F.lit(0).cast("long"))
    return F.when(x.isNull(), F.lit(-(2**31))).when(F.isnan(x), F.lit(2**31 - 1)).otherwise(F.when(x < 0, -size).otherwise(size).cast("int"))


def running_sums(df: DataFrame, by: Sequence[str], order: str, values: Sequence[str], *, descending: bool = False) -> DataFrame:
    """df with cum_<value>: the sum over the rows of the group up to and with this one, by `order`.

    Rows with equal order are taken together. A group is cut into buckets of the order column; windows run inside a
    bucket and over the bucket totals, so one group may hold any share of the rows.
    """
    b = bucket(F.col(order).cast("double"))
    rows = df.withColumn("_b", -b if descending else b)
    totals = rows.groupBy(*by, "_b").agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*by, "_b", *[F.coalesce(F.sum(f"_t_{v}").over(before), F.lit(0)).alias(f"_c_{v}") for v in values])
    o = F.col(order).desc() if descending else F.col(order).asc()
    inside = Window.partitionBy(*by, "_b").orderBy(o).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    out = rows.join(totals, [*by, "_b"])
    return out.select(*df.columns, *[(F.col(f"_c_{v}") + F.sum(v).over(inside)).alias(f"cum_{v}") for v in values])


GROUP_ROWS = 1 << 20  # of a group that one window takes whole; a larger one is cut
TASK_ROWS = 400_000  # of a shuffle that is dealt by the number of rows


def dealt(df: DataFrame, rows: int, keys: Sequence[str]) -> DataFrame:
    """df hashed by keys into partitions of about TASK_ROWS rows, where its `rows` rows are more than the session's partitions take."""
    parts = -(-rows // TASK_ROWS)
    return df.repartition(parts, *keys) if parts > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def parted(rows: DataFrame, by: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """rows of the groups of up to GROUP_ROWS rows, and those of larger groups, whose list is broadcast: of N rows it has N / GROUP_ROWS at most."""
    large = rows.groupBy(*[F.col(c).alias(f"_in_{c}") for c in by]).agg(F.count("*").alias("_n")).where(F.col("_n") > GROUP_ROWS).drop("_n")
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_in_{c}"))
    return rows.join(F.broadcast(large), same, "left_anti"), rows.join(F.broadcast(large), same, "left_semi")


def as_of(left: DataFrame, right: DataFrame, by: Sequence[str], on: str, values: Sequence[str]) -> DataFrame:
    """left with the values of the last row of right in its group at or before its `on` (a number or a time); nulls before the first.

    Of right rows with one `on` the largest by values counts. Both sides make one stream, in which a window finds the last row; groups of
    more than GROUP_ROWS rows are cut into buckets of `on`: inside a bucket a window finds the last row, and what a bucket needs from earlier ones is the last row of each, carried over a small table. So no
    left row meets more than one right row, and a group may have any size. Rows of left without `on`
    or without a group get nulls."""
    last = F.struct(*[F.col(v) for v in values])
    marks = right.where(F.col(on).isNotNull()).dropna(subset=list(by)).select(*by, on, F.lit(0).alias("_ask"), last.alias("_v"), F.lit(None).cast(left.schema).alias("_row"))
    asked = left.select(*by, on, F.lit(1).alias("_ask"), F.lit(None).cast(marks.schema["_v"].dataType).alias("_v"), F.struct(*left.columns).alias("_row"))
    at = F.col(on) if isinstance(left.schema[on].dataType, T.NumericType) else F.col(on).cast("timestamp")
    rows = marks.unionByName(asked)
    small, large = parted(rows, by)
    last_of = lambda w: F.last("_v", ignorenulls=True).over(w.orderBy(F.col(on), "_ask", "_v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    small = small.withColumn("_found", last_of(Window.partitionBy(*by))).where("_ask = 1").select("_row", "_found")
    large = large.withColumn("_b", bucket(at.cast("double")))
    cell = [*by, "_b"]
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    ends = large.groupBy(*cell).agg(F.max(F.when(F.col("_ask") == 0, F.struct(on, "_v"))).alias("_end"))
    ends = ends.select(*cell, F.last("_end", ignorenulls=True).over(before)["_v"].alias("_carry"))
    large = large.withColumn("_own", last_of(Window.partitionBy(*cell))).where("_ask = 1").join(ends, cell, "left")
    found = small.unionByName(large.select("_row", F.coalesce("_own", "_carry").alias("_found")))
    value = F.when(F.col(f"_row.{on}").isNotNull(), F.col("_found"))
    return found.select("_row", value.alias("_got")).select("_row.*", *[F.col(f"_got.{v}").alias(v) for v in values])


HOT_SHARE = 1000  # a value with more than one row in so many is hot; there are fewer such values
PIECES = 1 << 16  # of a hot value, by its tie key


def _between(tie: Column, kind: str, low: Column, high: Column, prefix: Column) -> Column:
    """A non-decreasing piece number of a tie key between a hot value's lowest and highest one; 0 for kinds without a scale."""
    if kind == "string":  # the six bytes after what all keys of the value start with, as a number
        number = lambda s: F.conv(F.rpad(F.substring(F.hex(F.encode(F.substring(s, prefix + 1, F.lit(6)), "UTF-8")), 1, 12), 12, "0"), 16, 10).cast("double")
    elif kind in ("byte", "short", "integer", "long", "float", "double") or kind.startswith("decimal"):
        number = lambda s: s.cast("double")
    else:
        return F.lit(0)
    x, a, z = number(tie), number(low), number(high)
    return F.coalesce(F.greatest(F.lit(0), F.least(F.lit(PIECES - 1), F.floor(PIECES * (x - a) / F.nullif(z - a, F.lit(0.0))).cast("int"))), F.lit(0))


def row_numbers(df: DataFrame, by: Sequence[str], order: str, tie: str, name: str = "rank", *, descending: bool = False, near: Sequence[str] | None = None) -> DataFrame:
    """df with the ordinal rank from 1 of each row in its group; ties go by `tie` (W1). Rows without a group are left out.

    A group is cut into buckets of the order column. Of a bucket with more than a thousandth of all rows, each value that has so
    many itself is cut again by its tie key, so that ties of any number spread over tasks; such values are fewer than a thousand,
    and only their list is broadcast. Where no group has so many rows a window takes each whole. df is evaluated once, into the shared folder;
    the counts read it from there, and the number of partitions follows from them. near: keys of the group that whole groups are dealt by, where
    what follows needs no finer ones."""
    b = bucket(F.col(order).cast("double")).cast("long")
    path = sinks.fresh(df.sparkSession, "ranked")
    df.withColumn("_b", -b if descending else b).write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    total = rows.count()
    least = max(1, total // HOT_SHARE)
    o = F.col(order).desc_nulls_last() if descending else F.col(order).asc_nulls_first()
    if rows.groupBy(*by).agg(F.count("*").alias("_n")).where(F.col("_n") > min(least, GROUP_ROWS)).isEmpty():
        rows = dealt(rows.dropna(subset=list(by)), total, near or by)
        return rows.select(*df.columns, F.row_number().over(Window.partitionBy(*by).orderBy(o, F.col(tie))).cast("long").alias(name))
    kind = df.schema[tie].dataType.typeName()
    crowded = rows.groupBy(*by, "_b").agg(F.count("*").alias("_n")).where(F.col("_n") > least).select(*by, "_b")
    values = rows.join(F.broadcast(crowded), [*by, "_b"], "left_semi").groupBy(*by, "_b", F.col(order).alias("_v"))
    values = values.agg(F.count("*").alias("_n"), F.min(tie).alias("_low"), F.max(tie).alias("_high")).where(F.col("_n") > least)
    low, high = (F.col(c).cast("string") for c in ("_low", "_high"))
    shared = F.aggregate(F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.length(low), F.length(high)))), F.lit(0), lambda k, i: F.when((k == i - 1) & (F.substring(low, F.lit(1), i) == F.substring(high, F.lit(1), i)), i).otherwise(k))
    hot = values.groupBy(*by, "_b").agg(F.collect_list(F.struct("_v", "_low", "_high", F.coalesce(shared, F.lit(0)).alias("_at"))).alias("_hot"))
    rows = rows.join(F.broadcast(hot), [*by, "_b"], "left")
    x = F.col(order)
    own = F.get(F.filter("_hot", lambda h: h["_v"].eqNullSafe(x)), F.lit(0))
    place = 2 * F.size(F.filter("_hot", lambda h: h["_v"] < x)) + F.when(own.isNotNull(), 1).otherwise(0)
    piece = F.when(own.isNull(), 0).otherwise(_between(F.col(tie), kind, own["_low"], own["_high"], own["_at"]))
    place = F.when(F.col("_hot").isNull(), 0).otherwise(place)
    rows = rows.withColumn("_s", -place if descending else place).withColumn("_p", piece).drop("_hot")
    cell = [*by, "_b", "_s", "_p"]
    before = Window.partitionBy(*by).orderBy("_b", "_s", "_p").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*cell).agg(F.count("*").alias("_n")).select(*cell, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_c"))
    rows = dealt(rows, total, cell)
    inside = Window.partitionBy(*cell).orderBy(o, F.col(tie))
    return rows.join(totals, cell).select(*df.columns, (F.col("_c") + F.row_number().over(inside)).alias(name))


def attach_quantiles(out: DataFrame, df: DataFrame, by: Sequence[str], asked: Mapping[str, tuple[Column | str, Sequence[float]]]) -> DataFrame:
    """out, which has a row a group, with exact linear-interpolated quantiles of df's groups: an array of doubles by name; null
    for a group without values. Nulls don't count, NaN is the largest value.

    asked: name to (value, probabilities). The counts of the buckets of each group tell which buckets hold the ranks that are asked for; only
    those buckets' values are counted one by one, so no task holds a group and a value counts once however often it occurs."""
    group = F.struct(*by) if by else F.lit(0)
    each = [F.struct(F.lit(i).alias("i"), (F.col(v) if isinstance(v, str) else v).cast("double").alias("x")) for i, (v, _) in enumerate(asked.values())]
    long = df.select(group.alias("_g"), F.explode(F.array(*each)).alias("_e")).select("_g", F.col("_e.i").alias("_i"), F.col("_e.x").alias("_x"))
    long = long.where(F.col("_x").isNotNull()).withColumn("_b", bucket(F.col("_x")))
    cell = ["_g", "_i", "_b"]
    whole = Window.partitionBy("_g", "_i")
    before = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    totals = long.groupBy(*cell).agg(F.count("*").alias("_n"))
    totals = totals.withColumn("_c", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumn("_t", F.sum("_n").over(whole))
    probs = F.array(*[F.array(*[F.struct(F.lit(j).alias("j"), F.lit(float(p)).alias("p")) for j, p in enumerate(ps)]) for _, ps in asked.values()])
    wanted = totals.withColumn("_q", F.explode(F.get(probs, F.col("_i")))).withColumn("_at", F.col("_q.p") * (F.col("_t") - 1))
    ranks = F.explode(F.array(*[F.struct(F.lit(k).alias("side"), f("_at").cast("long").alias("rank")) for k, f in enumerate((F.floor, F.ceil))]))
    wanted = wanted.withColumn("_r", ranks).where((F.col("_r.rank") >= F.col("_c")) & (F.col("_r.rank") < F.col("_c") + F.col("_n")))
    wanted = wanted.select(*cell, F.col("_q.j").alias("_j"), "_at", F.col("_r.side").alias("_side"), (F.col("_r.rank") - F.col("_c")).alias("_rank"))
    near = long.join(wanted.select(*cell).distinct(), cell, "left_semi").groupBy(*cell, "_x").agg(F.count("*").alias("_n"))
    near = near.withColumn("_to", F.sum("_n").over(Window.partitionBy(*cell).orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    hits = near.join(wanted, cell).where((F.col("_rank") < F.col("_to")) & (F.col("_rank") >= F.col("_to") - F.col("_n")))
    side = lambda k: F.max(F.when(F.col("_side") == k, F.col("_x")))
    found = hits.groupBy("_g", "_i", "_j").agg(side(0).alias("_lo"), side(1).alias("_hi"), F.max("_at").alias("_at"))
    mixed = (F.ceil("_at") - F.col("_at")) * F.col("_lo") + (F.col("_at") - F.floor("_at")) * F.col("_hi")
    found = found.withColumn("_v", F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(mixed))
    found = found.groupBy("_g").agg(F.array_sort(F.collect_list(F.struct("_i", "_j", "_v"))).alias("_all"))
    own = lambda i: F.transform(F.filter("_all", lambda s: s["_i"] == i), lambda s: s["_v"])
    joined = out.withColumn("_g", group).join(found, "_g", "left")
    return joined.select(*out.columns, *[F.when(F.size(own(i)) > 0, own(i)).alias(n) for i, n in enumerate(asked)])


def running_min_above(df: DataFrame, by: Sequence[str], order: str, value: str, name: str) -> DataFrame:
    """df with the least value among the rows of the group from this one on, by `order`; rows with equal order are taken together."""
    rows = df.withColumn("_b", -bucket(F.col(order).cast("double")))
    totals = rows.groupBy(*by, "_b").agg(F.min(value).alias("_t"))
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*by, "_b", F.min("_t").over(before).alias("_c"))
    inside = Window.partitionBy(*by, "_b").orderBy(F.col(order).desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.join(totals, [*by, "_b"]).select(*df.columns, F.least("_c", F.min(value).over(inside)).alias(name))


def with_pooled(df: DataFrame, outer: str = "outer_fold", pooled: int = -1) -> DataFrame:
    """Each row twice: in its fold and in the pool, which is fold -1."""
    return df.withColumn(outer, F.explode(F.array(F.col(outer).cast("int"), F.lit(pooled))))
