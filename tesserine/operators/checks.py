"""Checks as violation frames: the rows that break a rule. `refuse` raises when there are any."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserine.functions import labels as L


def refuse(violations: DataFrame, what: str, show: int = 5) -> None:
    """Raises with the first few offenders."""
    if found := violations.take(show):
        raise ValueError(f"{what}: {', '.join(str(r.asDict()) for r in found)}")


def repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def orphans(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not known."""
    return df.join(known.select(*keys).distinct(), list(keys), "left_anti")


def admitted(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is known."""
    return df.join(known.select(*keys).distinct(), list(keys), "left_semi")


def missing_columns(df: DataFrame, needed: Sequence[str]) -> list[str]:
    """Required columns that a sheet lacks."""
    return sorted(set(needed) - set(df.columns))


def out_of_map(df: DataFrame, column: str, mapping: dict[str, int]) -> DataFrame:
    """Distinct values that a categorical endpoint doesn't map (F7, a warning)."""
    v = L.clean(column)
    return df.select(v.alias("value")).where(F.col("value").isNotNull() & ~F.col("value").isin(*mapping)).distinct()


def validate_sheets(patients: DataFrame, slides: DataFrame, needed: Sequence[str] = ()) -> DataFrame:
    """All violations of the sheets as (kind, key, n)."""
    rows = repeated(patients, ["patient_id"]).select(F.lit("duplicate patient").alias("kind"), F.col("patient_id").alias("key"), "n")
    rows = rows.unionByName(repeated(slides, ["image_path"]).select(F.lit("duplicate slide").alias("kind"), F.col("image_path").alias("key"), "n"))
    lost = orphans(slides, patients, ["patient_id"]).groupBy("patient_id").agg(F.count("*").alias("n"))
    rows = rows.unionByName(lost.select(F.lit("orphan slide").alias("kind"), F.col("patient_id").alias("key"), "n"))
    absent = missing_columns(patients, ["patient_id", *needed]) + missing_columns(slides, ["patient_id", "image_path"])
    if absent:
        names = patients.sparkSession.createDataFrame([(c,) for c in absent], "key string")
        rows = rows.unionByName(names.select(F.lit("missing column").alias("kind"), "key", F.lit(1).cast("long").alias("n")))
    return rows


def one_row_per_patient(rows: DataFrame, key: str = "patient_id") -> tuple[DataFrame, DataFrame]:
    """(rows with exact duplicates collapsed, keys that still differ)."""
    distinct = rows.dropDuplicates()
    return distinct, repeated(distinct, [key])


def conflicting(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with more than one value."""
    return df.groupBy(key).agg(F.count_distinct(value).alias("n")).where("n > 1")


def valid_strata(df: DataFrame, target: Column, objective: str, strata: Column | None = None) -> DataFrame:
    """Patients usable for an endpoint, with their stratum (F1)."""
    rows = df.withColumn("_target", target)
    ok = F.col("_target").isNotNull() & (F.col("_target") >= 0) if objective in ("binary", "multiclass") else F.col("_target").isNotNull()
    level = F.col("_target").cast("int") if strata is None and objective != "regression" else strata
    return rows.where(ok).select("patient_id", (F.lit(0) if level is None else level).alias("stratum")).where(F.col("stratum").isNotNull())


def valid_survival(df: DataFrame, time: Column, event: Column) -> DataFrame:
    """Patients with an event of 0 or 1 and a positive time; the stratum is the event (F2)."""
    rows = df.select("patient_id", time.alias("_t"), event.alias("_e"))
    return rows.where(F.col("_e").isin(0, 1) & (F.col("_t") > 0)).select("patient_id", F.col("_e").cast("int").alias("stratum"))


def strata_of_fields(by_field: dict[str, DataFrame], covered: DataFrame | None = None) -> DataFrame:
    """(field, patient_id, stratum) over fields, gated by coverage."""
    out = None
    for name, rows in by_field.items():
        rows = rows.select(F.lit(name).alias("field"), "patient_id", "stratum")
        out = rows if out is None else out.unionByName(rows)
    return out if covered is None else admitted(out, covered, ["patient_id"])


def unusable_values(df: DataFrame, column: str, usable: Column) -> DataFrame:
    """Values that are there but can't be used, with patient counts."""
    rows = df.select("patient_id", L.clean(column).alias("value"), usable.alias("_ok"))
    bad = rows.where(F.col("value").isNotNull() & ~F.coalesce("_ok", F.lit(False)))
    return bad.groupBy(F.lit(column).alias("column"), "value").agg(F.count_distinct("patient_id").alias("n_patients"))


def covered_by_all(sets: Sequence[DataFrame], key: str = "patient_id") -> DataFrame:
    """Keys that all sets hold."""
    out = sets[0].select(key).distinct()
    for s in sets[1:]:
        out = out.join(s.select(key).distinct(), key, "left_semi")
    return out


def is_missing(label: Column, objective: str) -> Column:
    """Whether a label is missing, by objective."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    if objective in ("binary", "multiclass"):
        return label.isNull() | (label < 0)
    if objective == "regression_vector":
        return F.forall(label, bad)
    return bad(label)


def at_least(tiles: DataFrame, n: int, key: str = "slide_id") -> DataFrame:
    """Items with n rows or more."""
    return tiles.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") >= n).select(key)


def scored_coverage(declared: DataFrame, scored: DataFrame, by: Sequence[str]) -> DataFrame:
    """Declared and scored patients and those lost, by fold (F16)."""
    got = scored.select(*by, "patient_id").distinct().withColumn("_got", F.lit(1))
    rows = declared.select(*by, "patient_id").distinct().join(got, [*by, "patient_id"], "left")
    return rows.groupBy(*by).agg(
        F.count("*").alias("n_declared"), F.count("_got").alias("n_scored"), F.array_sort(F.collect_list(F.when(F.col("_got").isNull(), F.col("patient_id")))).alias("lost")
    )


def incomplete_grid(folds: DataFrame, n_outer: int, n_inner: int, by: Sequence[str] = ("field",)) -> DataFrame:
    """Cells of the declared grid without a fold."""
    axis = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    grid = folds.select(*by).distinct().withColumn("outer_fold", axis(n_outer)).withColumn("inner_fold", axis(n_inner))
    return orphans(grid, folds, [*by, "outer_fold", "inner_fold"])


def undeclared(folds: DataFrame, declared: DataFrame, by: str = "field") -> DataFrame:
    """Endpoints declared without folds, and folds of undeclared endpoints."""
    a = orphans(declared.select(by).distinct(), folds, [by]).withColumn("kind", F.lit("no folds"))
    return a.unionByName(orphans(folds.select(by).distinct(), declared, [by]).withColumn("kind", F.lit("undeclared")))


def uneven_replicates(preds: DataFrame, by: Sequence[str] = ("field", "outer_fold")) -> DataFrame:
    """Patients that some replicates of an outer fold scored and others didn't."""
    rows = preds.select(*by, "inner_fold", "patient_id").distinct()
    n = rows.groupBy(*by).agg(F.count_distinct("inner_fold").alias("n_inner"))
    got = rows.groupBy(*by, "patient_id").agg(F.count("*").alias("n_scored"))
    return got.join(n, list(by)).where("n_scored < n_inner")


def shared_with_development(scored: DataFrame, development: DataFrame) -> DataFrame:
    """Scored patients that a model was developed on."""
    return scored.select("patient_id").intersect(development.select("patient_id"))


def splits_violations(imported: DataFrame, expected: DataFrame, patients: DataFrame, valid: DataFrame, *, allow_uncovered: bool = False) -> DataFrame:
    """(version, patient_id, reason) of what is wrong with an imported split.

    imported: version, patient_id, category. expected: version, field, strategy. valid: field, patient_id.
    """
    name = ["split_version"]
    none = F.lit(None).cast("string")
    reason = lambda df, why, who="patient_id": df.select("split_version", (F.col(who) if who else none).cast("string").alias("patient_id"), F.lit(why).alias("reason"))
    out = reason(orphans(expected, imported, name), "missing version", None)
    out = out.unionByName(reason(orphans(imported.select("split_version").distinct(), expected, name), "unknown version", None))
    out = out.unionByName(reason(orphans(imported, patients, ["patient_id"]), "unknown patient"))
    known = imported.join(expected, name)
    allowed = F.when(F.col("strategy") == "nested_cv", F.col("category").isin("fit", "validate", "test")).when(F.col("strategy") == "all_test", F.col("category") == "test").otherwise(F.col("category") == "predict")
    out = out.unionByName(reason(known.where(~F.coalesce(allowed, F.lit(False))), "category"))
    fields = known.where(F.col("field").isNotNull())
    out = out.unionByName(reason(orphans(admitted(fields, patients, ["patient_id"]), valid, ["field", "patient_id"]), "invalid patient"))
    if not allow_uncovered:
        due = expected.where(F.col("field").isNotNull()).join(valid, "field").select("split_version", "patient_id")
        out = out.unionByName(reason(orphans(due, imported, ["split_version", "patient_id"]), "uncovered patient"))
    twice = repeated(imported, ["split_version", "patient_id"])
    return out.unionByName(reason(twice, "repeated patient"))


def uncovered_pairs(models: DataFrame, patients: DataFrame, predictions: DataFrame) -> DataFrame:
    """(model, patient) without a prediction."""
    n = models.select("outer_fold", "inner_fold").distinct()
    grid = patients.select("patient_id").distinct().join(F.broadcast(n))  # models are a fold grid, tens of rows
    return orphans(grid, predictions, ["outer_fold", "inner_fold", "patient_id"])


def disagreeing(arms: DataFrame, value: str, keys: Sequence[str] = ("field", "patient_id")) -> DataFrame:
    """Keys for which arms disagree on a value: labels (F23) or outer folds."""
    return arms.groupBy(*keys).agg(F.min(value).alias("low"), F.max(value).alias("high")).where(~F.col("low").eqNullSafe(F.col("high")))


def short_of_arms(arms: DataFrame, keys: Sequence[str] = ("field",)) -> DataFrame:
    """Fields that not every arm has."""
    have = arms.select("arm", *keys).distinct().groupBy(*keys).agg(F.count("*").alias("n_arms"))
    return have.where(F.col("n_arms") < arms.select("arm").distinct().count())


def trial_violations(trials: DataFrame) -> DataFrame:
    """(kind, key, n): a metric that isn't finite, a seed with two splits, a training seed used twice."""
    bad = F.col("metric").isNull() | F.isnan("metric") | (F.abs("metric") == float("inf"))
    out = trials.where(bad).groupBy(F.col("arm").alias("key")).agg(F.count("*").alias("n")).withColumn("kind", F.lit("metric"))
    split = trials.groupBy(F.col("seed").cast("string").alias("key")).agg(F.count_distinct("split_hash").alias("n")).where("n > 1").withColumn("kind", F.lit("split"))
    seed = trials.groupBy(F.col("train_seed").cast("string").alias("key")).agg(F.count("*").alias("n")).where("n > 1").withColumn("kind", F.lit("train seed"))
    return out.unionByName(split).unionByName(seed)


def uneven_keys(states: DataFrame, keys: Sequence[str], fold: Sequence[str] = ("outer_fold", "inner_fold")) -> DataFrame:
    """State keys that some folds lack."""
    folds = states.select(*fold).distinct()
    have = states.select(*keys, *fold).distinct()
    total = folds.count()
    return have.groupBy(*keys).agg(F.count("*").alias("n_folds")).where(F.col("n_folds") < total)


def missing_inputs(rows: DataFrame, value: str) -> DataFrame:
    """Rows whose input is missing: what the policy "refuse" refuses."""
    return rows.where(F.col(value).isNull() | F.isnan(F.col(value).cast("double")))


def other_panels(states: DataFrame, panel: str) -> DataFrame:
    """Folds whose recorded state names another gene panel than the run does."""
    return states.where(~F.col("panel").eqNullSafe(F.lit(panel))).select("field", "outer_fold", "inner_fold", "panel").distinct()


def impute(z: Column, policy: str) -> Column:
    """A missing standardised input: an error, or the mean, which is 0."""
    if policy == "refuse":
        return F.when(z.isNull(), F.raise_error(F.lit("an input is missing")).cast("double")).otherwise(z)
    if policy == "impute":
        return F.coalesce(z, F.lit(0.0))
    raise ValueError(f"unknown missing-input policy {policy!r}")


def work_left(planned: DataFrame, recorded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What is planned and not recorded."""
    return orphans(planned, recorded, keys)


def resolve_names(wanted: DataFrame, slides: DataFrame) -> DataFrame:
    """Wanted slides by full path or by base name; slide_id is null where nothing matches."""
    base = lambda c: F.element_at(F.split(c, "/"), -1)
    full = slides.select("slide_id", F.col("image_path").alias("name"))
    short = slides.select("slide_id", base(F.col("image_path")).alias("name"))
    return wanted.select("name").distinct().join(full.unionByName(short).distinct(), "name", "left")


def plan_endpoints(declared: DataFrame, trained: DataFrame, contract: DataFrame, reportable: Sequence[str]) -> DataFrame:
    """Declared endpoints with why each is skipped; null is to be run."""
    t = trained.select("field").distinct().withColumn("_trained", F.lit(True))
    c = contract.select("field", "objective").withColumn("_known", F.lit(True))
    rows = declared.select("field").distinct().join(t, "field", "left").join(c, "field", "left")
    why = F.when(F.col("_known").isNull(), "not in the contract").when(F.col("_trained").isNull(), "not trained").when(~F.col("objective").isin(*reportable), "not reportable")
    return rows.select("field", "objective", why.alias("skipped"))


def coordinate_clashes(attention: DataFrame) -> DataFrame:
    """Tiles on whose coordinates replicates disagree, and slides that two outer folds claim."""
    x, y = (F.when(F.col("x").isNotNull() & F.col("y").isNotNull(), F.col(c)) for c in "xy")
    moved = (F.min(x) != F.max(x)) | (F.min(y) != F.max(y))
    tiles = attention.groupBy("slide_id", "tile_idx").agg(moved.alias("moved"), F.min("outer_fold").alias("low"), F.max("outer_fold").alias("high"))
    slides = tiles.groupBy("slide_id").agg(F.max("moved").alias("moved"), (F.min("low") != F.max("high")).alias("claimed"))
    kinds = F.array(F.when(F.col("moved"), "coordinates"), F.when(F.col("claimed"), "outer folds"))
    return slides.select("slide_id", F.explode(F.array_compact(kinds)).alias("kind"))


def non_finite(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value isn't finite."""
    x = F.col(column)
    return df.where(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
