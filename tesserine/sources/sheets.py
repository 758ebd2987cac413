"""Readers: sheets of strings, matrices, panels, gene sets, listings, trials and manifest tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tesserine.sources import commits

#: Cells that count as missing when a sheet is read.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

TRIALS = "arm string, field string, seed int, rep int, metric double, metric_key string, n_declared int, n_test int, split_hash string, train_seed long, git_sha string"
MANIFEST = ("patient", "patient_labels", "image", "image_labels", "mask", "split_definitions", "split")


def read_sheet(spark: SparkSession, path: str, *, sep: str = ",") -> DataFrame:
    """A delimited sheet with every column a string; missing tokens are null."""
    raw = spark.read.option("header", True).option("sep", sep).option("inferSchema", False).csv(path)
    return raw.select(*[F.when(~F.col(f"`{c}`").isin(*MISSING), F.col(f"`{c}`")).alias(c) for c in raw.columns])


def read_masks(spark: SparkSession, path: str | None) -> DataFrame:
    """image_path -> mask_path; without a file an empty map; a blank mask is none."""
    if path is None:
        return spark.createDataFrame([], "image_path string, mask_path string")
    return read_sheet(spark, path).select("image_path", F.trim("mask_path").alias("mask_path")).where(F.col("mask_path") != "")


def read_manifest(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The seven manifest tables; split rows come joined to their definitions."""
    at = commits.current(spark, root)
    tables = {t: spark.read.parquet(f"{at}/{t}") for t in MANIFEST}
    tables["split"] = tables["split"].join(tables["split_definitions"], "split_version")
    return tables


def read_matrix(spark: SparkSession, path: str, patient: str = "patient_id") -> DataFrame:
    """A wide expression matrix in long form (patient_id, gene_id, value)."""
    return melt_matrix(spark.read.parquet(path), patient)


def melt_matrix(wide: DataFrame, patient: str = "patient_id") -> DataFrame:
    """Wide to long; missing values are kept as null."""
    genes = [c for c in wide.columns if c != patient]
    long = wide.select(F.col(patient).cast("string").alias("patient_id"), *[F.col(f"`{g}`").cast("double").alias(g) for g in genes])
    return long.unpivot(["patient_id"], genes, "gene_id", "value")


def read_panel(spark: SparkSession, path: str) -> DataFrame:
    """(pos, gene_id) of a panel file in file order, blanks dropped (S6). A panel is one small file."""
    raw = read_sheet(spark, path)
    if "Entrez_Gene_Id" not in raw.columns:
        raise ValueError(f"{path} has no Entrez_Gene_Id column")
    ids = raw.coalesce(1).select(F.monotonically_increasing_id().alias("pos"), F.trim("Entrez_Gene_Id").alias("gene_id"))
    return ids.where(F.col("gene_id").isNotNull())


def panel_path(name: str | None, root: str, exists) -> str | None:
    """Where a panel lies: None for all genes, an existing path itself, else a named file under root."""
    if name in (None, "", "full"):
        return None
    return name if exists(name) else f"{root}/{name}.csv"


def read_gmt(spark: SparkSession, path: str) -> DataFrame:
    """(set_name, pos, symbol) of gene sets: name, description, genes by tabs; shorter lines are skipped."""
    return parse_gmt(spark.read.text(path))


def parse_gmt(lines: DataFrame) -> DataFrame:
    parts = F.split("value", "\t")
    rows = lines.where(F.size(parts) >= 3)
    genes = F.filter(F.slice(parts, F.lit(3), F.greatest(F.size(parts) - 2, F.lit(0))), lambda g: F.trim(g) != "")
    return rows.select(parts[0].alias("set_name"), F.posexplode(genes).alias("pos", "symbol"))


def read_listing(spark: SparkSession, path: str, projects: dict[str, str]) -> DataFrame:
    """A tab-separated sidecar with the label of each row's project; an unknown project is an error."""
    return label_projects(read_sheet(spark, path, sep="\t"), projects)


def label_projects(rows: DataFrame, projects: dict[str, str]) -> DataFrame:
    pairs = F.create_map(*[F.lit(x) for kv in projects.items() for x in kv])
    label = F.try_element_at(pairs, F.col("project_id"))
    bad = F.raise_error(F.concat(F.lit("unknown project "), F.coalesce("project_id", F.lit("")))).cast("string")
    return rows.withColumn("label", F.coalesce(label, bad))


def read_trials(spark: SparkSession, path: str) -> DataFrame:
    """Trial rows, one JSON a trial; a metric written as text is an error."""
    schema = T._parse_datatype_string(TRIALS)
    loose = T.StructType([T.StructField(f.name, T.StringType() if f.name == "metric" else f.dataType) for f in schema])
    raw = spark.read.schema(loose).option("multiLine", True).json(path)
    return typed_trials(raw)


def typed_trials(raw: DataFrame) -> DataFrame:
    value = F.col("metric").try_cast("double")
    bad = F.raise_error(F.concat(F.lit("a metric that is no number: "), F.col("metric"))).cast("double")
    return raw.withColumn("metric", F.when(F.col("metric").isNotNull() & value.isNull(), bad).otherwise(value))


def flatten_listing(raw: DataFrame) -> DataFrame:
    """Flat rows of a nested file listing."""
    case = F.col("cases")[0]
    return raw.select("file_id", "file_name", case["submitter_id"].alias("patient_id"), case["project"]["project_id"].alias("project_id"))


def discover_folds(predictions: DataFrame, runs: DataFrame) -> DataFrame:
    """Predictions of the folds whose run record, written last, is there."""
    return predictions.join(runs.select("field", "outer_fold", "inner_fold").distinct(), ["field", "outer_fold", "inner_fold"], "left_semi")


def read_predictions(spark: SparkSession, path: str, schema: str, *, require_edges: bool = False) -> DataFrame:
    """Fold predictions by an explicit schema, partitioned by field, outer and inner fold."""
    rows = spark.read.schema(schema).parquet(path)
    if require_edges:
        edges = F.coalesce("time_edges", F.raise_error(F.lit("survival predictions without time edges")).cast("array<double>"))
        rows = rows.withColumn("time_edges", edges)
    return rows


def read_features(spark: SparkSession, path: str, model_name: str, model_hash: str, mpp: float, tile_size: int) -> DataFrame:
    """Tile features of one extractor and grid; a namespace without features is an error."""
    rows = namespace(spark.read.parquet(path), model_name, model_hash, mpp, tile_size)
    if not rows.take(1):
        raise ValueError(f"no features of {model_name} {model_hash} at {mpp} mpp and {tile_size} px")
    return rows


def namespace(features: DataFrame, model_name: str, model_hash: str, mpp: float, tile_size: int) -> DataFrame:
    return features.where((F.col("model_name") == model_name) & (F.col("model_hash") == model_hash) & (F.col("mpp") == mpp) & (F.col("tile_size") == tile_size))


def read_splits(spark: SparkSession, path: str) -> DataFrame:
    """An exported split: header, three columns and known categories are required; categories in lower case."""
    rows = spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
    if rows.columns != ["patient_id", "split_version", "category"]:
        raise ValueError(f"{path}: expected patient_id, split_version, category")
    category = F.lower("category")
    bad = F.raise_error(F.concat(F.lit("unknown category "), F.coalesce("category", F.lit("")))).cast("string")
    return rows.withColumn("category", F.when(category.isin("fit", "validate", "test", "predict"), category).otherwise(bad))


def long_labels(wide: DataFrame, key: str, reserved: Sequence[str] = ()) -> DataFrame:
    """Wide sheet to (key, label, value), missing dropped."""
    names = [c for c in wide.columns if c != key and c not in reserved]
    return wide.select(key, *[F.col(f"`{c}`").cast("string").alias(c) for c in names]).unpivot([key], names, "label", "value").where(F.col("value").isNotNull())


def wide_labels(long: DataFrame, names: Sequence[str], slides: DataFrame, patients: DataFrame) -> DataFrame:
    """Labels by patient with the number of slides, 0 for none."""
    wide = long.groupBy("patient_id").pivot("label", list(names)).agg(F.first("value"))
    n = slides.groupBy("patient_id").agg(F.count("*").alias("n_slides"))
    return patients.select("patient_id").join(wide, "patient_id", "left").join(n, "patient_id", "left").withColumn("n_slides", F.coalesce("n_slides", F.lit(0).cast("long")))


def stem(path: Column) -> Column:
    """The file name without folder and last extension."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def with_masks(slides: DataFrame, masks: DataFrame) -> DataFrame:
    """Slides with their mask or null."""
    return slides.join(masks.select("image_path", "mask_path"), "image_path", "left")


def pair_by_stem(slides: DataFrame, masks: DataFrame, suffix: str = "_mask") -> DataFrame:
    """Slides with the mask whose stem is theirs and a suffix."""
    keyed = masks.select(F.regexp_replace(stem(F.col("mask_path")), f"{suffix}$", "").alias("_stem"), "mask_path")
    return slides.withColumn("_stem", stem(F.col("image_path"))).join(keyed, "_stem", "left").drop("_stem")


def index_masks(spark: SparkSession, root: str, extension: str) -> DataFrame:
    """(mask_path, length) of the non-empty mask files under root."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{extension}").option("recursiveFileLookup", True).load(root)
    return files.select(F.col("path").alias("mask_path"), "length").where("length > 0")
