"""File sources and sinks (S1-S5, S8, S9, S11) and named collections."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cyclewise.operators.quality import coerce_types
from cyclewise.schema import UNIT, raw_columns

# Text tokens read as missing (the default NA set of the reference's CSV reader).
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
             "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def read_whitespace(spark: SparkSession, path: str, columns: list[str] | None = None,
                    coerce: bool = True) -> DataFrame:
    """Headerless whitespace-delimited text -> named columns (trailing blanks ignored).

    Each line is split on runs of whitespace; field i becomes ``columns[i]``
    (the 26-column raw panel layout by default); then list-form type coercion.
    """
    cols = columns or raw_columns()
    lines = spark.read.text(path).select(F.trim(F.col("value")).alias("v")).filter(F.col("v") != "")
    parts = F.split(F.col("v"), r"\s+")
    df = lines.select(*[parts.getItem(i).alias(c) for i, c in enumerate(cols)])
    return coerce_types(df) if coerce else df


def read_truth(spark: SparkSession, path: str, unit: str = UNIT, value: str = "RUL") -> DataFrame:
    """S3: one value per line; line i (1-based) belongs to unit i.

    Lines are numbered over all files in the order of their names, empty ones left out. A file is
    read in blocks, each in one task: lines are numbered within their block, and the blocks' counts,
    a row per block, give the blocks' offsets.
    """
    lines = spark.read.text(path).select(
        F.trim("value").alias("v"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    lines = lines.where("v <> ''")
    blocks = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)  # a row per block
    blocks = blocks.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("file", "block").orderBy("at"))
    return lines.select("v", "file", "block", inside.alias("i")).join(blocks, ["file", "block"]).select(
        (F.col("before") + F.col("i")).alias(unit), F.expr("try_cast(v AS BIGINT)").alias(value))


def write_truth(truth: DataFrame, path: str, unit: str = UNIT, value: str = "RUL") -> None:
    """S3: the values in the order of their units, one per line. The files' names keep the order."""
    truth.orderBy(unit).select(F.col(value).cast("string").alias("value")).write.mode("overwrite").text(path)


def normalize_na(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Map the NA text tokens to NULL in string columns."""
    cols = cols or [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    toks = F.array(*[F.lit(t) for t in NA_TOKENS])
    return df.withColumns({c: F.when(F.array_contains(toks, F.trim(F.col(c))), None)
                           .otherwise(F.col(c)) for c in cols})


def read_panel_csv(spark: SparkSession, path: str, spec: dict | list | None = None) -> DataFrame:
    """Header CSV read as text (no inference), NA tokens -> NULL, then coercion."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return coerce_types(normalize_na(raw), spec)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None,
                header: bool = True) -> None:
    """Overwrite, no index column."""
    w = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", header)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.save(path)


def write_whitespace(df: DataFrame, path: str) -> None:
    """Writer twin of S1: space-separated text lines, NULL as NaN."""
    txt = F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("NaN")) for c in df.columns])
    df.select(txt.alias("value")).write.mode("overwrite").text(path)


def replace_collection(df: DataFrame, base: str, name: str, fmt: str = "parquet") -> str:
    """Delete-all + insert-all of a named collection = one overwrite of its dataset."""
    path = f"{base.rstrip('/')}/{name}"
    df.write.mode("overwrite").format(fmt).save(path)
    return path


def scan_collection(spark: SparkSession, base: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Full scan of a named collection without the store's ``_id`` column."""
    df = spark.read.format(fmt).load(f"{base.rstrip('/')}/{name}")
    return df.drop("_id")


def verify_written(spark: SparkSession, path: str, expected_columns: list[str],
                   unit: str = UNIT, fmt: str = "parquet") -> DataFrame:
    """Re-read the output; one row with rows, columns, distinct units and ok flag.
    Raises if the output is empty."""
    df = spark.read.format(fmt).load(path)
    has_unit = unit in df.columns
    row = df.agg(F.count(F.lit(1)).alias("rows"),
                 (F.countDistinct(unit) if has_unit else F.lit(None)).cast("long").alias("units")).first()
    if not row["rows"]:
        raise ValueError(f"written output at {path} is empty")
    ok = sorted(df.columns) == sorted(expected_columns)
    return spark.createDataFrame([(row["rows"], len(df.columns), row["units"], ok)],
                                 "rows long, columns long, units long, columns_ok boolean")


def write_metrics_json(df: DataFrame, path: str) -> None:
    """Metrics / stats / report rows as JSON lines (small, bounded by model count)."""
    df.write.mode("overwrite").json(path)


def write_predictions(df: DataFrame, out: str | None = None, base: str = "predictions",
                      stats: DataFrame | None = None) -> str:
    """Write predictions (and optional stats as JSON); a timestamped path when
    ``out`` is None, taken once on the driver for the run."""
    if out is None:
        out = f"{base}/predictions_{_dt.datetime.now().strftime('%Y%m%d_%H%M%S')}"
    df.write.mode("overwrite").parquet(out)
    if stats is not None:
        write_metrics_json(stats, out.rstrip("/") + "_stats")
    return out


def list_subdirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path`` on any Hadoop file system
    (local, HDFS, object stores), via the session's Hadoop configuration."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())
