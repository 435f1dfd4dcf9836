"""Sinks: tables, truth, review queue, and a manifest of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from watchloom import schemas
from watchloom.sources.tables import SocTables


def export_tables(t: SocTables, out_dir: str) -> None:
    """Every canonical table as ``<table>.parquet``, file column names as submitted."""
    for name in schemas.TABLES:
        df = getattr(t, name)
        for field, alias in schemas.FILE_ALIASES.items():
            if field in df.columns:
                df = df.withColumnRenamed(field, alias)
        df.write.mode("overwrite").parquet(f"{out_dir}/{name}.parquet")


def export_truth(truth: DataFrame, out_dir: str) -> None:
    truth.write.mode("overwrite").json(f"{out_dir}/ground_truth.json")


def read_truth(spark: SparkSession, path: str, as_array: bool = False) -> DataFrame:
    """Ground truth from JSON lines, or from one JSON array per file."""
    return spark.read.schema(schemas.TRUTH).option("multiLine", as_array).json(path)


def export_review_queue(sample: DataFrame, path: str) -> None:
    """The review queue as CSV with a header."""
    sample.select("entity_id", "target_id", "detector_id", "severity", "selection_reason").write.mode(
        "overwrite").option("header", True).csv(path)


def file_manifest(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(file, bytes, sha256) of every file below ``path``, hashed on the executors."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob).load(path)
    )
    root = F.lit(path.rstrip("/").removeprefix("file:") + "/")
    plain = F.regexp_replace("path", "^[a-z0-9]+:/+", "/")
    return files.select(
        F.when(F.startswith(plain, root), F.substr(plain, F.length(root) + 1)).otherwise(plain).alias("file"),
        F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"),
    )


def manifest_row_counts(df: DataFrame) -> DataFrame:
    """(file, rows) of a frame read from files."""
    return df.groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("rows"))
