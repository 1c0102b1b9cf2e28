"""Reading raw transactions, and writing and reading the output tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

from patronage.sources.schema import ALIASES, RAW_FIELDS, table_schema

ENCODING = "ISO-8859-1"


def _csv_groups(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files of a path by their header line; only names are listed here."""
    listed = spark.read.format("binaryFile").load(path).select("path").collect()
    groups: dict[tuple[str, ...], list[str]] = {}
    for file in sorted(row["path"] for row in listed):
        header = spark.read.option("header", True).option("encoding", ENCODING).csv(file).columns
        groups.setdefault(tuple(header), []).append(file)
    return groups


def _csv_schema(header: Sequence[str]) -> str:
    """Names from the header line, types from the declaration; nothing is inferred."""
    return ", ".join(
        f"`{name}` {RAW_FIELDS.get(ALIASES.get(name, name), 'string')}" for name in header
    )


def _read_part(spark: SparkSession, path: str, suffix: str) -> list[DataFrame]:
    if suffix == "parquet":
        return [spark.read.parquet(path)]
    # A file that does not match its header raises instead of shifting columns.
    reader = spark.read.option("header", True).option("encoding", ENCODING)
    reader = reader.option("enforceSchema", False)
    return [
        reader.schema(_csv_schema(header)).csv(files)
        for header, files in _csv_groups(spark, path).items()
    ]


def load_raw(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Raw transactions from CSV or Parquet; several parts are lined up by name."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    raw = None
    for path in paths:
        suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
        if suffix not in ("csv", "parquet"):
            raise ValueError(f"Unsupported file format: {path}")
        for part in _read_part(spark, path, suffix):
            part = part.withColumnsRenamed(ALIASES)
            raw = part if raw is None else raw.unionByName(part, allowMissingColumns=True)
    if raw is None:
        raise ValueError("no input path")
    return raw


def write_table(df: DataFrame, root: str, name: str, fmt: str = "parquet", **options) -> str:
    path = f"{root.rstrip('/')}/{name}"
    writer = df.write.mode("overwrite").options(**options)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return path


def read_table(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    """An output table by name, with its declared types for CSV."""
    path = f"{root.rstrip('/')}/{name}"
    if fmt == "csv":
        return spark.read.option("header", True).schema(table_schema(name)).csv(path)
    return spark.read.format(fmt).load(path)


def table_exists(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> bool:
    try:
        read_table(spark, root, name, fmt)
        return True
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def load_clv(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """The model table if it was written, otherwise the feature table."""
    name = "clv_statistical" if table_exists(spark, root, "clv_statistical", fmt) else "clv_features"
    return read_table(spark, root, name, fmt)


def write_report(df: DataFrame, root: str, name: str) -> str:
    """A small report as JSON lines."""
    path = f"{root.rstrip('/')}/{name}"
    df.write.mode("overwrite").json(path)
    return path


def read_report(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.json(f"{root.rstrip('/')}/{name}")


def save_model(model, root: str, name: str) -> str:
    path = f"{root.rstrip('/')}/{name}"
    model.write().overwrite().save(path)
    return path


def load_model(root: str, name: str) -> PipelineModel:
    return PipelineModel.load(f"{root.rstrip('/')}/{name}")
