"""Columnar sources: parquet, ORC, CSV, JSON lines with given schemas, partition-aware page reads, vector indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagelode.sources.files import read_jsonl


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None, **options: str) -> DataFrame:
    """A table in any of Spark's formats; a schema is required where the format carries none."""
    if fmt == "jsonl":
        return read_jsonl(spark, path, schema or "")
    if fmt in ("csv", "json") and schema is None:
        raise ValueError(f"{fmt} needs a schema")
    r = spark.read.format(fmt).options(**options)
    return (r.schema(schema) if schema else r).load(path)


def read_pages(spark: SparkSession, path: str, documents: list[str] | None = None, first: int | None = None, last: int | None = None) -> DataFrame:
    """Page blocks with document and page predicates that reach the scan (partition pruning and pushed filters)."""
    df = spark.read.parquet(path)
    if documents:
        df = df.filter(df["document_id"].isin(documents))
    if first is not None:
        df = df.filter(df["page"] >= first)
    if last is not None:
        df = df.filter(df["page"] <= last)
    return df


def open_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(vectors with metadata, manifest) of an index written by ``pagelode.sinks.files.write_index``."""
    return spark.read.parquet(f"{path}/vectors"), spark.read.parquet(f"{path}/manifest")
