"""Structured Streaming over page blocks: files as they arrive, page metrics, first sight of terms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.functions.scalars import is_equation


def stream_table(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_trigger: int = 16) -> DataFrame:  # noqa: ANN001
    """New files of a folder as a stream."""
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_trigger).load(path)


def tag_equations_stream(blocks: DataFrame) -> DataFrame:
    """The stateless equation rule works on streams as it does on tables."""
    return blocks.withColumn("block_type", F.when((F.col("block_type") == "text") & is_equation("raw_text"), "equation").otherwise(F.col("block_type")))


def loads_per_window(rows: DataFrame, at: str = "loaded_at", late: str = "1 day", width: str = "1 day") -> DataFrame:
    """Rows per document and time window; rows later than ``late`` behind the watermark are not waited for."""
    return rows.withWatermark(at, late).groupBy(F.window(at, width), "document_id").agg(F.count("*").alias("n_rows")).select("window.start", "window.end", "document_id", "n_rows")


def first_deliveries(rows: DataFrame, row_id: str = "trace_id", at: str = "loaded_at", late: str = "7 days") -> DataFrame:
    """Each id once, within the watermark: deliveries repeated later than that are no longer remembered."""
    return rows.withWatermark(at, late).dropDuplicatesWithinWatermark([row_id])
