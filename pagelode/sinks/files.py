"""Sinks: JSON lines, reports, CSV over differing rows, Markdown, indexes, graph tables, run lineage."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelode.functions.scalars import heading_segments
from pagelode.functions.text import split_lines, strip
from pagelode.operators.blocks import reading_order, reading_position


@dataclass(frozen=True)
class StageRun:
    """Identity of one run of a stage; its id goes into trace ids."""

    stage_name: str
    stage_run_id: str
    started_at: datetime

    @classmethod
    def create(cls, stage: str, run_id: str | None = None) -> StageRun:
        return cls(stage, run_id or f"{stage}-{uuid.uuid4().hex[:12]}", datetime.now(timezone.utc))

    def manifest(self, spark: SparkSession) -> DataFrame:
        row = [(self.stage_name, self.stage_run_id, self.started_at, datetime.now(timezone.utc))]
        return spark.createDataFrame(row, "stage_name string, stage_run_id string, started_at timestamp, ended_at timestamp")

    def path(self, root: str, file: str) -> str:
        return f"{root.rstrip('/')}/{self.stage_name}/{file}"


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines with explicit nulls."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def report_json(df: DataFrame) -> DataFrame:
    """One row as a JSON report in column ``report``."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false", "pretty": "true"}).alias("report"))


def union_columns(parts: list[DataFrame]) -> DataFrame:
    """Rows of all parts under the sorted union of their columns; missing cells are null, nested values JSON."""
    flat = []
    for p in parts:
        flat.append(p.select(*(
            (F.to_json(f.name) if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) else F.col(f"`{f.name}`").cast("string")).alias(f.name) for f in p.schema.fields
        )))
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), flat)
    return out.select(*(F.col(f"`{c}`") for c in sorted(out.columns)))


def write_csv(parts: list[DataFrame], path: str) -> DataFrame:
    """CSV with header over :func:`union_columns`, and (row_count, status)."""
    rows = union_columns(parts)
    if not rows.isEmpty():
        rows.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)
    return rows.agg(F.count("*").alias("row_count")).withColumn("status", F.lit("skeleton"))


def markdown_blocks(blocks: DataFrame) -> DataFrame:
    """Each block as Markdown: (document_id, page, read_pos, markdown); page marks stand before the first block of a page."""
    on_page = Window.partitionBy("document_id", "page").orderBy(*reading_order()[1:])
    b = reading_position(blocks).withColumns({"_new": F.row_number().over(on_page) == 1, "_first": F.col("read_pos") == 0})
    raw = strip(F.coalesce("raw_text", F.lit("")))
    rows = F.transform(F.filter(split_lines(raw), lambda x: strip(x) != ""), lambda x: F.transform(F.split(x, "\t", -1), strip))
    width = F.array_max(F.transform(rows, lambda r: F.size(r)))
    full = F.transform(rows, lambda r: F.concat(F.lit("|"), F.array_join(F.concat(r, F.array_repeat(F.lit(""), width - F.size(r))), "|"), F.lit("|")))
    rule = F.concat(F.lit("|"), F.array_join(F.array_repeat(F.lit("---"), width), "|"), F.lit("|"))
    table = F.when(F.size(rows) > 0, F.concat(F.get(full, 0), F.lit("\n"), F.array_join(F.concat(F.array(rule), F.slice(full, F.lit(2), F.greatest(F.size(full) - 1, F.lit(0)))), "\n"), F.lit("\n\n"))).otherwise("")
    flat = lambda t: strip(F.replace(t, F.lit("\n"), F.lit(" ")))
    role = lambda s: (
        F.when(s["role"] == "heading1", F.concat(F.lit("# "), flat(s["text"]))).when(s["role"] == "heading2", F.concat(F.lit("## "), flat(s["text"])))
        .when(s["role"] == "heading3", F.concat(F.lit("### "), flat(s["text"]))).when(s["role"] == "caption", F.concat(F.lit("*"), strip(s["text"]), F.lit("*")))
        .when(s["role"] == "comment", F.concat(F.lit("<!-- "), strip(s["text"]), F.lit(" -->"))).otherwise(strip(s["text"]))
    )
    segs = F.filter(heading_segments(raw), lambda s: strip(s["text"]) != "")
    text = F.array_join(F.transform(segs, lambda s: F.concat(role(s), F.lit("\n"))), "\n")
    fence = lambda *x: F.concat(F.lit("```\n"), *x, F.lit("\n```\n"))
    body = (
        F.when(F.col("block_type") == "image", fence(F.lit("[IMAGE BLOCK]"), F.when(raw != "", F.concat(F.lit("\n"), raw)).otherwise("")))
        .when(F.col("block_type") == "table", table).when(F.col("block_type") == "equation", fence(raw)).otherwise(text)
    )
    mark = F.when(F.col("_new"), F.concat(F.when(F.col("_first"), "").otherwise("\n"), F.lit("<!-- page "), F.col("page").cast("string"), F.lit(" -->\n\n"))).otherwise("")
    return b.select("document_id", "page", "read_pos", F.concat(mark, body).alias("markdown"))


def write_markdown(blocks: DataFrame, path: str) -> None:
    """One folder per document, its blocks in reading order; a large document is cut into several files, in the order of their names."""
    m = markdown_blocks(blocks).filter("markdown <> ''")
    m.repartitionByRange("document_id", "read_pos").sortWithinPartitions("document_id", "read_pos").select("document_id", F.col("markdown").alias("value")).write.mode("overwrite").partitionBy("document_id").text(path)


def write_index(index: DataFrame, path: str, model: str = "", run_id: str = "") -> None:
    """Vectors with metadata partitioned by document, and a manifest row."""
    index.write.mode("overwrite").partitionBy("document_id").parquet(f"{path}/vectors")
    n = index.agg(F.count("*").alias("n_vectors"), F.max(F.size("vec")).alias("dim")) if "vec" in index.columns else index.agg(F.count("*").alias("n_vectors"))
    n.withColumns({"embedding_model": F.lit(model), "stage_run_id": F.lit(run_id)}).write.mode("overwrite").parquet(f"{path}/manifest")


def write_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """Node and relation tables as a graph database takes them: capped properties, edges with both ends only."""
    from pagelode.operators.graph import props_text, sound_edges

    nodes.select("id", F.col("type").alias("kind"), props_text(F.col("props")).alias("props")).write.mode("overwrite").parquet(f"{path}/nodes")
    sound_edges(nodes, edges).write.mode("overwrite").parquet(f"{path}/edges")


def write_blocks(blocks: DataFrame, path: str) -> None:
    """Page blocks partitioned by document; one shuffle on document and stretch of pages avoids small files and one task for a large document."""
    blocks.repartition("document_id", F.floor(F.coalesce("page", F.lit(0)) / 512)).write.mode("overwrite").partitionBy("document_id").parquet(path)
