"""File sources: JSON objects, JSON lines, ground-truth lists, override sheets, graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.functions.scalars import normalize_variation
from pagelode.functions.text import strip


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON object per file; a missing file is an error."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines: a missing file is an empty table, a malformed line an error, blank lines are skipped."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def jsonl_from_bytes(spark: SparkSession, data: bytes, schema: str) -> DataFrame:
    """JSON lines handed over as bytes (an upload, so of bounded size); undecodable bytes are replaced."""
    lines = [(i, x) for i, x in enumerate(data.decode("utf-8", errors="replace").removeprefix("﻿").split("\n")) if x.strip()]
    df = spark.createDataFrame(lines, "n bigint, line string")
    return df.select(F.from_json("line", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(pos, line) of a text file read whole (ground truth is hand-written): comments and blank lines left out, no byte order mark."""
    whole = spark.read.option("wholetext", True).text(path)
    e = whole.select(F.posexplode(F.split(F.regexp_replace("value", "^﻿", ""), r"\r\n|\n|\r")).alias("pos", "line"))
    return e.withColumn("line", strip("line")).filter((F.col("line") != "") & ~F.col("line").startswith("#"))


def _is_json(path: str) -> bool:
    return path.endswith((".json", ".jsonl"))


_GT = "instruction_name string, name string, mnemonic string, variation string, opcode_raw string, opcode_value bigint, execution_unit string, instruction_kind string, aliases array<string>, field_name string, bit_range string, word_index int"


def _json_items(spark: SparkSession, path: str, schema: str, field: str | None = None) -> DataFrame:
    """(pos, item) of a JSON array, a JSON object holding one, or JSON lines; plain strings become names."""
    if path.endswith(".jsonl"):
        raw = numbered_lines(spark, path).select("pos", F.col("line").alias("item"))
    else:
        whole = spark.read.option("wholetext", True).text(path).select(F.trim("value").alias("v"))
        arr = F.when(F.col("v").startswith("["), F.col("v")).otherwise(F.get_json_object("v", f"$.{field or 'instructions'}"))
        raw = whole.select(F.posexplode(F.from_json(arr, "array<string>")).alias("pos", "item"))
    obj = F.when(F.col("item").startswith("{"), F.from_json("item", schema))
    return raw.select("pos", "item", obj.alias("o"))


def read_instruction_truth(spark: SparkSession, path: str) -> DataFrame:
    """Instructions expected: one name per line (text files) or objects / strings (JSON); columns pos, instruction_name, …"""
    if not _is_json(path):
        t = numbered_lines(spark, path).select("pos", F.col("line").alias("instruction_name"))
        nulls = {c: F.lit(None).cast(k) for c, k in (("variation", "string"), ("opcode_raw", "string"), ("opcode_value", "bigint"), ("execution_unit", "string"), ("instruction_kind", "string"))}
        return t.withColumns(nulls)
    e = _json_items(spark, path, _GT)
    bare = F.when(F.col("o").isNull(), F.regexp_replace("item", '^"|"$', ""))
    name = F.coalesce("o.instruction_name", "o.name", "o.mnemonic", bare)
    return e.select("pos", strip(name).alias("instruction_name"), "o.variation", "o.opcode_raw", "o.opcode_value", "o.execution_unit", "o.instruction_kind").filter("instruction_name <> ''")


_BIT_TOKEN = r"^\[?[0-9]{1,3}(\s*:\s*[0-9]{1,3})?\]?$"


def read_field_truth(spark: SparkSession, path: str) -> DataFrame:
    """Fields expected: lines ``INSTR FIELD [BITS]`` or ``INSTR VAR FIELD [BITS]``, or objects."""
    if _is_json(path):
        e = _json_items(spark, path, _GT, "fields")
        return e.select("pos", strip(F.upper("o.instruction_name")).alias("instruction_name"), normalize_variation("o.variation").alias("variation"), F.upper(strip(F.col("o.field_name"))).alias("field_name"), F.regexp_replace("o.bit_range", r"[\s\[\]]", "").alias("bit_range"), "o.word_index").filter("instruction_name <> '' AND field_name <> ''")
    t = numbered_lines(spark, path).withColumn("t", F.split("line", r"\s+"))
    at = lambda i: F.get("t", i)
    is_bits = lambda i: F.coalesce(at(i).rlike(_BIT_TOKEN), F.lit(False))
    n = F.size("t")
    four, three = (n >= 4) & is_bits(3), (n >= 3) & is_bits(2)
    with_var = four | ((n == 3) & ~three)
    known = four | three | (n == 3) | (n == 2)
    bits = F.when(four, at(3)).when(three, at(2))
    return t.filter(known).select(
        "pos", F.upper(at(0)).alias("instruction_name"), F.when(with_var, normalize_variation(at(1))).alias("variation"),
        F.upper(F.when(with_var, at(2)).otherwise(at(1))).alias("field_name"), F.regexp_replace(bits, r"[\s\[\]]", "").alias("bit_range"), F.lit(None).cast("int").alias("word_index"),
    )


def read_name_truth(spark: SparkSession, path: str, field: str = "canonical_field_names") -> DataFrame:
    """Canonical names expected, distinct, case kept."""
    if _is_json(path):
        e = _json_items(spark, path, _GT, field)
        return e.select(strip(F.coalesce("o.field_name", F.regexp_replace("item", '^"|"$', ""))).alias("field_name")).filter("field_name <> ''").distinct()
    return numbered_lines(spark, path).select(F.col("line").alias("field_name")).distinct()


def _tagged(spark: SparkSession, path: str, tag: str) -> DataFrame:
    t = numbered_lines(spark, path).withColumn("p", F.transform(F.split("line", r"\|", -1), strip))
    return t.filter(F.upper(F.get("p", 0)) == tag).select("pos", F.slice("p", F.lit(2), F.size("p")).alias("p"))


def read_typed_truth(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Sections of ``TYPE|…``, ``DTYPE|…`` (2 to 4 operands) and ``DOMAIN|…`` (2 or 3; form range by default) lines."""
    at = lambda i: F.get("p", i)
    types = _tagged(spark, path, "TYPE").select("pos", at(0).alias("type_id"), at(1).alias("category")).filter("type_id <> ''")
    d = _tagged(spark, path, "DTYPE").withColumn("n", F.size("p"))
    dtypes = d.filter("n BETWEEN 2 AND 4").select(
        "pos", F.when(F.col("n") > 2, F.upper(at(0))).otherwise("").alias("instruction_name"), F.when(F.col("n") == 4, normalize_variation(at(1))).alias("variation"),
        F.upper(F.get("p", F.col("n") - 2)).alias("field_name"), F.get("p", F.col("n") - 1).alias("data_type_ref"),
    )
    m = _tagged(spark, path, "DOMAIN").withColumn("n", F.size("p"))
    domains = m.filter("n IN (2, 3)").select(
        "pos", F.upper(at(0)).alias("field_name"), F.when(F.col("n") == 3, at(1)).otherwise("range").alias("allowed_value_form"), F.get("p", F.col("n") - 1).alias("allowed_values_or_range")
    )
    return {"types": types, "dtypes": dtypes, "domains": domains}


def read_graph_truth(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Sections of ``CONSTRAINT|id``, ``NODE|id`` and ``EDGE|from|rel|to`` lines."""
    at = lambda i: F.get("p", i)
    return {
        "constraints": _tagged(spark, path, "CONSTRAINT").select("pos", at(0).alias("constraint_id")).filter("constraint_id <> ''"),
        "nodes": _tagged(spark, path, "NODE").select("pos", at(0).alias("id")).filter("id <> ''"),
        "edges": _tagged(spark, path, "EDGE").filter(F.size("p") >= 3).select("pos", at(0).alias("from"), at(1).alias("rel"), at(2).alias("to")),
    }


def read_override_sheet(spark: SparkSession, path: str) -> DataFrame:
    """(scope, fields) of an override sheet, a JSON object: keys in upper case (the last wins), ``_`` keys are comments."""
    whole = spark.read.option("wholetext", True).text(path)
    m = whole.select(F.explode(F.from_json("value", "map<string,string>", {"mode": "FAILFAST"})).alias("k", "v")).filter(~F.col("k").startswith("_"))
    fields = F.from_json("v", "fields array<struct<field_name:string,bit_range:string,word_index:int>>")["fields"]
    n = m.select(F.upper(strip("k")).alias("scope"), fields.alias("fields"), F.monotonically_increasing_id().alias("_pos"))
    return n.groupBy("scope").agg(F.max_by("fields", "_pos").alias("fields"))


def read_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of a graph file ``{"nodes": […], "edges": [{from, rel, to}]}``."""
    g = read_json(spark, path, "nodes array<map<string,string>>, edges array<struct<`from`:string,rel:string,`to`:string>>")
    nodes = g.select(F.posexplode("nodes").alias("pos", "n")).select(F.col("n")["id"].alias("id"), F.col("n")["type"].alias("type"), F.to_json("n").alias("props"), "pos")
    return nodes, g.select(F.inline("edges"))
