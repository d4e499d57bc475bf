"""Catalog building: order-dependent merges, first- and last-wins, registry repair, rows from ground truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelode.functions import scalars as S
from pagelode.functions.text import blank_to_null, strip
from pagelode.session import materialize


def attach_scope(df: DataFrame, name: str = "instruction_name", variation: str = "variation") -> DataFrame:
    """Upper-case name and explicit (possibly null) variation."""
    return df.withColumns({"instruction_name": F.upper(strip(F.coalesce(F.col(name), F.lit("")))), "variation": S.normalize_variation(variation)})


def first_wins(df: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """The first row per key by ``pos``; aggregated on the map side, so no group meets in one task."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), pos).alias("_r")).select(*keys, "_r.*")


def last_wins(df: DataFrame, keys: list[str], pos: str) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), pos).alias("_r")).select(*keys, "_r.*")


def fold_by_confidence(df: DataFrame, keys: list[str], pos: str, confidence: str, margin: float = 0.01) -> DataFrame:
    """Per key the row an ordered fold ends with: a later row replaces the current one only if its confidence
    exceeds it by more than ``margin``.

    Only a row above every earlier one can ever replace, so each key's running maxima (a window, spilled and never
    held as a whole) are all the fold needs; their number is bounded by the distinct steps of confidence.
    """
    w = Window.partitionBy(*keys).orderBy(pos)
    before = F.max(confidence).over(w.rowsBetween(Window.unboundedPreceding, -1))
    steps = df.withColumn("_b", before).filter(F.col("_b").isNull() | (F.col(confidence) > F.col("_b"))).drop("_b")
    rest = [c for c in df.columns if c not in keys]
    ordered = F.array_sort(F.collect_list(F.struct(F.col(pos).alias("_o"), F.struct(*rest).alias("_r"))))
    folded = F.aggregate(
        F.slice("_s", F.lit(2), F.greatest(F.size("_s") - 1, F.lit(0))), F.get("_s", 0),
        lambda cur, x: F.when(x["_r"][confidence] > cur["_r"][confidence] + margin, x).otherwise(cur),
    )
    return steps.groupBy(*keys).agg(ordered.alias("_s")).withColumn("_w", folded).select(*keys, "_w._r.*")


def _aliases(df: DataFrame) -> Column:
    """Stripped aliases without blank ones; an empty list where there are none."""
    if "aliases" not in df.columns:
        return F.array().cast("array<string>").alias("aliases")
    return F.coalesce(F.filter(F.transform("aliases", strip), lambda x: x != ""), F.array().cast("array<string>")).alias("aliases")


def instruction_catalog(items: DataFrame, run_id: str = "run") -> DataFrame:
    """Catalog rows from extracted items (document_id, pos, and raw columns): names of 1 to 64 characters, folded per scope."""
    c = F.col
    n = items.select(
        "document_id", "pos", F.upper(strip(F.coalesce("instruction_name", F.lit("")))).alias("instruction_name"), F.coalesce(S.normalize_variation("variation"), F.lit("")).alias("variation"),
        F.coalesce(blank_to_null("opcode_raw"), F.lit("UNKNOWN")).alias("opcode_raw"), F.coalesce(blank_to_null("execution_unit"), F.lit("UNKNOWN_UNIT")).alias("execution_unit"),
        S.clamp_choice("instruction_kind", S.INSTRUCTION_KINDS, "unknown").alias("instruction_kind"),
        S.clamp_unit(c("instruction_kind_confidence"), 0.35).alias("instruction_kind_confidence"), S.clamp_unit(c("confidence_score"), 0.6).alias("confidence_score"),
        F.coalesce(c("source_page").try_cast("int"), F.lit(1)).alias("page"), _aliases(items),
    ).filter((F.length("instruction_name") > 0) & (F.length("instruction_name") <= 64))
    f = fold_by_confidence(n, ["document_id", "instruction_name", "variation"], "pos", "confidence_score")
    return numbered_by(f, ["instruction_name", "variation"], "document_id").withColumnRenamed("n", "_i").select(
        S.trace_id(run_id, F.lit("instr"), c("_i")).alias("trace_id"), "document_id", "instruction_name", F.nullif("variation", F.lit("")).alias("variation"), "aliases", "opcode_raw",
        S.opcode_radix("opcode_raw").alias("opcode_radix"), S.opcode_value("opcode_raw").alias("opcode_value"), "execution_unit", "instruction_kind",
        F.round("instruction_kind_confidence", 4).alias("instruction_kind_confidence"), F.round("confidence_score", 4).alias("confidence_score"),
        F.array(F.struct(c("page"))).alias("source_refs"), c("_i").alias("pos"),
    )


def catalog_from_truth(truth: DataFrame, run_id: str = "run") -> DataFrame:
    """Catalog rows from ground truth: the last entry of a scope wins, opcodes are derived, defaults filled."""
    k = truth.withColumns({"instruction_name": F.upper(strip(F.coalesce("instruction_name", F.lit("")))), "variation": F.coalesce(S.normalize_variation("variation"), F.lit(""))})
    one = last_wins(k.filter("instruction_name <> ''"), ["instruction_name", "variation"], "pos")
    raw = S.opcode_text("opcode_raw", "opcode_value")
    return numbered_by(one.withColumn("_raw", raw), ["instruction_name", "variation"]).select(
        S.trace_id(run_id, F.lit("gt"), F.col("n")).alias("trace_id"), "instruction_name", F.nullif("variation", F.lit("")).alias("variation"), _aliases(one), F.col("_raw").alias("opcode_raw"),
        F.when(S.opcode_value("_raw").isNotNull(), S.opcode_radix("_raw")).otherwise("unknown").alias("opcode_radix"), F.coalesce(S.opcode_value("_raw"), F.col("opcode_value").cast("bigint")).alias("opcode_value"),
        F.coalesce(blank_to_null("execution_unit"), F.lit("UNKNOWN_UNIT")).alias("execution_unit"), S.clamp_choice("instruction_kind", S.INSTRUCTION_KINDS, "unknown").alias("instruction_kind"),
        F.lit(1.0).alias("instruction_kind_confidence"), F.lit(1.0).alias("confidence_score"),
        F.array(F.struct(F.lit("ground_truth_catalog").alias("method"))).alias("source_refs"),
    )


def field_map_from_truth(truth: DataFrame, run_id: str = "run") -> DataFrame:
    """Field rows from ground truth with full confidence; a missing bit range is ''."""
    t = attach_scope(truth).withColumn("field_name", F.upper(strip(F.coalesce("field_name", F.lit("")))))
    return t.select(
        S.trace_id(run_id, F.lit("gt"), F.col("pos")).alias("trace_id"), "instruction_name", "variation", "field_name", F.coalesce("bit_range", F.lit("")).alias("bit_range"),
        F.coalesce("word_index", F.lit(0)).alias("word_index") if "word_index" in truth.columns else F.lit(0).alias("word_index"), F.lit(1.0).alias("confidence_score"), F.lit(False).alias("uncertain"),
    )


def global_schema_from_truth(names: DataFrame) -> DataFrame:
    """One row: the sorted distinct canonical names of a (hand-written) list and their number."""
    n = F.array_sort(F.collect_set("field_name"))
    return names.agg(n.alias("canonical_field_names"), F.size(n).alias("n_fields"))


def typed_from_truth(truth: dict[str, DataFrame], run_id: str = "run") -> dict[str, DataFrame]:
    """Registry, field types and domains from ground truth, with ids of their own and empty references."""
    prefix = {"types": "reg", "dtypes": "dtype", "domains": "domain"}
    return {k: with_trace_ids(truth[k].withColumn("source_refs", F.array().cast("array<struct<page:int>>")), run_id, p) for k, p in prefix.items() if k in truth}


def graph_from_truth(truth: dict[str, DataFrame], run_id: str = "run") -> dict[str, DataFrame]:
    """Constraints with ids of their own, nodes and edges from ground truth."""
    return {**truth, "constraints": with_trace_ids(truth["constraints"], run_id, "c")}


def with_trace_ids(df: DataFrame, run_id: str, prefix: str, pos: str = "pos") -> DataFrame:
    """Fills missing trace ids with ``{run}:{prefix}:{pos}`` and missing references with an empty list."""
    out = df.withColumn("trace_id", F.coalesce(F.col("trace_id") if "trace_id" in df.columns else F.lit(None).cast("string"), S.trace_id(run_id, F.lit(prefix), F.col(pos))))
    return out.withColumn("source_refs", F.coalesce("source_refs", F.array())) if "source_refs" in df.columns else out


def type_slug(raw: str) -> Column:
    s = F.regexp_replace(F.regexp_replace(F.upper(strip(F.coalesce(F.col(raw), F.lit("")))), r"[^A-Z0-9_]+", "_"), r"^_+|_+$", "")
    return F.when(s == "", "UNKNOWN_TYPE").otherwise(s)


def datatype_registry(items: DataFrame, run_id: str = "run") -> DataFrame:
    """Types by normalised id, the first of each kept, numbered in the order of ids; unknown ids are left out."""
    n = items.withColumn("type_id", type_slug("type_id")).filter("type_id <> 'UNKNOWN_TYPE'")
    one = first_wins(n.select("type_id", "pos", *[c for c in ("type_name_raw", "category", "description") if c in items.columns]), ["type_id"], "pos")
    return numbered_by(one, "type_id").select(
        S.trace_id(run_id, F.lit("reg"), F.col("n")).alias("trace_id"), "type_id", F.coalesce(blank_to_null("type_name_raw"), F.col("type_id")).alias("type_name_raw"),
        F.col("type_id").alias("type_name_normalized"), S.clamp_choice("category", S.DATATYPE_CATEGORIES, "unknown").alias("category"), strip(F.coalesce("description", F.lit(""))).alias("description"),
    )


def numbered_by(df: DataFrame, key: str | list[str], by: str | None = None) -> DataFrame:
    """Adds ``n``, the rank from 0 in the order of ``key`` (of each ``by``, if given).

    The table is sorted by ranges and written once with the place of each row in its range; the sizes of the ranges before,
    a row for each range, give the rest. No single task sorts the table or a large group of it.
    """
    order = [*([by] if by else []), *([key] if isinstance(key, str) else key)]
    d = materialize(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part, place = F.shiftrightunsigned("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    d = d.withColumns({"_part": part, "_place": place})
    group = [by] if by else []
    sizes = d.groupBy(*group, "_part").agg(F.count("*").alias("_n"), F.min("_place").alias("_from"))
    before = (Window.partitionBy(by) if by else Window.partitionBy()).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*(F.col(c).alias(f"_{c}") for c in group), F.col("_part").alias("_p"), (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_from")).alias("_o"))
    on = F.col("_part") == F.col("_p")
    if by:
        on = on & F.col(by).eqNullSafe(F.col(f"_{by}"))
    return d.join(offsets, on).withColumn("n", F.col("_o") + F.col("_place")).drop("_at", "_part", "_place", "_p", "_o", *(f"_{c}" for c in group))


def repair_types(mappings: DataFrame, registry: DataFrame) -> DataFrame:
    """Mappings whose ``data_type_ref`` is no registered id take the alphabetically first id; an empty registry knows ``UNKNOWN`` only."""
    ids = registry.select(F.col("type_id").alias("_id")).distinct()
    least = registry.agg(F.coalesce(F.min("type_id"), F.lit("UNKNOWN"))).scalar()
    ref = strip(F.coalesce("data_type_ref", F.lit("")))
    j = mappings.withColumn("_ref", ref).join(ids, F.col("_ref") == F.col("_id"), "left")
    return j.withColumn("repaired", F.col("_id").isNull()).withColumn("data_type_ref", F.coalesce(F.col("_id"), least)).drop("_ref", "_id")


def field_datatypes(fields: DataFrame, run_id: str = "run") -> DataFrame:
    """Types inferred from bit widths."""
    t = S.type_id_for_width(S.bit_width("bit_range"))
    keep = [c for c in ("document_id", "pos") if c in fields.columns]
    return attach_scope(fields).select(*keep, "instruction_name", "variation", strip(F.coalesce("field_name", F.lit(""))).alias("field_name"), t.alias("data_type_raw"), t.alias("data_type_ref"))


def field_domains(fields: DataFrame) -> DataFrame:
    """Domains inferred from bit widths."""
    keep = [c for c in ("document_id", "pos", "instruction_name", "variation") if c in fields.columns]
    return fields.select(*keep, strip(F.coalesce("field_name", F.lit(""))).alias("field_name"), F.lit("range").alias("allowed_value_form"), S.domain_for_width(S.bit_width("bit_range")).alias("allowed_values_or_range"))


def inferred_registry(fields: DataFrame) -> DataFrame:
    """Distinct inferred types with their value ranges; ``uint4`` if there are no fields."""
    w = S.bit_width("bit_range")
    found = fields.select(S.type_id_for_width(w).alias("type_id"), S.domain_for_width(w).alias("value_constraint_summary"), w.alias("_w"))
    one = found.groupBy("type_id").agg(F.min_by("value_constraint_summary", "_w").alias("value_constraint_summary"))
    spark = fields.sparkSession
    default = spark.createDataFrame([("uint4", "0..15")], "type_id string, value_constraint_summary string")
    some = found.limit(1).select(F.lit(1).alias("_x"))
    return one.unionByName(default.join(some, how="left_anti")).withColumn("category", F.lit("software_primitive"))
