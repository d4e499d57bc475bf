"""Constraints from value domains and from extracted items, and their counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelode.functions import scalars as S
from pagelode.functions.text import blank_to_null, strip

_ID_WIDTH = 4


def _numbered(prefix: F.Column | str, n: str):  # noqa: ANN202
    return F.concat(prefix if not isinstance(prefix, str) else F.lit(prefix), F.lit("_"), F.when(F.length(F.col(n).cast("string")) >= _ID_WIDTH, F.col(n).cast("string")).otherwise(F.lpad(F.col(n).cast("string"), _ID_WIDTH, "0")))


def _document(df: DataFrame) -> list[str]:
    return [c for c in ("document_id",) if c in df.columns]


def constraints_from_domains(domains: DataFrame, run_id: str = "run", pos: str = "pos") -> DataFrame:
    """One constraint per domain row; a placeholder if there is no domain at all. ``pos`` numbers the rows."""
    field = F.coalesce(strip(F.col("field_name")), F.lit("UNKNOWN"))
    rows = domains.select(
        *_document(domains), S.trace_id(run_id, F.lit("c"), F.col(pos)).alias("trace_id"),
        _numbered(F.concat(F.lit("C_"), S.field_slug("field_name")), pos).alias("constraint_id"),
        S.value_form("allowed_value_form").alias("constraint_type_level1"),
        F.lit("field-domain").alias("constraint_type_level2"),
        S.domain_expression("field_name", "allowed_value_form", "allowed_values_or_range").alias("expression"),
        F.lit("derived from field_domain_catalog").alias("classification_rationale"),
        F.struct(F.lit("Field").alias("entity_type"), field.alias("entity_name")).alias("applies_to"),
        F.struct(
            S.value_form("allowed_value_form").alias("allowed_value_form"), blank_to_null("allowed_values_or_range").isNull().alias("domain_value_unspecified"),
            S.structured_domain("allowed_value_form", "allowed_values_or_range").alias("structured_domain"),
        ).alias("domain_constraint_meta"),
    )
    spark = domains.sparkSession
    none = spark.createDataFrame(
        [(f"{run_id}:c:0", "C_PLACEHOLDER_001", "range", "instruction-specific", "0 <= OPCODE <= 15", "placeholder when field_domain_catalog is empty")],
        "trace_id string, constraint_id string, constraint_type_level1 string, constraint_type_level2 string, expression string, classification_rationale string",
    ).withColumn("applies_to", F.struct(F.lit("Field").alias("entity_type"), F.lit("OPCODE").alias("entity_name")))
    some = domains.limit(1).select(F.lit(1).alias("_x"))
    return rows.unionByName(none.join(some, how="left_anti"), allowMissingColumns=True)


def constraints_from_items(items: DataFrame, mapping: DataFrame, run_id: str = "run", start: int = 0, pos: str = "pos") -> DataFrame:
    """Constraints from extracted items; categories go through ``mapping`` (label, canonical), unmapped ones stay."""
    m = mapping.select(F.col("label").alias("_l"), F.col("canonical").alias("_c"))
    cand = F.coalesce(blank_to_null("constraint_category_candidate"), F.lit("unknown"))
    j = items.withColumn("_cand", cand).withColumn("_n", (F.col(pos) + start).cast("bigint")).join(m, F.col("_cand") == F.col("_l"), "left")
    canon = F.coalesce(F.when(F.col("_l").isNull(), F.col("_cand")).otherwise(blank_to_null("_c")), F.lit("unknown"))
    field, inst = blank_to_null("field_name"), blank_to_null("instruction_name")
    return j.select(
        *_document(items), S.trace_id(run_id, F.lit("c:llm"), F.col("_n")).alias("trace_id"), _numbered("C_LLM", "_n").alias("constraint_id"),
        F.left(F.replace(canon, F.lit(" "), F.lit("_")), F.lit(64)).alias("constraint_type_level1"), F.lit("llm-document").alias("constraint_type_level2"),
        F.left(F.coalesce(F.nullif("constraint_content", F.lit("")), "verbatim_sentence", F.lit("")), F.lit(2000)).alias("expression"),
        F.concat(F.lit("LLM extraction; candidate="), F.col("_cand")).alias("classification_rationale"),
        F.struct(
            F.when(field.isNotNull(), "Field").when(inst.isNotNull(), "Instruction").otherwise("Document").alias("entity_type"),
            F.coalesce(field, inst, F.lit("GLOBAL")).alias("entity_name"),
        ).alias("applies_to"),
        F.coalesce(F.col("source_page").try_cast("int"), F.lit(1)).alias("page"), "verbatim_sentence",
    )


def category_labels(items: DataFrame) -> DataFrame:
    """Distinct category labels to be normalised."""
    return items.select(F.coalesce(blank_to_null("constraint_category_candidate"), F.lit("unknown")).alias("label")).distinct()


def complete_mapping(labels: DataFrame, mapping: DataFrame) -> DataFrame:
    """A mapping over all labels; those it lacks map to themselves."""
    m = mapping.select(F.col("label"), F.col("canonical").alias("_c"))
    return labels.join(m, "label", "left").select("label", F.coalesce(blank_to_null("_c"), F.col("label")).alias("canonical"))


def constraint_counts(constraints: DataFrame) -> DataFrame:
    """Counts by level 1 and by level 2 in one aggregation: (level, label, n)."""
    c = constraints.select(F.coalesce("constraint_type_level1", F.lit("")).alias("l1"), F.coalesce("constraint_type_level2", F.lit("")).alias("l2"))
    g = c.groupingSets([[F.col("l1")], [F.col("l2")]], F.col("l1"), F.col("l2")).agg(F.count("*").alias("n"), F.grouping("l1").alias("_g"))
    return g.select(F.when(F.col("_g") == 0, "level1").otherwise("level2").alias("level"), F.when(F.col("_g") == 0, F.col("l1")).otherwise(F.col("l2")).alias("label"), "n")


def evaluate_domain(values: str = "value", meta: str = "structured_domain"):  # noqa: ANN201
    """Whether a numeric value or text satisfies a structured domain; null where the domain says nothing checkable."""
    d, v = F.col(meta), F.col(values)
    num = lambda x: F.when(x.rlike("^0[xX]"), F.conv(F.substring(x, 3, 15), 16, 10)).otherwise(x).try_cast("bigint")
    lo, hi = num(d["lo_raw"]), num(d["hi_raw"])
    return F.when(d["form"] == "enum", F.array_contains(d["values"], v.cast("string"))).when(lo.isNotNull() & hi.isNotNull(), v.try_cast("bigint").between(lo, hi))
