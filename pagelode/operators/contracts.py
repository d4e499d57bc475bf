"""Contract checks: required values, allowed values and bounds per table, and the gate report over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelode.functions.text import blank_to_null
from pagelode.schemas import CONTRACTS


def violations(df: DataFrame, table: str, row_id: str = "trace_id") -> DataFrame:
    """One row per broken rule: (``row_id``, rule, column_name). One pass, no shuffle."""
    c = CONTRACTS[table]
    rules = []
    for col in c["required"]:
        if col not in df.columns:
            rules.append(F.struct(F.lit("required").alias("rule"), F.lit(col).alias("column_name")))
        else:
            missing = blank_to_null(F.col(col).cast("string")).isNull()
            rules.append(F.when(missing, F.struct(F.lit("required").alias("rule"), F.lit(col).alias("column_name"))))
    for col, allowed in c["choices"].items():
        if col in df.columns:
            rules.append(F.when(F.col(col).isNotNull() & ~F.col(col).isin(allowed), F.struct(F.lit("choice").alias("rule"), F.lit(col).alias("column_name"))))
    for col, (lo, hi) in c["bounds"].items():
        if col in df.columns:
            v = F.col(col).cast("double")
            bad = F.isnan(v)
            bad = bad | (v < lo) if lo is not None else bad
            bad = bad | (v > hi) if hi is not None else bad
            rules.append(F.when(v.isNotNull() & bad, F.struct(F.lit("bounds").alias("rule"), F.lit(col).alias("column_name"))))
    return df.select(row_id, F.explode(F.filter(F.array(*rules), lambda r: r.isNotNull())).alias("_r")).select(row_id, "_r.rule", "_r.column_name")


def quality_gates(t: dict[str, DataFrame]) -> DataFrame:
    """(gate, n_rows, passed) over the tables of a run that are there; a gate passes without bad rows."""
    from pagelode.operators.graph import dangling_edges

    field = ["document_id", "instruction_name", "variation", "field_name"]
    gates: dict[str, DataFrame] = {}
    for name in ("page_blocks", "instruction_catalog", "instruction_field_map"):
        if name in t and "trace_id" in t[name].columns:
            gates[f"contract_{name}"] = violations(t[name], name)
    if "instruction_field_map" in t:
        rows = t["instruction_field_map"].select(*field).distinct()
        for gate, other in (("fields_without_type", "field_datatype_catalog"), ("fields_without_domain", "field_domain_catalog")):
            if other in t:
                o = t[other].select(*(F.col(c).alias(f"_{c}") for c in field)).distinct()
                on = F.lit(True)
                for c in field:
                    on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
                gates[gate] = rows.join(o, on, "left_anti")
        gates["uncertain_fields"] = t["instruction_field_map"].filter("uncertain")
    if "scope_coverage" in t:
        gates["scopes_without_fields"] = t["scope_coverage"].filter("status = 'missing'")
    if "constraint_registry" in t:
        gates["constraints_without_expression"] = t["constraint_registry"].filter(blank_to_null("expression").isNull())
    if "edges" in t:
        gates["dangling_edges"] = dangling_edges(t["nodes"], t["edges"])
    if "test_cases" in t:
        gates["violated_cases"] = t["test_cases"].filter("constraint_satisfaction_status = 'violated'")
    out = None
    for name, df in gates.items():
        g = df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("gate"), "n_rows", (F.col("n_rows") == 0).alias("passed"))
        out = g if out is None else out.unionByName(g)
    if out is None:
        raise ValueError("nothing to check")
    return out


def gate_report(checked: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rule, column_name, n_rows) over the violations of several tables."""
    out = None
    for name, df in checked.items():
        g = df.groupBy("rule", "column_name").agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "*")
        out = g if out is None else out.unionByName(g)
    if out is None:
        raise ValueError("nothing to report")
    return out
