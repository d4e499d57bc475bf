"""Precision, recall and F1 of extracted tables against ground truth, as set operations on key tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelode.functions import scalars as S
from pagelode.functions.text import blank_to_null, strip


def score(tp: Column, fp: Column, fn: Column) -> list[Column]:
    """precision, recall, f1 rounded to 6: without predictions precision is 1 only if nothing was to be found."""
    p = F.when(tp + fp > 0, tp / F.when(tp + fp > 0, tp + fp)).otherwise(F.when(tp + fn == 0, 1.0).otherwise(0.0))
    r = F.when(tp + fn > 0, tp / F.when(tp + fn > 0, tp + fn)).otherwise(1.0)
    f = F.when(p + r <= 0, 0.0).otherwise(2 * p * r / F.when(p + r > 0, p + r))
    return [F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(f, 6).alias("f1")]


def verdicts(pred: DataFrame, truth: DataFrame, keys: list[str]) -> DataFrame:
    """Every distinct key with its verdict TP, FP or FN; nulls in keys are equal.

    One aggregation over the union: both sides are reduced before the shuffle and no join is needed.
    """
    both = pred.select(*keys, F.lit(1).alias("_p"), F.lit(0).alias("_t")).unionByName(truth.select(*keys, F.lit(0).alias("_p"), F.lit(1).alias("_t")))
    g = both.groupBy(*keys).agg(F.max("_p").alias("_p"), F.max("_t").alias("_t"))
    verdict = F.when((F.col("_p") == 1) & (F.col("_t") == 1), "TP").when(F.col("_p") == 1, "FP").otherwise("FN")
    return g.select(*keys, verdict.alias("verdict"))


def metrics(judged: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row (per group of ``by``): tp, fp, fn and the scores."""
    n = lambda v: F.count_if(F.col("verdict") == v)
    g = judged.groupBy(*by) if by else judged.groupBy()
    counts = g.agg(n("TP").alias("tp"), n("FP").alias("fp"), n("FN").alias("fn"))
    return counts.select(*(by or []), "tp", "fp", "fn", *score(F.col("tp"), F.col("fp"), F.col("fn")))


def evaluate(pred: DataFrame, truth: DataFrame, keys: list[str], by: list[str] | None = None) -> DataFrame:
    return metrics(verdicts(pred, truth, keys), by)


def _scope(df: DataFrame) -> DataFrame:
    return df.withColumns({"name": F.upper(strip(F.coalesce("instruction_name", F.lit("")))), "var": F.coalesce(S.normalize_variation("variation"), F.lit(""))}).filter("name <> ''")


def evaluate_instructions(pred: DataFrame, truth: DataFrame, scope: list[str] | None = None) -> DataFrame:
    """Scores on (name, variation) and how many opcodes of true positives match.

    Of several predictions of a key the first counts, of several true entries the last; both tables carry ``pos``.
    """
    key = [*(scope or []), "name", "var"]
    p = _scope(pred).groupBy(*key).agg(F.min_by("opcode_value", "pos").alias("pv"), F.lit(1).alias("_p"))
    t = _scope(truth).groupBy(*key).agg(F.max_by("opcode_value", "pos").alias("tv"), F.lit(1).alias("_t"))
    j = p.join(t, key, "full_outer")
    hit = F.col("_p").isNotNull() & F.col("_t").isNotNull()
    c = j.agg(
        F.count_if(hit).alias("tp"), F.count_if(F.col("_t").isNull()).alias("fp"), F.count_if(F.col("_p").isNull()).alias("fn"),
        F.count_if(hit & F.col("tv").isNotNull()).alias("opcode_defined"), F.count_if(hit & (F.col("tv") == F.col("pv"))).alias("opcode_matches"),
    )
    recall = F.round(F.when(F.col("opcode_defined") > 0, F.col("opcode_matches") / F.when(F.col("opcode_defined") > 0, F.col("opcode_defined"))), 6)
    return c.select("tp", "fp", "fn", *score(F.col("tp"), F.col("fp"), F.col("fn")), "opcode_defined", "opcode_matches", recall.alias("opcode_recall"))


def evaluate_field_map(pred: DataFrame, truth: DataFrame, scope: list[str] | None = None) -> DataFrame:
    """Scores on (name, variation, field[, bit range]): the range counts only if any true row has one; missing ranges are equal."""
    uses = truth.agg(F.coalesce(F.bool_or(blank_to_null("bit_range").isNotNull()), F.lit(False))).scalar()
    key = [*(scope or []), "name", "var", "field", "bits"]

    def keyed(df: DataFrame) -> DataFrame:
        d = _scope(df).withColumn("field", F.upper(blank_to_null("field_name"))).filter("field IS NOT NULL")
        return d.withColumn("bits", F.when(uses, F.regexp_replace(blank_to_null("bit_range"), r"\s", "")))

    return evaluate(keyed(pred), keyed(truth), key)


def evaluate_names(pred: DataFrame, truth: DataFrame, column: str = "field_name", upper: bool = False) -> DataFrame:
    """Scores on one column of names, upper-cased only if asked."""
    def keyed(df: DataFrame) -> DataFrame:
        s = blank_to_null(column)
        return df.select((F.upper(s) if upper else s).alias("k")).filter("k IS NOT NULL")

    return evaluate(keyed(pred), keyed(truth), ["k"])


def evaluate_sections(sections: dict[str, tuple[DataFrame, DataFrame, list[str]]]) -> DataFrame:
    """Scores of several sections in one table; a section without true rows is not reported."""
    out = None
    for name, (pred, truth, keys) in sections.items():
        m = evaluate(pred, truth, keys).filter("tp + fn > 0").select(F.lit(name).alias("section"), "*")
        out = m if out is None else out.unionByName(m)
    if out is None:
        raise ValueError("no section to evaluate")
    return out


def evaluate_graph(constraints: tuple[DataFrame, DataFrame], nodes: tuple[DataFrame, DataFrame], edges: tuple[DataFrame, DataFrame]) -> DataFrame:
    """Scores of constraints, nodes and edges by their identities."""
    return evaluate_sections({
        "constraints": (*constraints, ["constraint_id"]), "nodes": (*nodes, ["id"]), "edges": (*edges, ["from", "rel", "to"]),
    })
