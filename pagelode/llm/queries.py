"""Queries of the problems tagged llm over the pipeline's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.functions.text import alnum_key
from pagelode.llm.consensus import consensus_survivors, trusted_survivors
from pagelode.llm.format_dups import canonical_name, canonical_parts, format_collapsed, format_copies, unordered
from pagelode.llm.leakage import leaked_items
from pagelode.llm.ocr_repair import noisy_lines, repair_blocks
from pagelode.llm.packing import packed_documents
from pagelode.llm.splitting import split_documents
from pagelode.llm.sql import ORACLE  # noqa: F401
from pagelode.session import materialize, table


def _valid_confidence(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (c >= 0) & (c <= 1)


def readable_number(c: Column) -> Column:
    """Decimal digits or 0x with hexadecimal digits, apart from outer white space."""
    return F.coalesce(c.rlike(r"^[\s\p{Z}]*([0-9]+|0[xX][0-9A-Fa-f]+)[\s\p{Z}]*$"), F.lit(False))


def _p1(spark: SparkSession, base: str, keep: list[str], fall: float | None = None) -> DataFrame:
    """Survivors by the order of trust alone, or by the consensus of votes that fall with it."""
    cat = table(spark, base, "instruction_catalog").select(
        "trace_id", "document_id", "instruction_name", "variation", "opcode_raw", "confidence_score", "extracted_at"
    )
    if fall == 1:  # rows delivered twice would vote twice
        cat = cat.dropDuplicates(["trace_id"])
    conf, at = F.col("confidence_score"), F.col("extracted_at")
    trust = [
        F.when(_valid_confidence(conf), -conf).otherwise(F.lit(1.0)),
        F.when(at.isNotNull(), -F.unix_micros(at.cast("timestamp")).cast("double")).otherwise(F.lit(float("inf"))),
    ]
    args = (
        cat,
        {"document_id": F.col("document_id"), "name_key": F.coalesce(alnum_key("instruction_name"), F.lit("")), "variation_key": alnum_key("variation")},
        F.col("trace_id"),
        trust,
        {"name": (F.col("instruction_name"), F.lit(True)), "opcode": (F.col("opcode_raw"), readable_number(F.col("opcode_raw")))},
    )
    out = trusted_survivors(*args, keep=keep) if fall is None else consensus_survivors(*args, fall=fall, keep=keep)
    return out.withColumn("opcode_id", F.coalesce("opcode_id", "name_id"))


def p1_survivors(spark: SparkSession, base: str) -> DataFrame:
    """One surviving record per instruction with at least two records, field by field from the most trusted."""
    return _p1(spark, base, ["document_id"]).select("document_id", "group_id", "name_id", "name", "opcode_id", "opcode")


def p1_consensus(spark: SparkSession, base: str) -> DataFrame:
    """The same by the plain vote: every record has one vote, trust decides ties only."""
    return _p1(spark, base, ["document_id"], 1.0).select("document_id", "group_id", "name_id", "name", "opcode_id", "opcode")


def p1_found(spark: SparkSession, base: str) -> DataFrame:
    return _p1(spark, base, []).select(
        F.col("group_id").alias("group_trace_id"), F.col("name_id").alias("name_trace_id"), F.col("opcode_id").alias("opcode_trace_id")
    )


def page_text(spark: SparkSession, base: str) -> DataFrame:
    """Blocks with their place on the page and whether they were read optically."""
    method = F.lower(F.coalesce(F.col("extraction_method"), F.lit("")))
    return table(spark, base, "page_blocks").select(
        "document_id", "page", "block_id", F.col("bbox.y0").alias("top"), method.rlike(r"ocr|full_page").alias("is_ocr"), F.col("raw_text").alias("text")
    )


def p4_found(spark: SparkSession, base: str) -> DataFrame:
    return noisy_lines(page_text(spark, base))


def p4_repaired(spark: SparkSession, base: str) -> DataFrame:
    return repair_blocks(page_text(spark, base))


def _p6(spark: SparkSession, base: str) -> tuple[DataFrame, str, list[Column], list[Column]]:
    rows = table(spark, base, "instruction_field_map").select(
        "trace_id", "document_id", "variation", "word_index", "instruction_name", "field_name", "bit_range"
    )
    c = F.col
    exact = [c("document_id"), c("variation"), c("word_index")]
    canonical = [*unordered(canonical_name(c("instruction_name")), canonical_name(c("field_name"))), canonical_parts(c("bit_range"))]
    return rows, "trace_id", exact, canonical


def p6_found(spark: SparkSession, base: str) -> DataFrame:
    return format_copies(*_p6(spark, base)).select(F.col("keep").alias("keep_trace_id"), F.col("copy").alias("copy_trace_id"))


def p6_collapsed(spark: SparkSession, base: str) -> DataFrame:
    return format_collapsed(*_p6(spark, base))


def p7_containers(spark: SparkSession, base: str) -> DataFrame:
    return packed_documents(table(spark, base, "documents").select("doc_id", "text"), "doc_id", "text", 2048)


def p7_roundtrip(spark: SparkSession, base: str) -> DataFrame:
    """What the containers hold, put together again: each text whole, no container overfull, every fill as stated."""
    docs = table(spark, base, "documents").select("doc_id", "text")
    packed = materialize(packed_documents(docs, "doc_id", "text", 2048), "containers")
    fills = packed.groupBy("container").agg(F.sum("n_tokens").alias("held"), F.min("fill").alias("lo"), F.max("fill").alias("hi"))
    wrong = fills.filter("held > 2048 OR held <> lo OR held <> hi").select("container")
    parts = packed.join(wrong.withColumn("_wrong", F.lit(True)), "container", "left").groupBy("doc_id").agg(
        F.array_sort(F.collect_list(F.struct("piece", "start", "end"))).alias("spans"), F.count("_wrong").alias("n_misfilled")
    )
    return _put_together(docs.join(parts, "doc_id"), "n_misfilled")


def p9_roundtrip(spark: SparkSession, base: str) -> DataFrame:
    """The pieces without their overlaps, put together again: each text whole, no piece above the limit."""
    docs = table(spark, base, "documents").select("doc_id", "text")
    pieces = split_documents(docs, "doc_id", "text", 512, 64, all_texts=True)
    parts = pieces.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("piece", "start", "end"))).alias("spans"), F.count_if(F.col("n_tokens") > 512).alias("n_too_long"))
    return _put_together(docs.join(parts, "doc_id"), "n_too_long")


def _put_together(docs: DataFrame, count: str) -> DataFrame:
    """Texts from their spans (those of one text, in order), each from where the one before ended; a gap leaves text out."""
    begin = F.expr("transform(spans, (s, i) -> if(i = 0, s.start, greatest(s.start, spans[i - 1].end)))")
    text = F.array_join(F.transform(F.arrays_zip(begin.alias("a"), F.expr("spans.end").alias("z")), lambda x: F.substring("text", x["a"] + 1, x["z"] - x["a"])), "")
    return docs.filter(F.length("text") > 0).select("doc_id", F.length("text").alias("n_chars"), F.md5(text).alias("digest"), count)


def p8_found(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents").select("doc_id", "text")
    items = table(spark, base, "eval_items").select("item_id", "text")
    return leaked_items(docs, items, "doc_id", "text", "item_id", "text")


def p9_pieces(spark: SparkSession, base: str) -> DataFrame:
    return split_documents(table(spark, base, "documents").select("doc_id", "text"), "doc_id", "text", 512, 64)


QUERIES = {
    "p1_found": p1_found,
    "p1_survivors": p1_survivors,
    "p1_consensus": p1_consensus,
    "p4_found": p4_found,
    "p4_repaired": p4_repaired,
    "p6_found": p6_found,
    "p6_collapsed": p6_collapsed,
    "p7_containers": p7_containers,
    "p8_found": p8_found,
    "p9_pieces": p9_pieces,
    "p7_roundtrip": p7_roundtrip,
    "p9_roundtrip": p9_roundtrip,
}
