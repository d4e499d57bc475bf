"""Filters, orders, windows and aggregates over page blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelode.functions import geometry as G
from pagelode.functions import scalars as S
from pagelode.functions.text import blank_to_null

SUPPLEMENT = "supplemental_corpus"


def resolve_page_range(total: int, first: int | None = None, last: int | None = None) -> tuple[int, int]:
    """Pages asked for, kept within 1..total; ValueError if there are none."""
    if total < 1:
        raise ValueError("a document has at least one page")
    a = 1 if first is None else max(1, min(total, first))
    b = total if last is None else max(1, min(total, last))
    if (first is not None and last is not None and first > last) or a > b:
        raise ValueError("the first page lies after the last")
    return a, b


def filter_pages(blocks: DataFrame, first: int, last: int) -> DataFrame:
    """Blocks of a page range; a plain predicate, pushed down to the scan."""
    return blocks.filter(F.col("page").between(first, last))


def total_pages(blocks: DataFrame) -> DataFrame:
    """(document_id, total_pages): the last page without supplements, else of all blocks, else 1."""
    own = F.max(F.when(~F.coalesce(F.col("extraction_method"), F.lit("")).eqNullSafe(SUPPLEMENT), F.col("page")))
    return blocks.groupBy("document_id").agg(F.coalesce(own, F.max("page"), F.lit(1)).alias("total_pages"))


def drop_margins(blocks: DataFrame, heights: Column, top: float = 0.08, bottom: float = 0.08) -> DataFrame:
    """Without text and equations in the top and bottom margin; ratios are kept within 0..0.3, unknown heights keep all."""
    top, bottom = max(0.0, min(0.3, top)), max(0.0, min(0.3, bottom))
    return blocks.filter(~F.coalesce(in_margin(F.col("block_type"), F.col("bbox"), heights, top, bottom), F.lit(False)))


def in_margin(block_type: Column, bbox: Column, height: Column, top: float, bottom: float) -> Column:
    return block_type.isin("text", "equation") & (height > 0) & ((bbox["y1"] <= height * top) | (bbox["y0"] >= height * (1.0 - bottom)))


def drop_repeated(blocks: DataFrame, min_pages: int = 3, max_chars: int = 200) -> DataFrame:
    """Without short text repeated on at least max(2, ``min_pages``) pages of its document.

    Distinct (text, page) pairs are aggregated before they are counted, so a line on every page
    is one row per page; the join with the few repeated lines adapts to their number.
    """
    keyed = blocks.withColumn("_key", S.repeat_key("raw_text"))
    subject = F.col("block_type").isin("text", "equation") & (F.col("_key") != "") & (F.length("_key") <= max_chars)
    repeated = repeated_lines(blocks, min_pages, max_chars)
    gone = repeated.select(F.col("document_id").alias("_d"), F.col("line").alias("_l"))
    return keyed.join(gone, subject & F.col("document_id").eqNullSafe(F.col("_d")) & (F.col("_key") == F.col("_l")), "left_anti").drop("_key")


def repeated_lines(blocks: DataFrame, min_pages: int = 3, max_chars: int = 200) -> DataFrame:
    """(document_id, line, n_pages) of short texts on at least max(2, ``min_pages``) pages."""
    lines = blocks.filter(F.col("block_type").isin("text", "equation")).select("document_id", "page", S.repeat_key("raw_text").alias("line"))
    lines = lines.filter((F.col("line") != "") & (F.length("line") <= max_chars))
    return lines.groupBy("document_id", "line").agg(F.count_distinct("page").alias("n_pages")).filter(F.col("n_pages") >= max(2, min_pages))


def filter_block_ids(blocks: DataFrame, ids: DataFrame) -> DataFrame:
    """Blocks whose (document_id, block_id), or block_id alone where ids have no document, is wanted."""
    on = ["document_id", "block_id"] if "document_id" in ids.columns else ["block_id"]
    return blocks.join(ids.select(*on).distinct(), on, "left_semi")


def drop_text_in_tables(blocks: DataFrame) -> DataFrame:
    """Without text blocks whose centre lies in a table of their page that covers more than 0.35 of them."""
    tables = blocks.filter("block_type = 'table'").select(F.col("document_id").alias("_d"), F.col("page").alias("_p"), F.col("bbox").alias("_t"))
    on = (F.col("document_id") == F.col("_d")) & (F.col("page") == F.col("_p")) & (F.col("block_type") == "text") & G.covered_by(F.col("bbox"), F.col("_t"))
    return blocks.join(tables, on, "left_anti")


def number_blocks(blocks: DataFrame) -> DataFrame:
    """Block ids ``p{page}_b{n}`` in reading order, tables first."""
    w = Window.partitionBy("document_id", "page").orderBy((F.col("block_type") != "table"), F.col("bbox.y0"), F.col("bbox.x0"), "trace_id")
    n = F.row_number().over(w) - 1
    return blocks.withColumn("block_id", F.concat(F.lit("p"), F.col("page").cast("string"), F.lit("_b"), n.cast("string")))


def tag_equations(blocks: DataFrame) -> DataFrame:
    """Short text blocks that look like formulas become equations, said so in their method."""
    hit = (F.col("block_type") == "text") & S.is_equation("raw_text")
    method = F.concat(F.coalesce(blank_to_null("extraction_method"), F.lit("text_layer")), F.lit("+heuristic_equation"))
    return blocks.withColumns({
        "extraction_method": F.when(hit, method).otherwise(F.col("extraction_method")),
        "block_type": F.when(hit, "equation").otherwise(F.col("block_type")),
    })


def page_metrics(blocks: DataFrame, min_chars: int = 40, image_weight: int = 1) -> DataFrame:
    """Characters and block counts per page, with the reasons to read it optically."""
    kind = F.col("block_type")
    m = blocks.groupBy("document_id", "page").agg(
        F.sum(F.when(kind.isin("text", "equation"), F.length("raw_text")).otherwise(0)).alias("char_count"),
        F.count_if(kind.isin("text", "equation")).alias("text_blocks"),
        F.count_if(kind == "image").alias("image_blocks"),
        F.count_if(kind == "table").alias("table_blocks"),
    )
    reasons = S.ocr_reasons(F.col("char_count"), F.col("text_blocks"), F.col("image_blocks"), F.col("table_blocks"), min_chars, image_weight)
    return m.withColumn("ocr_reasons", reasons).withColumn("needs_ocr", F.size("ocr_reasons") > 0)


def page_extent(blocks: DataFrame) -> DataFrame:
    """Topmost and bottommost edge of the blocks of each page."""
    return blocks.groupBy("document_id", "page").agg(F.min("bbox.y0").alias("min_y"), F.max("bbox.y1").alias("max_y"))


def prompt_order() -> list[Column]:
    """Page, block id and type; ids compare as strings, so ``p1_b10`` comes before ``p1_b2``."""
    return [F.coalesce(F.col("page"), F.lit(0)), F.col("block_id"), F.col("block_type")]


def reading_order() -> list[Column]:
    """Page, top, left; the trace id keeps ties in a fixed order."""
    return [F.col("page"), F.col("bbox.y0"), F.col("bbox.x0"), F.col("trace_id")]


def running_by_page(blocks: DataFrame, within: list[Column], size: Column, out: str) -> DataFrame:
    """Adds ``out``, the running sum of ``size`` over a document in the order of its pages and, on a page, of ``within``.

    A page is summed for itself and moved by the sum of the pages before it, so that a document with a third of all
    rows is ordered page by page in many tasks; only its page sums meet in one. Missing pages come first.
    """
    b = blocks.withColumns({"_pg": F.coalesce("page", F.lit(0)), "_size": size.cast("bigint")})
    on_page = Window.partitionBy("document_id", "_pg").orderBy(*within).rowsBetween(Window.unboundedPreceding, 0)
    sums = b.groupBy("document_id", "_pg").agg(F.sum("_size").alias("_n"))
    before = Window.partitionBy("document_id").orderBy("_pg").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("document_id", "_pg", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    inner = b.withColumn("_r", F.sum("_size").over(on_page))
    return inner.join(offsets, ["document_id", "_pg"]).withColumn(out, F.col("_r") + F.col("_o")).drop("_pg", "_size", "_r", "_o")


def reading_position(blocks: DataFrame) -> DataFrame:
    """Adds ``read_pos`` (from 0) within the document."""
    out = running_by_page(blocks, [F.col("bbox.y0"), F.col("bbox.x0"), F.col("trace_id")], F.lit(1), "read_pos")
    return out.withColumn("read_pos", F.col("read_pos") - 1)


def within_budget(blocks: DataFrame, budget: int = 100_000) -> DataFrame:
    """Blocks whose pieces (header and stripped text, each ending its line), in prompt order, stay within the budget of characters.

    Blank ones take none. A prefix: the running sum only grows, since pieces are never negative.
    """
    text = S.block_prompt(F.col("page"), F.col("block_id"), F.col("block_type"), F.col("raw_text"))
    piece = F.when(text != "", F.concat(text, F.lit("\n"))).otherwise("")
    out = running_by_page(blocks, [*prompt_order()[1:], F.col("trace_id")], F.length(piece), "used_chars").withColumn("piece", piece)
    return out.filter((F.col("piece") != "") & (F.col("used_chars") <= budget))


def prompt_texts(blocks: DataFrame, budget: int = 100_000) -> DataFrame:
    """(document_id, prompt): pieces within the budget, a blank line between them, ``(no text blocks)`` where none fits.

    A prompt is bounded by the budget, so the ordered list that builds it is too.
    """
    kept = within_budget(blocks, budget).groupBy("document_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("used_chars", "piece"))), lambda x: x["piece"]), "\n").alias("prompt")
    )
    docs = blocks.select("document_id").distinct()
    return docs.join(kept, "document_id", "left").select("document_id", F.coalesce("prompt", F.lit("(no text blocks)")).alias("prompt"))


def corpus_chunks(docs: DataFrame, size: int = 6000) -> DataFrame:
    """(document_id, chunk_no, text): whole texts cut into chunks of fixed length; blank texts give none."""
    d = docs.filter(blank_to_null("text").isNotNull())
    n = F.ceil(F.length("text") / F.lit(size)).cast("int")
    e = d.select("document_id", "text", F.explode(F.sequence(F.lit(0), n - 1)).alias("chunk_no"))
    return e.select("document_id", "chunk_no", F.substring("text", F.col("chunk_no") * size + 1, F.lit(size)).alias("text"))


def add_supplement(blocks: DataFrame, chunks: DataFrame) -> DataFrame:
    """Chunks as further blocks of their documents: page 1, ids ``supp_{n}`` going on from the number of blocks."""
    counts = blocks.groupBy("document_id").agg(F.count("*").alias("_n"))
    w = Window.partitionBy("document_id").orderBy("chunk_no")
    extra = chunks.filter(blank_to_null("text").isNotNull()).join(counts, "document_id", "left").select(
        "document_id",
        F.lit(1).alias("page"),
        F.concat(F.lit("supp_"), (F.coalesce("_n", F.lit(0)) + F.row_number().over(w) - 1).cast("string")).alias("block_id"),
        F.lit("text").alias("block_type"),
        F.col("text").alias("raw_text"),
        F.lit(SUPPLEMENT).alias("extraction_method"),
    )
    return blocks.unionByName(extra, allowMissingColumns=True)


def neighbours(blocks: DataFrame) -> DataFrame:
    """Relations between blocks of a page in reading order: (document_id, block_id, type, target)."""
    w = Window.partitionBy("document_id", "page").orderBy("bbox.y0", "bbox.x0", "trace_id")
    n = blocks.select("document_id", "block_id", F.lag("block_id").over(w).alias("above"), F.lead("block_id").over(w).alias("below"))
    return n.select("document_id", "block_id", F.expr("stack(2, 'below', above, 'above', below) AS (type, target)")).filter("target IS NOT NULL")
